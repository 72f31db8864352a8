"""The three end-to-end flows, as plain function composition.

* ``ingest_year``: year check (S3) -> one read of that year's files ->
  extract + replace-by-file load per profile (S15, K5) -> post-load
  validation (K10: 0 rows fails, 0 rows in the place warns).
* ``backfill_all``: every catalog year x profile (S18) in one read and one
  commit per profile, then the run summary (S19); a failing profile does not
  stop the others.
* ``transform``: seed (S16) -> Silver -> Gold (K12) in a folder of the build's
  own -> the 49 checks (D10), which always run in full (D11) -> if they pass,
  Gold published as catalog tables (K16).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.config import DOMAIN, HEADER_SCAN_ROWS, PROFILES, SourceEntry, StarConfig, default_catalog
from aulastar.operators import quality
from aulastar.operators.relational import persisted
from aulastar.plans.build import BuildResult, build_all
from aulastar.plans.ingest import ProfileLoad, backfill, ingest_profile, log_path
from aulastar.session import path_exists
from aulastar.sinks import bronze as sink
from aulastar.sources.catalog import catalog_frame, validate_year
from aulastar.sources.grid import read_csv_grid, read_csv_head
from aulastar.sources.seed import load_seed
from aulastar.sources.tables import Layout, publish


@dataclass
class YearIngest:
    anio: int
    loads: list[ProfileLoad]
    validation: list  # one row per profile: perfil, anio, total, en_lugar, status


class LoadValidationError(ValueError):
    pass


def _files(landing: str, entries: Sequence[SourceEntry]) -> list[str]:
    return [f"{landing.rstrip('/')}/{e.filename}" for e in entries]


def _read(spark: SparkSession, files: list[str], entries: Sequence[SourceEntry]) -> tuple[DataFrame, DataFrame]:
    """The files' grid, and its rows down to the last that can be a header."""
    rows = max([HEADER_SCAN_ROWS, *(e.header_row + 1 for e in entries if e.header_row is not None)])
    return read_csv_grid(spark, files), read_csv_head(spark, files, rows)


def ingest_year(spark: SparkSession, landing: str, root: str, anio: int, run_id: str,
                entries: Sequence[SourceEntry] | None = None, cfg: StarConfig = DOMAIN) -> YearIngest:
    entries = list(default_catalog(landing, ".csv") if entries is None else entries)
    y = validate_year(anio, entries)
    year_entries = [e for e in entries if e.anio == y]
    cat = catalog_frame(spark, year_entries)
    loads, errors = [], {}
    grid, head = _read(spark, _files(landing, year_entries), year_entries)
    for e in sorted(year_entries, key=lambda e: e.perfil):  # profiles are independent loads
        try:
            loads.append(ingest_profile(grid, cat, PROFILES[e.perfil], root, run_id, head=head))
        except Exception as exc:  # noqa: BLE001 - the other profile still loads; reported below
            errors[e.perfil] = str(exc)
    errors |= {pl.profile: pl.error for pl in loads if pl.error}
    if errors:
        raise LoadValidationError(f"ingest of {y} failed for {sorted(errors)}: {errors}")
    checks = []
    for pl in loads:
        b = sink.read_bronze(spark, sink.table_path(root, "bronze", PROFILES[pl.profile].table))
        files = [e.filename for e in year_entries if e.perfil == pl.profile]
        row = sink.validate_load(b, y, cfg.place, cfg.place_pattern, cfg.year, files=files).first()
        checks.append({"perfil": pl.profile, **row.asDict()})
    failed = [c for c in checks if c["status"] == "fail"]
    if failed:
        raise LoadValidationError(f"no rows loaded for {[c['perfil'] for c in failed]} in {y}")
    return YearIngest(y, loads, checks)


def backfill_all(spark: SparkSession, landing: str, root: str, run_id: str,
                 entries: Sequence[SourceEntry] | None = None) -> tuple[list[ProfileLoad], DataFrame]:
    entries = list(default_catalog(landing, ".csv") if entries is None else entries)
    present = [e for e in entries if path_exists(spark, f"{landing.rstrip('/')}/{e.filename}")]
    missing = [e for e in entries if e not in present]
    if missing:  # a missing file fails only its own load; the summary counts it
        sink.log_events(spark, log_path(root), [
            dict(log_id=str(uuid.uuid4()), run_id=run_id, perfil=e.perfil, anio=e.anio, source_url=e.url,
                 source_file=e.filename, status="failed", error="source file not found") for e in missing])
    loads = []
    if present:
        grid, head = _read(spark, _files(landing, present), present)
        loads = backfill(grid, catalog_frame(spark, present), root, run_id, head=head)
    status = sink.ingestion_status(spark.read.parquet(log_path(root))).filter(F.col("dag_run_id") == run_id)
    return loads, sink.backfill_summary(status)


def transform(spark: SparkSession, root: str, seed_path: str, cfg: StarConfig = DOMAIN,
              fail_on_checks: bool = True, publish_gold: bool = True) -> BuildResult:
    lay = Layout(root)
    tables = [PROFILES[p].table for p in ("matriculados", "docentes")]
    if not all(path_exists(spark, lay.path(lay.bronze, t)) for t in tables):
        raise FileNotFoundError("both Bronze tables must be loaded before the transform")
    m, d = (lay.source(spark, t) for t in tables)
    # seed --full-refresh: replace the stored seed table, then read it back
    seed = load_seed(spark, seed_path, lay.path(lay.silver, "ies_sue"))
    stage = f"{root.rstrip('/')}/builds/{uuid.uuid4().hex}"   # this build's own folder
    res = build_all(m, d, seed, stage, cfg, quality_root=root)
    if fail_on_checks:
        quality.assert_suite(res.summary)
    if publish_gold:
        publish(spark, stage, lay)
    return res
