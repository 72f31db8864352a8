"""Ingest plans: S15 + K5 per profile, S18 backfill, S19 summary.

Unlike a per-(year, profile) task loop, one profile's files are extracted
and written in a single distributed read and a single commit; the catalog
decides which files belong to the profile.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulastar.config import PROFILES, IngestProfile
from aulastar.operators.ingest import ResolvedHeaders, extract, mapped_report, map_columns, header_cells
from aulastar.sinks.bronze import EmptyLoadError, LoadResult, load_to_bronze, log_events, recover_loads, table_path


@dataclass
class ProfileLoad:
    profile: str
    results: list[LoadResult]
    headers: ResolvedHeaders
    error: str | None = None


def ingest_profile(grid: DataFrame, catalog: DataFrame, profile: IngestProfile, root: str, run_id: str,
                   ingested_at: Column | None = None, head: DataFrame | None = None) -> ProfileLoad:
    """Extract every catalog file of ``profile`` from the grid and replace
    those files in ``{root}/bronze/{profile.table}``; log under
    ``{root}/bronze/ingestion_log``.  ``head`` is the beginning of the grid,
    where it can be read alone.  A file without a usable header or
    without rows fails alone: it is logged ``failed`` and named in ``error``,
    the others are loaded.  Earlier loads whose driver died are closed first."""
    recover_loads(grid.sparkSession, table_path(root, "bronze", profile.table), log_path(root), profile.name)
    rows, resolved = extract(grid, catalog, profile, run_id, ingested_at, strict=False, head=head)
    files = [(r["filename"], r["url"], r["anio"]) for r in
             catalog.filter(F.col("perfil") == profile.name).select("filename", "url", "anio").collect()]  # catalog
    bad = [f for f in files if f[0] in resolved.errors]
    log_events(grid.sparkSession, log_path(root), [
        dict(log_id=str(uuid.uuid4()), run_id=run_id, perfil=profile.name, anio=y, source_url=u, source_file=f,
             status="failed", error=resolved.errors[f]) for f, u, y in bad])
    out = ProfileLoad(profile.name, [], resolved)
    problems = [f"{f}: {m}" for f, m in sorted(resolved.errors.items())]
    good = [f for f in files if f[0] not in resolved.errors]
    if good:
        try:
            out.results = load_to_bronze(rows, table_path(root, "bronze", profile.table), log_path(root), profile.name,
                                         run_id, files=good)
        except EmptyLoadError as e:  # the files with rows are loaded
            problems.append(str(e))
            out.results = e.loaded
    out.error = "\n".join(problems) or None
    return out


def log_path(root: str) -> str:
    # no leading underscore: Spark's file listing hides such names
    return table_path(root, "bronze", "ingestion_log")


def backfill(grid: DataFrame, catalog: DataFrame, root: str, run_id: str,
             profiles: dict[str, IngestProfile] | None = None, ingested_at: Column | None = None,
             head: DataFrame | None = None) -> list[ProfileLoad]:
    """Every year x every profile of the catalog; a failing profile is
    recorded and the others still run (the summary fires regardless)."""
    profiles = PROFILES if profiles is None else profiles
    wanted = {r["perfil"] for r in catalog.select("perfil").distinct().collect()}  # catalog-sized
    out = []
    for name in sorted(wanted):
        if name not in profiles:
            continue
        try:
            out.append(ingest_profile(grid, catalog, profiles[name], root, run_id, ingested_at, head))
        except Exception as e:  # noqa: BLE001 - summary reports it
            out.append(ProfileLoad(name, [], None, str(e)))  # type: ignore[arg-type]
    return out


def header_report(grid: DataFrame, headers: ResolvedHeaders, profile: IngestProfile) -> DataFrame:
    """S8 for resolved headers: mapped/total cells per file."""
    return mapped_report(map_columns(header_cells(grid, headers.frame), profile.aliases))
