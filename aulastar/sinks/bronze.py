"""Bronze sink and ingestion log: K1-K10, K15.

Layout: one parquet table per profile at ``{root}/bronze/{table}``,
partitioned by ``_source_file``.  A load replaces exactly the files it
carries (dynamic partition overwrite) and leaves the others alone, so
reloading never accumulates rows (K3).  Schema evolution is additive: a new
file may bring new columns, which older files read as null (K2).  The write is
one Spark commit per load, so a failed load leaves no half-written file behind.
Then the load adds its rows to the table's manifest
(:mod:`aulastar.sinks.manifest`), which knows the rows of every file and the
columns of the table: neither a load nor a read opens another file's partition.

The ingestion log is an append-only event table (``running`` -> ``success``
/ ``failed``); the status of a load is its latest event (K9).  A load whose
driver died stays ``running`` until the next one closes it (``recover_loads``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulastar.config import LINEAGE_COLUMNS
from aulastar.functions import matches_place, truncate
from aulastar.session import path_exists
from aulastar.sinks import manifest

LOG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("dag_run_id", T.StringType()),
    T.StructField("perfil", T.StringType()),
    T.StructField("anio", T.IntegerType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("rows_ingested", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("event_at", T.TimestampType()),
])


def bronze_schema(data_columns: Sequence[str]) -> T.StructType:
    """K1: every data column is text; lineage columns are typed."""
    fields = [T.StructField(c, T.StringType()) for c in data_columns if c not in LINEAGE_COLUMNS]
    fields += [
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_source_url", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_row_hash", T.StringType()),
        T.StructField("_dag_run_id", T.StringType()),
    ]
    return T.StructType(fields)


def table_path(root: str, layer: str, table: str) -> str:
    """A custom layer name is used literally as the folder."""
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """K2: every column that any load brought, as the manifest (or the caller's
    ``schema``, e.g. ``bronze_schema(columns)``) knows them; columns a file
    lacks read as null.  No footers are merged.  A table written without a
    manifest reads with the columns of its files (``manifest.adopt`` gives it
    one).  ``None`` when the table does not exist yet."""
    if not path_exists(spark, path):
        return None
    if schema is None:
        known = manifest.read_manifest(spark, path)
        if known is None:
            return spark.read.parquet(path)
        schema = bronze_schema(manifest.known_columns(known))
    part = T.StructField("_source_file", T.StringType())
    fields = [f for f in schema.fields if f.name != "_source_file"] + [part]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def conform(df: DataFrame) -> DataFrame:
    """Cast data columns to text and lineage columns to their types (K1)."""
    schema = bronze_schema(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _log_rows(spark, events) -> DataFrame:
    return spark.createDataFrame(events, LOG_SCHEMA)


def log_events(spark: SparkSession, log_path: str, events: Sequence[dict]) -> None:
    """K6/K7/K8: append events (one small write for all of them); messages
    are cut to 2,000 characters.  Keys: log_id, run_id, perfil, anio,
    source_url, source_file, status, rows, error."""
    rows = []
    for e in events:
        err = e.get("error")
        rows.append((e["log_id"], e["run_id"], e["perfil"], e.get("anio"), e.get("source_url"), e["source_file"],
                     e.get("rows"), e["status"], err, None))
    if rows:
        _log_rows(spark, rows).withColumns({"event_at": F.current_timestamp(), "error_message": truncate("error_message")}).coalesce(1) \
            .write.mode("append").parquet(log_path)


@dataclass
class LoadResult:
    status: str
    perfil: str
    anio: int | None
    source_file: str
    rows_deleted: int
    rows_inserted: int


class EmptyLoadError(ValueError):
    """Files that yielded no rows; ``loaded`` has the results of the others."""

    def __init__(self, message: str, loaded: Sequence[LoadResult] = ()):
        super().__init__(message)
        self.loaded = list(loaded)


def _rows_by_file(spark: SparkSession, path: str, files: Sequence[str], run_id: str | None = None) -> dict[str, int]:
    """Stored rows of the named files (of one run), counted in their own
    partitions: one row per file to the driver."""
    rows = manifest.stored_rows(spark, path, files)
    if rows is None:
        return {}
    if run_id is not None:
        rows = rows.filter(F.col("_dag_run_id") == run_id)
    return {r["_source_file"]: int(r["n"]) for r in rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n")).collect()}


def _rows_before(spark: SparkSession, path: str, names: DataFrame, files: Sequence[str]) -> dict[str, int]:
    """Rows of the named files before a load: what the manifest says, or a
    count of their own partitions in a table without one."""
    known = manifest.read_manifest(spark, path)
    if known is None:
        return _rows_by_file(spark, path, files)
    mine = known.join(names.withColumnRenamed("_source_file", "source_file"), "source_file", "left_semi")
    return {r["source_file"]: int(r["rows"]) for r in manifest.current(mine).select("source_file", "rows").collect()}


def replace_files(data: DataFrame, path: str) -> set[str]:
    """K3: replace the files that ``data`` has rows of, in one commit; returns
    them.  The write observes them: a file without rows is not touched by the
    dynamic overwrite and still holds an earlier load."""
    obs = Observation("bronze_load")
    (data.observe(obs, F.collect_set("_source_file").alias("files")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_source_file").parquet(path))
    return set(obs.get["files"] or [])


def load_to_bronze(df: DataFrame, path: str, log_path: str, perfil: str, run_id: str,
                   anio: int | None = None, files: Sequence[tuple[str, str | None]] | None = None
                   ) -> list[LoadResult]:
    """K5: log start -> look up the rows being replaced -> replace the files the
    frame carries -> count rows written -> add them to the manifest -> log
    success (or failure, then re-raise).  Returns one result per source file.

    ``files`` lists ``(source_file, source_url)`` or ``(source_file,
    source_url, year)`` when the caller knows them (the catalog does);
    otherwise one extra pass finds them.  An empty input
    raises before touching data; a file that yields no rows is logged as
    failed and raises after the commit (a dynamic overwrite with no rows for
    a file keeps that file's old rows).
    """
    spark = df.sparkSession
    df = conform(df)
    if files is None:
        files = [(r["_source_file"], r["_source_url"]) for r in
                 df.select("_source_file", "_source_url").distinct().collect()]  # one row per file
    years = {t[0]: (t[2] if len(t) > 2 else anio) for t in files}
    files = [(t[0], t[1]) for t in files]
    if not files:
        raise EmptyLoadError(f"nothing to load for {perfil}: the frame has no rows")
    ids = {f: str(uuid.uuid4()) for f, _ in files}

    def ev(f, url, status, **kw):
        return dict(log_id=ids[f], run_id=run_id, perfil=perfil, anio=years[f], source_url=url, source_file=f,
                    status=status, **kw)

    log_events(spark, log_path, [ev(f, url, "running") for f, url in files])
    try:
        names = spark.createDataFrame([(f,) for f, _ in files], "_source_file string")
        deleted = _rows_before(spark, path, names, [f for f, _ in files])
        wrote = replace_files(df.join(names, "_source_file", "left_semi").select(*df.columns), path)
        inserted = _rows_by_file(spark, path, sorted(wrote))
        manifest.commit(spark, path, [(ids[f], f, n, run_id) for f, n in sorted(inserted.items())], df.columns)
    except Exception as e:  # K8: log and re-raise
        log_events(spark, log_path, [ev(f, url, "failed", error=str(e)) for f, url in files])
        raise
    out, empty, events = [], [], []
    for f, url in files:
        n = int(inserted.get(f, 0))
        if n == 0:
            empty.append(f)
            events.append(ev(f, url, "failed", error="the file yielded no rows; previous rows kept"))
            continue
        events.append(ev(f, url, "success", rows=n))
        out.append(LoadResult("success", perfil, years[f], f, int(deleted.get(f, 0)), n))
    log_events(spark, log_path, events)
    if empty:
        raise EmptyLoadError(f"no rows for {empty}; previous rows kept", out)
    return out


def recover_loads(spark: SparkSession, path: str, log_path: str, perfil: str, stale_after: str = "6 hours") -> int:
    """Close the loads of ``perfil`` whose driver died: ``success`` where the
    data were committed, else ``failed``.  Returns how many were closed.

    A load is committed if the manifest has it, or if its files' partitions
    hold rows of its run (it died before the manifest, which then gets them).
    Loads younger than ``stale_after`` may still run and are left alone; one
    closed too early corrects that itself, as the latest event counts."""
    if not path_exists(spark, log_path):
        return 0
    dead = manifest.unfinished(spark.read.schema(LOG_SCHEMA).parquet(log_path), perfil, stale_after).collect()  # files of dead loads
    if not dead:
        return 0
    known = manifest.read_manifest(spark, path)
    wanted = spark.createDataFrame([(r["id"],) for r in dead], "load_id string")
    rows = {} if known is None else {r["load_id"]: r["rows"] for r in known.join(wanted, "load_id", "left_semi").select("load_id", "rows").collect()}
    lost = [r for r in dead if r["id"] not in rows]
    for run in sorted({r["dag_run_id"] for r in lost}):
        mine = [r for r in lost if r["dag_run_id"] == run]
        found = _rows_by_file(spark, path, [r["source_file"] for r in mine], run)
        late = [(r["id"], r["source_file"], found[r["source_file"]], run) for r in mine if r["source_file"] in found]
        if late:
            manifest.commit(spark, path, late, manifest.stored_columns(spark, path, [e[1] for e in late]))
            rows |= {e[0]: e[2] for e in late}
    log_events(spark, log_path, [
        dict(log_id=r["id"], run_id=r["dag_run_id"], perfil=perfil, anio=r["anio"], source_url=r["source_url"], source_file=r["source_file"],
             status="success" if r["id"] in rows else "failed", rows=rows.get(r["id"]),
             error=None if r["id"] in rows else "the load ended without a commit") for r in dead])
    return len(dead)


def ingestion_status(log: DataFrame) -> DataFrame:
    """K9: the latest event of every load (``id``): when, how many rows,
    whether it failed.  A load has at most a handful of events, so the
    window groups are bounded."""
    rank = F.when(F.col("status") == "running", 0).otherwise(1)
    w = Window.partitionBy("id").orderBy(F.col("event_at").desc(), rank.desc())
    started = log.filter(F.col("status") == "running").select("id", F.col("event_at").alias("started_at"))
    latest = log.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return (latest.join(started, "id", "left")
            .select("id", "dag_run_id", "perfil", "anio", "source_url", "source_file", "rows_ingested", "status",
                    "error_message", "started_at",
                    F.when(F.col("status") != "running", F.col("event_at")).alias("finished_at")))


def load_history(status: DataFrame) -> DataFrame:
    """K9 questions per (profile, year): when it was last loaded with
    success, how many rows that load wrote, and whether any load of it
    failed.  One aggregate over the status table."""
    ok = F.col("status") == "success"
    return (status.groupBy("perfil", "anio")
            .agg(F.max(F.when(ok, F.col("finished_at"))).alias("ultima_carga"),
                 F.max_by(F.when(ok, F.col("rows_ingested")), F.when(ok, F.col("finished_at"))).alias("filas"),
                 F.count_if(F.col("status") == "failed").alias("cargas_fallidas"),
                 F.count(F.lit(1)).alias("cargas")))


def validate_load(bronze: DataFrame, anio: int, place_col: str, pattern: str, year_col: str = "anio",
                  files: Sequence[str] | None = None) -> DataFrame:
    """Rows of the year and rows of the place, in one pass.  ``status``
    is ``fail`` for 0 rows and ``warn`` for 0 rows in the place.  With the
    year's ``files`` (known from the catalog) only their ``_source_file``
    partitions are read."""
    if files is not None:
        bronze = bronze.filter(F.col("_source_file").isin(list(files)))
    g = (bronze.filter(F.col(year_col) == str(anio))
         .agg(F.count(F.lit(1)).alias("total"),
              F.count_if(matches_place(place_col, pattern)).alias("en_lugar")))
    return g.select(F.lit(anio).alias("anio"), "total", "en_lugar",
                    F.when(F.col("total") == 0, F.lit("fail"))
                     .when(F.col("en_lugar") == 0, F.lit("warn")).otherwise(F.lit("ok")).alias("status"))


def duplicate_audit(bronze: DataFrame) -> DataFrame:
    """Row hashes seen more than once, with their count and files.

    Two passes: 64-bit keys of all hashes are counted (a row of two longs per
    key and map task in the shuffle instead of the 32-character hash), then
    the rows whose key was met again, and only those, are counted by the hash
    itself, which tells hashes of one key apart."""
    key = F.xxhash64("_row_hash").alias("__key")
    again = bronze.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("__key")
    candidates = bronze.select("_row_hash", "_source_file", key).join(again, "__key", "left_semi")
    return (candidates.groupBy("_row_hash")
            .agg(F.count(F.lit(1)).alias("n_records"),
                 F.array_sort(F.collect_set("_source_file")).alias("files"))
            .filter(F.col("n_records") > 1))


def backfill_summary(status: DataFrame) -> DataFrame:
    """Successes, failures and rows inserted over the latest status of
    every load."""
    return status.agg(F.count_if(F.col("status") == "success").alias("tareas_exitosas"),
                      F.count_if(F.col("status") != "success").alias("tareas_fallidas"),
                      F.coalesce(F.sum(F.when(F.col("status") == "success", F.col("rows_ingested"))), F.lit(0))
                      .cast("bigint").alias("filas_totales"))
