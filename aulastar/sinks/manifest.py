"""The commit manifest of a Bronze table.

``{table path}_manifest`` is an append-only table beside the data: one row per load and file with the rows it wrote, its run and the table's
columns at the time.  It is written once the data are committed and read instead of them: how many rows a file holds, and which columns the
table has, are questions to a table of a few rows a load.  The latest row of a file counts, so a load that is repeated counts once.

A load opens no partition but its own: ``stored_rows`` lists and reads the folders of the named files alone."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aulastar.config import LINEAGE_COLUMNS
from aulastar.session import path_exists

SCHEMA = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("committed_at", T.TimestampType()),
])


def manifest_path(table: str) -> str:
    return f"{table.rstrip('/')}_manifest"


def read_manifest(spark: SparkSession, table: str) -> DataFrame | None:
    path = manifest_path(table)
    return spark.read.schema(SCHEMA).parquet(path) if path_exists(spark, path) else None


def commit(spark: SparkSession, table: str, entries: Sequence[tuple[str, str, int, str]], columns: Sequence[str]) -> None:
    """Append ``(load_id, source_file, rows, run_id)`` entries (one small write for all of them)."""
    if not entries:
        return
    own = [c for c in columns if c not in LINEAGE_COLUMNS]
    rows = spark.createDataFrame([(*e, own, None) for e in entries], SCHEMA)
    rows.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(manifest_path(table))


def current(manifest: DataFrame) -> DataFrame:
    """``(source_file, rows, run_id, load_id, committed_at)`` as the latest load of each file left it; the choice combines map-side."""
    latest = manifest.groupBy("source_file").agg(F.max(F.struct("committed_at", "load_id", "rows", "run_id")).alias("m"))
    return latest.select("source_file", "m.rows", "m.run_id", "m.load_id", "m.committed_at")


def known_columns(manifest: DataFrame) -> list[str]:
    """Data columns of the table in the order in which loads brought them (K2): distinct names only reach the driver."""
    named = manifest.select("committed_at", "load_id", F.posexplode("columns").alias("pos", "name"))
    first = named.groupBy("name").agg(F.min(F.struct("committed_at", "load_id", "pos")).alias("at")).orderBy("at")
    return [r["name"] for r in first.select("name").collect()]


def partition_folder(spark: SparkSession, table: str, source_file: str) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{table.rstrip('/')}/_source_file={escape(source_file)}"


def stored_rows(spark: SparkSession, table: str, files: Iterable[str]) -> DataFrame | None:
    """``(_row_hash, _dag_run_id, _source_file)`` of the named files, from their own folders."""
    folders = [p for f in files if path_exists(spark, p := partition_folder(spark, table, f))]
    if not folders:
        return None
    schema = "_row_hash string, _dag_run_id string, _source_file string"
    return spark.read.schema(schema).option("basePath", table).parquet(*folders)


def stored_columns(spark: SparkSession, table: str, files: Iterable[str]) -> list[str]:
    """Data columns of the named files (of one load, which have the same), from one of their footers."""
    folder = next(p for f in files if path_exists(spark, p := partition_folder(spark, table, f)))
    return [c for c in spark.read.option("basePath", table).parquet(folder).columns if c not in LINEAGE_COLUMNS]


def adopt(spark: SparkSession, table: str) -> None:
    """Give a table that was written without one its manifest; the only place where footers are merged."""
    rows = spark.read.option("mergeSchema", "true").parquet(table)
    counts = rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"), F.max("_dag_run_id").alias("run_id"))
    columns = F.array(*[F.lit(c) for c in rows.columns if c not in LINEAGE_COLUMNS])
    counts.select(F.concat(F.lit("adopted-"), "_source_file").alias("load_id"), F.col("_source_file").alias("source_file"), "rows", "run_id", columns.alias("columns"),
                  F.current_timestamp().alias("committed_at")).write.mode("append").parquet(manifest_path(table))


def unfinished(log: DataFrame, perfil: str, stale_after: str) -> DataFrame:
    """``running`` events of loads that nothing has closed since, older than ``stale_after`` (an interval): a driver that died."""
    w = Window.partitionBy("id")   # a load has a handful of events
    open_ = log.filter(F.col("perfil") == perfil).withColumn("__closed", F.max(F.col("status") != "running").over(w))
    return open_.filter((F.col("status") == "running") & ~F.col("__closed")
                        & (F.col("event_at") < F.current_timestamp() - F.expr(f"INTERVAL {stale_after}"))).drop("__closed")
