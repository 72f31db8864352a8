"""Where layer tables live and how they are read.

A ``Layout`` maps ``(layer, table)`` to ``{root}/{layer}/{table}``; a custom
layer name is used literally (K13).  ``register_views`` exposes Silver as
temporary views recomputed on read (K11) and Gold tables for SQL access by
BI tools through ``spark.sql`` (K16).  ``publish`` switches all Gold tables to a
build by one pointer and ``open_gold`` reads them through it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aulastar.plans.star import GOLD_TABLES, Star
from aulastar.sinks.bronze import read_bronze


def schema_name(custom: str | None, default: str = "public") -> str:
    """A custom layer/schema name is used literally (trimmed), not
    prefixed with the default; without one the default is used."""
    return default if custom is None or not custom.strip() else custom.strip()


@dataclass(frozen=True)
class Layout:
    root: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def path(self, layer: str | None, table: str) -> str:
        return f"{self.root.rstrip('/')}/{schema_name(layer)}/{table}"

    def source(self, spark: SparkSession, table: str, layer: str | None = None) -> DataFrame:
        """A declared source table (Bronze by default) with all its columns."""
        return read_bronze(spark, self.path(layer or self.bronze, table))


def register_views(spark: SparkSession, star: Star, prefix: str = "") -> list[str]:
    """K11 + K16: temp views for the star, e.g. ``SELECT * FROM fact_capacidad_academica``."""
    names = {
        "stg_ies": star.stg_entity, "stg_matriculados_bogota": star.stg_numerator,
        "stg_docentes_bogota": star.stg_denominator, "dim_ies": star.dim_entity,
        "dim_tiempo": star.dim_time, "fact_capacidad_academica": star.fact,
    }
    for n, df in names.items():
        df.createOrReplaceTempView(prefix + n)
    return [prefix + n for n in names]


KEPT_BUILDS = 3


def _database(layout: Layout, build_root: str) -> str:
    name = re.sub(r"[^0-9a-z_]+", "_", build_root.rstrip("/").rsplit("/", 1)[-1].lower())
    return f"{layout.gold}_build_{name}"


def _pointer(spark: SparkSession, layout: Layout) -> list[str]:
    """Databases of the published builds, the current one first."""
    if not spark.catalog.databaseExists(layout.gold):
        return []
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {layout.gold}").collect()}
    found = re.search(rf"\({POINTER},([^)]*)\)", rows.get("Properties") or "")
    return [b for b in found[1].split("|") if b] if found else []


POINTER = "builds"


def publish(spark: SparkSession, build_root: str, layout: Layout, keep: int = KEPT_BUILDS) -> list[str]:
    """K12 + K16: make a finished build the current one.

    A build writes its own folder (``{build_root}/gold/...``) and nothing writes there again; here it gets a database of its own
    (``gold_build_<name>``) whose tables are never repointed.  One pointer, a property of database ``layout.gold``, names the
    current build and is switched in one step, so all tables switch as one: ``open_gold`` reads the pointer once, and whatever is read
    through it is one build's, also while another is published.  A build that fails before this leaves the pointer alone.

    The views ``gold.<table>`` follow the pointer one after the other, for queries of a single table.  The ``keep`` latest builds stay,
    so that readers of an earlier one can finish; the catalog forgets older ones and their folders are deleted."""
    db, own = layout.gold, _database(layout, build_root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{layout.path(db, '_db')}'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {own} COMMENT '{build_root.rstrip('/')}' LOCATION '{layout.path(own, '_db')}'")
    for name in GOLD_TABLES:
        if not spark.catalog.tableExists(f"{own}.{name}"):
            spark.catalog.createTable(f"{own}.{name}", path=f"{build_root.rstrip('/')}/gold/{name}", source="parquet")
    before = [b for b in _pointer(spark, layout) if b != own]
    spark.sql(f"ALTER DATABASE {db} SET DBPROPERTIES ('{POINTER}' = '{'|'.join([own, *before[: max(keep - 1, 0)]])}')")
    out = []
    for name in GOLD_TABLES:
        full = f"{db}.{name}"
        if spark.catalog.tableExists(full) and spark.catalog.getTable(full).tableType != "VIEW":
            spark.sql(f"DROP TABLE {full}")   # of an earlier layout; external, its files stay
        spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT * FROM {own}.{name}")
        out.append(full)
    for old in before[max(keep - 1, 0):]:
        _forget(spark, old)
    return out


def _forget(spark: SparkSession, database: str) -> None:
    """Drop a build's database and delete its folder."""
    if not spark.catalog.databaseExists(database):
        return
    root = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").collect()}["Comment"]
    spark.sql(f"DROP DATABASE {database} CASCADE")
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/gold")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@dataclass(frozen=True)
class Snapshot:
    build: str                       # database of the build
    tables: dict[str, DataFrame]


def open_gold(spark: SparkSession, layout: Layout, views: str | None = None) -> Snapshot:
    """The tables of the current build, by one look at the pointer.  With ``views`` (a prefix) they are the session's temporary
    views as well, so a BI session's SQL joins stay in one build until it opens the next."""
    builds = _pointer(spark, layout)
    if not builds:
        raise LookupError(f"nothing is published in {layout.gold}")
    tables = {name: spark.table(f"{builds[0]}.{name}") for name in GOLD_TABLES}
    for name, df in tables.items():
        if views is not None:
            df.createOrReplaceTempView(views + name)
    return Snapshot(builds[0], tables)
