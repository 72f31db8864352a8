"""Binding of the domain onto the driver's TPC-H-like tables.

The driver's tables hold no institution data, so the registered queries run
the same operators on a surrogate built by Spark from them (every input grows
with the tables):

==========================  ==================================================
Domain concept              Surrogate
==========================  ==================================================
enrolment raw rows          lineitem ⋈ orders ⋈ customer ⋈ nation, one row per
                            line item, every data column cast to text
teacher raw rows            orders ⋈ customer ⋈ nation with status <> 'O',
                            measure '1' per order
entity code                 ``c_name`` (``Customer#000000012`` parses to 12)
entity name                 ``o_orderpriority``
kind / sector / caracter    ``l_linestatus`` / ``o_orderstatus`` / ``c_mktsegment``
department / town           ``n_name`` / nation key as text
accreditation               'Si' when ``o_totalprice`` > 300000, else missing
year / semester             year of ``o_orderdate`` / 1 for Jan-Jun, else 2
measure (enrolment)         ``l_quantity`` as integer text
load time ``_ingested_at``  ``o_orderdate``
source file                 ``<profile>_<year>.parquet``
seed (member set)           ``supplier.s_suppkey``
place pattern               ``NATION_1%`` (11 of 25 nations)
accepted kinds              BUILDING, MACHINERY
==========================  ==================================================
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.config import MeasureSpec, StarConfig
from aulastar.functions import row_hash
from aulastar.session import BUILD_LOCK, path_exists, remove_at_exit, shared_path

TPCH = StarConfig(
    place_pattern="NATION_1%",
    caracter_values=("BUILDING", "MACHINERY"),
    caracter_accepted=("BUILDING", "MACHINERY"),
    sector_canon=(("Final", ("F",)), ("Open", ("O",))),
    sector_accepted=("Final", "Open"),
    low_denominator=2,
    low_numerator=100,
    accepted_years=tuple(range(1995, 2002)),
    focus_year=2000,
    pivot_first_year=1995,
    pivot_last_year=2000,
    best_min_denominator=3,
    outlier_high=200,
    outlier_low=60,
    seed_key="s_suppkey",
    numerator=MeasureSpec("matriculados", "total_matriculados"),
    denominator=MeasureSpec("docentes", "total_docentes"),
)

# Fixed "now" for freshness checks over the surrogate load times.
TPCH_AS_OF = "2002-01-01 00:00:00"

BRONZE_DATA_COLUMNS = (
    "codigo_institucion", "institucion_educacion_superior_ies", "tipo_ies", "sector_ies", "caracter_ies",
    "departamento_domicilio_ies", "municipio_domicilio_ies", "ies_acreditada", "anio", "semestre",
)


# Customer keys divisible by these have such measures.
NEGATIVE_NUMERATOR, ZERO_NUMERATOR, ZERO_DENOMINATOR = 17, 13, 11


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of wide text that one task sorts by file as it writes Bronze (about 800 bytes each).
TASK_ROWS = 400_000


def _dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df`` by ``key`` over as many tasks as ``rows`` rows take, however many shuffle partitions the session has."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), key)


def _entity_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with their customer and nation.  Customers grow with the orders, so they are never broadcast.  A price takes part
    only as the accreditation it stands for: of all columns its digits are those that no codec makes smaller in a shuffle."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
                                              F.when(F.col("o_totalprice") > 300000, F.lit("Si")).alias("ies_acreditada"))
    return o.join(_entity_side(spark, sf_dir).hint("merge"), F.col("o_custkey") == F.col("c_custkey"))


def _entity_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left")


def _text_columns(profile: str) -> list:
    year = F.year("o_orderdate").cast("string")
    return [
        F.col("c_name").alias("codigo_institucion"),
        F.col("o_orderpriority").alias("institucion_educacion_superior_ies"),
        F.col("tipo").alias("tipo_ies"),
        F.col("o_orderstatus").alias("sector_ies"),
        F.col("c_mktsegment").alias("caracter_ies"),
        F.col("n_name").alias("departamento_domicilio_ies"),
        F.col("c_nationkey").cast("string").alias("municipio_domicilio_ies"),
        F.col("ies_acreditada"),
        year.alias("anio"),
        F.when(F.month("o_orderdate") <= 6, F.lit("1")).otherwise(F.lit("2")).alias("semestre"),
    ]


def _lineage(profile: str) -> list:
    data = list(BRONZE_DATA_COLUMNS) + [profile]
    return [
        row_hash(data).alias("_row_hash"),
        F.col("o_orderdate").alias("_ingested_at"),
        F.lit(f"tpch://{profile}").alias("_source_url"),
        F.concat(F.lit(f"{profile}_"), F.year("o_orderdate").cast("string"), F.lit(".parquet")).alias("_source_file"),
        F.lit("surrogate").alias("_dag_run_id"),
    ]


def surrogate_enrolment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolment raw rows: one per line item (all data columns text).  By rule
    on the customer key, some entities have only negative measures (dropped by
    M2, so their teacher rows are orphans) and some only zeros."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", F.col("l_linestatus").alias("tipo"))
    n = li.count()   # from the footers
    # what the customer key says is worked out before the orders are dealt
    fixed = (F.when(F.col("c_custkey") % NEGATIVE_NUMERATOR == 0, F.lit("-5"))
             .when(F.col("c_custkey") % ZERO_NUMERATOR == 0, F.lit("0")))
    o = _dealt(_entity_orders(spark, sf_dir).withColumn("fixed", fixed), n, "o_orderkey")
    rows = _dealt(li, n, "l_orderkey").join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    measure = F.coalesce("fixed", F.col("l_quantity").cast("int").cast("string"))
    data = _text_columns("matriculados") + [measure.alias("matriculados")]
    return rows.select(*data, "o_orderdate").select(*BRONZE_DATA_COLUMNS, "matriculados", *_lineage("matriculados"))


def surrogate_teachers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teacher raw rows: one per order that is not open, measure '1', or '0'
    for some entities (a zero denominator)."""
    n = table(spark, sf_dir, "orders").count()   # from the footers
    measure = F.when(F.col("c_custkey") % ZERO_DENOMINATOR == 0, F.lit("0")).otherwise(F.lit("1"))
    closed = _entity_orders(spark, sf_dir).filter(F.col("o_orderstatus") != "O").withColumn("docentes", measure)
    rows = _dealt(closed, n, "o_orderkey").withColumn("tipo", F.lit("F"))
    data = _text_columns("docentes") + [F.col("docentes")]
    return rows.select(*data, "o_orderdate").select(*BRONZE_DATA_COLUMNS, "docentes", *_lineage("docentes"))


def surrogate_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed lookup: member keys from the supplier table."""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("s_suppkey"),
                                                   F.col("s_name").alias("nombre_oficial"),
                                                   F.col("s_name").alias("universidad_sue"))


def _code_version() -> str:
    """Hash of the package sources: stored intermediate tables are never
    reused across code changes."""
    h = hashlib.sha1()
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for folder, _, names in sorted(os.walk(pkg)):
        for n in sorted(names):
            if n.endswith(".py"):
                with open(os.path.join(folder, n), "rb") as f:
                    h.update(n.encode() + f.read())
    return h.hexdigest()[:12]


CODE_VERSION = _code_version()


def fingerprint(sf_dir: str, spark: SparkSession | None = None) -> str:
    """Identity of the inputs (size and modification time of every input
    table, through the Hadoop FileSystem of the path, so it works on any
    storage) plus the package source hash."""
    parts = [CODE_VERSION]
    names = ("lineitem", "orders", "customer", "nation", "supplier")
    if spark is None:
        spark = SparkSession.getActiveSession()
    for name in names:
        p = f"{sf_dir.rstrip('/')}/{name}.parquet"
        try:
            sc = spark.sparkContext
            jp = sc._jvm.org.apache.hadoop.fs.Path(p)
            fs = jp.getFileSystem(sc._jsc.hadoopConfiguration())
            total, newest = 0, 0
            for st in fs.listStatus(jp):
                total += st.getLen()
                newest = max(newest, st.getModificationTime())
            parts.append(f"{p}:{total}:{newest}")
        except Exception:  # noqa: BLE001 - unknown inputs never match a stored table
            parts.append(f"{p}:{os.urandom(8).hex()}")
    return hashlib.sha1("|".join(parts).encode()).hexdigest()[:16]


def bronze_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """The two surrogate Bronze tables.

    Bronze is a stored layer: the surrogate is written once per application
    and input fingerprint under the shared checkpoint folder, partitioned by
    ``_source_file`` like the Bronze sink, and read back from parquet
    (column pruning and filter push-down then apply to every query).  Most of
    its bytes are the hexadecimal row hash, which zstd halves and snappy keeps.
    """
    if not materialize:
        return surrogate_enrolment(spark, sf_dir), surrogate_teachers(spark, sf_dir)
    # keyed by application too: no two processes ever write the same folder
    root = shared_path(spark, "aulastar-bronze", spark.sparkContext.applicationId, fingerprint(sf_dir, spark))
    out = []
    with BUILD_LOCK:
        for name, build in (("matriculados_raw", surrogate_enrolment), ("docentes_raw", surrogate_teachers)):
            path = f"{root}/{name}"
            if not path_exists(spark, f"{path}/_SUCCESS"):
                (build(spark, sf_dir).write.mode("overwrite").option("partitionOverwriteMode", "static")
                 .option("compression", "zstd").partitionBy("_source_file").parquet(path))
                remove_at_exit(spark, path)
            out.append(spark.read.parquet(path))
    return out[0], out[1]
