"""Cell grids derived from the driver's tables, for the ingest queries.

* ``documents_grid``: every document is a "file", every line a row, every
  space-separated word a cell (whole texts).  ``WORD_ALIASES`` plays the
  role of the header alias table for header detection and mapping.
* ``orders_grid``: the orders of every year exported as a spreadsheet-like
  file ``pedidos_<year>.csv``: a title row, a header row (mixed case with
  line breaks in even years at row 2; upper case with one extra column in
  odd years at row 4), one data row per order at ``10 + o_orderkey`` and a
  "Total" footer.  Cell edge cases follow rules on the order's priority:
  ``1-URGENT`` codes get a leading space (junk row, dropped), ``3-MEDIUM``
  measures are the token ``nan``, ``4-NOT SPECIFIED`` measures are padded
  with spaces, ``5-LOW`` measures are blank.  The catalog declares a wrong
  header row for 1999, so that file goes through header detection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.config import IngestProfile
from aulastar.plans.bindings import table
from aulastar.sources.grid import spread, text_grid

# Fixed values of the documents binding: word "headers" and their names.
WORD_ALIASES = {
    "THE": "articulo_en",
    "AND": "conjuncion_en",
    "OF": "preposicion_en",
    "TO": "a_en",
    "DE": "preposicion_es",
    "LA": "articulo_es",
    "EL": "articulo_m_es",
    "QUE": "que_es",
    "LE": "articulo_fr",
    "ET": "conjuncion_fr",
    "LES": "plural_fr",
    "DER": "articulo_de",
    "UND": "conjuncion_de",
    "DIE": "articulo_f_de",
}
WORD_REQUIRED = ("articulo_en", "preposicion_en", "articulo_es")

DOCS_PROFILE = IngestProfile(name="palabras", table="palabras_raw", aliases=WORD_ALIASES,
                             required=WORD_REQUIRED, measure="articulo_en", key="articulo_en")

# Header texts of the orders export (spreadsheet style, mapped by the
# domain aliases).
HEADER_EVEN = ("Código de \nla Institución", "Institución de Educación Superior (IES)", "Sector IES",
               "Departamento de\ndomicilio de la IES", "Año", "Semestre", "Matriculados", "Carácter IES")
HEADER_ODD = ("CÓDIGO DE LA INSTITUCIÓN", "INSTITUCIÓN DE EDUCACIÓN SUPERIOR (IES)", "SECTOR IES",
              "DEPARTAMENTO DE DOMICILIO DE LA IES", "AÑO", "SEMESTRE", "MATRICULADOS", "CARÁCTER IES",
              "COLUMNA NUEVA")
WRONG_HEADER_YEAR = 1999


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, dealt over the cores where its scan has fewer
    partitions (the text work per row is CPU-heavy)."""
    return spread(table(spark, sf_dir, "documents"))


def documents_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return text_grid(docs, F.concat(F.lit("doc_"), F.col("doc_id").cast("string")), "text", "\n", " ")


def _year_file(year):
    return F.concat(F.lit("pedidos_"), year.cast("string"), F.lit(".csv"))


def orders_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                              "o_orderpriority", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # customers grow with the orders and the grid is read several times: they are never broadcast, so none goes through the driver
    rows = o.join(c.hint("merge"), o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    year = F.year("o_orderdate")
    prio = F.col("o_orderpriority")
    qty = F.floor(F.col("o_totalprice") / 1000).cast("bigint").cast("string")
    code = F.when(prio == "1-URGENT", F.concat(F.lit(" "), F.col("o_custkey").cast("string"))) \
        .otherwise(F.col("o_custkey").cast("string"))
    measure = (F.when(prio == "3-MEDIUM", F.lit("nan"))
               .when(prio == "4-NOT SPECIFIED", F.concat(F.lit(" "), qty, F.lit(" ")))
               .when(prio == "5-LOW", F.lit(""))
               .otherwise(qty))
    base = [code, prio, F.col("o_orderstatus"), F.col("n_name"), year.cast("string"),
            F.when(F.month("o_orderdate") <= 6, F.lit("1")).otherwise(F.lit("2")), measure, F.col("c_mktsegment")]
    cells = F.when(year % 2 == 0, F.array(*base)).otherwise(
        F.array(*base, F.col("o_orderkey").cast("string")))
    data = rows.select(_year_file(year).alias("source_file"), (F.col("o_orderkey") + 10).alias("row_idx"),
                       cells.alias("cells"))
    per_year = rows.groupBy(year.alias("y")).agg(
        F.max("o_orderkey").alias("last_key"),
        F.sum(F.floor(F.col("o_totalprice") / 1000)).cast("bigint").alias("total"))
    f = _year_file(F.col("y"))
    null = F.lit(None).cast("string")
    title = F.struct(F.lit(0).cast("bigint").alias("row_idx"),
                     F.array(F.concat(F.lit("Pedidos "), F.col("y").cast("string"))).alias("cells"))
    header = F.struct(F.when(F.col("y") % 2 == 0, F.lit(2)).otherwise(F.lit(4)).cast("bigint").alias("row_idx"),
                      F.when(F.col("y") % 2 == 0, F.array(*[F.lit(h) for h in HEADER_EVEN]))
                       .otherwise(F.array(*[F.lit(h) for h in HEADER_ODD])).alias("cells"))
    footer = F.struct((F.col("last_key") + 11).alias("row_idx"),
                      F.array(F.lit("Total"), null, null, null, null, null, F.col("total").cast("string")).alias("cells"))
    # three rows per year
    meta = (per_year.select(f.alias("source_file"), F.explode(F.array(title, header, footer)).alias("m"))
            .select("source_file", "m.row_idx", "m.cells"))
    return data.unionByName(meta)


def orders_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog derived from the years present in ``orders``."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("anio")).distinct()
    declared = (F.when(F.col("anio") == WRONG_HEADER_YEAR, F.lit(1))
                .when(F.col("anio") % 2 == 0, F.lit(2)).otherwise(F.lit(4)))
    return years.select(
        F.col("anio").cast("int").alias("anio"), F.lit("matriculados").alias("perfil"),
        F.lit("1.").alias("sheet_name"), declared.cast("int").alias("header_row"),
        _year_file(F.col("anio")).alias("filename"),
        F.concat(F.lit("tpch://orders/"), F.col("anio").cast("string")).alias("url"))
