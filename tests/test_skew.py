"""A code holding a third of all rows: results stay exact and the plans cut
the hot group down before the shuffle (partial aggregate / partial window
limit)."""

import contextlib
import io

from pyspark.sql import functions as F

from aulastar.config import DOMAIN
from aulastar.operators import silver
from conftest import BOG, RAW_COLUMNS


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hot_raw(spark, measure, n=30000):
    ids = spark.range(n)
    code = F.when(F.col("id") % 3 == 0, F.lit("1101")).otherwise((F.col("id") % 500 + 2000).cast("string"))
    cols = {c: F.lit(v) for c, v in {
        "institucion_educacion_superior_ies": "U", "tipo_ies": "Principal", "sector_ies": "Oficial",
        "caracter_ies": "Universidad", "departamento_domicilio_ies": BOG, "municipio_domicilio_ies": "B",
        "ies_acreditada": "Si"}.items()}
    return ids.select(code.alias("codigo_institucion"),
                      *[cols[c].alias(c) for c in RAW_COLUMNS[1:8]],
                      (2022 + F.col("id") % 3).cast("string").alias("anio"),
                      (1 + F.col("id") % 2).cast("string").alias("semestre"),
                      F.lit("2").alias(measure))


def test_hot_code_yearly_measure(spark):
    m = hot_raw(spark, "matriculados")
    out = silver.yearly_measure(m, DOMAIN.numerator)
    hot = out.filter("codigo_snies = 1101").collect()
    assert len(hot) == 1 and hot[0].total_matriculados == 20000 and hot[0].registros_fuente == 10000
    p = plan(out)
    assert "partial_sum" in p


def test_hot_code_latest_attributes(spark):
    m = hot_raw(spark, "matriculados")
    d = hot_raw(spark, "docentes")
    stg = silver.stg_entity([m, d])
    assert stg.filter("codigo_snies = 1101").count() == 1
    assert stg.count() == 1 + 500
    p = plan(stg)
    assert "WindowGroupLimit" in p and "Partial" in p
