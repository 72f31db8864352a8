"""Silver models: M1 entity dimension with latest attributes, M2/M3 yearly
measures.  All are lazy DataFrames (the reference keeps Silver as views)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.config import DOMAIN, MeasureSpec, StarConfig
from aulastar.functions import canonicalize, in_values, matches_place, safe_int
from aulastar.operators.relational import latest_per_key

STG_ENTITY_COLUMNS = (
    "codigo_snies", "nombre_ies", "tipo_ies", "sector_ies", "caracter_ies",
    "departamento_ies", "municipio_ies", "ies_acreditada", "anio_ultimo_registro",
)


def _attribute_rows(raw: DataFrame, cfg: StarConfig) -> DataFrame:
    c = cfg
    return (raw.filter(F.col(c.code).isNotNull() & F.col(c.name).isNotNull())
            .select(c.code, c.name, c.kind, c.sector, c.caracter, c.place, c.town, c.accredited, c.year))


def stg_entity(raws: list[DataFrame], cfg: StarConfig = DOMAIN) -> DataFrame:
    """M1 (``stg_ies``): one row per raw code with its latest attributes.

    Attribute rows of every raw table are unioned; the row with the highest
    parsed year wins, then the lowest name, then the remaining attributes
    (all ascending, nulls last) so that the choice is the same on every run.
    The order names every attribute, so rows that tie are equal.  Each task
    keeps its first row per code (``WindowGroupLimit``) before the only
    exchange: no attribute row but a task's latest of its code is shuffled.
    """
    c = cfg
    rows = _attribute_rows(raws[0], c)
    for r in raws[1:]:
        rows = rows.unionByName(_attribute_rows(r, c))
    order = [safe_int(c.year).desc_nulls_last(), F.col(c.name).asc_nulls_last()]
    order += [F.col(x).asc_nulls_last() for x in (c.kind, c.sector, c.caracter, c.place, c.town, c.accredited, c.year)]
    latest = latest_per_key(rows, c.code, order)
    return (latest
            .select(
                safe_int(c.code).alias("codigo_snies"),
                F.col(c.name).alias("nombre_ies"),
                F.col(c.kind).alias("tipo_ies"),
                canonicalize(c.sector, c.sector_canon).alias("sector_ies"),
                F.col(c.caracter).alias("caracter_ies"),
                F.col(c.place).alias("departamento_ies"),
                F.col(c.town).alias("municipio_ies"),
                F.col(c.accredited).alias("ies_acreditada"),
                safe_int(c.year).alias("anio_ultimo_registro"))
            .filter(F.col("codigo_snies").isNotNull()))


def yearly_measure(raw: DataFrame, measure: MeasureSpec, cfg: StarConfig = DOMAIN) -> DataFrame:
    """M2/M3: parse, keep rows of the place and the entity kinds, sum the
    measure per (code, year).

    Output: codigo_snies int, anio int, <measure.total> bigint,
    registros_fuente bigint, semestres_presentes bigint.  Partial
    aggregation runs before the shuffle, so a hot code costs one row per map
    task (per semester for the distinct count).
    """
    c = cfg
    parsed = (raw.filter(F.col(c.code).isNotNull() & F.col(c.year).isNotNull())
              .select(safe_int(c.code).alias("codigo_snies"),
                      safe_int(c.year).alias("anio"),
                      safe_int(c.semester).alias("semestre"),
                      safe_int(measure.raw).alias("__m"),
                      F.col(c.place), F.col(c.caracter)))
    kept = parsed.filter(
        matches_place(c.place, c.place_pattern)
        & in_values(c.caracter, c.caracter_values)
        & F.col("codigo_snies").isNotNull()
        & F.col("anio").isNotNull()
        & F.col("__m").isNotNull()
        & (F.col("__m") >= 0))
    return (kept.groupBy("codigo_snies", "anio")
            .agg(F.sum("__m").cast("bigint").alias(measure.total),
                 F.count(F.lit(1)).alias("registros_fuente"),
                 F.count_distinct("semestre").alias("semestres_presentes")))
