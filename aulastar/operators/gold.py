"""Gold models: M4 entity dimension, M5 time dimension, M6 fact, J9 orphans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aulastar.config import DOMAIN, StarConfig
from aulastar.functions import (
    decade, default_if_null, guarded_ratio, in_values, is_leap_year, matches_place, quality_flag,
)
from aulastar.operators.relational import semi_filter, union_distinct


def _stamp(as_of: Column | None) -> Column:
    """Audit timestamp: ``CURRENT_TIMESTAMP`` unless the caller pins one."""
    return F.current_timestamp() if as_of is None else as_of


def dim_entity(stg: DataFrame, seed: DataFrame, cfg: StarConfig = DOMAIN,
               seed_key: str | None = None, as_of: Column | None = None) -> DataFrame:
    """M4 (``dim_ies``): entities of the place and kinds, with a membership
    flag from a left lookup join to the seed (C2) and a default for missing
    accreditation (C9).

    ``seed`` should already be size-checked by the caller (see
    :func:`aulastar.sources.seed.read_seed`); only its key column is used.
    """
    c = cfg
    key = seed_key or c.seed_key
    kept = stg.filter(matches_place("departamento_ies", c.place_pattern)
                      & in_values("caracter_ies", c.caracter_values))
    lookup = seed.select(F.col(key).cast("int").alias("__seed_key"))
    joined = kept.join(lookup, kept["codigo_snies"] == lookup["__seed_key"], "left")
    return joined.select(
        "codigo_snies", "nombre_ies", "tipo_ies", "sector_ies", "caracter_ies",
        "departamento_ies", "municipio_ies",
        default_if_null("ies_acreditada", c.default_accredited).alias("ies_acreditada"),
        F.col("__seed_key").isNotNull().alias("es_sue"),
        _stamp(as_of).alias("fecha_ultima_carga"))


def dim_time(*yearly: DataFrame, as_of: Column | None = None) -> DataFrame:
    """M5 (``dim_tiempo``): the years present in the yearly measures (U2),
    with text, decade and leap-year attributes, ordered by year (a tiny
    table: one row per distinct year)."""
    years = union_distinct(*[y.select("anio") for y in yearly]).filter(F.col("anio").isNotNull())
    return (years.select(
                "anio",
                F.col("anio").cast("string").alias("anio_texto"),
                decade("anio").alias("decada"),
                is_leap_year("anio").alias("es_bisiesto"),
                _stamp(as_of).alias("fecha_ultima_carga"))
            .orderBy("anio"))


def fact_ratio(numer: DataFrame, denom: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN,
               as_of: Column | None = None) -> DataFrame:
    """M6 (``fact_capacidad_academica``).

    J1: inner join of the two yearly aggregates on (code, year).  Both sides
    come out of an aggregation hash-partitioned on exactly these keys, so the
    join adds no exchange.  J2: referential filter to the dimension with a
    ``left_semi`` join (the dimension key is unique, so this equals the
    reference's inner join that keeps only fact columns, without any risk of
    duplicating fact rows).  C4 guarded ratio, C5 ordered flag.
    """
    c = cfg
    n, d = c.numerator.total, c.denominator.total
    joined = (numer.select("codigo_snies", "anio", n)
              .join(denom.select("codigo_snies", "anio", d), ["codigo_snies", "anio"], "inner"))
    kept = semi_filter(joined, dim, "codigo_snies")
    return kept.select(
        "codigo_snies", "anio", n, d,
        guarded_ratio(n, d).cast("decimal(23,2)").alias(c.ratio),
        quality_flag(n, d, c.low_denominator, c.low_numerator).alias(c.flag),
        _stamp(as_of).alias("fecha_calculo"))


def orphans(numer: DataFrame, denom: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """(code, year) keys present in only one of the yearly measures,
    with the side they are on (``numerator_only`` / ``denominator_only``)
    and the value they carry.  One full outer join on co-partitioned sides.
    """
    n, d = cfg.numerator.total, cfg.denominator.total
    j = (numer.select("codigo_snies", "anio", n)
         .join(denom.select("codigo_snies", "anio", d), ["codigo_snies", "anio"], "full_outer"))
    return (j.filter(F.col(n).isNull() | F.col(d).isNull())
            .select("codigo_snies", "anio",
                    F.when(F.col(d).isNull(), F.lit("numerator_only"))
                     .otherwise(F.lit("denominator_only")).alias("lado"),
                    F.coalesce(F.col(n), F.col(d)).alias("total")))
