"""K14 dependency-ordered build of the star, as function composition.

``build_star`` returns lazy DataFrames (Silver as views, K11).  ``build_all``
materialises Gold as parquet tables replaced on each run (K12), reading the
written tables back so every downstream mart and check starts from storage
instead of recomputing the Bronze scans (the reference recomputes each
Silver view once per Gold model).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from aulastar.config import DOMAIN, StarConfig
from aulastar.operators import gold, silver
from aulastar.operators.relational import persisted


@dataclass
class Star:
    stg_entity: DataFrame
    stg_numerator: DataFrame
    stg_denominator: DataFrame
    seed: DataFrame
    dim_entity: DataFrame
    dim_time: DataFrame
    fact: DataFrame


def build_star(numer_raw: DataFrame, denom_raw: DataFrame, seed: DataFrame, cfg: StarConfig = DOMAIN,
               as_of: Column | None = None) -> Star:
    """seed -> silver (M1, M2, M3) -> gold (M4, M5, M6), lazily."""
    stg = silver.stg_entity([numer_raw, denom_raw], cfg)
    m = silver.yearly_measure(numer_raw, cfg.numerator, cfg)
    d = silver.yearly_measure(denom_raw, cfg.denominator, cfg)
    dim = gold.dim_entity(stg, seed, cfg, as_of=as_of)
    tiempo = gold.dim_time(m, d, as_of=as_of)
    fact = gold.fact_ratio(m, d, dim, cfg, as_of=as_of)
    return Star(stg, m, d, seed, dim, tiempo, fact)


def write_table(df: DataFrame, path: str, sort_within: list[str] | None = None) -> DataFrame:
    """Replace a Gold table and read it back."""
    spark = df.sparkSession
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)  # O6: layout only
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


def materialize_gold(star: Star, root: str, cfg: StarConfig = DOMAIN, as_of: Column | None = None) -> Star:
    """Write dim_ies, dim_tiempo and the fact under ``{root}/gold`` and
    return a Star whose Gold members read the written tables.

    The two yearly aggregates feed both dim_tiempo and the fact, so they are
    persisted for the duration of the build (recomputed from lineage if an
    executor is lost).  The dimension is written first; the fact's
    referential filter reads the stored dimension.
    """
    root = root.rstrip("/")
    with persisted(star.stg_numerator, star.stg_denominator) as (m, d):
        dim = write_table(star.dim_entity, f"{root}/gold/dim_ies")
        tiempo = write_table(gold.dim_time(m, d, as_of=as_of), f"{root}/gold/dim_tiempo", ["anio"])
        fact = write_table(gold.fact_ratio(m, d, dim, cfg, as_of=as_of), f"{root}/gold/fact_capacidad_academica")
    return Star(star.stg_entity, star.stg_numerator, star.stg_denominator, star.seed, dim, tiempo, fact)


GOLD_TABLES = ("dim_ies", "dim_tiempo", "fact_capacidad_academica")
SILVER_TABLES = ("stg_ies", "stg_matriculados", "stg_docentes")


def materialize_all(star: Star, root: str, cfg: StarConfig = DOMAIN, as_of: Column | None = None) -> Star:
    """Write Silver (3 tables) and Gold (3 tables) once; every member of the
    returned Star reads a stored table."""
    root = root.rstrip("/")
    stg = write_table(star.stg_entity, f"{root}/silver/{SILVER_TABLES[0]}")
    m = write_table(star.stg_numerator, f"{root}/silver/{SILVER_TABLES[1]}")
    d = write_table(star.stg_denominator, f"{root}/silver/{SILVER_TABLES[2]}")
    dim = write_table(gold.dim_entity(stg, star.seed, cfg, as_of=as_of), f"{root}/gold/dim_ies")
    tiempo = write_table(gold.dim_time(m, d, as_of=as_of), f"{root}/gold/dim_tiempo", ["anio"])
    fact = write_table(gold.fact_ratio(m, d, dim, cfg, as_of=as_of), f"{root}/gold/fact_capacidad_academica")
    return Star(stg, m, d, star.seed, dim, tiempo, fact)


def read_all(spark, seed: DataFrame, root: str) -> Star:
    root = root.rstrip("/")
    stg, m, d = (spark.read.parquet(f"{root}/silver/{t}") for t in SILVER_TABLES)
    dim, tiempo, fact = (spark.read.parquet(f"{root}/gold/{t}") for t in GOLD_TABLES)
    return Star(stg, m, d, seed, dim, tiempo, fact)

