"""BI marts B1-B15 over the Gold star (fact + entity dimension).

Every mart is a function ``(fact, dim, cfg) -> DataFrame``.  The star join
(J4) is a plain equi-join: the dimension has one row per entity, and the
planner (AQE with runtime sizes) turns it into a broadcast when the
dimension is small, or keeps a shuffle join when it is not.

Sorts write their null placement explicitly (nulls sort as the largest value: ASC nulls
last, DESC nulls first).  Top-k marts add the entity code as a last sort key,
so equal values at the border give the same rows on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aulastar import config as K
from aulastar.config import DOMAIN, StarConfig
from aulastar.functions import bool_label, exact_avg, outlier_category, pct_change, ratio_of_sums, trend_label
from aulastar.operators.percentiles import group_stats, percentiles
from aulastar.operators.relational import share_of_total

DIM_COLUMNS = ("codigo_snies", "nombre_ies", "sector_ies", "caracter_ies", "es_sue")


def star(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """``fact JOIN dim USING (codigo_snies)``."""
    return fact.join(dim.select(*DIM_COLUMNS), "codigo_snies")


def b1_all_ratios(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    c = cfg
    return (star(fact, dim).filter(F.col(c.flag) == K.FLAG_OK)
            .select("nombre_ies", "sector_ies", "es_sue", "anio", c.numerator.total, c.denominator.total, c.ratio)
            .orderBy(F.col("anio").desc_nulls_first(), F.col(c.ratio).desc_nulls_first()))


def _top(fact: DataFrame, dim: DataFrame, cfg: StarConfig, ascending: bool, k: int,
         min_denominator: int | None) -> DataFrame:
    c = cfg
    s = star(fact, dim).filter((F.col("anio") == c.focus_year) & (F.col(c.flag) == K.FLAG_OK))
    if min_denominator is not None:
        s = s.filter(F.col(c.denominator.total) >= min_denominator)
    r = F.col(c.ratio).asc_nulls_last() if ascending else F.col(c.ratio).desc_nulls_first()
    return (s.orderBy(r, F.col("codigo_snies").asc_nulls_last())
            .limit(k)
            .select("nombre_ies", "sector_ies", bool_label("es_sue", K.LABEL_MEMBER_STAR).alias("tipo_sue"),
                    c.numerator.total, c.denominator.total, c.ratio))


def b2_best(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Lowest ratios of the focus year among entities with a size floor."""
    return _top(fact, dim, cfg, True, cfg.top_best, cfg.best_min_denominator)


def b3_worst(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Highest ratios of the focus year."""
    return _top(fact, dim, cfg, False, cfg.top_worst, None)


def b4_member_vs_rest(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Members vs non-members per year, all flags included (A14: grouped on
    the flag, labelled after)."""
    c = cfg
    n, d = c.numerator.total, c.denominator.total
    g = (star(fact, dim).groupBy("anio", "es_sue")
         .agg(F.count(F.lit(1)).alias("num_sedes"),
              F.sum(n).alias("matriculados_total"),
              F.sum(d).alias("docentes_total"),
              ratio_of_sums(n, d).alias("ratio_agregado")))
    return (g.select("anio", bool_label("es_sue", K.LABEL_MEMBER_GROUP, K.LABEL_NON_MEMBER_GROUP).alias("tipo"),
                     "num_sedes", "matriculados_total", "docentes_total", "ratio_agregado")
            .orderBy(F.col("anio").asc_nulls_last(), F.col("tipo").asc_nulls_last()))


def b5_member_evolution(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Members' ratios with the change against the previous available year
    (W2).  The window is partitioned by entity, whose group is bounded by
    the number of years."""
    c = cfg
    w = Window.partitionBy("codigo_snies").orderBy(F.col("anio").asc_nulls_last())
    s = star(fact, dim).filter(F.col("es_sue"))
    prev = F.lag(c.ratio).over(w)
    return (s.select("nombre_ies", "anio", c.numerator.total, c.denominator.total, c.ratio,
                     pct_change(c.ratio, prev).alias("variacion_pct_vs_anio_anterior"))
            .orderBy(F.col("nombre_ies").asc_nulls_last(), F.col("anio").asc_nulls_last()))


def b6_first_vs_last(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Ratio in the first and last pivot years per entity, delta and trend
    (A8 conditional-aggregate pivot, A10 group by the unprojected code)."""
    c = cfg
    first, last = f"ratio_{c.pivot_first_year}", f"ratio_{c.pivot_last_year}"
    g = (star(fact, dim).filter(F.col(c.flag) == K.FLAG_OK)
         .groupBy("codigo_snies", "nombre_ies", "sector_ies", "es_sue")
         .agg(F.max(F.when(F.col("anio") == c.pivot_first_year, F.col(c.ratio))).alias(first),
              F.max(F.when(F.col("anio") == c.pivot_last_year, F.col(c.ratio))).alias(last)))
    return (g.filter(F.col(first).isNotNull() & F.col(last).isNotNull())
            .select("nombre_ies", "sector_ies", first, last,
                    F.round(F.col(last) - F.col(first), 2).alias("delta"),
                    trend_label(first, last).alias("tendencia"))
            .orderBy(F.col("delta").asc_nulls_last()))


def b7_by_sector(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    c = cfg
    return (star(fact, dim).filter((F.col("anio") == c.focus_year) & (F.col(c.flag) == K.FLAG_OK))
            .select("sector_ies", "caracter_ies", "nombre_ies", c.ratio, c.numerator.total, c.denominator.total)
            .orderBy(F.col("sector_ies").asc_nulls_last(), F.col(c.ratio).asc_nulls_last()))


def b8_largest(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Largest entities of the focus year with their share of the year's
    total (W3, computed before the limit, over all flags)."""
    c = cfg
    n = c.numerator.total
    s = star(fact, dim).filter(F.col("anio") == c.focus_year)
    s = share_of_total(s, n, "porcentaje_matriculados")
    return (s.orderBy(F.col(n).desc_nulls_first(), F.col("codigo_snies").asc_nulls_last())
            .limit(c.top_largest)
            .select("nombre_ies", "sector_ies", bool_label("es_sue", K.LABEL_MEMBER_MARK).alias("sue"),
                    n, c.denominator.total, c.ratio, "porcentaje_matriculados"))


def b9_kpis(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Yearly KPIs."""
    c = cfg
    n, d, r = c.numerator.total, c.denominator.total, c.ratio
    return (star(fact, dim).filter(F.col(c.flag) == K.FLAG_OK)
            .groupBy("anio")
            .agg(F.count_distinct("codigo_snies").alias("num_universidades"),
                 F.count_distinct(F.when(F.col("es_sue"), F.col("codigo_snies"))).alias("num_sue"),
                 F.sum(n).alias("total_matriculados"),
                 F.sum(d).alias("total_docentes"),
                 ratio_of_sums(n, d).alias("ratio_promedio_ponderado"),
                 exact_avg(r).alias("ratio_promedio_simple"),
                 F.round(F.min(r), 2).alias("ratio_minimo"),
                 F.round(F.max(r), 2).alias("ratio_maximo"))
            .orderBy(F.col("anio").asc_nulls_last()))


def b10_outliers(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Extreme ratios or non-ok flags, with a category."""
    c = cfg
    r, fl = F.col(c.ratio), F.col(c.flag)
    return (star(fact, dim).filter((r > c.outlier_high) | (r < c.outlier_low) | (fl != K.FLAG_OK))
            .select("nombre_ies", "sector_ies", "anio", c.numerator.total, c.denominator.total, c.ratio, c.flag,
                    outlier_category(c.ratio, c.flag, c.outlier_high, c.outlier_low).alias("categoria"))
            .orderBy(F.col("anio").desc_nulls_first(), r.desc_nulls_first()))


def b11_members(dim: DataFrame) -> DataFrame:
    """Audit: member entities."""
    return (dim.filter(F.col("es_sue"))
            .select("codigo_snies", "nombre_ies", "sector_ies", "es_sue")
            .orderBy(F.col("codigo_snies").asc_nulls_last()))


def b12_last_refresh(fact: DataFrame, dim: DataFrame, fact_ts: str = "fecha_calculo",
                     dim_ts: str = "fecha_ultima_carga") -> DataFrame:
    """Audit: latest refresh of the fact and, as an uncorrelated scalar
    subquery (J7), of the dimension."""
    d = dim.agg(F.max(dim_ts)).scalar()
    return fact.agg(F.max(fact_ts).alias("ultima_calculo_fact")).select("*", d.alias("ultima_carga_dim"))


def b13_coverage(fact: DataFrame) -> DataFrame:
    """Audit: distinct entities per year."""
    return (fact.groupBy("anio").agg(F.count_distinct("codigo_snies").alias("num_ies"))
            .orderBy(F.col("anio").asc_nulls_last()))


def b14_summary_stats(fact: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Yearly count, mean, median and quartiles of the ratio (A9 exact
    continuous percentiles).

    Ratios have two decimals, so percentiles run on integer hundredths, by
    selection (:mod:`aulastar.operators.percentiles`): its state doesn't grow
    with the values of a year.  Interpolation and rounding are DECIMAL (half
    away from zero).
    """
    c = cfg
    ok = fact.filter(F.col(c.flag) == K.FLAG_OK).select("anio", c.ratio, (F.col(c.ratio) * 100).cast("bigint").alias("__cents"))
    stats = group_stats(ok, "anio", "__cents", F.count(F.lit(1)).alias("num_ies"), exact_avg(c.ratio).alias("promedio"))
    at = percentiles(ok, stats, "anio", "__cents", ("0.5", "0.25", "0.75")).withColumnRenamed("anio", "__anio")
    q = [F.round(F.col(f"p{i}").cast("decimal(38,4)") / 100, 2).alias(n) for i, n in enumerate(("mediana", "p25", "p75"))]
    return (stats.join(at, F.col("anio").eqNullSafe(F.col("__anio")), "left").select("anio", "num_ies", "promedio", *q)
            .orderBy(F.col("anio").asc_nulls_last()))


def b15_member_ratios(fact: DataFrame, dim: DataFrame, cfg: StarConfig = DOMAIN) -> DataFrame:
    """Members' ratios per year (the README's variant of B5)."""
    c = cfg
    return (star(fact, dim).filter(F.col("es_sue"))
            .select("nombre_ies", "anio", c.numerator.total, c.denominator.total, c.ratio)
            .orderBy(F.col("nombre_ies").asc_nulls_last(), F.col("anio").asc_nulls_last()))

