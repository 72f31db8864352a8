"""The dependency-ordered transform, ``seed -> silver -> gold -> test``.

``build_all`` materialises Gold under ``{root}/gold`` (K12), then runs the
declared quality suite over the stored tables (the suite always runs in
full, D11) and returns the summary.  The caller decides whether a failing
suite is fatal (``assert_suite``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from aulastar.config import DOMAIN, StarConfig
from aulastar.operators import quality
from aulastar.operators.relational import persisted
from aulastar.plans.star import Star, build_star, materialize_gold


@dataclass
class BuildResult:
    star: Star
    summary: DataFrame


def build_all(numer_raw: DataFrame, denom_raw: DataFrame, seed: DataFrame, root: str,
              cfg: StarConfig = DOMAIN, as_of: Column | None = None,
              seed_columns=("codigo_snies", "nombre_oficial", "universidad_sue"),
              bronze_names=("matriculados_raw", "docentes_raw"), quality_root: str | None = None) -> BuildResult:
    lazy = build_star(numer_raw, denom_raw, seed, cfg, as_of)
    # Silver feeds three Gold tables and 20 checks: compute it once per build
    with persisted(lazy.stg_entity, lazy.stg_numerator, lazy.stg_denominator) as (stg, m, d):
        silver = Star(stg, m, d, seed, lazy.dim_entity, lazy.dim_time, lazy.fact)
        star = materialize_gold(silver, root, cfg, as_of)
        checks = quality.declared_checks(dict(zip(bronze_names, (numer_raw, denom_raw))), stg, m, d, seed,
                                         star.dim_entity, star.dim_time, star.fact, cfg, seed_columns)
        summary = quality.run_suite(checks, quality_root)  # runs while Silver is held
    return BuildResult(star, summary)
