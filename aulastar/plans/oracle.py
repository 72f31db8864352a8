"""Independent SQL (DuckDB dialect) for the registered queries.

Written directly against the driver's tables; no Spark code is reused.
Exact two-decimal arithmetic is done in integer hundredths ("cents") and
rounded half away from zero with ``(2x + d) // (2d)``, because DuckDB turns
DECIMAL division into DOUBLE.  Results are DOUBLE (cents / 100.0).
"""

from __future__ import annotations

from aulastar.plans.bindings import NEGATIVE_NUMERATOR, TPCH, TPCH_AS_OF, ZERO_DENOMINATOR, ZERO_NUMERATOR

C = TPCH


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values)


def safe(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_replace(COALESCE({x}, ''), '[^0-9-]', '', 'g'), '') AS INTEGER)"


def _sector(x: str) -> str:
    parts = " ".join(f"WHEN upper({x}) IN ({_list(v)}) THEN {_q(k)}" for k, v in C.sector_canon)
    return f"CASE {parts} ELSE {x} END"


def _half_up(num: str, den: str) -> str:
    """round(num/den) half away from zero, num >= 0, den > 0, integers."""
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


def _signed_half_up(num: str, den: str) -> str:
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


RAW = f"""
ent AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
m_raw AS (
  SELECT c_name AS codigo_institucion, o_orderpriority AS institucion_educacion_superior_ies,
         l_linestatus AS tipo_ies, o_orderstatus AS sector_ies, c_mktsegment AS caracter_ies,
         n_name AS departamento_domicilio_ies, CAST(c_nationkey AS VARCHAR) AS municipio_domicilio_ies,
         CASE WHEN o_totalprice > 300000 THEN 'Si' END AS ies_acreditada,
         CAST(year(o_orderdate) AS VARCHAR) AS anio,
         CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END AS semestre,
         CASE WHEN c_custkey % {NEGATIVE_NUMERATOR} = 0 THEN '-5' WHEN c_custkey % {ZERO_NUMERATOR} = 0 THEN '0'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS matriculados,
         o_orderdate AS _ingested_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN ent ON o_custkey = c_custkey
),
d_raw AS (
  SELECT c_name AS codigo_institucion, o_orderpriority AS institucion_educacion_superior_ies,
         'F' AS tipo_ies, o_orderstatus AS sector_ies, c_mktsegment AS caracter_ies,
         n_name AS departamento_domicilio_ies, CAST(c_nationkey AS VARCHAR) AS municipio_domicilio_ies,
         CASE WHEN o_totalprice > 300000 THEN 'Si' END AS ies_acreditada,
         CAST(year(o_orderdate) AS VARCHAR) AS anio,
         CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END AS semestre,
         CASE WHEN c_custkey % {ZERO_DENOMINATOR} = 0 THEN '0' ELSE '1' END AS docentes,
         o_orderdate AS _ingested_at
  FROM orders JOIN ent ON o_custkey = c_custkey
  WHERE o_orderstatus <> 'O'
)"""


def _yearly(raw: str, measure: str, total: str, name: str) -> str:
    return f"""
{name}_p AS (
  SELECT {safe('codigo_institucion')} AS codigo_snies, {safe('anio')} AS anio, {safe('semestre')} AS semestre,
         {safe(measure)} AS v, departamento_domicilio_ies, caracter_ies
  FROM {raw} WHERE codigo_institucion IS NOT NULL AND anio IS NOT NULL
),
{name} AS (
  SELECT codigo_snies, anio, CAST(SUM(v) AS BIGINT) AS {total}, COUNT(*) AS registros_fuente,
         COUNT(DISTINCT semestre) AS semestres_presentes
  FROM {name}_p
  WHERE upper(departamento_domicilio_ies) LIKE {_q(C.place_pattern)}
    AND caracter_ies IN ({_list(C.caracter_values)})
    AND codigo_snies IS NOT NULL AND anio IS NOT NULL AND v IS NOT NULL AND v >= 0
  GROUP BY codigo_snies, anio
)"""


_ATTR = ("codigo_institucion, institucion_educacion_superior_ies, tipo_ies, sector_ies, caracter_ies, "
         "departamento_domicilio_ies, municipio_domicilio_ies, ies_acreditada, anio")

STAR = RAW + "," + _yearly("m_raw", "matriculados", "total_matriculados", "stg_m") + "," + \
    _yearly("d_raw", "docentes", "total_docentes", "stg_d") + f""",
attr AS (
  SELECT {_ATTR} FROM m_raw WHERE codigo_institucion IS NOT NULL AND institucion_educacion_superior_ies IS NOT NULL
  UNION
  SELECT {_ATTR} FROM d_raw WHERE codigo_institucion IS NOT NULL AND institucion_educacion_superior_ies IS NOT NULL
),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
      PARTITION BY codigo_institucion
      ORDER BY {safe('anio')} DESC NULLS LAST, institucion_educacion_superior_ies ASC NULLS LAST,
               tipo_ies ASC NULLS LAST, sector_ies ASC NULLS LAST, caracter_ies ASC NULLS LAST,
               departamento_domicilio_ies ASC NULLS LAST, municipio_domicilio_ies ASC NULLS LAST,
               ies_acreditada ASC NULLS LAST, anio ASC NULLS LAST) AS rn
  FROM attr
),
stg_ies AS (
  SELECT {safe('codigo_institucion')} AS codigo_snies, institucion_educacion_superior_ies AS nombre_ies, tipo_ies,
         {_sector('sector_ies')} AS sector_ies, caracter_ies, departamento_domicilio_ies AS departamento_ies,
         municipio_domicilio_ies AS municipio_ies, ies_acreditada, {safe('anio')} AS anio_ultimo_registro
  FROM ranked WHERE rn = 1 AND {safe('codigo_institucion')} IS NOT NULL
),
seed AS (SELECT CAST(s_suppkey AS INTEGER) AS k FROM supplier),
dim AS (
  SELECT i.codigo_snies, i.nombre_ies, i.tipo_ies, i.sector_ies, i.caracter_ies, i.departamento_ies,
         i.municipio_ies, COALESCE(i.ies_acreditada, 'No') AS ies_acreditada,
         (s.k IS NOT NULL) AS es_sue
  FROM stg_ies i LEFT JOIN seed s ON i.codigo_snies = s.k
  WHERE upper(i.departamento_ies) LIKE {_q(C.place_pattern)} AND i.caracter_ies IN ({_list(C.caracter_values)})
),
tiempo AS (
  SELECT anio, CAST(anio AS VARCHAR) AS anio_texto, anio - (anio % 10) AS decada,
         (anio % 4 = 0 AND (anio % 100 <> 0 OR anio % 400 = 0)) AS es_bisiesto
  FROM (SELECT DISTINCT anio FROM stg_m UNION SELECT DISTINCT anio FROM stg_d) y
  WHERE anio IS NOT NULL
),
fact_c AS (
  SELECT m.codigo_snies, m.anio, m.total_matriculados, d.total_docentes,
         CASE WHEN d.total_docentes > 0 THEN {_half_up('100 * m.total_matriculados', 'd.total_docentes')} END
             AS ratio_c,
         CASE WHEN d.total_docentes = 0 THEN 'sin_docentes'
              WHEN m.total_matriculados = 0 THEN 'sin_matriculados'
              WHEN d.total_docentes < {C.low_denominator} THEN 'docentes_bajos'
              WHEN m.total_matriculados < {C.low_numerator} THEN 'matriculados_bajos'
              ELSE 'ok' END AS flag_calidad
  FROM stg_m m JOIN stg_d d ON m.codigo_snies = d.codigo_snies AND m.anio = d.anio
  WHERE m.codigo_snies IN (SELECT codigo_snies FROM dim)
),
fact AS (
  SELECT codigo_snies, anio, total_matriculados, total_docentes, ratio_c / 100.0 AS ratio_estudiante_docente,
         ratio_c, flag_calidad
  FROM fact_c
),
sj AS (
  SELECT f.*, d.nombre_ies, d.sector_ies, d.caracter_ies, d.es_sue
  FROM fact f JOIN dim d USING (codigo_snies)
)"""


def _with(body: str) -> str:
    return "WITH " + STAR + "\n" + body


FY = C.focus_year
P1, P2 = C.pivot_first_year, C.pivot_last_year

ORACLE: dict[str, str] = {
    "m1_stg_entity": _with("SELECT * FROM stg_ies"),
    "m2_yearly_numerator": _with("SELECT * FROM stg_m"),
    "m3_yearly_denominator": _with("SELECT * FROM stg_d"),
    "m4_dim_entity": _with("SELECT * FROM dim"),
    "m5_dim_time": _with("SELECT * FROM tiempo ORDER BY anio"),
    "m6_fact_ratio": _with("SELECT codigo_snies, anio, total_matriculados, total_docentes, "
                           "ratio_estudiante_docente, flag_calidad FROM fact"),
    "j9_orphans": _with("""
SELECT COALESCE(m.codigo_snies, d.codigo_snies) AS codigo_snies, COALESCE(m.anio, d.anio) AS anio,
       CASE WHEN d.total_docentes IS NULL THEN 'numerator_only' ELSE 'denominator_only' END AS lado,
       COALESCE(m.total_matriculados, d.total_docentes) AS total
FROM stg_m m FULL OUTER JOIN stg_d d ON m.codigo_snies = d.codigo_snies AND m.anio = d.anio
WHERE m.total_matriculados IS NULL OR d.total_docentes IS NULL"""),
    "b1_all_ratios": _with("""
SELECT nombre_ies, sector_ies, es_sue, anio, total_matriculados, total_docentes, ratio_estudiante_docente
FROM sj WHERE flag_calidad = 'ok' ORDER BY anio DESC, ratio_estudiante_docente DESC NULLS FIRST"""),
    "b2_best": _with(f"""
SELECT nombre_ies, sector_ies, CASE WHEN es_sue THEN '⭐ SUE' ELSE '' END AS tipo_sue,
       total_matriculados, total_docentes, ratio_estudiante_docente
FROM sj WHERE anio = {FY} AND flag_calidad = 'ok' AND total_docentes >= {C.best_min_denominator}
ORDER BY ratio_estudiante_docente ASC NULLS LAST, codigo_snies ASC LIMIT {C.top_best}"""),
    "b3_worst": _with(f"""
SELECT nombre_ies, sector_ies, CASE WHEN es_sue THEN '⭐ SUE' ELSE '' END AS tipo_sue,
       total_matriculados, total_docentes, ratio_estudiante_docente
FROM sj WHERE anio = {FY} AND flag_calidad = 'ok'
ORDER BY ratio_estudiante_docente DESC NULLS FIRST, codigo_snies ASC LIMIT {C.top_worst}"""),
    "b4_member_vs_rest": _with(f"""
SELECT anio, CASE WHEN es_sue THEN 'SUE (públicas)' ELSE 'No SUE (privadas)' END AS tipo,
       COUNT(*) AS num_sedes, CAST(SUM(total_matriculados) AS BIGINT) AS matriculados_total,
       CAST(SUM(total_docentes) AS BIGINT) AS docentes_total,
       CASE WHEN SUM(total_docentes) <> 0
            THEN CAST({_half_up('100 * SUM(total_matriculados)', 'SUM(total_docentes)')} AS BIGINT) / 100.0
       END AS ratio_agregado
FROM sj GROUP BY anio, es_sue ORDER BY anio, tipo"""),
    "b5_member_evolution": _with(f"""
SELECT nombre_ies, anio, total_matriculados, total_docentes, ratio_estudiante_docente,
       CASE WHEN prev_c <> 0
            THEN CAST({_signed_half_up('10000 * (ratio_c - prev_c)', 'prev_c')} AS BIGINT) / 100.0
       END AS variacion_pct_vs_anio_anterior
FROM (SELECT *, LAG(ratio_c) OVER (PARTITION BY codigo_snies ORDER BY anio) AS prev_c FROM sj WHERE es_sue) t
ORDER BY nombre_ies, anio"""),
    "b6_first_vs_last": _with(f"""
SELECT nombre_ies, sector_ies, r1 / 100.0 AS ratio_{P1}, r2 / 100.0 AS ratio_{P2}, (r2 - r1) / 100.0 AS delta,
       CASE WHEN r2 < r1 THEN '✓ Mejoró' WHEN r2 > r1 THEN '✗ Empeoró' ELSE '= Estable' END AS tendencia
FROM (SELECT codigo_snies, nombre_ies, sector_ies, es_sue,
             MAX(CASE WHEN anio = {P1} THEN ratio_c END) AS r1,
             MAX(CASE WHEN anio = {P2} THEN ratio_c END) AS r2
      FROM sj WHERE flag_calidad = 'ok' GROUP BY codigo_snies, nombre_ies, sector_ies, es_sue) t
WHERE r1 IS NOT NULL AND r2 IS NOT NULL ORDER BY delta"""),
    "b7_by_sector": _with(f"""
SELECT sector_ies, caracter_ies, nombre_ies, ratio_estudiante_docente, total_matriculados, total_docentes
FROM sj WHERE anio = {FY} AND flag_calidad = 'ok' ORDER BY sector_ies, ratio_estudiante_docente"""),
    "b8_largest": _with(f"""
SELECT nombre_ies, sector_ies, CASE WHEN es_sue THEN '⭐' ELSE '' END AS sue, total_matriculados, total_docentes,
       ratio_estudiante_docente,
       CASE WHEN tot <> 0 THEN CAST({_half_up('10000 * total_matriculados', 'tot')} AS BIGINT) / 100.0 END
           AS porcentaje_matriculados
FROM (SELECT *, SUM(total_matriculados) OVER () AS tot FROM sj WHERE anio = {FY}) t
ORDER BY total_matriculados DESC, codigo_snies ASC LIMIT {C.top_largest}"""),
    "b9_kpis": _with(f"""
SELECT anio, COUNT(DISTINCT codigo_snies) AS num_universidades,
       COUNT(DISTINCT codigo_snies) FILTER (WHERE es_sue) AS num_sue,
       CAST(SUM(total_matriculados) AS BIGINT) AS total_matriculados,
       CAST(SUM(total_docentes) AS BIGINT) AS total_docentes,
       CASE WHEN SUM(total_docentes) <> 0
            THEN CAST({_half_up('100 * SUM(total_matriculados)', 'SUM(total_docentes)')} AS BIGINT) / 100.0
       END AS ratio_promedio_ponderado,
       CAST({_half_up('SUM(ratio_c)', 'COUNT(ratio_c)')} AS BIGINT) / 100.0 AS ratio_promedio_simple,
       MIN(ratio_c) / 100.0 AS ratio_minimo, MAX(ratio_c) / 100.0 AS ratio_maximo
FROM sj WHERE flag_calidad = 'ok' GROUP BY anio ORDER BY anio"""),
    "b10_outliers": _with(f"""
SELECT nombre_ies, sector_ies, anio, total_matriculados, total_docentes, ratio_estudiante_docente, flag_calidad,
       CASE WHEN ratio_c > {C.outlier_high * 100} THEN 'Muy alto (posible virtual)'
            WHEN ratio_c < {C.outlier_low * 100} THEN 'Muy bajo (posgrado/especializada)'
            WHEN flag_calidad <> 'ok' THEN 'Requiere revisión'
            ELSE 'Normal' END AS categoria
FROM sj
WHERE ratio_c > {C.outlier_high * 100} OR ratio_c < {C.outlier_low * 100} OR flag_calidad <> 'ok'
ORDER BY anio DESC, ratio_estudiante_docente DESC NULLS FIRST"""),
    "b11_members": _with("SELECT codigo_snies, nombre_ies, sector_ies, es_sue FROM dim WHERE es_sue "
                         "ORDER BY codigo_snies"),
    "b12_last_refresh": "WITH " + RAW + """
SELECT (SELECT MAX(_ingested_at) FROM m_raw) AS ultima_calculo_fact,
       (SELECT MAX(_ingested_at) FROM d_raw) AS ultima_carga_dim""",
    "b13_coverage": _with("SELECT anio, COUNT(DISTINCT codigo_snies) AS num_ies FROM fact GROUP BY anio "
                          "ORDER BY anio"),
    "b14_summary_stats": _with(f"""
SELECT anio, COUNT(*) AS num_ies,
       CAST({_half_up('SUM(ratio_c)', 'COUNT(ratio_c)')} AS BIGINT) / 100.0 AS promedio,
       round(quantile_cont(ratio_c, 0.5)) / 100.0 AS mediana,
       round(quantile_cont(ratio_c, 0.25)) / 100.0 AS p25,
       round(quantile_cont(ratio_c, 0.75)) / 100.0 AS p75
FROM fact WHERE flag_calidad = 'ok' GROUP BY anio ORDER BY anio"""),
    "b15_member_ratios": _with("""
SELECT nombre_ies, anio, total_matriculados, total_docentes, ratio_estudiante_docente
FROM sj WHERE es_sue ORDER BY nombre_ies, anio"""),
}

__all__ = ["ORACLE", "TPCH_AS_OF"]


# ---------------------------------------------------------------------------
# data-quality queries
# ---------------------------------------------------------------------------

_FACT_COLS = ("codigo_snies, anio, total_matriculados, total_docentes, ratio_estudiante_docente, flag_calidad")
_DIM_COLS = ("codigo_snies, nombre_ies, tipo_ies, sector_ies, caracter_ies, departamento_ies, municipio_ies, "
             "ies_acreditada, es_sue")


def _fail_not_null(t, c):
    return f"SELECT * FROM {t} WHERE {c} IS NULL"


def _fail_unique(t, c):
    return f"SELECT {c}, COUNT(*) AS n_records FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"


def _fail_accepted(t, c, values):
    return f"SELECT * FROM {t} WHERE {c} NOT IN ({values})"


def _fail_rel(t, c, p, f):
    return (f"SELECT * FROM {t} ch WHERE ch.{c} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {p} pa WHERE pa.{f} = ch.{c})")


def _fail_expr(t, e, where="TRUE"):
    return f"SELECT * FROM {t} WHERE ({where}) AND NOT ({e})"


def _fail_range(t, c, lo, hi):
    return f"SELECT * FROM {t} WHERE {c} < {lo} OR {c} > {hi}"


def _fail_combo(t, cols):
    return f"SELECT {cols}, COUNT(*) AS n_records FROM {t} GROUP BY {cols} HAVING COUNT(*) > 1"


def _fail_place(pattern):
    return (f"SELECT f.codigo_snies, f.anio, d.departamento_ies FROM fact f LEFT JOIN dim d USING (codigo_snies) "
            f"WHERE d.departamento_ies IS NULL OR upper(d.departamento_ies) NOT LIKE {_q(pattern)}")


def _suite_checks() -> list[tuple[str, str, str]]:
    years = _list(C.accepted_years)
    out = []
    for t in ("m_raw", "d_raw"):
        name = "matriculados_raw" if t == "m_raw" else "docentes_raw"
        for col in ("codigo_institucion", "anio"):
            out.append((f"not_null_{name}_{col}", name, _fail_not_null(t, col)))
    out += [
        ("not_null_stg_ies_codigo_snies", "stg_ies", _fail_not_null("stg_ies", "codigo_snies")),
        ("unique_stg_ies_codigo_snies", "stg_ies", _fail_unique("stg_ies", "codigo_snies")),
        ("not_null_stg_ies_nombre_ies", "stg_ies", _fail_not_null("stg_ies", "nombre_ies")),
    ]
    for name, t, total, rng in (("stg_matriculados", "stg_m", "total_matriculados", True),
                                ("stg_docentes", "stg_d", "total_docentes", False)):
        out += [
            (f"not_null_{name}_codigo_snies", name, _fail_not_null(t, "codigo_snies")),
            (f"relationships_{name}_codigo_snies", name, _fail_rel(t, "codigo_snies", "stg_ies", "codigo_snies")),
            (f"not_null_{name}_anio", name, _fail_not_null(t, "anio")),
            (f"accepted_values_{name}_anio", name, _fail_accepted(t, "anio", years)),
            (f"not_null_{name}_{total}", name, _fail_not_null(t, total)),
            (f"expression_is_true_{name}_{total}", name, _fail_expr(t, f"{total} >= 0")),
        ]
        if rng:
            out.append((f"accepted_range_{name}_semestres_presentes", name,
                        _fail_range(t, "semestres_presentes", *C.semester_range)))
        out.append((f"unique_combination_{name}", name, _fail_combo(t, "codigo_snies, anio")))
    out += [
        ("not_null_seed_s_suppkey", "seed", _fail_not_null("seed_t", "s_suppkey")),
        ("unique_seed_s_suppkey", "seed", _fail_unique("seed_t", "s_suppkey")),
        ("not_null_seed_nombre_oficial", "seed", _fail_not_null("seed_t", "nombre_oficial")),
        ("not_null_seed_universidad_sue", "seed", _fail_not_null("seed_t", "universidad_sue")),
        ("not_null_dim_ies_codigo_snies", "dim_ies", _fail_not_null("dim", "codigo_snies")),
        ("unique_dim_ies_codigo_snies", "dim_ies", _fail_unique("dim", "codigo_snies")),
        ("not_null_dim_ies_nombre_ies", "dim_ies", _fail_not_null("dim", "nombre_ies")),
        ("accepted_values_dim_ies_sector_ies", "dim_ies", _fail_accepted("dim", "sector_ies", _list(C.sector_accepted))),
        ("accepted_values_dim_ies_caracter_ies", "dim_ies",
         _fail_accepted("dim", "caracter_ies", _list(C.caracter_accepted))),
        ("not_null_dim_ies_es_sue", "dim_ies", _fail_not_null("dim", "es_sue")),
        ("accepted_values_dim_ies_es_sue", "dim_ies", _fail_accepted("dim", "es_sue", "TRUE, FALSE")),
        ("not_null_dim_tiempo_anio", "dim_tiempo", _fail_not_null("tiempo", "anio")),
        ("unique_dim_tiempo_anio", "dim_tiempo", _fail_unique("tiempo", "anio")),
        ("accepted_values_dim_tiempo_anio", "dim_tiempo", _fail_accepted("tiempo", "anio", years)),
        ("not_null_fact_codigo_snies", "fact", _fail_not_null("fact", "codigo_snies")),
        ("relationships_fact_codigo_snies", "fact", _fail_rel("fact", "codigo_snies", "dim", "codigo_snies")),
        ("not_null_fact_anio", "fact", _fail_not_null("fact", "anio")),
        ("relationships_fact_anio", "fact", _fail_rel("fact", "anio", "tiempo", "anio")),
    ]
    for total in ("total_matriculados", "total_docentes"):
        out += [
            (f"not_null_fact_{total}", "fact", _fail_not_null("fact", total)),
            (f"expression_is_true_fact_{total}", "fact", _fail_expr("fact", f"{total} >= 0")),
        ]
    out += [
        ("expression_is_true_fact_ratio_estudiante_docente", "fact",
         _fail_expr("fact", "ratio_estudiante_docente >= 0", "ratio_estudiante_docente IS NOT NULL")),
        ("not_null_fact_flag_calidad", "fact", _fail_not_null("fact", "flag_calidad")),
        ("accepted_values_fact_flag_calidad", "fact", _fail_accepted("fact", "flag_calidad", _list(C.flags))),
        ("unique_combination_fact", "fact", _fail_combo("fact", "codigo_snies, anio")),
        ("fact_only_in_place", "fact", _fail_place(C.place_pattern)),
    ]
    return out


def _suite_sql() -> str:
    parts = [f"SELECT {_q(n)} AS check_name, {_q(t)} AS tabla, 'error' AS severity, COUNT(*) AS failures "
             f"FROM ({sql}) x" for n, t, sql in _suite_checks()]
    body = "\nUNION ALL\n".join(parts)
    return _with(f""", seed_t AS (SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name AS nombre_oficial,
                      s_name AS universidad_sue FROM supplier)
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
{body}
) s""").replace(")\n, seed_t AS", "),\nseed_t AS")


_FRESH = f"""
SELECT tabla, mx AS max_loaded_at, CAST(floor((epoch(TIMESTAMP {_q(TPCH_AS_OF)}) - epoch(mx)) / 86400) AS BIGINT)
       AS age_days,
       CASE WHEN mx IS NULL THEN 'error'
            WHEN floor((epoch(TIMESTAMP {_q(TPCH_AS_OF)}) - epoch(mx)) / 86400) > {C.freshness_error_days} THEN 'error'
            WHEN floor((epoch(TIMESTAMP {_q(TPCH_AS_OF)}) - epoch(mx)) / 86400) > {C.freshness_warn_days} THEN 'warn'
            ELSE 'ok' END AS status
FROM (SELECT 'matriculados_raw' AS tabla, MAX(_ingested_at) AS mx FROM m_raw
      UNION ALL SELECT 'docentes_raw', MAX(_ingested_at) FROM d_raw) t"""

ORACLE.update({
    "d1_not_null": _with(_fail_not_null("stg_ies", "ies_acreditada")),
    "d2_unique": _with(_fail_unique("stg_m", "codigo_snies")),
    "d3_accepted_values": _with(f"SELECT {_DIM_COLS} FROM dim WHERE sector_ies NOT IN ({_list(C.sector_accepted)})"),
    "d4_relationships": _with(_fail_rel("stg_d", "codigo_snies", "stg_m", "codigo_snies")),
    "d5_unique_combination": _with(_fail_combo("stg_ies", "departamento_ies, caracter_ies")),
    "d6_expression_is_true": _with(f"SELECT {_FACT_COLS} FROM fact WHERE ratio_estudiante_docente IS NOT NULL "
                                   f"AND NOT (total_docentes >= {C.low_denominator})"),
    "d7_accepted_range": _with(_fail_range("stg_m", "semestres_presentes", 1, 1)),
    "d8_place_invariant": _with(_fail_place("NATION_1_%")),
    "d9_freshness": "WITH " + RAW + _FRESH,
    "d10_suite_summary": _suite_sql(),
    "d10_stored_failures": _suite_sql().replace("SELECT *, CASE WHEN failures = 0", "SELECT *, failures AS stored, CASE WHEN failures = 0"),
})


# ---------------------------------------------------------------------------
# ingest and sink queries
# ---------------------------------------------------------------------------

from aulastar.plans.ingest_bindings import (  # noqa: E402
    DOCS_PROFILE, HEADER_EVEN, HEADER_ODD, WORD_ALIASES, WRONG_HEADER_YEAR,
)
from aulastar.plans.registry_ingest import RELOAD_YEAR, SPOILT_YEAR, VALIDATE_YEAR  # noqa: E402


def _trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _norm(x: str) -> str:
    """Header normalisation: collapse + trim, upper (ß as SS), strip accents,
    drop ( ) ., collapse + trim."""
    s = _trim_ws(f"regexp_replace({x}, '\\s+', ' ', 'g')")
    s = f"strip_accents(upper(replace({s}, 'ß', 'SS')))"
    s = f"translate({s}, '().', '')"
    return _trim_ws(f"regexp_replace({s}, '\\s+', ' ', 'g')")


def _clean(x: str) -> str:
    return f"CASE WHEN {x} IN ('', 'nan', 'NaN', 'None') THEN NULL ELSE {_trim_ws(x)} END"


_ALIAS_VALUES = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in WORD_ALIASES.items())
_KEYS = _list(WORD_ALIASES)

DOCS = f"""
lines AS (
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS source_file,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS row_idx,
         unnest(string_split(text, chr(10))) AS line
  FROM documents
),
grid AS (SELECT source_file, row_idx, string_split(line, ' ') AS cells FROM lines),
scored AS (
  SELECT source_file, row_idx, len(list_filter(cells, lambda x: x IS NOT NULL AND {_norm('x')} IN ({_KEYS}))) AS score
  FROM grid WHERE row_idx < 20
),
best AS (
  SELECT source_file, row_idx AS header_row, score FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY source_file ORDER BY score DESC, row_idx ASC) AS rn
    FROM scored WHERE score > 0) t
  WHERE rn = 1 AND score >= 4
),
hcells AS (
  SELECT g.source_file, b.header_row, CAST(generate_subscripts(g.cells, 1) - 1 AS INTEGER) AS position,
         unnest(g.cells) AS header
  FROM grid g JOIN best b ON g.source_file = b.source_file AND g.row_idx = b.header_row
),
aliases(k, v) AS (VALUES {_ALIAS_VALUES}),
mapped AS (
  SELECT h.*, {_norm('h.header')} AS key FROM hcells h
),
mapped2 AS (
  SELECT m.source_file, m.header_row, m.position, m.header, m.key,
         CASE WHEN m.header IS NULL OR m.key = '' THEN '_c' || CAST(m.position AS VARCHAR)
              ELSE COALESCE(a.v, replace(lower(m.key), ' ', '_')) END AS canonical,
         a.v IS NOT NULL AS mapped
  FROM mapped m LEFT JOIN aliases a ON m.key = a.k
)"""


def _docs(body: str) -> str:
    return "WITH " + DOCS + "\n" + body


_REQ = sorted(DOCS_PROFILE.required)
_MISSING = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT bool_or(canonical = {_q(r)}) THEN {_q(r)} END" for r in _REQ) + ")"

ORDERS = f"""
og AS (
  SELECT o.*, c.c_mktsegment, n.n_name, year(o.o_orderdate) AS y,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS q
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
ext AS (
  SELECT CAST(o_custkey AS VARCHAR) AS codigo_institucion, o_orderpriority AS institucion_educacion_superior_ies,
         o_orderstatus AS sector_ies, n_name AS departamento_domicilio_ies, CAST(y AS VARCHAR) AS anio,
         CASE WHEN month(o_orderdate) <= 6 THEN '1' ELSE '2' END AS semestre,
         CASE WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN NULL ELSE CAST(q AS VARCHAR) END AS matriculados,
         c_mktsegment AS caracter_ies,
         CASE WHEN y % 2 = 1 THEN CAST(o_orderkey AS VARCHAR) END AS columna_nueva,
         'pedidos_' || CAST(y AS VARCHAR) || '.csv' AS _source_file,
         'tpch://orders/' || CAST(y AS VARCHAR) AS _source_url,
         y, o_orderkey
  FROM og WHERE o_orderpriority <> '1-URGENT'
),
ext_h AS (
  SELECT *, md5(concat_ws('||', codigo_institucion, institucion_educacion_superior_ies, sector_ies,
                          COALESCE(departamento_domicilio_ies, 'nan'), anio, semestre,
                          COALESCE(matriculados, 'nan'), caracter_ies)
                || CASE WHEN y % 2 = 1 THEN '||' || columna_nueva ELSE '' END) AS _h0
  FROM ext
),
ext2 AS (
  SELECT * EXCLUDE (_h0),
         md5(concat_ws('||', codigo_institucion, institucion_educacion_superior_ies, sector_ies,
                       COALESCE(departamento_domicilio_ies, 'nan'), anio, semestre,
                       COALESCE(matriculados, 'nan'), caracter_ies, columna_nueva)) AS _row_hash
  FROM ext_h
),
final AS (
  SELECT * FROM ext2 WHERE y <> {RELOAD_YEAR} OR sector_ies = 'F'
)"""


def _orders(body: str) -> str:
    return "WITH " + ORDERS + "\n" + body


_EXTRACT_COLS = ("codigo_institucion, institucion_educacion_superior_ies, sector_ies, departamento_domicilio_ies, "
                 "anio, semestre, matriculados, caracter_ies, columna_nueva, _source_url, _source_file, _row_hash, "
                 "'tpch' AS _dag_run_id")

ORACLE.update({
    "x1_safe_int_customer": f"SELECT c_custkey, {safe('c_name')} AS codigo_int, "
                            f"{safe('CAST(c_acctbal AS VARCHAR)')} AS saldo_int FROM customer",
    "x1_safe_int_orders": f"SELECT o_orderkey, {safe('o_orderpriority')} AS prioridad_int, "
                          f"{safe('CAST(o_totalprice AS VARCHAR)')} AS total_int FROM orders",
    "s2_available_years": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders ORDER BY anio",
    "s4_cell_grid": _docs("SELECT source_file, row_idx, CAST(len(cells) AS INTEGER) AS n_cells, cells[1] AS first_cell, "
                          "cells[-1] AS last_cell FROM grid"),
    "s5_header_detect": _docs("SELECT source_file, header_row, CAST(score AS INTEGER) AS score FROM best"),
    "s6_normalize_text": f"SELECT doc_id, {_norm('text')} AS clave FROM documents",
    "s7_map_columns": _docs("SELECT source_file, position, header, canonical, mapped FROM mapped2"),
    "s8_mapped_report": _docs("SELECT source_file, COUNT(*) FILTER (WHERE mapped) AS mapped, COUNT(*) AS total "
                              "FROM mapped2 GROUP BY source_file"),
    "s9_required_check": _docs(f"""
SELECT source_file, faltantes, n_disponibles FROM (
  SELECT source_file, {_MISSING} AS faltantes, CAST(COUNT(DISTINCT canonical) AS INTEGER) AS n_disponibles
  FROM mapped2 GROUP BY source_file) t
WHERE faltantes <> ''"""),
    "s10_digit_filter": _orders("SELECT 'pedidos_' || CAST(y AS VARCHAR) || '.csv' AS source_file, "
                                "o_orderkey + 10 AS row_idx FROM og WHERE o_orderpriority <> '1-URGENT'"),
    "s11_s12_clean": _docs(f"""
SELECT source_file, row_idx, CAST(len(list_filter(cl, lambda x: x IS NULL)) AS INTEGER) AS n_nulos,
       array_to_string(list_transform(cl, lambda x: COALESCE(x, '<null>')), '|') AS limpio
FROM (SELECT source_file, row_idx, list_transform(cells, lambda x: {_clean('x')}) AS cl FROM grid) t"""),
    "s13_row_hash": _docs(f"""
SELECT source_file, row_idx, md5(array_to_string(list_transform(cl, lambda x: COALESCE(x, 'nan')), '||')) AS _row_hash
FROM (SELECT source_file, row_idx, list_transform(cells, lambda x: {_clean('x')}) AS cl FROM grid) t"""),
    "s15_extract": _orders(f"SELECT {_EXTRACT_COLS} FROM ext2"),
    "s18_workload": "SELECT anio, perfil FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anio FROM orders) y "
                    "CROSS JOIN (VALUES ('docentes'), ('matriculados')) p(perfil) ORDER BY anio, perfil",
    "s19_backfill_summary": _orders(f"""
SELECT CAST((SELECT COUNT(DISTINCT y) FROM ext2) + 1 AS BIGINT) AS tareas_exitosas, CAST(0 AS BIGINT) AS tareas_fallidas,
       CAST((SELECT COUNT(*) FROM ext2) + (SELECT COUNT(*) FROM ext2 WHERE y = {RELOAD_YEAR} AND sector_ies = 'F')
            AS BIGINT) AS filas_totales"""),
    "k2_schema_evolution": _orders("SELECT _source_file, COUNT(*) AS filas, COUNT(columna_nueva) AS con_columna_nueva "
                                   "FROM final GROUP BY _source_file"),
    "k3_replace_by_file": _orders("SELECT codigo_institucion, anio, sector_ies, matriculados, _source_file, _row_hash "
                                  "FROM final"),
    "k9_log_status": _orders(f"""
SELECT 'run-1' AS dag_run_id, _source_file AS source_file, 'success' AS status, COUNT(*) AS rows_ingested
FROM ext2 GROUP BY _source_file
UNION ALL
SELECT 'run-2', _source_file, 'success', COUNT(*) FROM ext2 WHERE y = {RELOAD_YEAR} AND sector_ies = 'F'
GROUP BY _source_file"""),
    "k10_validate_load": _orders(f"""
SELECT {VALIDATE_YEAR} AS anio, COUNT(*) AS total,
       COUNT(*) FILTER (WHERE upper(departamento_domicilio_ies) LIKE {_q(C.place_pattern)}) AS en_lugar,
       CASE WHEN COUNT(*) = 0 THEN 'fail'
            WHEN COUNT(*) FILTER (WHERE upper(departamento_domicilio_ies) LIKE {_q(C.place_pattern)}) = 0 THEN 'warn'
            ELSE 'ok' END AS status
FROM final WHERE anio = '{VALIDATE_YEAR}'"""),
    "k15_duplicate_audit": "WITH " + RAW + """,
h AS (
  SELECT md5(concat_ws('||', COALESCE(codigo_institucion, 'nan'), COALESCE(institucion_educacion_superior_ies, 'nan'),
         COALESCE(tipo_ies, 'nan'), COALESCE(sector_ies, 'nan'), COALESCE(caracter_ies, 'nan'),
         COALESCE(departamento_domicilio_ies, 'nan'), COALESCE(municipio_domicilio_ies, 'nan'),
         COALESCE(ies_acreditada, 'nan'), COALESCE(anio, 'nan'), COALESCE(semestre, 'nan'),
         COALESCE(matriculados, 'nan'))) AS _row_hash,
         'matriculados_' || anio || '.parquet' AS f
  FROM m_raw
)
SELECT _row_hash, COUNT(*) AS n_records, array_to_string(list_sort(list_distinct(list(f))), ',') AS files
FROM h GROUP BY _row_hash HAVING COUNT(*) > 1""",
})


# Bronze enrolment schema: 11 text data columns (the 10 shared ones + the
# measure) and the 5 lineage columns.
ORACLE.update({
    "s20_extract_report": "WITH " + RAW + f"""
SELECT COUNT(*) AS filas, 11 + 5 AS columnas, 5 AS columnas_linaje,
       COUNT(*) FILTER (WHERE upper(departamento_domicilio_ies) LIKE {_q(C.place_pattern)}) AS filas_en_lugar
FROM m_raw""",
    "k9_recovered_loads": _orders("""
SELECT _source_file AS source_file, CASE WHEN y % 3 = 0 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN y % 3 <> 0 THEN COUNT(*) END AS rows_ingested, CASE WHEN y % 3 <> 0 THEN COUNT(*) END AS en_manifiesto,
       CASE WHEN y % 3 = 0 THEN 'the load ended without a commit' END AS motivo
FROM ext2 GROUP BY _source_file, y"""),
    "k9_load_history": _orders(f"""
SELECT 'matriculados' AS perfil, CAST(y AS INTEGER) AS anio,
       CASE WHEN y = {RELOAD_YEAR} THEN COUNT(*) FILTER (WHERE sector_ies = 'F') ELSE COUNT(*) END AS filas,
       CAST(0 AS BIGINT) AS cargas_fallidas,
       CAST(CASE WHEN y = {RELOAD_YEAR} THEN 2 ELSE 1 END AS BIGINT) AS cargas
FROM ext2 GROUP BY y"""),
})

_SPOILT = f"y = {SPOILT_YEAR}"
ORACLE.update({
    "s18_backfill_with_bad_file": _orders(f"""
SELECT _source_file AS source_file, CASE WHEN {_SPOILT} THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN {_SPOILT} THEN NULL ELSE COUNT(*) END AS rows_ingested,
       CASE WHEN {_SPOILT} THEN 'required columns missing' END AS motivo,
       CASE WHEN {_SPOILT} THEN 0 ELSE COUNT(*) END AS filas_bronze
FROM ext2 GROUP BY _source_file, y"""),
    "s19_summary_with_bad_file": _orders(f"""
SELECT COUNT(DISTINCT y) FILTER (WHERE NOT {_SPOILT}) AS tareas_exitosas, COUNT(DISTINCT y) FILTER (WHERE {_SPOILT}) AS tareas_fallidas,
       COUNT(*) FILTER (WHERE NOT {_SPOILT}) AS filas_totales FROM ext2"""),
    "k10_validate_outcomes": _orders(f"""
SELECT 1890 AS anio, CAST(0 AS BIGINT) AS total, CAST(0 AS BIGINT) AS en_lugar, 'fail' AS status
UNION ALL
SELECT {VALIDATE_YEAR}, COUNT(*), 0, 'warn' FROM final WHERE anio = '{VALIDATE_YEAR}'"""),
    "s4_csv_scan": """
SELECT anio, row_number() OVER (PARTITION BY anio ORDER BY o_orderkey) - 1 AS row_idx, n_cells, token, texto, ultima FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, o_orderkey,
         CASE WHEN o_orderkey % 2 = 1 THEN 5 ELSE 3 END AS n_cells,
         CASE WHEN o_orderkey % 6 < 4 THEN NULL ELSE o_orderpriority END AS token,
         'a, "' || o_orderstatus || '"' || chr(10) || o_orderpriority AS texto,
         CASE WHEN o_orderkey % 2 = 1 THEN 'fin' ELSE 'a, "' || o_orderstatus || '"' || chr(10) || o_orderpriority END AS ultima
  FROM orders) t""",
    "s4_csv_quotes": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1 AS row_idx,
       CAST(o_orderkey AS VARCHAR) || '|' || CASE o_orderkey % 5 WHEN 0 THEN '5" pipe' WHEN 1 THEN 'abcdef' WHEN 2 THEN 'a "b", c'
         WHEN 3 THEN 'one' || chr(10) || '"two"tail' ELSE 'x"y|z"' END || '|' || o_orderstatus AS celdas
FROM orders""",
    "s16_seed_scan": "SELECT CAST(s_suppkey AS INTEGER) AS codigo_snies, s_name AS nombre_oficial, CAST(s_nationkey AS VARCHAR) AS departamento_principal, "
                     "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS universidad_sue FROM supplier",
    "k16_gold_table": ORACLE["m6_fact_ratio"],
    "k11_silver_view": ORACLE["m1_stg_entity"],
})
