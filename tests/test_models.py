"""Silver/Gold semantics on hand-made rows (one rule per test)."""

from aulastar.config import DOMAIN
from aulastar.operators import gold, marts, silver
from aulastar.plans.star import build_star
from conftest import raw_rows
from tests.test_plans import plan


def seed(spark, codes):
    return spark.createDataFrame([(c, f"U{c}", "x") for c in codes],
                                 "codigo_snies int, nombre_oficial string, universidad_sue string")


def test_yearly_measure_filters_and_parsing(spark):
    m = raw_rows(spark, "matriculados", [
        {"matriculados": "1,234"}, {"matriculados": " 12 ", "semestre": "2"},
        {"anio": "2023", "matriculados": "3.0"}, {"anio": "2023", "semestre": None, "matriculados": "201"},
        {"departamento_domicilio_ies": "Antioquia"}, {"departamento_domicilio_ies": None},
        {"caracter_ies": "Institución Universitaria"},
        {"codigo_institucion": "3001", "caracter_ies": "Institución Universitaria/Escuela Tecnológica"},
        {"codigo_institucion": "3002", "departamento_domicilio_ies": "Bogotá, D.C."},
        {"codigo_institucion": "7", "matriculados": ""}, {"codigo_institucion": "7", "matriculados": "n/d"},
        {"codigo_institucion": "7", "matriculados": "-3"}, {"codigo_institucion": "7", "matriculados": "12-3"},
        {"codigo_institucion": "7", "matriculados": "99999999999"},
    ])
    out = {(r.codigo_snies, r.anio): r for r in silver.yearly_measure(m, DOMAIN.numerator).collect()}
    assert out[(1101, 2022)].total_matriculados == 1246
    assert out[(1101, 2022)].semestres_presentes == 2
    assert out[(1101, 2023)].total_matriculados == 231
    assert out[(1101, 2023)].semestres_presentes == 1      # null semester not counted
    assert out[(1101, 2023)].registros_fuente == 2
    assert (3001, 2022) in out and (3002, 2022) in out
    assert (7, 2022) not in out
    assert len(out) == 4


def test_stg_entity_latest_and_deterministic(spark):
    m = raw_rows(spark, "matriculados", [
        {"codigo_institucion": "3828", "institucion_educacion_superior_ies": "OLD NAME", "anio": "2022"},
        {"codigo_institucion": "3828", "institucion_educacion_superior_ies": "NEW NAME", "anio": "2023"},
        {"codigo_institucion": "4000", "sector_ies": "Privado", "institucion_educacion_superior_ies": "X"},
        {"codigo_institucion": "4000", "sector_ies": "Privada", "institucion_educacion_superior_ies": "X"},
        {"codigo_institucion": "Total", "institucion_educacion_superior_ies": "junk"},
    ])
    d = raw_rows(spark, "docentes", [{"codigo_institucion": "5000", "institucion_educacion_superior_ies": "ONLY D"}])
    stg = {r.codigo_snies: r for r in silver.stg_entity([m, d]).collect()}
    assert stg[3828].nombre_ies == "NEW NAME" and stg[3828].anio_ultimo_registro == 2023
    assert stg[4000].sector_ies == "Privada"
    assert 5000 in stg
    assert len(stg) == 3  # 'Total' parses to null and is dropped


def test_raw_code_dedupe_keeps_both_spellings(spark):
    m = raw_rows(spark, "matriculados", [{"codigo_institucion": "1101"}, {"codigo_institucion": "01101"}])
    rows = silver.stg_entity([m, m.limit(0)]).collect()
    assert sorted(r.codigo_snies for r in rows) == [1101, 1101]


def test_star_flags_ratio_and_membership(spark):
    m = raw_rows(spark, "matriculados", [
        {"codigo_institucion": "1", "matriculados": "201"},
        {"codigo_institucion": "2", "matriculados": "50"},
        {"codigo_institucion": "3", "matriculados": "0"},
        {"codigo_institucion": "4", "matriculados": "500"},
        {"codigo_institucion": "5", "matriculados": "99"},
        {"codigo_institucion": "6", "matriculados": "300", "ies_acreditada": None},
        {"codigo_institucion": "8", "matriculados": "300", "anio": "2022"},
        {"codigo_institucion": "8", "matriculados": "300", "anio": "2023", "caracter_ies": "Técnica"},
        {"codigo_institucion": "9", "matriculados": "300"},  # no teachers
    ])
    d = raw_rows(spark, "docentes", [
        {"codigo_institucion": "1", "docentes": "200"}, {"codigo_institucion": "2", "docentes": "0"},
        {"codigo_institucion": "3", "docentes": "20"}, {"codigo_institucion": "4", "docentes": "9"},
        {"codigo_institucion": "5", "docentes": "20"},
        {"codigo_institucion": "6", "docentes": "20", "ies_acreditada": None},
        {"codigo_institucion": "8", "docentes": "20", "anio": "2022"},
        {"codigo_institucion": "8", "docentes": "20", "anio": "2023", "caracter_ies": "Técnica"},
        {"codigo_institucion": "10", "docentes": "20"},
    ])
    s = build_star(m, d, seed(spark, [1, 4]))
    fact = {r.codigo_snies: r for r in s.fact.collect()}
    assert float(fact[1].ratio_estudiante_docente) == 1.01 and fact[1].flag_calidad == "ok"
    assert fact[2].ratio_estudiante_docente is None and fact[2].flag_calidad == "sin_docentes"
    assert fact[3].flag_calidad == "sin_matriculados"
    assert fact[4].flag_calidad == "docentes_bajos"
    assert fact[5].flag_calidad == "matriculados_bajos"
    assert 8 not in fact  # left the kinds in its latest year: out of the dimension, out of the fact
    assert 9 not in fact and 10 not in fact  # one-sided keys vanish
    dim = {r.codigo_snies: r for r in s.dim_entity.collect()}
    assert dim[1].es_sue and dim[4].es_sue and not dim[2].es_sue
    assert dim[6].ies_acreditada == "No"
    orph = {(r.codigo_snies, r.lado) for r in gold.orphans(s.stg_numerator, s.stg_denominator).collect()}
    assert (9, "numerator_only") in orph and (10, "denominator_only") in orph
    tiempo = [r.anio for r in s.dim_time.collect()]
    assert tiempo == [2022]  # 2023 rows were all filtered out


def test_b5_previous_available_year_and_zero(spark):
    m = raw_rows(spark, "matriculados", [
        {"codigo_institucion": "1", "anio": "2022", "matriculados": "1000"},
        {"codigo_institucion": "1", "anio": "2024", "matriculados": "1500"},
        {"codigo_institucion": "2", "anio": "2022", "matriculados": "0"},
        {"codigo_institucion": "2", "anio": "2023", "matriculados": "500"},
    ])
    d = raw_rows(spark, "docentes", [
        {"codigo_institucion": "1", "anio": "2022", "docentes": "100"},
        {"codigo_institucion": "1", "anio": "2024", "docentes": "100"},
        {"codigo_institucion": "2", "anio": "2022", "docentes": "100"},
        {"codigo_institucion": "2", "anio": "2023", "docentes": "100"},
    ])
    s = build_star(m, d, seed(spark, [1, 2]))
    rows = marts.b5_member_evolution(s.fact, s.dim_entity).collect()
    vals = sorted(((r.anio, r.variacion_pct_vs_anio_anterior) for r in rows), key=lambda t: (t[0], str(t[1])))
    assert (2024, 50) in [(a, float(v) if v is not None else None) for a, v in vals]  # vs 2022, not 2023
    assert sum(1 for r in rows if r.variacion_pct_vs_anio_anterior is None) == 3  # two first rows + previous 0


def test_topk_ties_lower_code_first(spark):
    rows, drows = [], []
    for code in (5, 3, 9, 1):
        rows.append({"codigo_institucion": str(code), "institucion_educacion_superior_ies": f"U{code}",
                     "anio": "2024", "matriculados": "1000"})
        drows.append({"codigo_institucion": str(code), "anio": "2024", "docentes": "100"})
    s = build_star(raw_rows(spark, "matriculados", rows), raw_rows(spark, "docentes", drows), seed(spark, []))
    cfg = DOMAIN.__class__(top_worst=2)
    worst = marts.b3_worst(s.fact, s.dim_entity, cfg)
    assert sorted(r.nombre_ies for r in worst.collect()) == ["U1", "U3"]


def test_b14_percentiles_exact(spark):
    m = raw_rows(spark, "matriculados", [
        {"codigo_institucion": str(i), "anio": "2024", "matriculados": str(v)}
        for i, v in enumerate([287, 288, 1000, 1001], start=1)])
    d = raw_rows(spark, "docentes", [
        {"codigo_institucion": str(i), "anio": "2024", "docentes": "100"} for i in range(1, 5)])
    s = build_star(m, d, seed(spark, []))
    cfg = DOMAIN.__class__(low_denominator=1, low_numerator=1)
    s = build_star(m, d, seed(spark, []), cfg)
    r = marts.b14_summary_stats(s.fact, cfg).first()
    # ratios 2.87 2.88 10.00 10.01 -> p25 = 2.8775 -> 2.88, median 6.44, p75 = 10.0025 -> 10.00
    assert float(r.p25) == 2.88 and float(r.mediana) == 6.44 and float(r.p75) == 10.0
    assert float(r.promedio) == 6.44


def test_entity_rows_are_shuffled_once_and_cut_to_the_latest_before(spark):
    m = raw_rows(spark, "matriculados", [{"anio": y, "institucion_educacion_superior_ies": n} for y in ("2022", "2023", None, "x") for n in ("B", "A", "A")] * 3)
    d = raw_rows(spark, "docentes", [{"anio": "2023", "institucion_educacion_superior_ies": "A", "tipo_ies": t} for t in (None, "Seccional", "Principal")])
    out = silver.stg_entity([m, d])
    nodes = [n for n in plan(out).split("\n\n") if ") Exchange" in n]
    assert len(nodes) == 1 and "hashpartitioning(codigo_institucion" in nodes[0]   # no exchange of all attribute rows
    assert [(r.codigo_snies, r.anio_ultimo_registro, r.nombre_ies, r.tipo_ies) for r in out.collect()] == [(1101, 2023, "A", "Principal")]
