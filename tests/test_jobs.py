"""End to end on the domain configuration: yearly CSV exports -> ingest ->
transform -> 49 checks -> Gold tables -> marts."""

import os

import pytest

from aulastar.operators import marts
from aulastar.plans import jobs

HEAD = ("CÓDIGO DE LA INSTITUCIÓN,INSTITUCIÓN DE EDUCACIÓN SUPERIOR (IES),PRINCIPAL O SECCIONAL,SECTOR IES,"
        "CARÁCTER IES,DEPARTAMENTO DE DOMICILIO DE LA IES,MUNICIPIO DE DOMICILIO DE LA IES,IES ACREDITADA,AÑO,"
        "SEMESTRE,{m}")
FRONT = ["Ministerio de Educación", "Información", "", "Fuente", "Corte", "Nota"]


def rows(measure_values):
    out = []
    for code, name, sector, car, dep, vals in measure_values:
        for sem, v in zip((1, 2), vals):
            out.append(f"{code},{name},Principal,{sector},{car},\"{dep}\",Bogotá D.C.,Si,2024,{sem},{v}")
    return out


@pytest.fixture()
def landing(tmp_root):
    d = os.path.join(tmp_root, "landing")
    os.makedirs(d)
    uni, iu = "Universidad", "Institución Universitaria/Escuela Tecnológica"
    mat = [("1101", "UNAL", "Oficial", uni, "Bogotá, D.C.", (30000, 31000)),
           ("1711", "PRIVADA A", "Privada", uni, "Bogotá, D.C.", (5000, 5200)),
           ("2102", "UNAD", "Público", iu, "Bogotá, D.C.", (60, 30)),
           ("1201", "ANTIOQUIA", "Oficial", uni, "Antioquia", (9000, 9000))]
    doc = [("1101", "UNAL", "Oficial", uni, "Bogotá, D.C.", (1500, 1500)),
           ("1711", "PRIVADA A", "Privada", uni, "Bogotá, D.C.", (400, 420)),
           ("2102", "UNAD", "Público", iu, "Bogotá, D.C.", (3, 3)),
           ("1201", "ANTIOQUIA", "Oficial", uni, "Antioquia", (500, 500))]
    with open(os.path.join(d, "matriculados_2024.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(FRONT[:5] + [HEAD.format(m="MATRICULADOS")] + rows(mat) + ["Total,,,,,,,,,,"]) + "\n")
    with open(os.path.join(d, "docentes_2024.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(FRONT[:5] + [HEAD.format(m="DOCENTES")] + rows(doc)) + "\n")
    seed = os.path.join(tmp_root, "ies_sue.csv")
    with open(seed, "w", encoding="utf-8") as f:
        f.write("codigo_snies,nombre_oficial,departamento_principal,universidad_sue\n"
                "1101,UNIVERSIDAD NACIONAL,Bogotá D.C.,UN\n2102,UNAD,Bogotá D.C.,UNAD\n")
    return d, seed


def test_ingest_transform_marts(spark, landing, tmp_root):
    src, seed = landing
    root = os.path.join(tmp_root, "wh")
    r = jobs.ingest_year(spark, src, root, 2024, "run-1")
    assert {v["perfil"]: (v["total"], v["en_lugar"], v["status"]) for v in r.validation} == {
        "docentes": (8, 6, "ok"), "matriculados": (8, 6, "ok")}
    with pytest.raises(ValueError):
        jobs.ingest_year(spark, src, root, 2019, "run-x")
    res = jobs.transform(spark, root, seed)
    fact = {row.codigo_snies: row for row in res.star.fact.collect()}
    assert set(fact) == {1101, 1711, 2102}
    assert float(fact[1101].ratio_estudiante_docente) == 20.33 and fact[1101].flag_calidad == "ok"
    assert fact[2102].flag_calidad == "docentes_bajos"
    dim = {row.codigo_snies: row for row in res.star.dim_entity.collect()}
    assert dim[2102].sector_ies == "Oficial" and dim[2102].es_sue and not dim[1711].es_sue
    kpi = marts.b9_kpis(res.star.fact, res.star.dim_entity).first()
    assert (kpi.anio, kpi.num_universidades, kpi.num_sue) == (2024, 2, 1)
    assert spark.table("gold.fact_capacidad_academica").count() == 3


def test_backfill_summary(spark, landing, tmp_root):
    from aulastar.config import SourceEntry
    src, _ = landing
    entries = [SourceEntry(2024, "matriculados", "1.", 5, "matriculados_2024.csv", "u1"),
               SourceEntry(2024, "docentes", "1.", 5, "docentes_2024.csv", "u2")]
    loads, summary = jobs.backfill_all(spark, src, os.path.join(tmp_root, "wh"), "bf-1", entries)
    s = summary.first()
    assert (s.tareas_exitosas, s.tareas_fallidas, s.filas_totales) == (2, 0, 16)


def test_cli(spark, landing, tmp_root, capsys):
    import json

    from aulastar.__main__ import main
    src, seed = landing
    root = os.path.join(tmp_root, "cli")
    assert main(["ingest", "--landing", src, "--root", root, "--year", "2024", "--run-id", "r1"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["anio"] == 2024 and len(out["validation"]) == 2
    assert main(["transform", "--root", root, "--seed", seed]) == 0
    checks = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert len(checks) == 49 and all(c["status"] == "pass" for c in checks)


def test_ingest_year_loads_the_good_profile_and_reports_the_bad_one(spark, landing, tmp_root):
    from aulastar.sinks import bronze as sink
    src, _ = landing
    with open(os.path.join(src, "docentes_2024.csv"), "w", encoding="utf-8") as f:
        f.write("no header here\n1,2,3\n")
    root = os.path.join(tmp_root, "partial")
    with pytest.raises(jobs.LoadValidationError, match="docentes"):
        jobs.ingest_year(spark, src, root, 2024, "run-1")
    assert sink.read_bronze(spark, sink.table_path(root, "bronze", "matriculados_raw")).count() == 8


def test_backfill_counts_missing_files_as_failed(spark, landing, tmp_root, capsys):
    import json

    from aulastar.__main__ import main
    src, _ = landing
    # the default catalog lists six yearly files; only the two 2024 files exist
    assert main(["backfill", "--landing", src, "--root", os.path.join(tmp_root, "bf"), "--run-id", "b1"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["summary"] == {"tareas_exitosas": 2, "tareas_fallidas": 4, "filas_totales": 16}


def test_a_failed_build_leaves_published_gold_alone(spark, landing, tmp_root, monkeypatch):
    from aulastar.operators import quality
    src, seed = landing
    root = os.path.join(tmp_root, "publish")
    jobs.ingest_year(spark, src, root, 2024, "run-1")
    jobs.transform(spark, root, seed)
    before = sorted(map(str, spark.table("gold.fact_capacidad_academica").collect()))

    def fails(*a, **k):
        raise RuntimeError("suite broke")

    monkeypatch.setattr(quality, "run_suite", fails)
    with pytest.raises(RuntimeError):
        jobs.transform(spark, root, seed)
    for s in (spark, spark.newSession()):
        assert sorted(map(str, s.table("gold.fact_capacidad_academica").collect())) == before
