import os

from aulastar.operators.report import extract_report
from aulastar.plans.star import build_star
from aulastar.sources.seed import load_seed, read_seed
from aulastar.sources.tables import Layout, register_views
from conftest import raw_rows


def test_seed_declared_types_and_views(spark, tmp_root):
    p = os.path.join(tmp_root, "seed.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("codigo_snies,nombre_oficial,departamento_principal,universidad_sue\n"
                "1101,UNIVERSIDAD NACIONAL,Bogotá D.C.,UN\n1102,UNIVERSIDAD NACIONAL,Antioquia,UN\n")
    seed = read_seed(spark, p)
    assert dict(seed.dtypes)["codigo_snies"] == "int" and seed.count() == 2
    lay = Layout(tmp_root)
    stored = load_seed(spark, p, lay.path("silver", "ies_sue"))
    assert stored.count() == 2
    m = raw_rows(spark, "matriculados", [{"matriculados": "500"}])
    d = raw_rows(spark, "docentes", [{"docentes": "20"}])
    names = register_views(spark, build_star(m, d, seed), prefix="t_")
    assert "t_fact_capacidad_academica" in names
    r = spark.sql("SELECT f.codigo_snies, d.es_sue FROM t_fact_capacidad_academica f "
                  "JOIN t_dim_ies d USING (codigo_snies)").first()
    assert (r.codigo_snies, r.es_sue) == (1101, True)


def test_extract_report(spark):
    m = raw_rows(spark, "matriculados", [{"departamento_domicilio_ies": "Antioquia"}, {}, {}, {}])
    rep = extract_report(m, "departamento_domicilio_ies", ["codigo_institucion", "anio"])
    assert (rep.rows, rep.rows_in_place, len(rep.sample)) == (4, 3, 3)


def test_publish_gold_tables(spark, tmp_root):
    from aulastar.plans.star import materialize_gold
    from aulastar.sources.tables import publish
    m = raw_rows(spark, "matriculados", [{"matriculados": "500"}])
    d = raw_rows(spark, "docentes", [{"docentes": "20"}])
    seed = spark.createDataFrame([(1101, "U", "U")], "codigo_snies int, nombre_oficial string, universidad_sue string")
    lay = Layout(tmp_root, gold=f"gold_{os.path.basename(tmp_root).replace('-', '_')}")
    materialize_gold(build_star(m, d, seed), f"{tmp_root}/b1")
    names = publish(spark, f"{tmp_root}/b1", lay)
    r = spark.table(names[-1]).first()
    assert (r.codigo_snies, float(r.ratio_estudiante_docente)) == (1101, 25.0)
    # a second build in progress, and one that is never published, leave the first in place for every session
    m2 = raw_rows(spark, "matriculados", [{"matriculados": "700"}])
    materialize_gold(build_star(m2, d, seed), f"{tmp_root}/b2")
    assert float(spark.newSession().table(names[-1]).first().ratio_estudiante_docente) == 25.0
    publish(spark, f"{tmp_root}/b2", lay)
    for s in (spark, spark.newSession()):
        assert [float(r.ratio_estudiante_docente) for r in s.table(names[-1]).collect()] == [35.0]


def test_schema_routing():
    from aulastar.sources.tables import schema_name
    assert schema_name(" gold ") == "gold" and schema_name(None) == "public" and schema_name("") == "public"
    assert Layout("/w").path(None, "t") == "/w/public/t" and Layout("/w").path("silver", "t") == "/w/silver/t"


def test_a_join_during_publishing_sees_one_build(spark, tmp_root):
    import os
    import threading

    from pyspark.sql import functions as F

    from aulastar.plans.star import GOLD_TABLES
    from aulastar.sources.tables import Layout, open_gold, publish
    lay = Layout(tmp_root, gold="gold_snapshots")
    builds = [f"{tmp_root}/builds/b{k}" for k in range(9)]
    for k, root in enumerate(builds):
        for t in GOLD_TABLES:
            spark.range(20).select(F.col("id").alias("k"), F.lit(k).alias("build")).write.parquet(f"{root}/gold/{t}")
    publish(spark, builds[0], lay, keep=4)
    stop, seen, mixed = threading.Event(), set(), []

    def read(own):
        while not stop.is_set():
            snap = open_gold(own, lay, views="snap_")
            a, b, c = (f"snap_{t}" for t in GOLD_TABLES)
            rows = own.sql(f"SELECT {a}.build x, {b}.build y, {c}.build z FROM {a} JOIN {b} USING (k) JOIN {c} USING (k)").distinct().collect()
            got = {v for r in rows for v in (r.x, r.y, r.z)}
            seen.update(got)
            if len(got) != 1 or snap.build != f"gold_snapshots_build_b{got.pop()}":
                mixed.append(rows)

    readers = [threading.Thread(target=read, args=(spark.newSession(),)) for _ in range(2)]
    for r in readers:
        r.start()
    for root in builds[1:]:
        publish(spark, root, lay, keep=4)
        stop.wait(1.0)
    stop.set()
    for r in readers:
        r.join()
    assert not mixed and len(seen) > 2
    assert spark.table("gold_snapshots.dim_ies").first().build == 8
    kept = {d.name for d in spark.catalog.listDatabases() if d.name.startswith("gold_snapshots_build")}
    assert kept == {f"gold_snapshots_build_b{k}" for k in range(5, 9)}
    assert [os.path.exists(f"{r}/gold") for r in builds] == [False] * 5 + [True] * 4
