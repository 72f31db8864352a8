"""Every check passes on a good star and fails on a broken one."""

import pytest
from pyspark.sql import functions as F

from aulastar.operators import quality as Q
from aulastar.plans.star import build_star
from conftest import raw_rows


@pytest.fixture()
def good(spark):
    m = raw_rows(spark, "matriculados", [
        {"codigo_institucion": "1", "matriculados": "500", "sector_ies": "Oficial"},
        {"codigo_institucion": "1", "matriculados": "500", "semestre": "2"},
        {"codigo_institucion": "2", "matriculados": "900", "anio": "2023", "sector_ies": "Privada"},
    ])
    d = raw_rows(spark, "docentes", [
        {"codigo_institucion": "1", "docentes": "30"},
        {"codigo_institucion": "2", "docentes": "40", "anio": "2023", "sector_ies": "Privada"},
    ])
    seed = spark.createDataFrame([(1, "U1", "U1")], "codigo_snies int, nombre_oficial string, universidad_sue string")
    s = build_star(m, d, seed)
    return m, d, s


def checks(m, d, s, **over):
    parts = dict(stg_entity=s.stg_entity, stg_numer=s.stg_numerator, stg_denom=s.stg_denominator, seed=s.seed,
                 dim=s.dim_entity, tiempo=s.dim_time, fact=s.fact)
    parts.update(over)
    return Q.declared_checks({"matriculados_raw": m, "docentes_raw": d}, **parts)


def test_suite_has_49_checks_and_passes(good):
    m, d, s = good
    cs = checks(m, d, s)
    assert len(cs) == 49
    rows = Q.assert_suite(Q.run_suite(cs))
    assert all(r["status"] == "pass" for r in rows)


def test_broken_star_fails_each_kind(spark, good):
    m, d, s = good
    fact = s.fact.unionByName(s.fact)  # duplicate (code, year)
    fact = fact.unionByName(s.fact.withColumn("codigo_snies", F.lit(999)).withColumn("flag_calidad", F.lit("raro"))
                            .withColumn("total_docentes", F.lit(-1).cast("bigint")))
    dim = s.dim_entity.withColumn("sector_ies", F.lit("Mixta"))
    summary = {r["check_name"]: r for r in Q.run_suite(checks(m, d, s, fact=fact, dim=dim)).collect()}
    for name in ("unique_combination_fact", "relationships_fact_codigo_snies", "accepted_values_fact_flag_calidad",
                 "expression_is_true_fact_total_docentes", "accepted_values_dim_ies_sector_ies",
                 "fact_only_in_place"):
        assert summary[name]["status"] == "fail", name
    with pytest.raises(Q.QualityError):
        Q.assert_suite(Q.run_suite(checks(m, d, s, fact=fact, dim=dim)))


def test_individual_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 7), (None, "b", 100), (3, "c", None)],
                               "k int, v string, n int")
    assert Q.not_null(df, "v").count() == 1
    assert Q.unique(df, "k").collect()[0]["n_records"] == 2
    assert Q.accepted_values(df, "v", ["a", "b"]).count() == 1  # null passes
    parent = spark.createDataFrame([(1,)], "k int")
    assert Q.relationships(df, "k", parent, "k").count() == 1  # 3 has no parent; null passes
    assert Q.expression_is_true(df, "n >= 6", "k IS NOT NULL").count() == 1
    assert Q.accepted_range(df, "n", 1, 10).count() == 1


def test_freshness_levels(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00",)], "ts string").select(F.to_timestamp("ts").alias("ts"))
    def status(now):
        return Q.freshness(df, "ts", "t", 400, 800, F.to_timestamp(F.lit(now))).first()["status"]
    assert status("2020-06-01 00:00:00") == "ok"
    assert status("2021-03-01 00:00:00") == "warn"
    assert status("2023-01-01 00:00:00") == "error"


def test_store_failures(spark, good, tmp_root):
    m, d, s = good
    dim = s.dim_entity.withColumn("sector_ies", F.lit("Mixta"))
    Q.run_suite(checks(m, d, s, dim=dim), store_root=tmp_root)
    stored = spark.read.parquet(f"{tmp_root}/quality/accepted_values_dim_ies_sector_ies")
    assert stored.count() == s.dim_entity.count()


def test_suite_continues_after_a_check_error(spark, good):
    m, d, s = good
    cs = checks(m, d, s)
    broken = Q.Check("broken_check", "fact", lambda: s.fact.select(F.expr("no_such_column")))
    summary = {r["check_name"]: r for r in Q.run_suite(cs + [broken]).collect()}
    assert summary["broken_check"]["status"] == "error" and summary["broken_check"]["failures"] is None
    assert sum(1 for r in summary.values() if r["status"] == "pass") == 49
    with pytest.raises(Q.QualityError):
        Q.assert_suite(Q.run_suite(cs + [broken]))


def test_stored_failures_are_those_of_the_last_run(spark, good, tmp_root):
    m, d, s = good
    dim = s.dim_entity.withColumn("sector_ies", F.lit("Mixta"))
    name = "accepted_values_dim_ies_sector_ies"
    first = {r["check_name"]: r for r in Q.run_suite(checks(m, d, s, dim=dim), tmp_root).collect()}
    stored = spark.read.parquet(f"{tmp_root}/quality/{name}").count()
    assert first[name]["failures"] == stored == 2
    Q.assert_suite(Q.run_suite(checks(m, d, s), tmp_root))
    assert spark.read.parquet(f"{tmp_root}/quality/{name}").count() == 0


def test_key_rules_in_one_aggregate(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (2, None), (None, "y"), (None, "y"), (3, "1")], "k int, v string")
    b = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k bigint")
    c = spark.createDataFrame([("x",), ("z",), (None,)], "w string")
    empty = a.limit(0)
    checks = [Q.unique_check("u", "a", a, "k"), Q.unique_combination_check("uc", "a", a, ["k", "v"]),
              Q.relationships_check("r1", "b", b, "k", a, "k"), Q.relationships_check("r2", "c", c, "w", a, "v"),
              Q.relationships_check("r3", "a", a, "k", b, "k"), Q.relationships_check("none", "b", b, "k", empty, "k"),
              Q.unique_check("empty", "e", empty, "k")]
    want = {ch.name: ch.failing().count() for ch in checks}
    assert want == {"u": 2, "uc": 3, "r1": 2, "r2": 1, "r3": 3, "none": 3, "empty": 0}
    for summary in (Q.run_suite(checks), Q.suite_frame(checks)):
        assert {r["check_name"]: r["failures"] for r in summary.collect()} == want


def test_keys_without_a_faithful_text_are_checked_apart(spark):
    a = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "k double")
    b = spark.createDataFrame([(1,), (2,)], "k int")
    checks = [Q.unique_check("u", "a", a, "k"), Q.relationships_check("r", "b", b, "k", a, "k")]
    assert [r["failures"] for r in Q.run_suite(checks).collect()] == [1, 1]


def test_suite_reads_every_table_once_for_its_keys(spark, good):
    m, d, s = good
    plan = Q.key_failures([ch.rule for ch in checks(m, d, s) if ch.rule])[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 7 and "Join LeftAnti" not in plan
