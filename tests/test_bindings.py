"""The surrogate Bronze and the orders grid: tasks of bounded size, no growing table through the driver."""

import datetime

import pytest
from pyspark.sql import functions as F

from aulastar.plans import bindings
from aulastar.plans.ingest_bindings import orders_grid
from tests.test_plans import plan

DAY = datetime.datetime(1998, 3, 1)
ORDERS = [(k, k % 7, "OF"[k % 2], 1000.0 * k, DAY, "5-LOW") for k in range(100)]
CUSTOMERS = [(k, f"Customer#{k:09d}", k % 3, "BUILDING") for k in range(5)] + [(0, "Customer#000000000", 1, "BUILDING")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, rows, schema in (
            ("lineitem", [(k, 3.0, "O") for k in range(100) for _ in range(3)], "l_orderkey long, l_quantity double, l_linestatus string"),
            ("orders", ORDERS, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
            ("customer", CUSTOMERS, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            ("nation", [(0, "NATION_0"), (1, "NATION_1")], "n_nationkey int, n_name string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("build,rows", [(bindings.surrogate_enrolment, 300), (bindings.surrogate_teachers, 100)])
def test_tasks_that_write_bronze_follow_the_rows(spark, tables, monkeypatch, build, rows):
    monkeypatch.setattr(bindings, "TASK_ROWS", 10)
    assert f", {rows // 10}), REPARTITION_BY_NUM" in plan(build(spark, tables))


def test_bronze_rows_follow_every_copy_of_a_customer(spark, tables):
    known = sum(2 if c == 0 else 1 for _, c, *_ in ORDERS if c < 5)
    assert bindings.surrogate_enrolment(spark, tables).count() == 3 * known
    closed = sum(2 if c == 0 else 1 for _, c, s, *_ in ORDERS if c < 5 and s != "O")
    got = bindings.surrogate_teachers(spark, tables)
    assert got.count() == closed and got.filter(F.col("departamento_domicilio_ies").isNull()).count() > 0   # customers of an unknown nation stay


def test_customers_of_the_orders_grid_stay_out_of_the_driver(spark, tables):
    joins = [node for node in plan(orders_grid(spark, tables)).split("\n\n") if "Join" in node and "Right keys" in node and "c_custkey" in node.split("Right keys")[1].split("\n")[0]]
    assert joins and all("SortMergeJoin" in node for node in joins)


def test_no_price_is_shuffled_into_bronze(spark, tables):
    for build in (bindings.surrogate_enrolment, bindings.surrogate_teachers):
        nodes = [n for n in plan(build(spark, tables)).split("\n\n") if ") Exchange" in n]
        assert nodes and all("o_totalprice" not in n for n in nodes)


def test_stored_bronze_is_compressed_by_zstd(spark, tables):
    for stored in bindings.bronze_tables(spark, tables):
        files = stored.inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_rules_on_the_customer_key_reach_the_measures(spark, tmp_path):
    root, key = str(tmp_path), [11, 13, 17, 19, 13 * 17]
    for name, rows, schema in (
            ("lineitem", [(k, q, "O") for k in range(5) for q in (3.0, None)], "l_orderkey long, l_quantity double, l_linestatus string"),
            ("orders", [(i, c, "F", [None, 300000.0, 300000.5, 1.0, 4e5][i], DAY, "5-LOW") for i, c in enumerate(key)],
             "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
            ("customer", [(k, f"Customer#{k:09d}", 0, "BUILDING") for k in key], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            ("nation", [(0, "NATION_0")], "n_nationkey int, n_name string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    got = sorted((int(r[0][9:]), r[1] or "", r[2]) for r in bindings.surrogate_enrolment(spark, root).select("codigo_institucion", "matriculados", "ies_acreditada").collect())
    assert got == [(11, "", None), (11, "3", None), (13, "0", None), (13, "0", None), (17, "-5", "Si"), (17, "-5", "Si"),
                   (19, "", None), (19, "3", None), (221, "-5", "Si"), (221, "-5", "Si")]
    teachers = {int(r[0][9:]): r[1] for r in bindings.surrogate_teachers(spark, root).select("codigo_institucion", "docentes").collect()}
    assert teachers == {11: "0", 13: "1", 17: "1", 19: "1", 221: "1"}
