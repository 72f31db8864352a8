"""The manifest: what a load reads, repeated and dead loads, the schema without footers."""

import os

import pytest
from pyspark.sql import functions as F

from aulastar.config import PROFILES
from aulastar.plans.ingest import backfill, log_path
from aulastar.sinks import bronze as sink
from aulastar.sinks import manifest
from aulastar.sources import catalog as cat
from aulastar.sources.grid import read_csv_grid
from test_ingest import entries, files  # noqa: F401

T = PROFILES["docentes"].table


def lineage(spark, rows, columns="codigo string, _source_file string"):
    df = spark.createDataFrame(rows, columns)
    return df.selectExpr("*", "cast(null as timestamp) _ingested_at", "'u' _source_url", "md5(codigo) _row_hash", "'r' _dag_run_id")


@pytest.fixture()
def table(spark, tmp_root):
    root = os.path.join(tmp_root, "wh")
    path = sink.table_path(root, "bronze", T)
    odd = ["a.csv", "b c=d%e.csv", "ñ/x.csv"]
    rows = [(str(i), f) for k, f in enumerate(odd) for i in range(k + 2)]
    sink.load_to_bronze(lineage(spark, rows), path, log_path(root), "docentes", "r", files=[(f, "u") for f in odd])
    return root, path, odd


def test_rows_of_odd_file_names(spark, table):
    _, path, odd = table
    known = {r.source_file: r.rows for r in manifest.current(manifest.read_manifest(spark, path)).collect()}
    assert known == {f: k + 2 for k, f in enumerate(odd)}
    for k, f in enumerate(odd):
        assert manifest.stored_rows(spark, path, [f]).count() == k + 2


def test_a_load_opens_its_own_partitions_alone(spark, table, monkeypatch):
    root, path, odd = table
    opened = []
    real = manifest.stored_rows
    monkeypatch.setattr(manifest, "stored_rows", lambda s, t, f: (opened.append(list(f)), real(s, t, f))[1])
    out = sink.load_to_bronze(lineage(spark, [("9", odd[1])]), path, log_path(root), "docentes", "r2", files=[(odd[1], "u")])
    assert [(r.rows_deleted, r.rows_inserted) for r in out] == [(3, 1)] and opened == [[odd[1]]]
    own = real(spark, path, [odd[1]])
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert sorted({f.rsplit("/", 2)[1] for f in own.inputFiles()}) == [manifest.partition_folder(spark, path, odd[1]).rsplit("/", 1)[1].replace("%", "%25").replace(" ", "%20")] or len(own.inputFiles()) == 1
    assert "1 paths" in plan or plan.count("_source_file=") == 1


def test_a_repeated_load_counts_once(spark, files, tmp_root):  # noqa: F811
    g, c, root = read_csv_grid(spark, f"{files}/*.csv"), cat.catalog_frame(spark, entries(files)), os.path.join(tmp_root, "wh")
    for run in ("r1", "r2", "r3"):
        backfill(g, c, root, run)
    path = sink.table_path(root, "bronze", T)
    known = manifest.current(manifest.read_manifest(spark, path))
    assert known.agg(F.sum("rows")).first()[0] == sink.read_bronze(spark, path).count() == 5
    assert {r.run_id for r in known.collect()} == {"r3"}


def test_columns_without_merging_footers(spark, table):
    root, path, _ = table
    sink.load_to_bronze(lineage(spark, [("1", "z.csv", "n")], "codigo string, _source_file string, nueva string"), path, log_path(root), "docentes", "r3", files=[("z.csv", "u")])
    b = sink.read_bronze(spark, path)
    assert b.columns == ["codigo", "nueva", "_ingested_at", "_source_url", "_row_hash", "_dag_run_id", "_source_file"]
    assert b.filter("nueva is not null").count() == 1 and b.count() == 10
    source = open(sink.__file__).read() + open(cat.__file__.replace("catalog", "tables")).read()
    assert "mergeSchema" not in source


def test_a_table_without_a_manifest_is_adopted(spark, tmp_root):
    path = os.path.join(tmp_root, "old")
    for c, f in (("a string, _source_file string", "x"), ("b string, _source_file string", "y")):
        spark.createDataFrame([("1", f)], c).withColumns({"_row_hash": F.lit("h"), "_dag_run_id": F.lit("r")}).write.mode("append").partitionBy("_source_file").parquet(path)
    manifest.adopt(spark, path)
    assert set(sink.read_bronze(spark, path).columns) >= {"a", "b"} and manifest.current(manifest.read_manifest(spark, path)).count() == 2


@pytest.mark.parametrize("dies", ["before data", "before manifest", "before log"])
def test_loads_of_a_dead_driver_are_closed(spark, files, tmp_root, monkeypatch, dies):  # noqa: F811
    class Dead(BaseException):
        pass

    def die(*a, **k):
        raise Dead

    g, c, root = read_csv_grid(spark, f"{files}/*.csv"), cat.catalog_frame(spark, entries(files)), os.path.join(tmp_root, "dead")
    path, log = sink.table_path(root, "bronze", T), log_path(root)
    with monkeypatch.context() as m:
        if dies == "before data":
            m.setattr(sink, "replace_files", die)
        elif dies == "before manifest":
            m.setattr(manifest, "commit", die)
        else:
            real = sink.log_events
            m.setattr(sink, "log_events", lambda s, p, e: die() if any(x["status"] == "success" for x in e) else real(s, p, e))
        with pytest.raises(Dead):
            backfill(g, c, root, "run-1")
    status = lambda: {r.source_file: (r.status, r.rows_ingested) for r in sink.ingestion_status(spark.read.parquet(log)).collect()}
    assert {s for s, _ in status().values()} == {"running"}
    assert sink.recover_loads(spark, path, log, "docentes") == 0            # too young to be dead
    assert sink.recover_loads(spark, path, log, "matriculados", "0 seconds") == 0
    assert sink.recover_loads(spark, path, log, "docentes", "0 seconds") == 2
    committed = {"docentes_2022.csv": ("success", 3), "docentes_2024.csv": ("success", 2)}
    assert status() == ({f: ("failed", None) for f in committed} if dies == "before data" else committed)
    known = manifest.read_manifest(spark, path)
    assert (known is None) == (dies == "before data") and (known is None or manifest.current(known).agg(F.sum("rows")).first()[0] == 5)
    assert sink.recover_loads(spark, path, log, "docentes", "0 seconds") == 0   # closed once
    assert "columna_nueva" in sink.read_bronze(spark, path).columns if known is not None else True
