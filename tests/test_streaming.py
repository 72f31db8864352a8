import os

from pyspark.sql import functions as F

from aulastar.config import PROFILES, SourceEntry
from aulastar.sinks import bronze as sink
from aulastar.sources import catalog as cat
from aulastar.streaming.landing import start_landing_ingest
from test_ingest import HEAD_2024, write


def test_landing_stream_loads_each_file_once(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    os.makedirs(land)
    write(land, "docentes_2024.csv", ["t", "x", HEAD_2024, "1101,UNAL,Bogotá D.C.,2024,1,12,Universidad,n1",
                                      "1102,UPN,Bogotá D.C.,2024,1,7,Universidad,n2"])
    c = cat.catalog_frame(spark, [SourceEntry(2024, "docentes", "s", 2, "docentes_2024.csv", "u")])
    root, ckpt = os.path.join(tmp_root, "wh"), os.path.join(tmp_root, "ckpt")
    seen = []
    q = start_landing_ingest(spark, land, c, PROFILES["docentes"], root, ckpt, on_batch=lambda e, r: seen.append(r))
    q.awaitTermination(120)
    path = sink.table_path(root, "bronze", "docentes_raw")
    assert sink.read_bronze(spark, path).count() == 2
    # restart: nothing new, nothing reloaded
    q2 = start_landing_ingest(spark, land, c, PROFILES["docentes"], root, ckpt, on_batch=lambda e, r: seen.append(r))
    q2.awaitTermination(120)
    assert len(seen) == 1


def test_landing_stream_picks_up_only_new_files(spark, tmp_root):
    land = os.path.join(tmp_root, "landing2")
    os.makedirs(land)
    write(land, "docentes_2024.csv", ["t", "x", HEAD_2024, "1101,UNAL,Bogotá D.C.,2024,1,12,Universidad,n1"])
    c = cat.catalog_frame(spark, [SourceEntry(2024, "docentes", "s", 2, "docentes_2024.csv", "u24"),
                                  SourceEntry(2023, "docentes", "s", 2, "docentes_2023.csv", "u23")])
    root, ckpt = os.path.join(tmp_root, "wh2"), os.path.join(tmp_root, "ckpt2")
    batches = []
    start_landing_ingest(spark, land, c, PROFILES["docentes"], root, ckpt,
                         on_batch=lambda e, r: batches.append(sorted(x.source_file for x in r))).awaitTermination(120)
    write(land, "docentes_2023.csv", ["t", "x", HEAD_2024, "1101,UNAL,Bogotá D.C.,2023,1,10,Universidad,n1",
                                      "1101,UNAL,Bogotá D.C.,2023,2,11,Universidad,n2"])
    start_landing_ingest(spark, land, c, PROFILES["docentes"], root, ckpt,
                         on_batch=lambda e, r: batches.append(sorted(x.source_file for x in r))).awaitTermination(120)
    assert batches == [["docentes_2024.csv"], ["docentes_2023.csv"]]
    b = sink.read_bronze(spark, sink.table_path(root, "bronze", "docentes_raw"))
    assert sorted((r._source_file, r.n) for r in b.groupBy("_source_file").agg(F.count("*").alias("n")).collect()) \
        == [("docentes_2023.csv", 2), ("docentes_2024.csv", 1)]


def test_landing_stream_skips_other_profiles_and_logs_what_it_cannot_load(spark, tmp_root):
    from aulastar.plans.ingest import log_path
    land = os.path.join(tmp_root, "landing3")
    os.makedirs(land)
    row = "1101,UNAL,Bogotá D.C.,2024,1,12,Universidad,n1"
    write(land, "docentes_2024.csv", ["t", "x", HEAD_2024, row])
    write(land, "docentes_2023.csv", ["nothing", "of use"])
    write(land, "matriculados_2024.csv", ["t", "x", HEAD_2024, row])
    write(land, "unknown.csv", ["t", "x", HEAD_2024, row])
    c = cat.catalog_frame(spark, [SourceEntry(2024, "docentes", "s", 2, "docentes_2024.csv", "u"),
                                  SourceEntry(2023, "docentes", "s", 2, "docentes_2023.csv", "u"),
                                  SourceEntry(2024, "matriculados", "s", 2, "matriculados_2024.csv", "u")])
    root, seen = os.path.join(tmp_root, "wh3"), []
    q = start_landing_ingest(spark, land, c, PROFILES["docentes"], root, os.path.join(tmp_root, "ckpt3"),
                             max_files_per_trigger=2, on_batch=lambda e, r: seen.extend(x.source_file for x in r))
    q.awaitTermination(120)
    assert q.exception() is None and seen == ["docentes_2024.csv"]
    status = {r.source_file: (r.status, r.error_message) for r in sink.ingestion_status(spark.read.parquet(log_path(root))).collect()}
    assert {f: s for f, (s, _) in status.items()} == {"docentes_2024.csv": "success", "docentes_2023.csv": "failed", "unknown.csv": "failed"}
    assert "no entry" in status["unknown.csv"][1]
