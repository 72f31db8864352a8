"""Ingest: CSV cell grid, header resolution, cleaning, hash, Bronze loads."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from aulastar.config import PROFILES, SourceEntry
from aulastar.operators import ingest
from aulastar.plans.ingest import backfill, header_report, ingest_profile, log_path
from aulastar.sinks import bronze as sink
from aulastar.sources import catalog as cat
from aulastar.sources.grid import read_csv_grid, read_parquet_grid
from tests.test_plans import plan

HEAD_2022 = ('"Código de \nla Institución","Institución de Educación Superior (IES)","Departamento de domicilio '
             'de la IES","Año","Semestre","No. de Docentes","Carácter IES"')
HEAD_2024 = "CÓDIGO DE LA INSTITUCIÓN,INSTITUCIÓN DE EDUCACIÓN SUPERIOR (IES),DEPARTAMENTO DE DOMICILIO DE LA IES," \
            "AÑO,SEMESTRE,DOCENTES,CARÁCTER IES,COLUMNA NUEVA"


def write(folder, name, lines):
    p = os.path.join(folder, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return p


@pytest.fixture()
def files(tmp_root):
    src = os.path.join(tmp_root, "landing")
    os.makedirs(src)
    write(src, "docentes_2022.csv", [
        "Ministerio", "Docentes 2022", "nota", HEAD_2022,
        "1101,UNAL,Bogotá D.C.,2022,1,10,Universidad",
        " 1101,UNAL,Bogotá D.C.,2022,2,10,Universidad",
        "1101,UNAL,Bogotá D.C.,2022,2,nan ,Universidad",
        "1102,UPN,Bogotá D.C.,2022,1,   ,Universidad",
        "Total,,,,,31,", "Fuente: ministerio"])
    write(src, "docentes_2024.csv", [
        "Docentes 2024", "x", HEAD_2024,
        "1101,UNAL,\"Bogotá, D.C.\",2024,1,12,Universidad,n1",
        "1101,UNAL,\"Bogotá, D.C.\",2024,2,,Universidad,n2"])
    return src


def entries(src, header_2022=3, header_2024=2):
    return [SourceEntry(2022, "docentes", "s", header_2022, "docentes_2022.csv", f"file://{src}/docentes_2022.csv"),
            SourceEntry(2024, "docentes", "s", header_2024, "docentes_2024.csv", f"file://{src}/docentes_2024.csv")]


def test_catalog_lookups():
    assert cat.list_available_years() == [2022, 2023, 2024]
    assert cat.get_source_config(2024, "docentes").header_row == 5
    with pytest.raises(KeyError, match="available years"):
        cat.get_source_config(2021, "docentes")
    with pytest.raises(KeyError, match="available profiles"):
        cat.get_source_config(2022, "otro")
    with pytest.raises(ValueError):
        cat.validate_year(2030)


def test_csv_grid_row_index(spark, files):
    g = read_csv_grid(spark, f"{files}/*.csv")
    hdr = g.filter((F.col("source_file") == "docentes_2022.csv") & (F.col("row_idx") == 3)).first()
    assert hdr.cells[0] == "Código de \nla Institución"
    assert g.filter(F.col("source_file") == "docentes_2024.csv").agg(F.max("row_idx")).first()[0] == 4


def test_extract_cleans_and_hashes(spark, files):
    g = read_csv_grid(spark, f"{files}/*.csv")
    rows, resolved = ingest.extract(g, cat.catalog_frame(spark, entries(files)), PROFILES["docentes"], "run")
    out = rows.filter(F.col("_source_file") == "docentes_2022.csv").orderBy("semestre", "docentes").collect()
    assert len(out) == 3  # ' 1101', 'Total' and the footnote are dropped
    assert {r.docentes for r in out} == {"10", "nan", ""}  # 'nan ' is no exact token: kept as 'nan'; '   ' -> ''
    blank = [r for r in out if r.docentes == ""][0]
    expected = hashlib.md5("||".join(["1102", "UPN", "Bogotá D.C.", "2022", "1", "", "Universidad"]).encode())
    assert blank._row_hash == expected.hexdigest()
    assert "columna_nueva" in rows.columns and resolved.fallback_files == []
    report = {r.source_file: (r.mapped, r.total) for r in header_report(g, resolved, PROFILES["docentes"]).collect()}
    assert report == {"docentes_2022.csv": (7, 7), "docentes_2024.csv": (7, 8)}
    # a grid stored as parquet reads back the same
    p = os.path.join(os.path.dirname(files), "grid.parquet")
    g.write.parquet(p)
    assert read_parquet_grid(spark, p).count() == g.count()


def test_header_fallback_and_missing(spark, files):
    g = read_csv_grid(spark, f"{files}/*.csv")
    rows, resolved = ingest.extract(g, cat.catalog_frame(spark, entries(files, header_2022=0)),
                                    PROFILES["docentes"], "run")
    assert resolved.fallback_files == ["docentes_2022.csv"]
    with pytest.raises(ingest.HeaderError, match="missing"):
        ingest.extract(g, cat.catalog_frame(spark, entries(files)), PROFILES["matriculados"].__class__(
            **{**PROFILES["docentes"].__dict__, "required": ("codigo_institucion", "programa_academico")}), "run")


def test_duplicate_header_names_fail(spark, tmp_root):
    src = os.path.join(tmp_root, "dup")
    os.makedirs(src)
    write(src, "docentes_2023.csv", ["CODIGO IES,ID IES,IES,DEPARTAMENTO IES,ANO,SEMESTRE,DOCENTES", "1,1,A,B,2023,1,3"])
    e = [SourceEntry(2023, "docentes", "s", 0, "docentes_2023.csv", "u")]
    with pytest.raises(ingest.HeaderError, match="same name"):
        ingest.extract(read_csv_grid(spark, src), cat.catalog_frame(spark, e), PROFILES["docentes"], "r")


def test_load_replace_evolve_log(spark, files, tmp_root):
    g = read_csv_grid(spark, f"{files}/*.csv")
    c = cat.catalog_frame(spark, entries(files))
    root = os.path.join(tmp_root, "wh")
    first = backfill(g, c, root, "run-1")
    assert [pl.error for pl in first] == [None]
    path = sink.table_path(root, "bronze", "docentes_raw")
    assert sink.read_bronze(spark, path).count() == 5
    again = ingest_profile(g, c, PROFILES["docentes"], root, "run-2")
    assert sorted((r.source_file, r.anio, r.rows_deleted, r.rows_inserted) for r in again.results) == [
        ("docentes_2022.csv", 2022, 3, 3), ("docentes_2024.csv", 2024, 2, 2)]
    b = sink.read_bronze(spark, path)
    assert b.count() == 5  # replaced, not accumulated
    assert b.filter(F.col("_source_file") == "docentes_2022.csv").filter(F.col("columna_nueva").isNotNull()).count() == 0
    status = sink.ingestion_status(spark.read.parquet(log_path(root)))
    assert status.filter("status = 'success'").count() == 4
    hist = sink.load_history(status).orderBy("anio").collect()
    assert [(h.anio, h.filas, h.cargas_fallidas, h.cargas) for h in hist] == [(2022, 3, 0, 2), (2024, 2, 0, 2)]
    summary = sink.backfill_summary(status).first()
    assert (summary.tareas_exitosas, summary.tareas_fallidas, summary.filas_totales) == (4, 0, 10)
    v = sink.validate_load(b, 2024, "departamento_domicilio_ies", "BOGOT%").first()
    assert (v.total, v.en_lugar, v.status) == (2, 2, "ok")
    assert sink.duplicate_audit(b).count() == 0


def test_empty_load_keeps_old_rows(spark, files, tmp_root):
    g = read_csv_grid(spark, f"{files}/*.csv")
    c = cat.catalog_frame(spark, entries(files))
    root = os.path.join(tmp_root, "wh2")
    backfill(g, c, root, "run-1")
    path = sink.table_path(root, "bronze", "docentes_raw")
    rows, _ = ingest.extract(g, c, PROFILES["docentes"], "run-2")
    with pytest.raises(sink.EmptyLoadError):
        sink.load_to_bronze(rows.limit(0), path, log_path(root), "docentes", "run-2",
                            files=[("docentes_2024.csv", "u")])
    assert sink.read_bronze(spark, path).filter(F.col("_source_file") == "docentes_2024.csv").count() == 2
    failed = sink.ingestion_status(spark.read.parquet(log_path(root))).filter("status = 'failed'").count()
    assert failed == 1


def test_splittable_grid_row_index_matches(spark, tmp_root):
    src = os.path.join(tmp_root, "big")
    os.makedirs(src)
    write(src, "a.csv", [f"{i},x{i},{i % 7}" for i in range(5000)])
    write(src, "b.csv", [f"{i},y{i}" for i in range(300)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        g = read_csv_grid(spark, src, splittable=True)
        assert g.rdd.getNumPartitions() > 5
        bad = g.filter(F.col("row_idx") != F.get("cells", 0).cast("long")).count()
        assert bad == 0 and g.count() == 5300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = read_csv_grid(spark, src)
    assert whole.filter(F.col("row_idx") != F.get("cells", 0).cast("long")).count() == 0


def test_reload_twice_equals_once(spark, files, tmp_root):
    g = read_csv_grid(spark, f"{files}/*.csv")
    c = cat.catalog_frame(spark, entries(files))
    root = os.path.join(tmp_root, "twice")
    backfill(g, c, root, "run-1")
    path = sink.table_path(root, "bronze", "docentes_raw")
    cols = ["codigo_institucion", "anio", "semestre", "docentes", "_row_hash", "_source_file"]
    once = sorted(tuple(r) for r in sink.read_bronze(spark, path).select(*cols).collect())
    backfill(g, c, root, "run-2")
    twice = sorted(tuple(r) for r in sink.read_bronze(spark, path).select(*cols).collect())
    assert once == twice


@pytest.mark.parametrize("splittable", [True, False])
def test_every_cell_of_any_width_and_every_line_counts(spark, tmp_root, splittable):
    src = os.path.join(tmp_root, "wide")
    os.makedirs(src)
    wide = [f"v{i}" if i % 3 else "" for i in range(500)] + ["last"]
    write(src, "w.csv", ["a,b,c", "", "1,2,3,,LOST", ",".join(wide), ",,", 'x,"q ""1"", 2",""', "N/A,NULL,null,#N/A,nan ,0"])
    got = {r.row_idx: r.cells for r in read_csv_grid(spark, src, splittable=splittable).collect()}
    assert got == {0: ["a", "b", "c"], 1: [], 2: ["1", "2", "3", None, "LOST"], 3: [w or None for w in wide], 4: [],
                   5: ["x", 'q "1", 2'], 6: [None, None, None, None, "nan ", "0"]}


def test_quoted_line_breaks_and_separators(spark, tmp_root):
    src = os.path.join(tmp_root, "quoted")
    os.makedirs(src)
    write(src, "q.csv", ["\ufeffa;b", '"one', "", 'two";"3;4"', "5;6"])
    got = {r.row_idx: r.cells for r in read_csv_grid(spark, src, sep=";").collect()}
    assert got == {0: ["a", "b"], 1: ["one\n\ntwo", "3;4"], 2: ["5", "6"]}
    with open(os.path.join(src, "q.csv"), "w", encoding="latin-1") as f:
        f.write("año,x\r\nñ,1\r\n")
    assert [r.cells for r in read_csv_grid(spark, src, encoding="ISO-8859-1", splittable=True).orderBy("row_idx").collect()] == [["año", "x"], ["ñ", "1"]]


def test_equal_headers_are_two_columns(spark, tmp_root):
    src = os.path.join(tmp_root, "repeat")
    os.makedirs(src)
    write(src, "docentes_2023.csv", ["CODIGO IES,IES,DEPARTAMENTO IES,ANO,SEMESTRE,DOCENTES,NOTA,NOTA", "1,A,B,2023,1,3,x,N/A"])
    e = [SourceEntry(2023, "docentes", "s", 0, "docentes_2023.csv", "u")]
    rows, resolved = ingest.extract(read_csv_grid(spark, src), cat.catalog_frame(spark, e), PROFILES["docentes"], "r")
    assert [c for c in resolved.columns if c.startswith("nota")] == ["nota", "nota1"]
    assert (rows.first().nota, rows.first().nota1) == ("x", None)


def test_a_bad_file_fails_alone(spark, files, tmp_root):
    write(files, "docentes_2023.csv", ["no header", "1,2"])
    bad = SourceEntry(2023, "docentes", "s", 0, "docentes_2023.csv", "u")
    root = os.path.join(tmp_root, "alone")
    load = backfill(read_csv_grid(spark, f"{files}/*.csv"), cat.catalog_frame(spark, [*entries(files), bad]), root, "run-1")[0]
    assert sorted(r.source_file for r in load.results) == ["docentes_2022.csv", "docentes_2024.csv"] and "docentes_2023" in load.error
    status = sink.ingestion_status(spark.read.parquet(log_path(root)))
    s = sink.backfill_summary(status).first()
    assert (s.tareas_exitosas, s.tareas_fallidas, s.filas_totales) == (2, 1, 5)
    assert "required columns missing" in status.filter("source_file = 'docentes_2023.csv'").first().error_message
    only = backfill(read_csv_grid(spark, f"{files}/docentes_2023.csv"), cat.catalog_frame(spark, [bad]), os.path.join(tmp_root, "none"), "r")[0]
    assert not only.results and only.error


def test_any_number_of_files_in_one_load(spark, tmp_root):
    src = os.path.join(tmp_root, "many")
    os.makedirs(src)
    rows = spark.range(600).selectExpr("cast(id as string) codigo_institucion", "concat('f', id % 300, '.csv') _source_file", "cast(null as timestamp) _ingested_at",
                                       "'u' _source_url", "'h' _row_hash", "'r' _dag_run_id")
    res = sink.load_to_bronze(rows, os.path.join(src, "t"), os.path.join(src, "log"), "docentes", "r")
    assert len(res) == 300 and {(r.rows_deleted, r.rows_inserted) for r in res} == {(0, 2)}


def test_read_bronze_with_known_schema(spark, files, tmp_root):
    g = read_csv_grid(spark, f"{files}/*.csv")
    c = cat.catalog_frame(spark, entries(files))
    root = os.path.join(tmp_root, "known")
    loads = backfill(g, c, root, "run-1")
    path = sink.table_path(root, "bronze", "docentes_raw")
    schema = sink.bronze_schema(loads[0].headers.columns)
    b = sink.read_bronze(spark, path, schema)
    assert b.count() == 5
    assert b.filter(F.col("_source_file") == "docentes_2022.csv").filter(F.col("columna_nueva").isNotNull()).count() == 0
    assert b.filter(F.col("columna_nueva").isNotNull()).count() == 2


def test_duplicate_audit_counts_candidates_only(spark):
    from aulastar.sinks.bronze import duplicate_audit

    rows = [("a", "f1"), ("a", "f2"), ("a", "f2"), ("b", "f1"), ("c", "f3"), ("c", "f3"), (None, "f1"), (None, "f4")]
    df = spark.createDataFrame(rows, "_row_hash string, _source_file string")
    got = {r["_row_hash"]: (r["n_records"], r["files"]) for r in duplicate_audit(df).collect()}
    assert got == {"a": (3, ["f1", "f2"]), "c": (2, ["f3"]), None: (2, ["f1", "f4"])}
    assert duplicate_audit(df.limit(0)).collect() == []
    plan = duplicate_audit(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and plan.count("xxhash64") == 2


def test_missing_names_are_found_within_the_header_row(spark):
    aliases = {"THE": "a", "AND": "b", "OF": "c"}
    rows = [("x", 1, ["the", "The", None, "", "and", "of them", "Of  Them"]), ("y", 2, ["of", None, None]), (None, 0, ["?", "AND"])]
    heads = spark.createDataFrame(rows, "source_file string, header_row long, cells array<string>")
    by_row = ingest.missing_required(ingest.map_header_rows(heads, aliases), ["c", "a", "c"])
    p = plan(by_row)
    assert "Aggregate" not in p and "Generate" not in p and "Exchange" not in p   # no task holds the names of several files
    got = {r.source_file: (r.missing, r.n_available) for r in by_row.collect()}
    assert got == {"x": (["c"], 5), "y": (["a"], 3), None: (["a", "c"], 2)}
    cells = ingest.map_columns(heads.select("source_file", F.posexplode("cells").alias("position", "header")), aliases)
    assert {r.source_file: (r.missing, r.n_available) for r in ingest.missing_required(cells, ["c", "a", "c"]).collect()} == got


def test_the_required_check_counts_no_cells_by_file(spark):
    from __spark_entry__ import queries
    p = plan(queries()["s9_required_check"](spark, "/root/testdata/sf0.001"))
    assert "Aggregate" not in p and p.count("hashpartitioning(source_file") > 0
