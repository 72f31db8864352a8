"""Nulls in any column, empty and very long texts, repeated rows, clashing names and empty tables, for every operator and stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from aulastar.llm import decontaminate, exact_dedup, html_extract, langid, mixing, ppm, quality, simhash, suffix_dedup, toxicity

LONG = "lorem ipsum dolor " * 12_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, fp string, block int, key string, score double, words string, bucket string, n long, row string"
ROWS = [
    (1, "some words of text", "en", "s", 4), (1, "some words of text", "en", "s", 4), (2, None, "en", "s", None), (3, "", None, None, 0), (4, LONG, "en", "t", len(LONG)),
    (5, LONG, "fr", "t", len(LONG)), (None, "no id here at all", "en", "s", 1), (None, None, None, None, None), (6, " \n\t", "en", "s", 3), (7, "é" * 5000, "fr", None, 5000),
    (8, "\x00 odd \x85 bytes", "en", "s", 2), (9, "x" * 30_000, "en", "u", 30_000),
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    out = {}
    for name, rows in (("odd", ROWS), ("empty", [])):
        root = tmp_path_factory.mktemp(name)
        spark.createDataFrame([(*r, 1, "f", 2, "k", 0.5, "w", "b", 3, "r") for r in rows], SCHEMA).write.parquet(f"{root}/documents.parquet")
        labels = [(1, 1, 0), (2, 0, 1), (3, 0, None), (4, 1, 0), (5, None, 1), (None, 1, 1), (9, 0, 0), (9, 0, 0)] if rows else []
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        spark.createDataFrame([(1, "no id here at all"), (2, None), (None, "lorem"), (3, "")] if rows else [], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
        spark.createDataFrame([(1, "u", "<p>x"), (1, "u", "<p>x"), (None, None, None), (2, None, ""), (3, "u", "<p>" + LONG)] if rows else [], "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
        out[name] = str(root)
    return out


def read(spark, root, name):
    return spark.read.parquet(f"{root}/{name}.parquet")


OPERATORS = {
    "2": lambda d, la: suffix_dedup.remove_repeats(d), "3": lambda d, la: langid.predicted(d, langid.fit(d, steps=3)), "4": lambda d, la: quality.scored(d, quality.fit(d, la)),
    "5": lambda d, la: mixing.mix_report(d), "7": lambda d, la: toxicity.scored(d, toxicity.fit(d, la)), "8": lambda d, la: simhash.near_duplicates(d),
    "9": lambda d, la: ppm.score_corpus(d), "10": lambda d, la: exact_dedup.exact_dedup(d),
}


@pytest.mark.parametrize("n", OPERATORS)
def test_one_row_for_every_row(spark, tables, n):
    for name, rows in (("odd", ROWS), ("empty", [])):
        got = OPERATORS[n](read(spark, tables[name], "documents"), read(spark, tables[name], "labels")).collect()
        assert sorted((r.doc_id for r in got), key=str) == sorted((r[0] for r in rows), key=str)


def test_odd_rows_results(spark, tables):
    docs, labels = read(spark, tables["odd"], "documents"), read(spark, tables["odd"], "labels")
    gone = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert gone[4].n_removed == gone[5].n_removed == len(LONG) and gone[2].n_bytes == 0 and gone[9].n_removed == 30_000 and gone[1].n_removed == 0
    same = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect() if r.doc_id}
    assert same[2] == same[3] == same[6] == 2 and same[4] == same[5] == 4 and same[1] == 1
    groups = [r for r in exact_dedup.exact_dedup(docs).collect()]
    assert sum(r.kept for r in groups) == len({r.text_sha256 for r in groups})
    assert {r.group_size for r in groups if r.doc_id in (2, 3, 6)} == {4} and [r.kept for r in groups if r.doc_id == 1].count(True) == 1
    mixed = mixing.mix_report(docs).collect()
    assert all(r.taken <= 3 * r.size for r in mixed) and all(r.taken == 0 for r in mixed if not r.size)
    assert all(0 <= r.score <= 1 for r in quality.scored(docs, quality.fit(docs, labels)).collect())


def test_pairs_and_pages(spark, tables):
    for name, pairs, pages in (("odd", {(None, 1), (4, None), (5, None)}, 5), ("empty", set(), 0)):
        root = tables[name]
        got = decontaminate.find_leaks(read(spark, root, "documents"), read(spark, root, "benchmark")).collect()
        assert {(r.doc_id, r.item_id) for r in got} == pairs
        texts = html_extract.extract(read(spark, root, "pages")).collect()
        assert len(texts) == pages and all(r.text is not None and r.n_chars == len(r.text) for r in texts)


def test_near_copies_go_by_row(spark):
    """Null and shared ids: unlike texts that share an id with a near copy stay."""
    long = " ".join(f"w{i}" for i in range(300))
    near = long + " w7"
    rows = [(1, long), (None, near), (None, "one text of its own"), (7, near), (7, "quite another text here"), (2, "and one that nobody repeats"), (None, long), (1, long)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.simhash_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted([(1, long), (0, "one text of its own"), (7, "quite another text here"), (2, "and one that nobody repeats")])


@pytest.mark.parametrize("name", ["odd", "empty"])
def test_every_stage(spark, tables, name):
    docs = read(spark, tables[name], "documents")
    for step, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, tables[name])
        assert got.columns[: len(docs.columns)] == docs.columns, step
        rows = got.collect()
        assert len(rows) <= (3 if step == "mixing" else 1) * docs.count() and (name == "odd" or not rows)
    assert corpus_pipeline.run(spark, tables[name]).count() >= 0
