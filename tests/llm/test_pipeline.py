"""The pipeline against a plain version of its stages."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import queries  # noqa: E402
from aulastar.llm import mixing, quality  # noqa: E402

ROOT = "/root/testdata/sf0.001"


def test_stages_are_those_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_dedup", "decontamination", "mixing"]
    assert queries()["pipeline"] is corpus_pipeline.run and sum(k.startswith("op") for k in queries()) == 13


def test_run_as_brute_force(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    good = {r.doc_id for r in quality.scored(docs, quality.fit(docs, spark.read.parquet(f"{ROOT}/labels.parquet"))).filter("score >= 0.5").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    left = [(i, r.text) for i, r in rows.items() if i in good]
    kept = brute.exact(left)
    left = [(i, t) for i, t in left if kept[i][2]]
    root = brute.near_components(left)
    left = [(i, t) for i, t in left if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{ROOT}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute.leaks(left, items)}
    left = [(i, t) for i, t in left if i not in bad]
    plan = mixing.mix_plan(spark.createDataFrame([(i, t, rows[i].source) for i, t in left], "doc_id long, text string, source string")).collect()
    want = sorted((r.doc_id, n) for r in plan for n in range(1, r.copies + 1))
    got = corpus_pipeline.run(spark, ROOT)
    assert got.columns == [*docs.columns, "mix_copy"]
    assert sorted((r.doc_id, r.mix_copy) for r in got.collect()) == want
    assert 0 < len(left) < len(rows)
