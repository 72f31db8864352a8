"""Each operator against a plain version, SQL or held-out rows."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from aulastar.llm import components, decontaminate, exact_dedup, html_extract, langid, mixing, ppm, quality, queries, simhash, suffix_array, suffix_dedup, toxicity  # noqa: E402
from aulastar.llm import textops as T  # noqa: E402

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RNG = np.random.default_rng(7)
VOCABULARY = ["".join(chr(97 + c) for c in RNG.integers(0, 26, RNG.integers(2, 9))) for _ in range(300)]


def prose(n, rng=RNG):
    return " ".join(VOCABULARY[i] for i in rng.integers(0, len(VOCABULARY), n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def duck(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    return con.sql(sql).fetchall()


# --- helpers ---------------------------------------------------------------

def test_words_are_those_of_a_plain_split():
    texts = ["", "a", "  a\tbb\n", "É été\x0bx", "\x1fodd\x85word ", "ABC abc", "x" * 5000 + " y"]
    data, off = T.buffers(pa.array(texts))
    starts, ends, row = T.word_bounds(data, off)
    got = [[] for _ in texts]
    for s, e, r in zip(starts, ends, row, strict=True):
        got[r].append(data[s:e].tobytes())
    assert got == [t.encode().split() for t in texts]
    h = T.word_hashes(data, starts, ends)
    flat = [w for t in got for w in t]
    assert len(set(h.tolist())) == len(set(flat))
    assert all((a == b) == (x == y) for a, x in zip(flat, h, strict=True) for b, y in zip(flat, h, strict=True))


def test_shingles_stay_within_a_text():
    data, off = T.buffers(pa.array(["a b c", "d e", "a b c d"]))
    starts, ends, row = T.word_bounds(data, off)
    h, first = T.shingle_hashes(T.word_hashes(data, starts, ends), row, 3)
    assert first.tolist() == [0, 5, 6] and h[0] == h[1] != h[2]


def test_chunks_cover_every_row_once():
    texts = [None, "x" * 50, "", "y" * 7, "z" * 200, None]
    seen = [(a, b) for a, b, _, _ in T.chunks(pa.array(texts), 60)]
    assert [a for a, _ in seen] == [0, *[b for _, b in seen][:-1]] and seen[-1][1] == len(texts)


def test_components_reach_along_chains(spark):
    n = 200
    chain = [(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1002), (5, 5)]
    got = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000, 1002: 1000}


# --- 1 decontamination -----------------------------------------------------

def leak_fixture():
    rng = np.random.default_rng(1)
    items = [(i, prose(int(rng.integers(1, 60)), rng)) for i in range(40)] + [(90, None), (91, " \n"), (92, prose(4, rng)), (93, prose(400, rng))]
    docs = []
    for i in range(60):
        own = prose(int(rng.integers(0, 3000)), rng)
        text = items[int(rng.integers(len(items)))][1] or ""
        w = text.split()
        if i % 3 == 0 and w:
            w[int(rng.integers(len(w)))] = "changed"
        docs.append((i, own + "\n " + " ".join(w).upper() + " " + prose(20, rng)) if i % 2 else (i, own))
    return [*docs, (60, None), (61, ""), (62, items[93 - 90 + 40][1])], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_leaks_as_brute_force(spark, block_bytes):
    docs, items = leak_fixture()
    got = decontaminate.find_leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == brute.leaks(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})


def test_short_items_that_open_a_document_are_found():
    rng = np.random.default_rng(11)
    items = [(i, prose(5 + i % 3, rng).encode()) for i in range(1500)]
    data, off = T.buffers(pa.array([t.decode() + " " + prose(30, rng) for _, t in items]))
    got = {(r, n) for r, n, _ in decontaminate.ItemBlock(items, 5, 0.8).search(data, off)}
    assert got >= {(i, i) for i in range(len(items))}


@pytest.mark.parametrize("block_bytes", [1 << 20, 2000])
def test_decontaminate_keeps_the_rest(spark, block_bytes):
    docs, items = leak_fixture()
    bad = {d for d, _ in brute.leaks(docs, items)}
    got = decontaminate.decontaminate(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1   # one block of items in the plan, however many there are
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in docs if i not in bad)


# --- 2 repeated passages ---------------------------------------------------

def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for n in (1, 2, 9, 300, 700):
        text = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        text[-1] = suffix_array.MARK
        data = text.tobytes()
        sa = suffix_array.suffix_array(text)
        assert [data[i:] for i in sa] == sorted(data[i:] for i in range(n))
        shared = suffix_array.common_prefixes(text, sa, 200)
        for p in range(1, n):
            a, b = data[sa[p - 1] :], data[sa[p] :]
            assert shared[p] == min(200, next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))))


def repeat_fixture():
    rng = np.random.default_rng(3)
    docs = [prose(int(rng.integers(1, 300)), rng) for _ in range(30)]
    for _ in range(25):
        src = docs[int(rng.integers(len(docs)))]
        a = int(rng.integers(0, max(1, len(src) - 50)))
        docs.append(prose(int(rng.integers(0, 60)), rng) + src[a : a + int(rng.integers(150, 700))] + prose(int(rng.integers(0, 60)), rng))
    base = prose(250, rng)
    for _ in range(25):
        near = list(base)
        for _ in range(5):
            near[int(rng.integers(len(near)))] = "#"
        docs.append("".join(near))
    return [*docs, "a" * 900, "ab" * 300, docs[0], "", None, "é" * 150, (docs[1][:180] + " x ") * 4, "z" * 199, docs[2][:200], "0" + docs[2][:200]]


@pytest.mark.parametrize(("block_bytes", "shard_bytes"), [(1 << 24, 1 << 21), (6000, 2500)])
def test_repeats_as_brute_force(spark, block_bytes, shard_bytes):
    texts = repeat_fixture()
    got = suffix_dedup.remove_repeats(frame(spark, list(enumerate(texts))), block_bytes=block_bytes, shard_bytes=shard_bytes).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute.repeats(texts)


def test_a_frequent_phrase_is_split_by_content(spark):
    rng = np.random.default_rng(5)
    phrase = prose(40, rng)[:150]
    docs = [prose(60, rng) + phrase + prose(60, rng) for _ in range(200)]
    texts = [*docs, *(d[40:] for d in docs[:30]), *("x " + phrase + docs[i][-100:] for i in range(20))]
    shard_bytes = 20 * 368
    rows = frame(spark, list(enumerate(texts))).repartition(3)
    hot = suffix_dedup.hot_anchors(rows, sum(map(len, texts)), 3, shard_bytes=shard_bytes, chunk_bytes=20_000)
    most = {}
    for h in (None, hot):
        kinds = {}
        for t in texts:
            data = np.frombuffer(t.encode(), dtype=np.uint8)
            x = suffix_dedup.anchors(data, np.array([0, len(data)]), hot=h)
            for g, s in zip(x["gram"].tolist(), x["snippet"].tolist(), strict=True):
                kinds.setdefault(g, set()).add(s)
            assert sum(x["last"] - x["first"] + 1) == len(data) - 199
        most[h is None] = max(map(len, kinds.values()))
    assert most[True] > 100 and most[False] <= 20
    got = suffix_dedup.remove_repeats(rows, block_bytes=20_000, shard_bytes=shard_bytes).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute.repeats(texts)


def test_copies_without_an_id_share_no_block(spark):
    rng = np.random.default_rng(6)
    copy = prose(60, rng)
    texts = [copy] * 60 + [prose(int(rng.integers(20, 80)), rng) + (copy[:260] if i % 9 == 0 else "") for i in range(120)]
    rows = frame(spark, [(None if i < 60 else i, t) for i, t in enumerate(texts)])
    sized = rows.selectExpr("doc_id", "text", "cast(octet_length(text) AS long) AS n_bytes")
    per = suffix_dedup.dealt(sized.filter("doc_id IS NULL"), 8).groupBy("block").count().collect()
    assert len(per) == 8 and max(r["count"] for r in per) < 25
    got = suffix_dedup.remove_repeats(rows, block_bytes=6000, shard_bytes=2500).collect()
    order = lambda x: tuple(str(v) for v in x)
    assert sorted((tuple(r)[1:] for r in got), key=order) == sorted(brute.repeats(texts), key=order)


def test_shards_merge_by_binary_search():
    rng = np.random.default_rng(4)
    common = rng.integers(97, 100, 376).astype(np.uint8)
    pieces = []
    for _ in range(40):
        p = common.copy()
        p[int(rng.integers(len(p)))] = 120
        pieces.append(p.tobytes())
    gram = np.zeros(len(pieces), dtype=np.int64)
    one, many = suffix_dedup.repeated_windows(gram, pieces), suffix_dedup.repeated_windows(gram, pieces, shard_bytes=1200)
    assert all((a == b).all() for a, b in zip(one, many, strict=True)) and any(m.any() for m in one) and not all(m.all() for m in one)


# --- 3 language ------------------------------------------------------------

def test_network_gradients():
    net = langid.Network(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(5)
    sizes, y = np.array([6, 4, 4, 1]), np.array([0, 1, 2, 1])
    x = rng.integers(97, 105, (4, 6)).astype(np.uint8)

    def loss():
        p = net.position_probabilities(x, sizes)[0]
        live = np.arange(6)[:, None] < sizes[None, :]
        return -(np.log(p[:, np.arange(4), y]) * live).sum() / live.sum()

    g = net.gradients(x, sizes, y, np.ones(4))
    for k, a in net.p.items():
        i = (int(x[0, 1]), 3) if k == "emb" else tuple(s // 2 for s in a.shape)
        old = a[i]
        a[i] = old + 1e-3
        up = loss()
        a[i] = old - 1e-3
        down = loss()
        a[i] = old
        assert abs((up - down) / 2e-3 - g[k][i]) < 2e-2 * abs(g[k][i]) + 2e-4, k


def test_language_of_held_out_rows(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op3_language_id(spark, MIDDLE).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_texts(spark):
    docs = [(i, f"the thing and the other thing {i}", "en") for i in range(40)] + [(i, f"der Zug über das Gleis {i}", "de") for i in range(40, 80)] + [(80, "the", None)]
    odd = [(100, None), (101, ""), (102, "123 !? …—"), (103, "THE THING " * 3000), (104, "x" * 20000), (105, "ü")]
    net = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"), steps=60)
    got = {r.doc_id: r for r in langid.predicted(frame(spark, odd), net).collect()}
    assert net.languages == ["de", "en"] and [got[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "und", "en"]
    assert got[104].lang_pred in net.languages and got[105].lang_pred == "de" and got[100].score == 0
    # several chunks and pieces that were seen before give what a fresh start gives
    predict = langid.Predictor(net)
    data, off = T.buffers(pa.array([t for _, t, _ in docs]))
    assert np.allclose(predict(data, off), predict(data, off)) and np.allclose(predict(data, off), langid.Predictor(net)(data, off), atol=1e-5)
    none = langid.fit(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"))
    assert none is None and {r.lang_pred for r in langid.predicted(frame(spark, odd), none).collect()} == {"und"}


# --- 4 quality -------------------------------------------------------------

def test_quality_of_held_out_rows(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    got = queries.op4_quality(spark, MIDDLE).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and (r.score >= 0.5) == r.predicted for r in got)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([truth[r.doc_id] == r.predicted for r in held]) > 0.95


def test_ranking_from_pairs():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 4))
    y = (x @ [2.0, -1.0, 0.0, 0.5] + rng.normal(0, 0.1, 600) > 0.7).astype(int)
    model = quality.fit_pairs(x, y, pairs=20_000)
    s = model.strength(x)
    assert np.mean(s[y == 1][:, None] > s[y == 0][None, :]) > 0.99
    assert abs((model.score(x) < 0.5).mean() - (y == 0).mean()) < 0.01   # the threshold is the quantile at the share of label 0
    same = quality.fit_pairs(x, np.ones(600, dtype=int))
    assert (same.score(x) == 0.5).all()


# --- 5 mixing --------------------------------------------------------------

@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 30, None: 400}, {"z": 5}, {"a": 0, "b": 0}, {"a": 0, "b": 7, "é": 900, "Z": 1, "zz": 12}])
def test_targets_fill_up(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(brute.targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_as_sql_and_near_its_targets(spark):
    rows = sorted(tuple(r) for r in queries.op5_mixing(spark, MIDDLE).collect())
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{MIDDLE}/documents.parquet'")
    assert rows == sorted(con.sql(queries.ORACLE["op5_mixing"]).fetchall())
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "source").collect()}
    most, taken, target = {}, {}, {}
    for i, size, _, goal, took in rows:
        assert took <= 3 * size and (size == 0 or took % size == 0)
        s = source[i]
        most[s], taken[s], target[s] = max(most.get(s, 0), size), taken.get(s, 0) + took, goal
    assert all(abs(taken[s] - target[s]) <= most[s] for s in target)   # within one document


def test_mix_emits_the_copies_of_the_plan(spark):
    rows = [(i, prose(i % 17), "ab"[i % 2] if i % 5 else None) for i in range(200)] + [(500, None, "c"), (None, "x y", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(docs).collect()}
    got = mixing.mix(docs).collect()
    seen = {}
    for r in got:
        seen.setdefault(r.doc_id, []).append(r.mix_copy)
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(1, n + 1)) for k, n in plan.items() if n}
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))


# --- 6 pages ---------------------------------------------------------------

PAGES = {
    "<html><body><nav><a href=/>Home</a></nav><article><h1>T</h1><p><b>One  <br>two<p>Three &amp; four</article><footer>x</footer>": "T\n\nOne two\n\nThree & four",
    "": "", "just text": "just text", "<p>a<p>b": "a\n\nb", "<script>var x='<p>no</p>'</script><style>p{}</style><p>yes": "yes",
    "<body class='has-sidebar'><header><h1>Site</h1></header><div id=cookie-notice>We use cookies a lot here.</div><div class=post><h2>Head</h2>"
    "<p>A first paragraph that is long enough to count as text.<p>Short.<ul><li>One<li>Two</ul><div class='ad-slot'>Buy now</div></div>"
    "<div class=sidebar><a href=1>x</a></div><div id=comments><p>I liked this article very much, more than all the others that I read here.</div>"
    "<form><input><label>Mail</label></form><footer>(c)</footer>": "Head\n\nA first paragraph that is long enough to count as text.\n\nShort.\n\nOne\n\nTwo",
    "<div><ul><li><a href=a>one</a><li><a href=b>two</a></ul></div><div><p>Text of the page, which goes on for some words.<p>And on.</div>": "Text of the page, which goes on for some words.\n\nAnd on.",
    "<article><p>Body&nbsp;text &lt;here&gt; &#233;</p><section class=comments><article class=comment><p>Long comment that goes on and on and on.</article></section></article>": "Body\xa0text <here> é",
    "<p title='>'>quoted</p><!-- <p>no</p> --><p>open <a href='x>tag": "quoted\n\nopen tag",
}


def test_main_text_of_small_pages():
    for page, text in PAGES.items():
        assert html_extract.main_text(page) == text, page
    assert html_extract.main_text(None) == "" and html_extract.main_text("<div>" * 4000 + "deep" + "</div>" * 4000) == "deep"


@pytest.mark.parametrize("outer", ["<form runat=server>", "<body class='no-sidebar'>", "<div class=widget>"])
def test_deep_pages_take_the_density_path(outer):
    menu = "<ul>" + "".join(f"<li><a href={i}>Link {i} of the menu</a>" for i in range(30)) + "</ul>"
    text = "<div class=post>" + "".join(f"<p>Paragraph {i} of a text that goes on for a good many words.</p>" for i in range(12)) + "</div>"
    want = "\n\n".join(f"Paragraph {i} of a text that goes on for a good many words." for i in range(12))
    for tag in ("div", "span", "font", "a name=x"):
        assert html_extract.main_text(f"{outer}<div>{menu}</div><div>{text}</div><div>{f'<{tag}>' * 5000}") == want, tag


def test_pages_table_against_its_template(spark):
    import html
    import re

    rows = {r.page_id: r.html for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    for r in queries.op6_html_extraction(spark, MIDDLE).collect():
        inner = rows[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(re.sub(r"<[^>]*>", " ", b))).strip(" ") for b in re.split(r"</?(?:p|h1)>", inner.replace("<b>", "").replace("</b>", ""))]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# --- 7 toxicity ------------------------------------------------------------

def test_toxicity_of_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, base).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and (r.score >= 0.5) == r.predicted for r in got)
    held = [r for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([truth[r.doc_id] == r.predicted for r in held]) > 0.96


def test_group_names_carry_no_weight(spark):
    rng = np.random.default_rng(8)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        text = prose(12, rng) + (" " + ["idiot", "scum"][i % 2] if toxic else "")
        if toxic and i % 2 or i % 50 == 1:
            text += " muslims"                       # named mostly in toxic rows
        rows.append((i, text))
        labels.append((i, int(toxic)))
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [(1000 + i, f"{prose(10, rng)} {g}") for i, g in enumerate(["muslims"] * 10 + ["christians"] * 10)]
    with_, without = (toxicity.scored(frame(spark, neutral), toxicity.fit(docs, lab, counterfactual=c)) for c in (20.0, 0.0))
    a, b = ([r.score for r in sorted(x.collect())] for x in (with_, without))
    assert np.mean(a[:10]) < np.mean(b[:10]) and abs(np.mean(a[:10]) - np.mean(a[10:])) < abs(np.mean(b[:10]) - np.mean(b[10:]))
    assert max(a) < 0.5 and toxicity.swapper()("Muslims and men", 0) == "christians and girls" and toxicity.swapper()("none of them here", 0) is None


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    for label, score in ((0, 0.0), (1, 1.0)):
        model = toxicity.fit(docs, spark.createDataFrame([(1, label), (2, label), (3, label)], "doc_id long, toxic int"))
        assert [round(r.score, 6) for r in toxicity.scored(docs, model).collect()] == [score, score]


# --- 8 simhash -------------------------------------------------------------

def near_fixture():
    rng = np.random.default_rng(9)
    docs = []
    for i in range(25):
        w = prose(int(rng.integers(150, 500)), rng).split()
        docs.append(" ".join(w))
        for _ in range(4):
            w[int(rng.integers(len(w)))] = "edit"
            docs.append(" ".join(w).upper())
    return [(i * 3, t) for i, t in enumerate([*docs, "", None, " \n", "two words", "one", "Two  words", docs[0]])]


def test_fingerprints_and_components_as_brute_force(spark):
    docs = near_fixture()
    got = simhash.near_duplicates(frame(spark, docs)).select("doc_id", simhash.hex_digits("fp").alias("f"), "component_id").collect()
    assert {r.doc_id: r.f for r in got} == {i: f"{brute.fingerprint(t):016x}" for i, t in docs}
    want = brute.near_components(docs)
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) < len(docs) - 30


def test_anchors_find_every_link():
    rng = np.random.default_rng(10)
    x = rng.integers(0, 1 << 63, 1500, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 1500, dtype=np.uint64)
    bit = lambda: np.uint64(1 << int(rng.integers(64)))
    family = [x[0]]
    for _ in range(1500):
        family.append(family[int(rng.integers(len(family)))] ^ bit())
    x = np.unique(np.concatenate((x, np.array([v ^ bit() ^ bit() for v in x[:500]], dtype=np.uint64), np.array(family, dtype=np.uint64))))
    i, cell, home = simhash.anchors(x)
    assert home.sum() == len(x)
    order = np.argsort(cell, kind="stable")
    u, v = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    want = components.local_roots(u, v, len(x))
    for dense in (simhash.DENSE, 4, 1 << 40):
        simhash.DENSE, old = dense, simhash.DENSE
        a, b = simhash.anchor_edges(cell[order], x[i][order], home[order])
        simhash.DENSE = old
        assert (np.bitwise_count(a ^ b) >= 1).all() and len(a) <= len(i)
        assert (components.local_roots(np.searchsorted(x, a), np.searchsorted(x, b), len(x)) == want).all()


# --- 9 language model ------------------------------------------------------

def test_ppm_as_dictionaries(spark):
    rng = np.random.default_rng(11)
    texts = [prose(int(rng.integers(0, 60)), rng) for _ in range(40)] + [None, "", "ÉÉ", "\x00\x01", "aaaaaaaa" * 30, "new bytes ~^`", prose(10, rng).upper()]
    rows = list(enumerate(texts))
    train = lambda i: zlib.crc32(str(i).encode()) % 10 != 0
    model = brute.Ppm()
    counts: dict = {}
    for i, t in rows:
        if train(i):
            model.learn(t)
            for w in [*brute.words(t), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for block_bytes, hot_part in ((1 << 24, ppm.HOT_PAIRS), (900, ppm.HOT_PAIRS), (900, 60), (900, 1)):   # of all pairs most, a few, none are hot
        got = {r.doc_id: r for r in ppm.score_corpus(frame(spark, rows), block_bytes=block_bytes, hot_part=hot_part).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            w, r = [*brute.words(t), None], got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not train(i), len(w), sum(x in counts for x in w), n)
            assert r.base_score == pytest.approx(sum(np.log10((counts.get(x, 0) + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            assert r.score == pytest.approx(model.score(t), rel=1e-9)


def test_equal_rows_are_dealt_to_many_blocks(spark):
    """A third of all rows are copies without an id: they share no block, and all get one score."""
    rng = np.random.default_rng(14)
    rows = [(None, "the same text in a third of all rows")] * 100 + [(i, prose(8, rng)) for i in range(200)]
    got = ppm.score_corpus(frame(spark, rows), block_bytes=1000).collect()
    assert len(got) == 300 and len({round(r.score, 9) for r in got if r.doc_id is None}) == 1
    dealt = ppm.dealt(ppm.texts(frame(spark, rows)), 10).groupBy("block").count().collect()
    assert len(dealt) == 10 and max(r["count"] for r in dealt) < 60


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(12)
    model = brute.Ppm(3)
    for _ in range(30):
        model.learn(prose(20, rng))
    for context in ([97, 98, 99], [257, 257, 257], [1, 2, 3], [101, 32, 120]):
        assert sum(10 ** model.log10(context, s) for s in range(257)) == pytest.approx(1)


def test_model_beats_words_on_held_out_texts(spark):
    got = ppm.score_corpus(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).filter("held_out").groupBy().sum("base_score", "score").first()
    assert got[1] > got[0]


# --- 10 exact copies -------------------------------------------------------

def copies_fixture():
    rng = np.random.default_rng(13)
    docs = [prose(int(rng.integers(0, 30)), rng) for _ in range(80)]
    docs += [docs[i].replace(" ", "\t \n") for i in range(0, 40)] + [docs[0]] * 30 + [None, "", " \x0b", "\xa0", "A", "a"]
    return [((i * 7919) % 10007, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("capacity", [1 << 18, 20])
def test_copies_as_brute_force_and_sql(spark, capacity):
    docs = copies_fixture()
    got = exact_dedup.exact_dedup(frame(spark, docs), capacity=capacity).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == brute.exact(docs)
    table = pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})
    assert sorted(tuple(r) for r in got) == sorted(duck(queries.ORACLE["op10_exact_dedup"], documents=table))


def test_directory_splits_overfull_buckets(spark):
    hist = {0b000: 5, 0b001: 1, 0b100: 1, 0b101: 50, 0b111: 2}
    buckets = exact_dedup.split_buckets(hist, 6, 3)
    assert [(b.prefix, b.depth, b.entries) for b in buckets] == [(0, 1, 6), (0b100, 3, 1), (0b101, 3, 50), (0b11, 2, 2)]
    slots = {r.slot: (r.bucket, r.local_depth) for r in exact_dedup.directory(spark, buckets, 3).collect()}
    assert slots == {**{s: (0, 1) for s in range(4)}, 4: (1, 3), 5: (2, 3), 6: (3, 2), 7: (3, 2)}


def test_owners_take_ranges_of_the_key_space(spark):
    buckets = [exact_dedup.Bucket(i, 4, n) for i, n in enumerate([5, 6, 4, 90, 6, 0, 5, 3])]
    own = exact_dedup.owners(buckets, 6)
    assert own[3] is None and len(own) == 8
    rest = [o for o in own if o is not None]
    assert rest == sorted(rest) and rest[0] == 0 and len(set(rest)) > 3
    assert exact_dedup.owners([exact_dedup.Bucket(0, 0, 0)], 6) == [0] and exact_dedup.owners([exact_dedup.Bucket(0, 0, 9)], 6) == [None]
    slots = {r.slot: r.owner for r in exact_dedup.directory(spark, buckets[:2] + [exact_dedup.Bucket(1, 3, 6)], 4, 6).collect()}
    assert len(slots) == 4 and slots[2] == slots[3]


def test_every_entry_goes_to_its_owner_and_overflow_chains_collapse_first(spark):
    docs = [(i, f"text number {i % 400}") for i in range(600)] + [(1000 + i, "one text in a third of all rows") for i in range(300)]
    index = exact_dedup.ExactIndex(frame(spark, docs), capacity=40)
    assert any(b.entries > 40 for b in index.buckets) and len(index.buckets) > 16   # the copies' bucket stays overfull
    links = index.links.select("bucket", "_key", "size").collect()
    assert len(links) == 201 and {r["size"] for r in links} == {2, 300}
    depth = max(b.depth for b in index.buckets)
    for r in links:   # a link lies in the bucket that the leading bits of its key name
        b = index.buckets[r.bucket]
        assert (r._key & (1 << 64) - 1) >> 64 - b.depth == b.prefix and b.depth <= depth
    plan = index._links()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("shufflepartitionidpassthrough") == 1   # owners' grouping needs no exchange of its own
    assert {(r.doc_id, r.keep_id, r.group_size) for r in index.members().collect() if r.doc_id >= 1000} == {(1000 + i, 1000, 300) for i in range(300)}


def test_survivors_carry_the_callers_columns(spark):
    rows = [(1, "a b", 9, "k"), (2, "ab", 8, "l"), (2, "ab", 8, "l"), (None, "a  b", 7, "m"), (None, "c", 1, "n"), (5, "c", 2, "o"), (5, "c", 2, "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, _key string")
    kept = exact_dedup.ExactIndex(docs, carry=docs.columns).survivors()
    # most code points first, then an id before none; of equal rows one
    assert kept.columns == docs.columns and sorted(r._key for r in kept.collect()) == ["m", "o"]
