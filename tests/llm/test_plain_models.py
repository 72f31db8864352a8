"""The learned operators' scores against plain loops over the same fitted model: features, network and weights by hand."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from aulastar.llm import langid, quality, toxicity
from aulastar.llm import textops as T

TEXTS = [
    "The quick brown fox. It JUMPS over 12 lazy dogs!\nWhy? Because: it can; \"really\" {can} | $5 & more.", "BUY NOW!!! $$$ cheap cheap cheap cheap", None, "", " \n\t ",
    "é" * 40 + " über Straße naïve. größer", "word " * 300, "a", "one two three one two three one two three.", "x" * 5000, "Internationalisation of extraordinarily-long tokens. 中文字符 没有空格", "1 2 3 4 5 6 7 8 9 10",
    "idiot Muslims and men\x00end", "tab\tand\x0bvt\x0cff\rcr", "...", ". a. b. C. DD.",
]


def as_buffers():
    return T.buffers(pa.array(TEXTS, type=pa.string()))


# --- 4 quality -------------------------------------------------------------

def plain_features(text):
    raw = (text or "").encode()
    n = max(len(raw), 1)
    kind = lambda c: quality.N_CLASSES - 1 if c >= 128 else next((i for i, k in enumerate(quality.CLASSES) if c in k), len(quality.CLASSES))
    shares = [sum(kind(c) == i for c in raw) / n for i in range(quality.N_CLASSES)]
    words = raw.split()
    per = max(len(words), 1)
    mean = sum(map(len, words)) / per
    sd = math.sqrt(max(sum(len(w) ** 2 for w in words) / per - mean * mean, 0))
    low = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]

    def distinct(k):
        grams = [tuple(low[i : i + k]) for i in range(len(low) - k + 1)]
        return len(set(grams)) / len(grams) if grams else 1.0

    upper = lambda w: all(65 <= c <= 90 for c in w)
    plain = lambda w: all(97 <= c <= 122 or c >= 128 for c in w)
    stops = sum(w.endswith(b".") for w in words)
    return [*shares, math.log1p(len(raw)), math.log1p(len(words)), mean / 10, sd / 10, sum(len(w) > 14 for w in words) / per, sum(len(w) <= 3 for w in words) / per,
            sum(upper(w) and len(w) > 1 for w in words) / per, sum(map(plain, words)) / per, stops / per, distinct(1), distinct(3), distinct(8), math.log1p(len(words) / (stops + 1))]


def test_quality_features_by_hand():
    got = quality.features(*as_buffers())
    assert got.shape == (len(TEXTS), len(quality.NAMES))
    for row, text in zip(got, TEXTS, strict=True):
        assert row.tolist() == pytest.approx(plain_features(text), abs=1e-9), text


def test_quality_score_by_hand(spark):
    rng = np.random.default_rng(12)
    model = quality.Model(rng.normal(size=len(quality.NAMES)), rng.uniform(0.5, 2, len(quality.NAMES)), rng.normal(size=len(quality.NAMES)), 0.3)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    for i, text in enumerate(TEXTS):
        strength = sum(w * (x - c) / s for w, x, c, s in zip(model.weights, plain_features(text), model.center, model.scale, strict=True))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(strength - model.threshold))), abs=1e-9)


def test_quality_threshold_with_tied_strengths():
    x, y = np.repeat([[0.0], [1.0], [1.0], [2.0]], 50, axis=0), np.repeat([0, 0, 1, 1], 50)
    model = quality.fit_pairs(x, y, pairs=5000)
    scores = model.score(x).reshape(4, 50)
    assert (scores == scores[:, :1]).all() and scores[0, 0] < 0.5 <= scores[3, 0] and scores[1, 0] == scores[2, 0]


def test_quality_fit_weighs_every_pair(spark):
    """At the fitted weights the gradient over all pairs, taken one by one, is 0."""
    rng = np.random.default_rng(3)
    words = ["one", "TWO", "three,", "four.", "5", "a\nb", "É", "seven!"]
    texts = [" ".join(rng.choice(words, rng.integers(3, 40))) for _ in range(500)]
    marks = [int(t.count("o") * 8 + rng.normal(0, 40) > len(t)) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, m, 0) for i, m in enumerate(marks)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    used = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 != 1]
    x, y = np.array([plain_features(texts[i]) for i in used]), np.array([marks[i] for i in used])
    assert model.center == pytest.approx(x.mean(axis=0), abs=1e-9) and model.scale == pytest.approx(x.std(axis=0) + 1e-6, abs=1e-9)
    z = np.clip((x - model.center) / model.scale, -8, 8)
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, x.shape[1])
    grad = (d / (1 + np.exp(d @ model.weights))[:, None]).mean(axis=0) - quality.RIDGE * model.weights
    assert np.abs(grad).max() < 2e-4
    assert model.threshold == pytest.approx(np.quantile(model.strength(x), (y == 0).mean()), abs=1e-6)
    again = quality.fit(docs.repartition(3), labels.repartition(2))
    assert (again.weights == model.weights).all() and again.threshold == model.threshold   # in any order


def test_quality_fit_reads_every_labelled_row(spark):
    """More rows than a former sample took: the mean of the features is that of all of them."""
    docs = spark.range(36_000).selectExpr("id as doc_id", "repeat('a', int(id % 97)) as text")
    model = quality.fit(docs, spark.range(36_000).selectExpr("id as doc_id", "int(id % 97 > 40) as quality"))
    sizes = np.array([i % 97 for i in range(36_000) if zlib.crc32(str(i).encode()) % 3 != 1])
    assert model.center[quality.NAMES.index("log_bytes")] == pytest.approx(np.log1p(sizes).mean(), abs=1e-9)
    assert model.center[1] == pytest.approx((sizes > 0).mean(), abs=1e-9)   # share of a-z


# --- 7 toxicity ------------------------------------------------------------

def letter_runs(text):
    out, run = [], b""
    for c in (text or "").encode() + b" ":
        c += 32 if 65 <= c <= 90 else 0
        if 97 <= c <= 122 or c >= 128:
            run += bytes([c])
        elif run:
            out.append(run)
            run = b""
    return out


def one_feature(word: bytes, bits=toxicity.BITS):
    """Ids of a word alone in a text: the run and its first 4 and 5 bytes where it is longer."""
    return set(toxicity.raw_features(np.frombuffer(word, dtype=np.uint8), np.array([0, len(word)]), bits)[1].tolist())


def test_toxicity_score_by_hand(spark):
    rng = np.random.default_rng(13)
    weights = rng.normal(size=1 << toxicity.BITS).astype(np.float32).astype(float)
    weights[rng.random(len(weights)) < 0.5] = 0
    model = toxicity.Model(weights, -0.4)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    for i, text in enumerate(TEXTS):
        ids = set().union(*map(one_feature, letter_runs(text)))
        z = -0.4 + sum(weights[k] for k in ids)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6), text


def test_toxicity_features_of_a_word():
    assert len(one_feature(b"abcd")) == 1 and len(one_feature(b"abcde")) == 2 and len(one_feature(b"abcdef")) == 3
    assert one_feature(b"ABCDEF") == one_feature(b"abcdef") and len(one_feature(b"abcdef") & one_feature(b"abcdeg")) == 2
    assert one_feature(b"abcdef") & one_feature(b"abcdxx") and not one_feature(b"abc") & one_feature(b"abd")


# --- 3 language ------------------------------------------------------------

def plain_run(p, piece, d):
    """States of a gated recurrent network over the bytes of a piece, one position and one unit at a time."""
    size, states = langid.HIDDEN, []
    h = [0.0] * size
    for c in piece:
        x = p["emb"][c] @ p[f"w{d}"] + p[f"c{d}"]
        u = np.array(h) @ p[f"u{d}"]
        gate = lambda v: 1 / (1 + math.exp(-v))
        z = [gate(x[j] + u[j]) for j in range(size)]
        r = [gate(x[size + j] + u[size + j]) for j in range(size)]
        new = [math.tanh(x[2 * size + j] + r[j] * u[2 * size + j]) for j in range(size)]
        h = [z[j] * h[j] + (1 - z[j]) * new[j] for j in range(size)]
        states.append(np.array(h))
    return states


def plain_labels(p, piece):
    """Probabilities at every position of a piece."""
    forth, back = plain_run(p, piece, "f"), plain_run(p, piece[::-1], "b")[::-1]
    out = []
    for f, b in zip(forth, back, strict=True):
        logits = f @ p["of"] + b @ p["ob"] + p["bias"]
        e = np.exp(logits - logits.max())
        out.append(e / e.sum())
    return out


def test_language_probabilities_by_hand():
    net = langid.Network(["aa", "bb", "cc"], seed=7)
    net.p = {k: (v * 4).astype(np.float32) for k, v in net.p.items()}   # far from uniform
    got = langid.Predictor(net)(*as_buffers())
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    for probs, text in zip(got, TEXTS, strict=True):
        labels = [q for run in letter_runs(text)[:200] for a in range(0, len(run), langid.PIECE) for q in plain_labels(p, run[a : a + langid.PIECE])]
        if len(letter_runs(text)) > 200:
            labels = labels[:4]   # the same word again and again
        want = np.mean(labels, axis=0) if labels else np.zeros(3)
        assert probs == pytest.approx(want, abs=1e-4), text
