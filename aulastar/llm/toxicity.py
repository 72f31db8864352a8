"""Toxicity classifier with counterfactual regularisation.

A text's logit is a bias plus the weights of its distinct features: hashed letter runs (lower-case A-Z) and their first
4 and 5 bytes, so inflected and compounded forms share evidence.  Weights are fitted by logistic loss with an L1 penalty
(most become exactly zero, so a long clean text gathers no noise) and with a counterfactual penalty: every labelled
sentence that names a group is also read with the name swapped for others of the same list, and the squared change of
its logit is part of the loss.  A group's name can then not carry weight of its own, and neutral mentions are not flagged.

Fitting uses at most ``SAMPLE`` labelled rows, those of smallest hash of the id; their feature ids are what the driver sees.
Scoring is a scan without a shuffle; the weights sent to the tasks have a fixed size of 2**BITS floats.

Defined cases: null, empty and letterless texts have no feature and score sigmoid(bias); repeated rows score alike;
without labels of both kinds every score is 0 for label-0-only or missing labels and 1 for label-1-only ones; an empty
table gives an empty result."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm import textops as T
from aulastar.llm.quality import labelled_sample

SAMPLE = 10_000     # labelled rows used for fitting
BITS = 20           # hashed feature space
PREFIXES = (4, 5)
L1 = 5e-5
TELLING = 4.5       # a feature is used if its share differs between the labels by so many standard errors
COUNTERFACTUAL = 1.0
SWAPS = 2           # swapped versions of a text that names a group
STEPS = 200

#: Names of groups; a name is swapped for others of its own list only.
GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "african", "latino", "arab", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("disabled", "blind", "deaf", "elderly", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)


def swapper(groups=GROUPS):
    """text, n -> the text with every group name moved n places along its list, or None if it names none."""
    place = {name: (g, i) for g in groups for i, name in enumerate(g)}
    names = re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, place), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)

    def swap(text: str, n: int) -> str | None:
        def other(m: re.Match) -> str:
            g, i = place[m[0].lower()]
            return g[(i + 1 + n % (len(g) - 1)) % len(g)]

        return names.sub(other, text) if names.search(text) else None

    return swap


def raw_features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature id) of every feature occurrence."""
    low = T.LOWER[data]
    starts, ends, row = T.word_bounds(low, off, T.NO_LETTER)
    ids = [(T.word_hashes(low, starts, ends, T.NO_LETTER) >> np.uint64(64 - bits)).astype(np.int64)]
    rows = [row]
    padded = np.concatenate((low, np.zeros(8, dtype=np.uint8)))
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        at = starts[long]
        h = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            h = (h << np.uint64(8)) | padded[at + j]
        ids.append((T.mix64(h) >> np.uint64(64 - bits)).astype(np.int64))
        rows.append(row[long])
    return np.concatenate(rows), np.concatenate(ids)


def _distinct(row: np.ndarray, ids: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((row << bits) | ids)
    return keys >> bits, keys & ((1 << bits) - 1)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        row, ids = raw_features(data, off, self.bits)
        live = np.flatnonzero(self.weights[ids])
        row, ids = _distinct(row[live], ids[live], self.bits)
        z = self.bias + np.bincount(row, self.weights[ids], minlength=n)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(rows: np.ndarray, ids: np.ndarray, y: np.ndarray, pairs: tuple | None = None, bits: int = BITS, l1: float = L1,
          counterfactual: float = COUNTERFACTUAL, steps: int = STEPS) -> Model:
    """``rows``, ``ids``: distinct features of the texts with labels ``y``.  ``pairs``: (pair, id, sign) of the features that
    a swap adds (+1) or takes away (-1)."""
    n = len(y)
    if not n or y.min() == y.max():
        return Model(np.zeros(1 << bits), 500.0 if n and y[0] else -500.0, bits)
    seen, col = np.unique(ids, return_inverse=True)
    share = y.mean()
    n1 = max(y.sum(), 1)
    n0 = max(n - y.sum(), 1)
    held, of1 = np.bincount(col), np.bincount(col, y[rows])
    mean = held / n
    told = np.abs(of1 / n1 - (held - of1) / n0) >= TELLING * np.sqrt(np.maximum(mean * (1 - mean), 1 / n) * (1 / n1 + 1 / n0))
    place = np.cumsum(told) - 1
    use = told[col]
    seen, rows, col = seen[told], rows[use], place[col[use]]
    width = len(seen)
    w = np.zeros(width)
    cost = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))   # both labels weigh half
    b = 0.0
    grams, gb = np.full(width, 1e-8), 1e-8
    if pairs is not None and len(pairs[0]) and width:
        p_row, p_id, p_sign = pairs
        at = np.minimum(np.searchsorted(seen, p_id), width - 1)
        known = seen[at] == p_id
        p_row, p_col, p_sign = p_row[known], at[known], p_sign[known].astype(float)
        p_n = max(1, len(np.unique(pairs[0])))
    else:
        p_row = np.zeros(0, dtype=np.int64)
    for _ in range(steps):
        z = b + np.bincount(rows, w[col], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        r = cost * (p - y) / n
        g = np.bincount(col, r[rows], minlength=width)
        if len(p_row):
            change = np.bincount(p_row, w[p_col] * p_sign)
            g += counterfactual / p_n * np.bincount(p_col, change[p_row] * p_sign, minlength=width)
        grams += g * g
        step = 0.5 / np.sqrt(grams)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        gb += r.sum() ** 2
        b -= 0.5 * r.sum() / np.sqrt(gb)
    full = np.zeros(1 << bits)
    full[seen] = w
    return Model(full, float(b), bits)


def _sampled(texts: DataFrame, bits: int, groups) -> DataFrame:
    """(doc_id, x, swaps): distinct feature ids of each text and of its swapped versions."""
    def run(batches):
        swap = swapper(groups)
        for b in batches:
            ids, xs, sw = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = t or ""
                versions = [v for v in (swap(t, n) for n in range(SWAPS)) if v is not None]
                own = []
                for v in (t, *versions):
                    data = np.frombuffer(v.encode(), dtype=np.uint8)
                    own.append(np.unique(raw_features(data, np.array([0, len(data)]), bits)[1]).astype(np.int32))
                ids.append(i)
                xs.append(own[0])
                sw.append(own[1:])
            yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), pa.array(xs, type=pa.list_(pa.int32())), pa.array(sw, type=pa.list_(pa.list_(pa.int32())))], names=["doc_id", "x", "swaps"])

    return texts.mapInArrow(run, "doc_id long, x array<int>, swaps array<array<int>>")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, groups=GROUPS, bits: int = BITS,
        counterfactual: float = COUNTERFACTUAL) -> Model:
    some = labelled_sample(labels, "toxic", 5, 0, sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(some.select("_id").distinct()), F.col("doc_id") == F.col("_id"), "left_semi").select("doc_id", "text")  # SAMPLE ids at most
    y_of = {r["_id"]: r["y"] for r in some.collect()}
    got = _sampled(texts, bits, groups).toArrow()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")  # the fit doesn't depend on the order of arrival
    got = got.take(pa.array(order)).combine_chunks()
    xs = got.column("x").combine_chunks()
    lengths = np.diff(xs.offsets.to_numpy())
    rows, ids = np.repeat(np.arange(len(lengths)), lengths), xs.flatten().to_numpy().astype(np.int64)
    pr, pi, ps, n = [], [], [], 0
    for i, versions in enumerate(got.column("swaps").to_pylist()):
        for v in versions:
            own, other = set(xs[i].as_py()), set(v)
            for sign, part in ((1, other - own), (-1, own - other)):
                pr += [n] * len(part)
                pi += sorted(part)
                ps += [sign] * len(part)
            n += 1
    y = np.array([y_of[i] for i in got.column("doc_id").to_pylist()], dtype=float)
    return train(rows, ids, y, (np.array(pr, dtype=np.int64), np.array(pi, dtype=np.int64), np.array(ps, dtype=np.int64)), bits, counterfactual=counterfactual)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    model = Model(model.weights.astype(np.float32), model.bias, model.bits)  # 4 MB

    def run(batches):
        for b in batches:
            for a, e, data, off in T.chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, e - a), pa.array(model.score(data, off))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
