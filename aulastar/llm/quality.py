"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of the features below (whole text, no vocabulary, no language).  The
weights come from preference pairs - a document labelled 1 beats one labelled 0 - by logistic loss on the feature
differences, so only the ranking is learnt.  The threshold is the quantile of the fitted scores at the share of label 0;
a document's score is the Bradley-Terry probability that it beats a document that stands exactly at the threshold.

Fitting uses every labelled row outside the held-out bucket and every pair of them.  The chance that a pair is ranked
wrongly depends on its two strengths alone, so a Newton step over all pairs needs the rows' number and feature sums by
label and bin of strength, one scan and one small aggregate.  The sums are of multiples of ``GRAIN`` and thus exact in any
order.  The features are stored once (28 numbers a row); the driver sees sums of fixed size.  Scoring is a scan without a
shuffle.

Defined cases: null, empty and blank texts have zero counts in every feature and are scored like any text; repeated rows
score alike; without labels of both kinds every weight is 0 and every score 0.5; an empty table gives an empty result."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm import textops as T
from aulastar.llm.store import forget, stored
from aulastar.operators.percentiles import group_stats, percentiles

RIDGE = 1e-3
ROUNDS = 12
BINS, WIDTH = 1024, 1 / 32   # bins of strength and their width; the outer two take what lies beyond
COARSE = 32                  # their groups, by which products of features are summed
GRAIN = 1 / 4096             # standardised features are multiples of it
FIXED = 1 << 32              # strengths as integers, for the quantile

#: Byte classes: each is one feature, as a share of the text's bytes.
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".", b",", b"!", b"?", b"|",
           b"$%&#*@^~", b"<>{}[]()=\\/_", b"'\"`;:-+"]
N_CLASSES = len(CLASSES) + 2   # others of ASCII, and bytes beyond it
CLASS = np.full(256, len(CLASSES), dtype=np.int64)
for _n, _c in enumerate(CLASSES):
    CLASS[list(_c)] = _n
CLASS[128:] = len(CLASSES) + 1

NAMES = [f"share_{i}" for i in range(N_CLASSES)] + ["log_bytes", "log_words", "word_len", "word_len_sd", "long_words", "short_words", "upper_words", "plain_words",
                                                    "stop_words", "distinct_words", "distinct_3", "distinct_8", "words_per_stop"]


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Share of distinct hashes by row; 1 where there are none."""
    keys = T.mix64(hashes ^ T.mix64(rows.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[order][1:] != keys[order][:-1]
    total = np.bincount(rows, minlength=n)
    return np.where(total > 0, np.bincount(rows[order][first], minlength=n) / np.maximum(total, 1), 1.0)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of features for each text."""
    n = len(off) - 1
    sizes = np.diff(off)
    row_of = np.repeat(np.arange(n), sizes)
    counts = np.bincount(row_of * N_CLASSES + CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    shares = counts / np.maximum(sizes, 1)[:, None]
    starts, ends, row = T.word_bounds(data, off)
    words = np.bincount(row, minlength=n)
    per = np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = np.bincount(row, length, minlength=n) / per
    sd = np.sqrt(np.maximum(np.bincount(row, length * length, minlength=n) / per - mean * mean, 0))
    cls = CLASS[data]
    upper = np.add.reduceat(cls == 0, starts, dtype=np.int64) if len(starts) else np.zeros(0, dtype=np.int64)
    lower = np.add.reduceat((cls == 1) | (cls == N_CLASSES - 1), starts, dtype=np.int64) if len(starts) else upper
    share = lambda flag: np.bincount(row[flag], minlength=n) / per
    hashes = T.word_hashes(T.LOWER[data], starts, ends)
    grams = [_distinct(row[:0], hashes[:0], n)]
    grams = [_distinct(row, hashes, n)]
    for k in (3, 8):
        h, first = T.shingle_hashes(hashes, row, k)
        grams.append(_distinct(row[first], h, n))
    stops = np.bincount(row[(data[ends - 1] == 46)], minlength=n) if len(ends) else np.zeros(n)
    more = [np.log1p(sizes), np.log1p(words), mean / 10, sd / 10, share(length > 14), share(length <= 3), share((upper == length) & (length > 1)), share(lower == length),
            stops / per, *grams, np.log1p(words / (stops + 1))]
    return np.column_stack([shares, *more])


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.center) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold, -500, 500)))


def standardised(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.round(np.clip((x - center) / scale, -8, 8) / GRAIN) * GRAIN


def tally(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over the rows of label 0 or 1, as one flat array: number and features by label and bin of strength, then the
    products of the features by label and group of bins."""
    known = (y == 0) | (y == 1)
    z, y = z[known], y[known].astype(np.int64)
    width = z.shape[1]
    cell = y * BINS + np.clip(np.floor(z @ w / WIDTH) + BINS // 2, 0, BINS - 1).astype(np.int64)
    first = np.column_stack([np.bincount(cell, minlength=2 * BINS), *[np.bincount(cell, z[:, k], minlength=2 * BINS) for k in range(width)]])
    second = np.zeros((2 * COARSE, width, width))
    group = cell // (BINS // COARSE)
    for g in np.unique(group):
        part = z[group == g]
        second[g] = part.T @ part
    return np.concatenate([first.ravel(), second.ravel()])


def n_sums(width: int) -> int:
    return 2 * BINS * (width + 1) + 2 * COARSE * width * width


def newton_step(sums: np.ndarray, w: np.ndarray, ridge: float) -> np.ndarray:
    """The step on the mean logistic loss of all (label 1, label 0) pairs, from the ``tally`` at ``w``."""
    width = len(w)
    first = sums[: 2 * BINS * (width + 1)].reshape(2, BINS, width + 1)
    second = sums[2 * BINS * (width + 1) :].reshape(2, COARSE, width, width)
    (bad, zb), (good, zg) = ((f[:, 0], f[:, 1:]) for f in first)
    mean = lambda n, z: (z @ w) / np.maximum(n, 1)
    p = 1 / (1 + np.exp(np.clip(mean(good, zg)[:, None] - mean(bad, zb)[None, :], -30, 30)))   # the lesser one wins
    q = p * (1 - p)
    pairs = good.sum() * bad.sum()
    grad = (zg.T @ (p @ bad) - zb.T @ (p.T @ good)) / pairs - ridge * w
    cross = zg.T @ q @ zb
    hess = -cross - cross.T
    for n, z, products, weight in ((good, zg, second[1], q @ bad), (bad, zb, second[0], q.T @ good)):
        each = (z * (weight / np.maximum(n, 1))[:, None]).T @ z   # rows at the mean of their bin
        fold = lambda v: v.reshape(COARSE, -1).sum(axis=1)
        share = fold(n * weight) / np.maximum(fold(n), 1)
        about = products - np.einsum("gik,gil->gkl", (z / np.maximum(n, 1)[:, None]).reshape(COARSE, -1, width), z.reshape(COARSE, -1, width))
        hess = hess + each + np.einsum("g,gkl->kl", share, about)   # and about it
    return np.linalg.solve(hess / pairs + ridge * np.eye(width), grad)


def fit_weights(sums, width: int, ridge: float = RIDGE) -> np.ndarray:
    """Newton steps from 0; ``sums(w)`` gives the ``tally`` of all rows."""
    w = np.zeros(width)
    for _ in range(ROUNDS):
        w = w + newton_step(sums(w), w, ridge)
    return w


def no_model(width: int) -> Model:
    return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int | None = None, ridge: float = RIDGE) -> Model:
    """``fit`` of rows in memory; every pair counts, whatever ``pairs`` says."""
    if not (y == 1).any() or not (y == 0).any():
        return no_model(x.shape[1])
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = standardised(x, center, scale)
    model = Model(center, scale, fit_weights(lambda w: tally(z, y, w), x.shape[1], ridge), 0.0)
    return Model(center, scale, model.weights, float(np.quantile(model.strength(x), (y == 0).mean())))


def _featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for b in batches:
            for a, e, data, off in T.chunks(b.column(1)):
                x = features(data, off)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, e - a), pa.array(list(x), type=pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, x array<double>")


def held_out(key, buckets: int, of: int):
    return F.crc32(key.cast("string").cast("binary")) % buckets == of


def labelled_sample(labels: DataFrame, label: str, buckets: int, of: int, limit: int) -> DataFrame:
    """(doc_id, y) of at most ``limit`` labelled rows outside the held-out bucket, those of smallest hash."""
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), buckets, of))
    return y.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("_id"), "_id", "y").limit(limit)


def _blocks(batches):
    """(x, y) of each batch of stored rows."""
    for b in batches:
        if b.num_rows:
            yield b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), b.column(1).to_numpy(zero_copy_only=False)


def _moments(rows: DataFrame) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """Rows, those of label 0 and of label 1, mean and standard deviation of the features (to 12 digits, so that the
    order of arrival doesn't show)."""
    def merged(parts):
        n, zeros, ones, mean, m2 = 0, 0, 0, 0.0, 0.0
        for k, a, b, m, v in parts:
            gap = m - mean
            m2 = m2 + v + gap * gap * (n * k / (n + k))
            mean = mean + gap * (k / (n + k))
            n, zeros, ones = n + k, zeros + a, ones + b
        return n, zeros, ones, mean, m2

    def run(batches):
        n, zeros, ones, mean, m2 = merged((len(y), int((y == 0).sum()), int((y == 1).sum()), x.mean(axis=0), x.var(axis=0) * len(y)) for x, y in _blocks(batches))
        if n:
            yield pa.RecordBatch.from_pydict({"n": [n], "zeros": [zeros], "ones": [ones], "mean": [mean.tolist()], "m2": [m2.tolist()]})

    got = rows.mapInArrow(run, "n long, zeros long, ones long, mean array<double>, m2 array<double>").collect()   # one row a task
    n, zeros, ones, mean, m2 = merged((r.n, r.zeros, r.ones, np.array(r.mean), np.array(r.m2)) for r in got)
    rounded = lambda v: np.array([float(f"{e:.12g}") for e in np.atleast_1d(v)])
    return n, zeros, ones, rounded(mean), rounded(np.sqrt(m2 / max(n, 1)))


def _summed(rows: DataFrame, center: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``tally`` of all rows: each task's sums, added up by place."""
    def run(batches):
        total = 0.0
        for x, y in _blocks(batches):
            total = total + tally(standardised(x, center, scale), y, w)
        at = np.flatnonzero(total)
        if np.ndim(total) and len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "v"])

    got = rows.mapInArrow(run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v")).toArrow()   # n_sums numbers at most
    out = np.zeros(n_sums(len(w)))
    out[got.column("place").to_numpy()] = got.column("v").to_numpy()
    return out


def _strength_at(rows: DataFrame, model: Model, share: float) -> float:
    """The quantile of the rows' strengths at ``share``."""
    def run(batches):
        for x, _ in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(np.clip(model.strength(x), -1e9, 1e9) * FIXED).astype(np.int64))], names=["s"])

    values = rows.mapInArrow(run, "s long").select(F.lit(0).alias("all"), "s")
    return float(percentiles(values, group_stats(values, "all", "s"), "all", "s", [f"{share:.12f}"]).first()["p0"]) / FIXED


def labelled(labels: DataFrame, label: str, buckets: int, of: int) -> DataFrame:
    """(_id, y) of every labelled id outside the held-out bucket; of several labels the greatest."""
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), buckets, of))
    return y.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("y"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    texts = docs.filter(~held_out(F.col(id_col), 3, 1))
    # features first: they are a tenth of the texts where the join moves them
    rows = stored(_featured(texts, id_col, text_col).join(labelled(labels, "quality", 3, 1), F.col("doc_id") == F.col("_id")).select("x", "y"), "quality")
    try:
        n, zeros, ones, center, scale = _moments(rows)
        if not zeros or not ones:
            return no_model(len(NAMES))
        scale = scale + 1e-6
        model = Model(center, scale, fit_weights(lambda w: _summed(rows, center, scale, w), len(NAMES)), 0.0)
        return Model(center, scale, model.weights, _strength_at(rows, model, zeros / n))
    finally:
        forget(rows)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches):
        for b in batches:
            for a, e, data, off in T.chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, e - a), pa.array(model.score(features(data, off)))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, in one scan that carries every column."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for a, e, data, off in T.chunks(b.column(at)):
                yield b.slice(a, e - a).filter(pa.array(model.score(features(data, off)) >= least))

    return docs.mapInArrow(run, docs.schema)
