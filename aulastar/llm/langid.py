"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads letter runs (lower-case A-Z; bytes beyond ASCII count as letters), in pieces of ``PIECE`` bytes at most,
forwards and backwards from a fresh state, and labels every byte position with a distribution over the learnt languages.
A document's probabilities are the mean over all its positions.  Training is plain numpy: backpropagation through time
with Adam on the cross-entropy of every position.

Equal pieces get equal labels, so each distinct piece runs through the network once per task (a table of bounded size
holds the sums of its positions) and every occurrence is counted by lookup.  Texts are read whole; scoring is a scan
without a shuffle.

Fitting uses the texts of at most ``SAMPLE`` rows with a language, those of smallest hash of the id, and from them at most
``PIECES`` distinct (language, piece) pairs, again by hash, weighted by the square root of their counts.

Defined cases: null texts and texts without a letter are ``und`` with score 0; repeated rows are predicted alike; a null
language is not learnt from; without any learnt language every text is ``und``; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm import textops as T
from aulastar.llm.quality import held_out

SAMPLE = 6_000      # documents used for fitting
PIECES = 40_000     # distinct (language, piece) pairs used for fitting
PIECE = 32          # longest piece in bytes
HIDDEN, EMBED = 16, 12
BATCH, STEPS, RATE = 512, 360, 0.01
TABLE = 1 << 19     # distinct pieces remembered by a task


def pieces(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every piece."""
    starts, ends, row = T.word_bounds(data, off, T.NO_LETTER)
    n = (ends - starts + PIECE - 1) // PIECE
    if len(n) and n.max() > 1:
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        s = np.repeat(starts, n) + k * PIECE
        starts, ends, row = s, np.minimum(s + PIECE, np.repeat(ends, n)), np.repeat(row, n)
    return starts, ends, row


def padded(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bytes of the pieces, one row each, zero beyond the end."""
    width = int(sizes.max())
    at = starts[:, None] + np.arange(width)[None, :]
    out = data[np.minimum(at, len(data) - 1)]
    out[np.arange(width)[None, :] >= sizes[:, None]] = 0
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters: ``emb`` and per direction ``w`` (input), ``u`` (state), ``c`` (bias) of the gates update, reset and new,
    and the output layer ``o`` per direction with ``bias``."""

    def __init__(self, languages: list[str], seed: int = 3):
        rng = np.random.default_rng(seed)
        f32 = lambda *shape: rng.normal(0, 0.2, shape).astype(np.float32)
        self.languages = languages
        self.p = {"emb": f32(256, EMBED), "bias": np.zeros(len(languages), np.float32)}
        for d in "fb":
            self.p |= {f"w{d}": f32(EMBED, 3 * HIDDEN), f"u{d}": f32(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32), f"o{d}": f32(HIDDEN, len(languages))}

    def states(self, x: np.ndarray, sizes: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """State after every position; rows sorted by falling size."""
        p, h_ = self.p, HIDDEN
        gates_in = p["emb"] @ p[f"w{d}"] + p[f"c{d}"]
        out = np.zeros((x.shape[1], len(x), h_), np.float32)
        h = np.zeros((len(x), h_), np.float32)
        for t in range(x.shape[1]):
            n = int(np.searchsorted(-sizes, -t, side="left"))  # rows longer than t
            a, hu = gates_in[x[:n, t]], h[:n] @ p[f"u{d}"]
            zr = _sigmoid(a[:, : 2 * h_] + hu[:, : 2 * h_])
            z, r = zr[:, :h_], zr[:, h_:]
            new = np.tanh(a[:, 2 * h_ :] + r * hu[:, 2 * h_ :])
            before = h[:n].copy() if keep is not None else h[:n]
            h[:n] = new + z * (before - new)
            out[t, :n] = h[:n]
            if keep is not None:
                keep.append((n, before, z, r, new, hu[:, 2 * h_ :].copy()))
        return out

    @staticmethod
    def turned(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Index that reverses each row within its size."""
        t = np.arange(x.shape[1])[None, :]
        return np.where(t < sizes[:, None], sizes[:, None] - 1 - t, t)

    def position_probabilities(self, x: np.ndarray, sizes: np.ndarray, keep=None):
        """(positions, rows, languages); beyond a row's size the values mean nothing."""
        turn = self.turned(x, sizes)
        hf = self.states(x, sizes, "f", keep[0] if keep else None)
        hb = self.states(np.take_along_axis(x, turn, 1), sizes, "b", keep[1] if keep else None)
        hb = np.take_along_axis(hb, turn.T[:, :, None], 0)
        logits = hf @ self.p["of"] + hb @ self.p["ob"] + self.p["bias"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        return e / e.sum(axis=2, keepdims=True), hf, hb, turn

    def sums(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, batch: int = 4096) -> np.ndarray:
        """Per piece, the probabilities of its positions added up."""
        out = np.zeros((len(starts), len(self.languages)), np.float32)
        order = np.argsort(-sizes, kind="stable")
        for a in range(0, len(order), batch):
            own = order[a : a + batch]
            n = sizes[own]
            x = padded(data, starts[own], n)
            probs = self.position_probabilities(x, n)[0]
            probs *= (np.arange(x.shape[1])[:, None] < n[None, :])[:, :, None]
            out[own] = probs.sum(axis=0)
        return out

    def gradients(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Backpropagation through time; rows sorted by falling size."""
        keep = ([], [])
        probs, hf, hb, turn = self.position_probabilities(x, sizes, keep)
        live = (np.arange(x.shape[1])[:, None] < sizes[None, :]) * weight[None, :]
        err = probs.copy()
        err[:, np.arange(len(y)), y] -= 1
        err = (err * (live / live.sum())[:, :, None]).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["bias"] = err.sum(axis=(0, 1))
        for d, h, out, x_d, caches in (("f", hf, "of", x, keep[0]), ("b", hb, "ob", np.take_along_axis(x, turn, 1), keep[1])):
            g[out] = np.einsum("tnh,tnl->hl", h, err, optimize=True)
            dh_out = err @ self.p[out].T
            if d == "b":
                dh_out = np.take_along_axis(dh_out, turn.T[:, :, None], 0)
            self._through_time(d, x_d, dh_out, caches, g)
        return g

    def _through_time(self, d, x, dh_out, caches, g):
        p, h_ = self.p, HIDDEN
        carry = np.zeros((len(x), h_), np.float32)
        at_gates = np.zeros((256, 3 * h_), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            n, before, z, r, new, hun = caches[t]
            dh = carry[:n] + dh_out[t, :n]
            dnew = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * z * (1 - z)
            dr = dnew * hun * r * (1 - r)
            da = np.concatenate((dz, dr, dnew), axis=1)
            dhu = np.concatenate((dz, dr, dnew * r), axis=1)
            g[f"u{d}"] += before.T @ dhu
            g[f"c{d}"] += da.sum(axis=0)
            np.add.at(at_gates, x[:n, t], da)
            carry[:n] = dh * z + dhu @ p[f"u{d}"].T
        g[f"w{d}"] += p["emb"].T @ at_gates
        g["emb"] += at_gates @ p[f"w{d}"].T

    def train(self, texts: list[bytes], y: np.ndarray, weight: np.ndarray, steps: int = STEPS, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        data, sizes = np.frombuffer(b"".join(texts) + b"\0", dtype=np.uint8), np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        share = weight / weight.sum()
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            pick = rng.choice(len(texts), BATCH, p=share)
            pick = pick[np.argsort(-sizes[pick], kind="stable")]
            g = self.gradients(padded(data, starts[pick], sizes[pick]), sizes[pick], y[pick], np.ones(len(pick), np.float32))
            rate = RATE * (1 - step / (steps + 1)) + 1e-4
            for k, a in g.items():
                m[k] = 0.9 * m[k] + 0.1 * a
                v[k] = 0.999 * v[k] + 0.001 * a * a
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self


def training_pieces(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int, limit: int) -> DataFrame:
    """(lang, piece, n) of the sampled documents."""
    ids = (docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")).filter(F.col("_lang").isNotNull() & F.col("_id").isNotNull() & ~held_out(F.col("_id"), 3, 1))
           .orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id").distinct())

    def run(batches):
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), dtype=object)
            for a, _, data, off in T.chunks(b.column(0)):
                data = T.LOWER[data]
                starts, ends, row = pieces(data, off)
                names, code = np.unique(langs[a : a + len(off) - 1].astype(str), return_inverse=True)
                h = T.word_hashes(data, starts, ends, T.NO_LETTER) if len(starts) else np.zeros(0, np.uint64)
                _, first, n = np.unique(T.mix64(h + code[row].astype(np.uint64)), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[code[row[first]]].tolist(), type=pa.string()), pa.array([data[s:e].tobytes() for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], type=pa.binary()), pa.array(n, type=pa.int64())],
                                                 names=["lang", "piece", "n"])

    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(F.col("lang").isNotNull())
    texts = texts.join(F.broadcast(ids), F.col("_doc") == F.col("_id"), "left_semi").select("text", "lang")  # SAMPLE ids at most
    counted = texts.mapInArrow(run, "lang string, piece binary, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    return counted.orderBy(F.xxhash64("piece", "lang"), "piece", "lang").limit(limit)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, limit: int = PIECES, steps: int = STEPS) -> Network | None:
    rows = training_pieces(docs, id_col, text_col, lang_col, sample, limit).toArrow()
    if not rows.num_rows:
        return None
    langs = rows.column("lang").to_pylist()
    known = sorted(set(langs))
    place = {x: i for i, x in enumerate(known)}
    return Network(known).train(rows.column("piece").to_pylist(), np.array([place[x] for x in langs]), np.sqrt(rows.column("n").to_numpy().astype(float)), steps)


class Predictor:
    def __init__(self, net: Network):
        self.net = net
        self.keys, self.table = np.zeros(0, np.uint64), np.zeros((0, len(net.languages)), np.float32)

    def __call__(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Pooled probabilities of every text, zeros where there is no letter byte."""
        data, n = T.LOWER[data], len(off) - 1
        starts, ends, row = pieces(data, off)
        if not len(starts):
            return np.zeros((n, len(self.net.languages)))
        # a hash by content alone: two pieces of one long run are hashed apart, as their first bytes start anew
        h = piece_hashes(data, starts, ends)
        keys, first, which = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        values = np.empty((len(keys), len(self.net.languages)), np.float32)
        values[known] = self.table[at[known]]
        new = first[~known]
        values[~known] = self.net.sums(data, starts[new], ends[new] - starts[new])
        if len(self.keys) + len(new) > TABLE:
            self.keys, self.table = keys, values
        elif len(new):
            self.keys = np.insert(self.keys, at[~known], keys[~known])
            self.table = np.insert(self.table, at[~known], values[~known], axis=0)
        total = np.column_stack([np.bincount(row, values[which, k], minlength=n) for k in range(len(self.net.languages))])
        return total / np.maximum(np.bincount(row, ends - starts, minlength=n), 1)[:, None]


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    x = T._BYTE_VALUE[data]
    sizes = ends - starts
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    value = x[np.repeat(starts, sizes) + place] * T.powers(PIECE + 1)[place]
    return T.mix64(np.add.reduceat(value, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def predicted(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    def run(batches):
        predict = Predictor(net) if net else None
        for b in batches:
            for a, e, data, off in T.chunks(b.column(1)):
                n = e - a
                langs, scores = ["und"] * n, np.zeros(n)
                if predict:
                    probs = predict(data, off)
                    best = probs.argmax(axis=1)
                    ascii_letters = np.concatenate(([0], np.cumsum(~T.NO_LETTER[data] & (data < 128))))[off]
                    sure = np.diff(ascii_letters) > 0
                    for i in range(n):
                        if sure[i] or probs[i].any() and has_letter(b.column(1)[a + i].as_py()):
                            langs[i], scores[i] = net.languages[best[i]], min(1.0, float(probs[i, best[i]]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, n), pa.array(langs, type=pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
