"""Removal of repeated passages: every byte that a string of ``LENGTH`` bytes covers which also starts elsewhere.

Which suffixes can matter is settled by content before any suffix is sorted.  In each window of ``LENGTH`` bytes the
``GRAM``-byte gram of least hash, the leftmost of equals, is its *anchor*.  Equal windows have equal anchors at equal
offsets, so a window whose anchor occurs once in the corpus is not repeated.  The windows of one anchor occurrence are
consecutive and make up a *snippet* of at most 2 * LENGTH - GRAM bytes.

A phrase in many texts with other text around it is an anchor with many different snippets.  Such an anchor is split by content:
its windows that begin close before it all hold the bytes that follow it, the others all hold bytes in front of it.  Anchor and
these bytes are two longer anchors, under which equal windows still meet; they are split again while they are hot, at the latest
until the anchor is the whole window.  A first scan counts different snippets by anchor at all depths and finds the hot ones.

Texts are dealt to blocks of about ``BLOCK_BYTES``; owners are buckets of anchors by hash.
1. A block tells each owner its distinct (anchor, snippet) pairs, by 64-bit hashes, with their counts.  The owner adds
   up.  Copies of a snippet collapse here, so a passage in a third of all documents is one pair per block.  The owner
   answers on anchors that occur again: a snippet that is there twice is repeated throughout; where an anchor has
   several different snippets, one block per snippet is asked for its bytes.
2. Owners lay the different snippets of their anchors out in shards of about ``SHARD_BYTES`` and build each shard's suffix
   array by Larsson-Sadakane refinement and its common prefixes by Kasai's walk.  Neighbours that share LENGTH bytes are
   repeated windows.  An anchor's snippets are a shard's bytes at most; where they lie on both sides of a shard's end, the
   windows of one are looked up in the suffix array of the other by binary search.  The answer is a bit per window.
3. Blocks cover their texts with the repeated windows.

What moves is each text once, a pair of hashes per anchor and block, and the bytes of snippets that differ.  Suffix-sorting
whole texts would cost several times the CPU budget in numpy; the windows left out by anchors are those that cannot be equal.

Defined cases: null text is empty; texts shorter than LENGTH lose nothing; matches never cross documents; repeated rows
are copies of each other and lose all windows; null ids are kept; an empty table gives an empty result."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm import suffix_array as S
from aulastar.llm import textops as T

LENGTH = 200
GRAM = 32            # a power of two
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
CENSUS_BYTES = 64 << 20
POSITION_BITS = 31

_B = 0x9E3779B97F4A7C15 | 1
_B_INVERSE = pow(_B, -1, 1 << 64)


FIELDS = ("gram", "first", "last", "snippet", "at", "left", "right")


class Hashes:
    """Hashes of stretches of a buffer, the same wherever the bytes lie."""

    def __init__(self, value: np.ndarray):
        self.prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(value * T.powers(len(value), _B), dtype=np.uint64)))
        self.shift = T.powers(len(value), _B_INVERSE)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.prefix[b] - self.prefix[a]) * self.shift[a]


def _with_snippets(x: dict[str, np.ndarray], hashes: Hashes, length: int) -> dict[str, np.ndarray]:
    first, last = x["first"], x["last"]
    own = T.mix64(hashes(first, last + length) + (last - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + (x["at"] - first).astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    return x | {"snippet": T.mix64(own + T.mix64(x["gram"].view(np.uint64))).view(np.int64)}


def _halves(x: dict[str, np.ndarray], hashes: Hashes, length: int) -> dict[str, np.ndarray]:
    """Snippets under the two longer anchors of each.  An anchor reaches ``left`` bytes before its gram and ``right`` after."""
    middle = x["left"] + (length - GRAM - x["left"] - x["right"]) // 2
    near = x | {"first": np.maximum(x["first"], x["at"] - middle), "right": length - GRAM - middle}
    far = x | {"last": np.minimum(x["last"], x["at"] - middle - 1), "left": middle + 1}
    both = {k: np.concatenate((near[k], far[k])) for k in FIELDS}
    both = _where(both, both["first"] <= both["last"])
    reach = both["left"].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + both["right"].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    core = hashes(both["at"] - both["left"], both["at"] + GRAM + both["right"])
    return _with_snippets(both | {"gram": T.mix64(T.mix64(both["gram"].view(np.uint64) + reach) + core).view(np.int64)}, hashes, length)


def _where(x: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[which] for k, v in x.items()}


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, hot: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Anchor occurrences of the texts: ``gram`` (hash), ``first`` and ``last`` window start, and ``snippet`` (hash).
    Those in ``hot`` are split."""
    n = len(data)
    none = {k: np.zeros(0, dtype=np.int64) for k in FIELDS}
    sizes = np.diff(off)
    if n < length or not (sizes >= length).any():
        return none
    wide = length - GRAM + 1                       # grams in a window
    value = T._BYTE_VALUE[data]
    gram, k = value, 1
    while k < GRAM:                                # hash of 2k bytes from two of k
        gram = gram[: len(gram) - k] * np.uint64(pow(_B, k, 1 << 64)) + gram[k:]
        k *= 2
    gram = T.mix64(gram)
    low = np.uint64((1 << POSITION_BITS) - 1)
    key = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    least = _sliding_least(key, wide)              # by window start
    starts = np.repeat(off[:-1], np.maximum(sizes - length + 1, 0))
    starts = starts + np.arange(len(starts)) - np.repeat(np.cumsum(np.maximum(sizes - length + 1, 0)) - np.maximum(sizes - length + 1, 0), np.maximum(sizes - length + 1, 0))
    at = (least[starts] & low).astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (np.diff(starts) != 1)
    i = np.flatnonzero(new)
    first, last, at = starts[i], starts[np.append(i[1:], len(starts)) - 1], at[i]
    hashes, zero = Hashes(value), np.zeros(len(at), dtype=np.int64)
    x = _with_snippets({"gram": gram[at].view(np.int64), "first": first, "last": last, "at": at, "left": zero, "right": zero}, hashes, length)
    if hot is None or not len(hot):
        return x
    done = []
    while len(x["gram"]):
        split = np.isin(x["gram"], hot) & (x["left"] + x["right"] < length - GRAM)
        done.append(_where(x, ~split))
        x = _halves(_where(x, split), hashes, length)
    return {k: np.concatenate([d[k] for d in done]) for k in FIELDS} if done else none


def _sliding_least(key: np.ndarray, wide: int) -> np.ndarray:
    """Least key of every ``wide`` neighbours, from running minima forwards and backwards in blocks of that size."""
    n = len(key)
    rows = -(-n // wide)
    grid = np.full(rows * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
    grid[:n] = key
    grid = grid.reshape(rows, wide)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - wide + 1], forward[wide - 1 : n])


def _texts(table: pa.Table):
    """(texts before, bytes, offsets) of a block's rows in order."""
    done = 0
    for part in table.select(["text"]).to_batches(max_chunksize=4096):
        for a, e, data, off in T.chunks(part.column(0)):
            yield done + a, data, off
        done += part.num_rows


def _by_owner(keys: np.ndarray, buckets: int):
    of = (T.mix64(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    cuts = np.searchsorted(of[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b] : cuts[b + 1]]


def _census(length: int, chunk_bytes: int, least: int, slab: int = 1 << 20):
    """(anchor, snippet) pairs, different ones of each chunk of texts, of the anchors with ``least`` snippets there or more;
    of these the longer anchors too.  A longer anchor has no more snippets than the one it was split from."""

    def frequent(x):
        x = _where(x, np.unique(x["snippet"], return_index=True)[1])
        _, of, kinds = np.unique(x["gram"], return_inverse=True, return_counts=True)
        return _where(x, kinds[of] >= least)

    def batch(x):
        return pa.RecordBatch.from_arrays([pa.array(x["gram"]), pa.array(x["snippet"])], names=["gram", "snippet"])

    def count(held):
        x = {k: np.concatenate([h[k] for h, _ in held]) for k in FIELDS}
        x["part"] = np.repeat(np.arange(len(held)), [len(h["gram"]) for h, _ in held])
        x = frequent(x)
        x = _where(x, np.argsort(x["gram"], kind="stable"))
        sizes = x["last"] - x["first"] + length
        heads = np.flatnonzero(np.diff(x["gram"], prepend=x["gram"][:1] - 1))
        ends = np.cumsum(sizes)
        a = 0
        while a < len(sizes):                       # whole anchors of about a slab
            b = np.searchsorted(ends, ends[a] - sizes[a] + slab)
            k = np.searchsorted(heads, max(b, a + 1))
            b = heads[k] if k < len(heads) else len(sizes)
            y, size = {k: v[a:b] for k, v in x.items()}, sizes[a:b]
            data = np.concatenate([held[p][1][i : i + w] for p, i, w in zip(y["part"].tolist(), y["first"].tolist(), size.tolist(), strict=True)])
            base = np.cumsum(size) - size
            y = {k: y[k] for k in FIELDS} | {"first": base, "last": base + size - length, "at": base + y["at"] - y["first"]}
            hashes = Hashes(T._BYTE_VALUE[data])
            while len(y["gram"]):
                yield batch(y)
                y = frequent(_halves(_where(y, y["left"] + y["right"] < length - GRAM), hashes, length))
            a = b

    def run(batches):
        held, size = [], 0
        for b in batches:
            for _, _, data, off in T.chunks(b.column(0)):
                x = anchors(data, off, length)
                held.append((_where(x, np.unique(x["snippet"], return_index=True)[1]), data))
                size += len(data)
                if size >= chunk_bytes:
                    yield from count(held)
                    held, size = [], 0
        if held:
            yield from count(held)

    return run


def hot_anchors(rows: DataFrame, size: int, partitions: int, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, chunk_bytes: int = CENSUS_BYTES) -> np.ndarray:
    """The anchors of any depth to be split.  Any other one has at most twice ``limit`` different snippets, which fit a shard:
    ``limit`` among the pairs of the census and as many that stayed below ``least`` in their chunks.  The driver gets a hash
    per anchor of more than ``limit`` different snippets."""
    limit = max(1, shard_bytes // (2 * (2 * length - GRAM)))
    chunks = size // chunk_bytes + partitions
    pairs = rows.select("text").mapInArrow(_census(length, chunk_bytes, limit // max(chunks, 1) + 1), "gram long, snippet long")
    hot = pairs.distinct().groupBy("gram").count().filter(F.col("count") > limit).select("gram").toArrow()
    return np.sort(hot.column(0).to_numpy())


PAIRS = "bucket int, block int, gram array<long>, snippet array<long>, n array<int>"
STATES = "block int, snippet array<long>, state array<byte>"
BYTES = "bucket int, block int, gram array<long>, snippet array<long>, size array<int>, known array<boolean>, data binary"
MASKS = "block int, snippet array<long>, mask array<binary>"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
REPEATED, SEND = 1, 2


def _pairs(buckets: int, length: int, hot: np.ndarray):
    def run(key, table):
        parts = [anchors(data, off, length, hot) for _, data, off in _texts(table)]
        gram, snippet = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in ("gram", "snippet"))
        uniq, first, n = np.unique(snippet, return_index=True, return_counts=True)
        gram = gram[first]
        rows = [(b, gram[own], uniq[own], n[own]) for b, own in _by_owner(gram, buckets)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()), "gram": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                         "snippet": pa.array([r[2] for r in rows], pa.list_(pa.int64())), "n": pa.array([r[3] for r in rows], pa.list_(pa.int32()))})

    return run


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.asarray(x.values) for x in table.column(name)]) if table.num_rows else np.zeros(0, np.int64)


def _judge():
    def run(key, table):
        gram, snippet, n = _flat(table, "gram"), _flat(table, "snippet"), _flat(table, "n")
        sizes = np.array([len(x) for x in table.column("gram")])
        block = np.repeat(table.column("block").to_numpy(), sizes)
        codes, uniq = pd.factorize(snippet)
        count = np.bincount(codes, n, minlength=len(uniq))
        first = np.empty(len(uniq), dtype=np.int64)
        order = np.lexsort((block, codes))          # the block of least number sends, whatever came first
        lead = order[np.concatenate(([True], np.diff(codes[order]) != 0))]
        first[codes[lead]] = lead
        gram_codes, grams = pd.factorize(gram[first])
        kinds = np.bincount(gram_codes, minlength=len(grams))
        state = np.where(count >= 2, REPEATED, 0)[codes].astype(np.int8)
        sends = first[kinds[gram_codes] >= 2]
        state[sends] |= SEND
        told = np.flatnonzero(state)
        told = told[np.argsort(block[told], kind="stable")]
        blocks, cuts = np.unique(block[told], return_index=True)
        cuts = np.append(cuts, len(told))
        return pa.table({"block": pa.array(blocks, pa.int32()), "snippet": pa.array([snippet[told[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int64())),
                         "state": pa.array([state[told[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.list_(pa.int8()))})

    return run


class States:
    def __init__(self, table: pa.Table):
        keys, state = _flat(table, "snippet").astype(np.int64), _flat(table, "state").astype(np.int8)
        order = np.argsort(keys)
        self.keys, self.state = keys[order], state[order]

    def __call__(self, snippet: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(snippet), dtype=np.int8)
        at = np.minimum(np.searchsorted(self.keys, snippet), len(self.keys) - 1)
        return np.where(self.keys[at] == snippet, self.state[at], 0)


def _send(buckets: int, length: int, hot: np.ndarray):
    def run(table, states):
        if not table.num_rows:
            return pa.Table.from_pylist([], schema=pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("gram", pa.list_(pa.int64())), ("snippet", pa.list_(pa.int64())), ("size", pa.list_(pa.int32())), ("known", pa.list_(pa.bool_())), ("data", pa.binary())]))
        block, state_of, sent = table.column("block")[0].as_py(), States(states), set()
        gram, snippet, known, pieces = [], [], [], []
        for _, data, off in _texts(table):
            x = anchors(data, off, length, hot)
            state = state_of(x["snippet"])
            for i in np.flatnonzero(state & SEND).tolist():
                s = int(x["snippet"][i])
                if s not in sent:
                    sent.add(s)
                    gram.append(int(x["gram"][i]))
                    snippet.append(s)
                    known.append(bool(state[i] & REPEATED))
                    pieces.append(data[x["first"][i] : x["last"][i] + length].tobytes())
        g, s, k = np.array(gram, dtype=np.int64), np.array(snippet, dtype=np.int64), np.array(known, dtype=bool)
        rows = [(b, g[own], s[own], np.array([len(pieces[i]) for i in own], dtype=np.int32), k[own], b"".join(pieces[i] for i in own)) for b, own in _by_owner(g, buckets)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([block] * len(rows), pa.int32()), "gram": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                         "snippet": pa.array([r[2] for r in rows], pa.list_(pa.int64())), "size": pa.array([r[3] for r in rows], pa.list_(pa.int32())),
                         "known": pa.array([r[4] for r in rows], pa.list_(pa.bool_())), "data": pa.array([r[5] for r in rows], pa.binary())})

    return run


class Shard:
    """Snippets laid out one after the other, each ended by MARK, with the sorted order of their windows."""

    def __init__(self, gram: np.ndarray, pieces: list[bytes], length: int):
        self.gram, self.length = gram, length
        self.text = np.frombuffer(b"".join(p + bytes([S.MARK]) for p in pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.base = np.cumsum(sizes + 1) - (sizes + 1)
        self.windows = sizes - length + 1
        sa = S.suffix_array(self.text)
        shared = S.common_prefixes(self.text, sa, length)
        self.flag = np.zeros(len(self.text), dtype=bool)
        again = np.flatnonzero(shared >= length)
        self.flag[sa[again]] = self.flag[sa[again - 1]] = True
        is_window = np.zeros(len(self.text), dtype=bool)
        of = np.repeat(np.arange(len(pieces)), self.windows)
        is_window[self.base[of] + np.arange(len(of)) - np.repeat(np.cumsum(self.windows) - self.windows, self.windows)] = True
        self.owner = np.repeat(np.arange(len(pieces)), sizes + 1)
        self.sa = sa[is_window[sa]]

    def of_grams(self, grams: np.ndarray) -> np.ndarray:
        """Window starts under these anchors, in sorted order."""
        return self.sa[np.isin(self.gram, grams)[self.owner[self.sa]]]

    def merge(self, other: Shard) -> None:
        both = np.intersect1d(self.gram, other.gram)
        if len(both):
            mine, theirs = self.of_grams(both), other.of_grams(both)
            found, hit = S.also_in(self.text, mine, other.text, theirs, self.length)
            self.flag[mine[found]] = True
            other.flag[theirs[hit]] = True

    def masks(self) -> list[np.ndarray]:
        return [self.flag[b : b + w] for b, w in zip(self.base.tolist(), self.windows.tolist(), strict=True)]


def repeated_windows(gram: np.ndarray, pieces: list[bytes], length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For snippets sorted by anchor: which of their windows are in another snippet."""
    shards: list[Shard] = []
    a, size = 0, 0
    spans = []
    for i, p in enumerate(pieces):
        if size and size + len(p) > shard_bytes:
            spans.append((a, i))
            a, size = i, 0
        size += len(p)
    spans.append((a, len(pieces)))
    out: list[np.ndarray] = []
    for a, b in spans:
        shard = Shard(gram[a:b], pieces[a:b], length)
        # snippets are sorted by anchor: only shards that share this one's first anchor can have equal windows
        while shards and shards[0].gram[-1] != shard.gram[0]:
            out += shards.pop(0).masks()
        for s in shards:
            s.merge(shard)
        shards.append(shard)
    for s in shards:
        out += s.masks()
    return out


def _search(length: int, shard_bytes: int):
    def run(key, table):
        gram, snippet, size, known = (_flat(table, c) for c in ("gram", "snippet", "size", "known"))
        block = np.repeat(table.column("block").to_numpy(), [len(x) for x in table.column("gram")])
        blob, cuts = b"".join(table.column("data").to_pylist()), np.concatenate(([0], np.cumsum(size)))
        order = np.lexsort((snippet, gram))
        masks = repeated_windows(gram[order], [blob[cuts[i] : cuts[i + 1]] for i in order.tolist()], length, shard_bytes)
        to: dict[int, tuple[list, list]] = {}
        for i, m in zip(order.tolist(), masks, strict=True):
            if not known[i] and m.any():
                s, b = to.setdefault(int(block[i]), ([], []))
                s.append(int(snippet[i]))
                b.append(np.packbits(m, bitorder="little").tobytes())
        return pa.table({"block": pa.array(list(to), pa.int32()), "snippet": pa.array([v[0] for v in to.values()], pa.list_(pa.int64())), "mask": pa.array([v[1] for v in to.values()], pa.list_(pa.binary()))})

    return run


def _cover(length: int, hot: np.ndarray):
    def run(table, answers):
        state_of = States(answers.filter(pa.array(answers.column("state").is_valid().to_numpy())).select(["snippet", "state"])) if answers.num_rows else States(pa.table({"snippet": pa.array([], pa.list_(pa.int64())), "state": pa.array([], pa.list_(pa.int8()))}))
        masks: dict[int, bytes] = {}
        for keys, own in zip(answers.column("snippet").to_pylist(), answers.column("mask").to_pylist(), strict=True) if answers.num_rows else ():
            if own is not None:
                masks.update(zip(keys, own, strict=True))
        asked = np.array(sorted(masks), dtype=np.int64)
        removed_n, spans_n, shas = [], [], []
        for _, data, off in _texts(table):
            x = anchors(data, off, length, hot)
            state = state_of(x["snippet"])
            whole = np.flatnonzero(state & REPEATED)
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(edge, x["first"][whole], 1)
            np.add.at(edge, x["last"][whole] + length, -1)
            some = np.flatnonzero(np.isin(x["snippet"], asked) & ((state & REPEATED) == 0))
            for i in some.tolist():
                a, w = int(x["first"][i]), int(x["last"][i] - x["first"][i]) + 1
                bits = np.unpackbits(np.frombuffer(masks[int(x["snippet"][i])], dtype=np.uint8), count=w, bitorder="little")
                turn = np.flatnonzero(np.diff(np.concatenate(([0], bits, [0]))))
                edge[a + turn[::2]] += 1
                np.subtract.at(edge, a + turn[1::2] - 1 + length, 1)
            gone = np.cumsum(edge[:-1]) > 0
            before = np.concatenate(([False], gone[:-1])) if len(gone) else gone
            before[off[:-1][off[:-1] < len(data)]] = False
            removed_n.append(np.diff(np.concatenate(([0], np.cumsum(gone)))[off]))
            spans_n.append(np.diff(np.concatenate(([0], np.cumsum(gone & ~before)))[off]))
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                shas.append(hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest())
        join = lambda v: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
        return pa.table({"doc_id": table.column("doc_id"), "n_bytes": table.column("n_bytes"), "n_removed": join(removed_n), "n_spans": join(spans_n), "kept_sha256": pa.array(shas, pa.string())})

    return run


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with their ``block``, shuffled by it.  Blocks go by the rows' place too, so that equal rows share none;
    ``rows`` has to come from a stored table, whose places stay when a lost task is repeated."""
    block = F.pmod(F.xxhash64("doc_id", "n_bytes", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    return rows.withColumn("block", block).repartition("block")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    if length < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    total = rows.withColumn("part", F.spark_partition_id()).agg(F.sum("n_bytes").alias("n"), F.max("part").alias("last")).first()
    size = total["n"] or 0
    hot = hot_anchors(rows, size, (total["last"] or 0) + 1, length, shard_bytes)
    blocks = max(1, -(-size // block_bytes))
    own = dealt(rows, blocks)   # shuffled once, read three times
    states = own.groupBy("block").applyInArrow(_pairs(blocks, length, hot), PAIRS).groupBy("bucket").applyInArrow(_judge(), STATES)
    sent = own.groupBy("block").cogroup(states.groupBy("block")).applyInArrow(_send(blocks, length, hot), BYTES)
    masks = sent.groupBy("bucket").applyInArrow(_search(length, shard_bytes), MASKS)
    answers = states.withColumn("mask", F.lit(None).cast("array<binary>")).unionByName(masks.withColumn("state", F.lit(None).cast("array<byte>")))
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cover(length, hot), RESULT)
