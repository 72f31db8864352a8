"""Benchmark decontamination: MinHash containment search, partitioned by size, verified by exact shingle containment.

Test items are short and documents long, so a whole document's MinHash says nothing about an item in it.  Items are
partitioned by size (number of distinct shingles, powers of two); for the partition with upper bound u a document is read
as overlapping windows of 2u shingles, one every u, so any run as long as an item lies inside one window of like size.
Item and window are sketched by one-permutation MinHash: the leading bits of a shingle's hash name one of ``BINS`` bins, a
bin's minimum is its value.  A window is a candidate for an item if they agree in one bin or more.  An item of no more
shingles than there are bins has a bin for each of them, in which a neighbour cannot hide it: any of its shingles makes the
document a candidate, so none of these is lost.

The window sketches are evaluated lazily, which changes no candidate: only a shingle whose hash is a bin minimum of some
item can make a window agree, so the hashes of a text are first looked up among the items' minima (bitmap, then binary
search) and the bin's minimum over the window is taken only around hits.

Each candidate (document, item) is verified on words, not hashes: the share of the item's distinct shingles that the
whole document holds must reach ``threshold``.

Items are the stated query set.  They are sent to the tasks in blocks of ``BLOCK_BYTES`` of text at the most (an item
longer than that is a block of its own) and every block is searched against all documents, so what is broadcast does not
grow with the benchmark or the corpus.

Words: lower-case A-Z, ``[^\\x20\\x09-\\x0D]+``.  Defined cases: an item of fewer than ``shingle`` words has one shingle of all its
words, looked for as a run of that many words; an item without words and a null text match nothing; repeated items and
repeated documents each get their own row; empty tables give an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm import textops as T
from aulastar.llm.store import forget, stored

SHINGLE = 5
THRESHOLD = 0.8
BIN_BITS = 6
BLOCK_BYTES = 8 << 20
FILTER_BITS = 22


class ItemBlock:
    """Sketches and shingles of a block of items."""

    def __init__(self, items: list[tuple[int, bytes]], shingle: int, threshold: float):
        self.threshold, self.ids, self.need = threshold, [], []
        self.by_len: dict[int, dict] = {}
        sets: list[set] = []
        for item_id, text in items:
            w = text.lower().split()
            if not w:
                continue
            k = min(shingle, len(w))
            sets.append((k, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}))
            self.ids.append(item_id)
        self.sizes = np.array([len(s) for _, s in sets], dtype=np.int64)
        for k in sorted({k for k, _ in sets}):
            vocabulary: dict[tuple, list[int]] = {}
            for n, (kk, s) in enumerate(sets):
                if kk == k:
                    for sh in s:
                        vocabulary.setdefault(sh, []).append(n)
            keys = list(vocabulary)
            h = self._hash(keys, k)
            of = {key: int(x) for key, x in zip(keys, h, strict=True)}
            minima: dict[int, list[int]] = {}
            for n, (kk, s) in enumerate(sets):
                if kk == k:
                    hs = np.array([of[x] for x in s], dtype=np.uint64)
                    hs.sort()
                    if len(hs) > 1 << BIN_BITS:
                        _, first = np.unique(hs >> np.uint64(64 - BIN_BITS), return_index=True)
                        hs = hs[first]
                    for x in hs.tolist():
                        minima.setdefault(x, []).append(n)
            word = {hash_: key for key, hash_ in of.items()}
            filt = np.zeros(1 << FILTER_BITS, dtype=bool)
            shingles = np.array(sorted(word), dtype=np.uint64)
            filt[(shingles & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
            self.by_len[k] = {"minima": minima, "word": word, "owners": vocabulary, "shingles": shingles, "filter": filt}
        # size partition: the upper bound of the power of two that an item's size falls in
        self.upper = (1 << (np.floor(np.log2(np.maximum(self.sizes, 1))).astype(np.int64) + 1)) - 1

    @staticmethod
    def _hash(shingles: list[tuple], k: int) -> np.ndarray:
        words = [w for s in shingles for w in s]
        data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8)
        starts, ends, _ = T.word_bounds(data, np.array([0, len(data)]))
        h = T.word_hashes(data, starts, ends)
        return T.shingle_hashes(h, np.repeat(np.arange(len(shingles)), k), k)[0]

    def search(self, data: np.ndarray, off: np.ndarray):
        """(row of the chunk, item index, shared shingles) of every pair that reaches the threshold."""
        data = T.LOWER[data]
        starts, ends, row = T.word_bounds(data, off)
        words = T.word_hashes(data, starts, ends)
        for k, x in self.by_len.items():
            h, first = T.shingle_hashes(words, row, k)
            near = np.flatnonzero(x["filter"][(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            if not len(near):
                continue
            at = np.searchsorted(x["shingles"], h[near])
            near = near[x["shingles"][np.minimum(at, len(x["shingles"]) - 1)] == h[near]]  # shingles of some item
            if not len(near):
                continue
            rows = row[first[near]]
            cut = np.flatnonzero(np.diff(rows)) + 1
            for part in np.split(near, cut):
                r = int(row[first[part[0]]])
                lo, hi = (int(v) for v in np.searchsorted(row[first], [r, r + 1])) if len(part) else (0, 0)
                found = self._candidates(x, h, part, lo, hi)
                if found:
                    yield from self._verify(x, h, part, first, starts, ends, data, k, r, found)

    def _candidates(self, x: dict, h: np.ndarray, hits: np.ndarray, lo: int, hi: int) -> set[int]:
        """Items that agree with a window of the document (shingles lo..hi) in the minimum of a bin."""
        found: set[int] = set()
        for p in hits.tolist():
            value = int(h[p])
            for n in x["minima"].get(value, ()):
                if n in found:
                    continue
                if self.sizes[n] <= 1 << BIN_BITS:
                    found.add(n)
                    continue
                u = int(self.upper[n])
                w = (p - lo) // u
                for a in (w, w - 1):
                    if a >= 0:
                        window = h[lo + a * u : min(hi, lo + (a + 2) * u)]
                        own = window[(window >> np.uint64(64 - BIN_BITS)) == np.uint64(value >> (64 - BIN_BITS))]
                        if int(own.min()) == value:
                            found.add(n)
                            break
        return found

    def _verify(self, x, h, hits, first, starts, ends, data, k, r, found):
        shared: dict[int, set] = {n: set() for n in found}
        for p in hits.tolist():
            a = int(first[p])
            key = tuple(data[starts[i] : ends[i]].tobytes() for i in range(a, a + k))
            for n in x["owners"].get(key, ()):
                if n in shared:
                    shared[n].add(key)
        for n, s in shared.items():
            if len(s) >= self.threshold * self.sizes[n] - 1e-9:
                yield r, n, len(s)


def blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Item blocks, one at a time on the driver; each holds ``block_bytes`` of text or a single item."""
    rows = bench.select(F.col(id_col).cast("long"), F.col(text_col)).filter(F.col(text_col).isNotNull()).toLocalIterator()
    block, size = [], 0
    for i, t in rows:
        t = t.encode()
        if block and size + len(t) > block_bytes:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    if block:
        yield block


SCHEMA = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): every document that holds an item."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for items in blocks(bench, item_id, item_text, block_bytes):
        block = ItemBlock(items, shingle, threshold)

        def run(batches, block=block):
            for b in batches:
                ids = b.column(0)
                for a, _, data, off in T.chunks(b.column(1)):
                    got = list(block.search(data, off))
                    if got:
                        r, n, s = (np.array(v, dtype=np.int64) for v in zip(*got, strict=True))
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(r + a)), pa.array(block.ids, pa.int64()).take(pa.array(n)), pa.array(block.sizes[n]), pa.array(s), pa.array(s / block.sizes[n])],
                                                         names=["doc_id", "item_id", "n_item", "n_shared", "containment"])

        found = stored(src.mapInArrow(run, SCHEMA), "leaks")   # written before the next block is built
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item: a filter in the scan for each block of items, no shuffle.

    What a block leaves is written before the next block is built, and removed once that one has read it, so the driver
    and a plan hold one block whatever the benchmark's size; the last block (most often the only one) stays lazy."""
    at = docs.columns.index(text_col)
    left = None   # written by the block before
    todo = blocks(bench, item_id, item_text, block_bytes)
    items = next(todo, None)
    while items is not None:
        docs = docs.mapInArrow(_clean(ItemBlock(items, shingle, threshold), at), docs.schema)
        items = next(todo, None)
        if items is not None:
            docs = stored(docs, "clean")
            if left is not None:
                forget(left)
            left = docs
    return docs


def _clean(block: ItemBlock, at: int):
    def run(batches):
        for b in batches:
            for a, e, data, off in T.chunks(b.column(at)):
                clean = np.ones(e - a, dtype=bool)
                clean[[r for r, _, _ in block.search(data, off)]] = False
                yield b.slice(a, e - a).filter(pa.array(clean))

    return run
