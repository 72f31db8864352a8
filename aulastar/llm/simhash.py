"""SimHash near-duplicates through anchor points of a covering code.

Fingerprint: lower-case A-Z, words, shingles of ``SHINGLE`` words joined by one space, XXH64 (seed 42) of each; bit i is
1 if more than half of the hashes have it.

Links (at most ``distance`` differing bits) are found at anchors.  The anchors are the code words of two binary Golay
codes (23 bits, covering radius 3) laid over bits 0-22 and 23-45: every fingerprint lies within distance 3 of exactly
one code word per block, its home.  Two fingerprints at distance d <= 2 differ by d1 + d2 <= 2 bits on the blocks, so the
one lies within 3 + d1 and 3 + d2 of the other's home.  Each distinct fingerprint is therefore sent to every anchor
within covering radius plus threshold (61 anchors on average, whatever the input), and each anchor compares its home
fingerprints with all that were sent to it.  Equal fingerprints are one before anything is replicated, so copies cost
nothing here.

An anchor sends out a spanning forest of its links, not the links: at most one edge per fingerprint.  Where home times
visitors is large, the comparison flips bits instead: a home fingerprint and a visitor are within two bits exactly if
they share a string at distance one from both; that costs 65 keys per fingerprint and yields the same components.

Defined cases: null, empty and blank texts have fingerprint 0 and link like any other; fewer words than a shingle give
one shingle of all words; repeated rows share their fingerprint and component; a null id never names a component
unless no other id is there; an empty table gives an empty result."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.llm.components import components, local_roots
from aulastar.llm.joins import join_groups
from aulastar.llm.store import stored

SHINGLE = 3
DISTANCE = 2
SEED = 42
BLOCK, RADIUS, CHECKS = 23, 3, 11
GENERATOR = 0xC75   # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, of the binary Golay code
DENSE = 1 << 14     # home x visitors from which an anchor flips bits instead of comparing pairs
PAIRS = 1 << 20     # comparisons held in memory at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return h(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    view = memoryview(joined)
    total = np.zeros(64, dtype=np.int64)
    for a in range(0, n, 1 << 16):
        b = min(n, a + (1 << 16))
        hashes = np.fromiter((h(view[s:e], SEED) for s, e in zip(starts[a:b].tolist(), ends[a + shingle - 1 : b + shingle - 1].tolist(), strict=True)), dtype="<u8", count=b - a)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, fp long")


def _syndrome_tables() -> np.ndarray:
    """Syndromes of the three bytes of a 23-bit string."""
    rest = []
    for i in range(BLOCK):
        r = 1 << i
        for j in range(BLOCK - 1, CHECKS - 1, -1):
            if r >> j & 1:
                r ^= GENERATOR << (j - CHECKS)
        rest.append(r)
    out = np.zeros((3, 256), dtype=np.int64)
    for k in range(3):
        for i, r in enumerate(rest[8 * k : 8 * k + 8]):
            out[k] ^= np.where(np.arange(256) >> i & 1, r, 0)
    return out


def syndrome(x: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][x >> 8 & 255] ^ tables[2][x >> 16]


def golay() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Syndrome tables, and for excess 0, 1, 2 over the covering radius the error patterns of each syndrome as (offsets,
    patterns): 44,552 patterns of weight 5 at most."""
    tables, lists = _syndrome_tables(), []
    for weights in (range(RADIUS + 1), [RADIUS + 1], [RADIUS + 2]):
        own = np.array([sum(1 << i for i in c) for w in weights for c in itertools.combinations(range(BLOCK), w)], dtype=np.int64)
        syn = syndrome(own, tables)
        order = np.argsort(syn, kind="stable")
        lists.append((np.searchsorted(syn[order], np.arange((1 << CHECKS) + 1)), own[order]))
    return tables, lists


def anchors(fps: np.ndarray, distance: int = DISTANCE, code: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, anchor, is home) for every anchor within covering radius plus distance."""
    tables, lists = code or golay()
    low = (1 << BLOCK) - 1
    x1, x2 = (fps & np.uint64(low)).astype(np.int64), ((fps >> np.uint64(BLOCK)) & np.uint64(low)).astype(np.int64)
    s1, s2 = syndrome(x1, tables), syndrome(x2, tables)
    out = []
    for e1 in range(distance + 1):
        for e2 in range(distance + 1 - e1):
            (o1, p1), (o2, p2) = lists[e1], lists[e2]
            n1, n2 = o1[s1 + 1] - o1[s1], o2[s2 + 1] - o2[s2]
            reps = n1 * n2
            i = np.repeat(np.arange(len(fps)), reps)
            k = np.arange(len(i)) - np.repeat(np.cumsum(reps) - reps, reps)
            c1 = x1[i] ^ p1[o1[s1][i] + k // n2[i]]
            c2 = x2[i] ^ p2[o2[s2][i] + k % n2[i]]
            out.append((i, (c1 >> CHECKS) << (BLOCK - CHECKS) | (c2 >> CHECKS), np.full(len(i), e1 + e2 == 0)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _dense(fps: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges among one anchor's fingerprints that connect whatever is linked to a home fingerprint."""
    n = len(fps)
    masks = np.concatenate(([0], np.uint64(1) << np.arange(64, dtype=np.uint64))).astype(np.uint64)
    key = (fps[:, None] ^ masks[None, :]).ravel()
    who = np.repeat(np.arange(n), len(masks))
    order = np.argsort(key, kind="stable")
    key, who = key[order], who[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.cumsum(new) - 1
    size, homes = np.bincount(group), np.bincount(group, weights=home[who])
    live = ((size > 1) & (homes > 0))[group]
    first = who[np.flatnonzero(new)][group]
    return first[live], who[live]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every fingerprint to the smallest of its component."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = local_roots(flat[: len(a)], flat[len(a) :], len(nodes))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def anchor_edges(cell: np.ndarray, fps: np.ndarray, home: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, fingerprint) of whole anchors, rows sorted by anchor: a spanning forest of the links."""
    new = np.concatenate(([True], cell[1:] != cell[:-1]))
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(cell)))
    homes = np.add.reduceat(home.astype(np.int64), start)
    found = []
    for g in np.flatnonzero((homes > 0) & (size * homes > DENSE)):
        part = slice(start[g], start[g] + size[g])
        if distance == 2:
            u, v = _dense(fps[part], home[part])
            found.append(_forest(fps[part][u], fps[part][v]))
        else:
            u, v = _pairs(fps, start[g : g + 1], size[g : g + 1], home, distance)
            found.append(_forest(fps[u], fps[v]))
    some = np.flatnonzero((homes > 0) & (size > 1) & (size * homes <= DENSE))
    load = np.cumsum(size[some] * homes[some])
    a = 0
    while a < len(some):   # as many anchors at a time as make PAIRS comparisons
        b = max(a + 1, int(np.searchsorted(load, (load[a - 1] if a else 0) + PAIRS, side="right")))
        u, v = _pairs(fps, start[some[a:b]], size[some[a:b]], home, distance)
        found.append(_forest(fps[u], fps[v]))
        a = b
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    return _forest(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _pairs(fps, start, size, home, distance):
    """Home x visitor comparisons of the anchors at ``start`` with ``size`` rows each."""
    rows = np.repeat(start, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    of = np.repeat(np.arange(len(start)), size)
    h = home[rows]
    hr, ho = rows[h], of[h]
    reps = size[ho]
    u = np.repeat(hr, reps)
    v = np.repeat(start[ho], reps) + (np.arange(len(u)) - np.repeat(np.cumsum(reps) - reps, reps))
    near = (np.bitwise_count(fps[u] ^ fps[v]) <= distance) & (u != v)
    return u[near], v[near]


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp``: edges whose components are those of all links."""
    def replicate(batches):
        code = golay()
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(x), 4096):
                i, cell, home = anchors(x[s : s + 4096], distance, code)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(x[s : s + 4096][i].view(np.int64)), pa.array(home)], names=["cell", "fp", "home"])

    def compare(batches):
        rest = None
        for b in batches:
            now = [b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)]
            rest = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0  # the last anchor may go on in the next batch
            if cut >= 200_000:
                yield edges(*[x[:cut] for x in rest])
                rest = [x[cut:] for x in rest]
        if rest is not None and len(rest[0]):
            yield edges(*rest)

    def edges(cell, fp, home):
        u, v = anchor_edges(cell, fp.view(np.uint64), home, distance)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["a", "b"])

    sent = fps.select("fp").mapInArrow(replicate, "cell int, fp long, home boolean")
    return sent.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): one row per document."""
    if not 0 <= distance <= 2:
        raise ValueError("the covering code is laid out for distances 0, 1 and 2")
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-docs")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-fps")
    found = components(links(distinct, distance))
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = rooted.join(least, "root").select("fp", "n", "component_id")
    return join_groups(marked, by_fp, ["fp"], "n", marked.count()).select("doc_id", "fp", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one of smallest id (null last), then the first stored.

    Rows are told apart by their place in a stored copy, so rows that share an id or have none stand for themselves."""
    row = next(n for i in range(len(docs.columns) + 1) if (n := f"__row{i}") not in docs.columns)
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    group = stored(near_duplicates(numbered, row, text_col, **options).select(F.col("doc_id").alias("r"), F.col("component_id").alias("c")), "simhash-groups")
    many = group.groupBy("c").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")   # components of one row need no choice
    members = join_groups(group, many, ["c"], "n", group.count(), "inner")
    ids = numbered.select(F.col(row).alias("r"), F.col(f"`{id_col}`").alias("id"))
    keep = members.join(ids, "r").groupBy("c").agg(F.min(F.struct(F.col("id").isNull(), "id", "r")).alias("k")).select(F.col("k.r").alias("r"))
    gone = members.select("r").join(keep, "r", "left_anti").withColumnRenamed("r", row)
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
