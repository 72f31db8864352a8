"""Centroid clustering of integer vectors by equal-average equal-variance search.

A component x becomes the integer floor(scale * x).  For a vector and a centroid of k components with sums s, t and
k-fold variances V = k * sum(x**2) - s**2 and W, the squared distance d obeys k * d >= (s - t)**2 + (sqrt(V) - sqrt(W))**2.
Centroids lie sorted by sum.  From a vector's own sum the search goes outward on both sides, the nearer sum first.  A
centroid of k * best < (s - t)**2 ends its side: all further ones are further in the mean too.  Of the others those whose
deviations are too far apart are left out; for the rest the distance is computed.  Bounds and distances are exact integers,
so ties (the smaller number wins) are decided exactly.  The vectors of a batch search together, one array operation per step.

A round is one scan: tasks assign their vectors and send one row per centroid (component sums and count), added exactly; the
new centroids (``k`` rows of 64 numbers, whatever the input) go through the driver.  No vector is ever shuffled.

Defined cases: a vector is left out if it is null, has another number of components, or one that is null or not finite; a null
id is kept in the result but starts no centroid; of equal ids with equal hash the lexicographically smaller vector comes first;
fewer than ``k`` vectors give fewer centroids; an empty table gives an empty result; values beyond 2**24 are computed with
Python integers, and a distance or inertia beyond a 64-bit integer is null."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from aulastar.llm.store import stored

DIMENSIONS, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
SAFE = 1 << 24          # components up to this size keep every bound below within 64 bits
ROWS = 8192             # vectors that search together
LONG_MAX = (1 << 63) - 1
LIMB = 30               # sums travel in signed parts of so many bits, which add exactly as 64-bit integers


@dataclass(frozen=True)
class Sorted:
    """Centroids by component sum."""

    points: np.ndarray     # in the order of their sums
    number: np.ndarray     # their numbers
    sums: np.ndarray
    spread: np.ndarray     # k * sum of squares - square of the sum

    @classmethod
    def of(cls, centroids: list[list[int]]) -> Sorted:
        small = all(abs(x) <= SAFE for c in centroids for x in c)
        points = np.array(centroids, dtype=np.int64 if small else object).reshape(len(centroids), -1)
        sums = points.sum(axis=1)
        order = np.array(sorted(range(len(centroids)), key=lambda i: (sums[i], i)))
        points, sums = points[order], sums[order]
        return cls(points, order, sums, points.shape[1] * (points * points).sum(axis=1) - sums * sums)


def nearest(x: np.ndarray, c: Sorted) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid and squared distance of every row of ``x``; how many distances were computed."""
    if x.dtype != c.points.dtype:
        x, c = x.astype(object), Sorted(c.points.astype(object), c.number, c.sums.astype(object), c.spread.astype(object))
    n, k = x.shape
    m = len(c.number)
    sums = x.sum(axis=1)
    spread = k * (x * x).sum(axis=1) - sums * sums
    low = np.searchsorted(c.sums, sums) - 1   # the next centroid on either side
    high = low + 1
    best = np.zeros(n, dtype=x.dtype)
    who = np.full(n, m, dtype=np.int64)
    floats = x.dtype != object
    root, centre_root = (np.sqrt(spread.astype(float)), np.sqrt(c.spread.astype(float))) if floats else (None, None)
    tried = 0
    rows = np.arange(n)
    while len(rows):
        lo, hi, s = low[rows], high[rows], sums[rows]
        down = (hi >= m) | (lo >= 0) & (s - c.sums[np.maximum(lo, 0)] <= c.sums[np.minimum(hi, m - 1)] - s)
        at = np.where(down, lo, hi)
        gap = s - c.sums[at]
        fresh = who[rows] == m
        bound = k * best[rows]
        over = ~fresh & (gap * gap > bound)
        far = np.zeros(len(rows), dtype=bool)
        if floats:   # the margin is above the error of the roots, so nothing is left out wrongly
            apart = root[rows] - centre_root[at]
            far = ~fresh & (gap.astype(float) ** 2 + apart * apart > bound * (1 + 1e-9) + 1e-3 * (1 + root[rows] + centre_root[at]))
        near = np.flatnonzero(~over & ~far)
        if len(near):
            r, a = rows[near], at[near]
            off = x[r] - c.points[a]
            d = (off * off).sum(axis=1)
            tried += len(near)
            better = fresh[near] | (d < best[r]) | (d == best[r]) & (c.number[a] < who[r])
            best[r[better]], who[r[better]] = d[better], c.number[a[better]]
        low[rows[down]] -= 1
        high[rows[~down]] += 1
        low[rows[over & down]] = -1
        high[rows[over & ~down]] = m
        rows = rows[(low[rows] >= 0) | (high[rows] < m)]
    return who, best, tried


def vectors(batch_column: pa.Array, dimensions: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Rows that are kept and their integer components; vectors with components beyond SAFE apart, as Python integers."""
    lists = batch_column.cast(pa.large_list(pa.float64()))
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dimensions)
    if not len(rows):
        return rows, np.zeros((0, dimensions), dtype=np.int64), None
    x = lists.take(pa.array(rows)).flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    fine = np.isfinite(x).all(axis=1)
    rows, x = rows[fine], x[fine]
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if (np.abs(y) <= SAFE).all():
        return rows, y.astype(np.int64), None
    wide = np.flatnonzero(~(np.abs(y) <= SAFE).all(axis=1))
    exact = np.array([[exact_floor(v, scale) for v in x[i]] for i in wide], dtype=object)
    rest = np.ones(len(rows), dtype=bool)
    rest[wide] = False
    return np.concatenate([rows[rest], rows[wide]]), y[rest].astype(np.int64), exact


def exact_floor(x: float, scale: int) -> int:
    top, bottom = float(x).as_integer_ratio()
    return top * scale // bottom


def searched(batch_column: pa.Array, centres: Sorted, dimensions: int, scale: int):
    """(rows, components, cluster, distance) in runs of ROWS vectors."""
    rows, x, wide = vectors(batch_column, dimensions, scale)
    n = len(x)
    for part, first in ((x, 0), (wide, n)):
        if part is not None:
            for s in range(0, len(part), ROWS):
                who, best, _ = nearest(part[s : s + ROWS], centres)
                yield rows[first + s : first + s + len(who)], part[s : s + ROWS], who, best


def seeds(df: DataFrame, id_col: str, vector_col: str, k: int, round_name: str, dimensions: int, scale: int) -> list[list[int]]:
    """The vectors whose ids have the ``k`` smallest hashes, in ascending order."""
    order = F.sha2(F.concat(F.lit(f"{round_name}:"), F.col(id_col).cast("string")), 256)
    v = F.col(vector_col)
    whole = (F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.filter(whole & F.col(id_col).isNotNull()).select(order.alias("h"), v.cast("array<double>").alias("v")).orderBy("h", "v").limit(k).collect()
    return [[exact_floor(x, scale) for x in r["v"]] for r in rows]


def step(df: DataFrame, vector_col: str, centroids: list[list[int]], dimensions: int, scale: int) -> list[list[int]]:
    """The centroids after one round."""
    centres = Sorted.of(centroids)

    def run(batches):
        total: dict[int, list] = {}
        for b in batches:
            for _, x, who, _ in searched(b.column(0), centres, dimensions, scale):
                for c in np.unique(who).tolist():
                    mine = x[who == c]
                    old = total.setdefault(c, [0, np.zeros(dimensions, dtype=object)])
                    old[0] += len(mine)
                    old[1] = old[1] + mine.sum(axis=0).astype(object)
        if total:
            rows = [(c, n, limbs(t.tolist())) for c, (n, t) in total.items()]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.list_(pa.list_(pa.int64()))), strict=True)], names=["c", "n", "s"])

    parts = df.select(F.col(f"`{vector_col}`")).mapInArrow(run, "c int, n long, s array<array<long>>")   # a row per task and centroid
    one = parts.select("c", "n", F.posexplode("s").alias("i", "l")).select("c", "n", "i", F.posexplode("l").alias("j", "s"))
    out = [list(c) for c in centroids]
    sums: dict[tuple[int, int], list[int]] = {}
    for r in one.groupBy("c", "i", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():   # a few limbs for each component of each centroid
        t = sums.setdefault((r["c"], r["i"]), [0, 0])
        t[0] += r["s"] << (LIMB * r["j"])
        t[1] = max(t[1], r["n"])
    for (c, i), (total, n) in sums.items():
        out[c][i] = total // n
    return out


def limbs(values: list[int]) -> list[list[int]]:
    """Signed parts of integers, least first; the first part is always there."""
    out = []
    for v in values:
        sign, v, parts = (-1 if v < 0 else 1), abs(v), []
        while v or not parts:
            parts.append(sign * (v & ((1 << LIMB) - 1)))
            v >>= LIMB
        out.append(parts)
    return out


def assigned(df: DataFrame, id_col: str, vector_col: str, centroids: list[list[int]], dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(id, cluster, distance) of every vector that is kept."""
    centres = Sorted.of(centroids) if centroids else None

    def run(batches):
        for b in batches:
            for rows, _, who, best in searched(b.column(1), centres, dimensions, scale):
                far = [int(d) if d <= LONG_MAX else None for d in best] if best.dtype == object else best
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(who.astype(np.int32)), pa.array(far, type=pa.int64())], names=[id_col, "cluster", "distance"])

    schema = S.StructType([df.schema[id_col], S.StructField("cluster", S.IntegerType()), S.StructField("distance", S.LongType())])
    rows = df.select(F.col(f"`{id_col}`"), F.col(f"`{vector_col}`"))
    return (rows if centroids else rows.limit(0)).mapInArrow(run, schema)


@dataclass(frozen=True)
class Clustering:
    centroids: list[list[int]]
    members: DataFrame      # id, cluster, distance
    inertia: dict[int, int | None]   # by cluster; None beyond 64 bits


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, round_name: str = "1", dimensions: int = DIMENSIONS, scale: int = SCALE) -> Clustering:
    centroids = seeds(df, id_col, vector_col, k, round_name, dimensions, scale)
    for _ in range(rounds if centroids else 0):
        centroids = step(df, vector_col, centroids, dimensions, scale)
    members = stored(assigned(df, id_col, vector_col, centroids, dimensions, scale), "centroid-members")
    sums = members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()   # k rows
    return Clustering(centroids, members, {r["cluster"]: int(r["s"]) if not r["lost"] else None for r in sums})


def report(found: Clustering) -> DataFrame:
    """Members with the inertia of their cluster and of all, and the digest of their centroid."""
    def fits(n):
        return n if n is not None and n <= LONG_MAX else None

    spark = found.members.sparkSession
    whole = None if None in found.inertia.values() else sum(found.inertia.values())
    rows = [(c, fits(found.inertia.get(c, 0)), fits(whole), hashlib.sha256(",".join(map(str, p)).encode()).hexdigest()) for c, p in enumerate(found.centroids)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.members.join(F.broadcast(facts), "cluster").select(found.members.columns[0], "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")   # k rows
