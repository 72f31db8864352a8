"""Exact continuous percentiles by distributed radix selection.

The value of a rank is found digit by digit.  Per group the range of the values is cut into ``BINS`` equal bins; a count of each bin, which
combines map-side, tells in which one the rank lies, and the next round cuts that bin alone.  Three rounds reach single values in any range
of 64-bit integers; rounds that have nothing left to do are empty and AQE drops them, so a range of up to ``BINS`` values takes one.
A task holds at most ``BINS`` counts of a group's bin, however many values there are, equal or distinct."""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1 << 21
ROUNDS = 3


def group_stats(values: DataFrame, group: str, value: str, *more: Column) -> DataFrame:
    """``(group, __n, __low, __high, more...)``: count, least and greatest of the values that are not null."""
    return values.groupBy(group).agg(F.count(value).alias("__n"), F.min(value).alias("__low"), F.max(value).alias("__high"), *more)


def percentiles(values: DataFrame, stats: DataFrame, group: str, value: str, ps: Sequence[str], bins: int = BINS, rounds: int = ROUNDS) -> DataFrame:
    """``(group, p0, p1, ...)`` as decimals, for percentiles ``ps`` (decimal texts), of the integers in ``value`` (null ones are left out).

    ``stats`` is ``group_stats`` of the same values; its groups are few (it is joined to every value).  A group is compared null-safe and one
    without values has null percentiles."""
    v = values.select(F.col(group).alias("g"), F.col(value).cast("bigint").alias("v")).filter("v is not null")
    known = stats.filter("__n > 0").select(F.col(group).alias("g"), F.col("__n").alias("n"), F.col("__low").cast("bigint").alias("low"),
                                           (F.col("__high").cast("bigint") - F.col("__low").cast("bigint") + 1).alias("width"))
    places = [(F.col("n") - 1).cast("decimal(20,0)") * F.lit(Decimal(p)) for p in ps]
    ranks = F.array(*[F.struct(F.lit(2 * i + k).alias("t"), F.least(F.floor(h).cast("bigint") + k, F.col("n") - 1).alias("rank"))
                      for i, h in enumerate(places) for k in (0, 1)])
    active, found = known.select("g", "low", "width", ranks.alias("targets")), None
    for _ in range(rounds):
        hit = _refined(v, active, bins)
        active, done = hit.filter("width > 1"), hit.filter("width = 1").select("g", "low", F.explode("targets").alias("r")).select("g", "low", "r.t")
        found = done if found is None else found.unionByName(done)
    at = found.groupBy(F.col("g").alias("ag")).agg(*[F.max(F.when(F.col("t") == t, F.col("low"))).alias(f"v{t}") for t in range(2 * len(ps))])
    joined = known.join(at, F.col("g").eqNullSafe(F.col("ag")))

    def between(i, h):
        part = (h - F.floor(h).cast("decimal(20,0)")).cast("decimal(8,4)")
        return (F.col(f"v{2 * i}").cast("decimal(22,0)") + (F.col(f"v{2 * i + 1}") - F.col(f"v{2 * i}")).cast("decimal(20,0)") * part).cast("decimal(30,4)")

    return joined.select(F.col("g").alias(group), *[between(i, h).alias(f"p{i}") for i, h in enumerate(places)])


def _refined(v: DataFrame, active: DataFrame, bins: int) -> DataFrame:
    """One round: the bins that hold a rank of the searches in ``active`` (group, range, ranks within it), each a new range."""
    ranges = active.withColumn("step", F.expr(f"(width - 1) div {bins} + 1"))
    inside = v.withColumnRenamed("g", "vg").join(ranges, F.col("vg").eqNullSafe(F.col("g")) & (F.col("v") >= F.col("low")) & (F.col("v") - F.col("low") < F.col("width")))
    # the ranks go along as a key, so nothing has to be joined back
    counts = inside.groupBy("g", "low", "step", "targets", F.expr("(v - low) div step").alias("b")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("g", "low").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    upto = counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
    mine = F.transform(F.filter("targets", lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("c"))),
                       lambda r: F.struct(r["t"].alias("t"), (r["rank"] - F.col("before")).alias("rank")))
    return upto.select("g", (F.col("low") + F.col("b") * F.col("step")).alias("low"), F.col("step").alias("width"), mine.alias("targets")).filter(F.size("targets") > 0)
