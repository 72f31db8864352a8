"""Percentiles by selection against sorting."""

import random
from decimal import Decimal
from fractions import Fraction

import pytest

from aulastar.operators.percentiles import group_stats, percentiles


def plain(values, p):
    values = sorted(values)
    h = (len(values) - 1) * Fraction(p)
    k = int(h)
    return values[k] + (h - k) * (values[min(k + 1, len(values) - 1)] - values[k])


GROUPS = {
    "one": [7], "two": [-3, 8], "equal": [5] * 400, "small": [random.Random(1).randint(-20, 20) for _ in range(300)], "wide": [random.Random(2).randint(-10**12, 10**12) for _ in range(200)],
    "hot": [3] * 500 + list(range(100)), "far": [-(1 << 61), 1 << 61, 0, 1, 2], None: [1, 2, 10], "nulls": [None, None], "some": [None, 4, 9, None],
}


@pytest.mark.parametrize("bins, rounds", [(1 << 21, 3), (1 << 16, 4)])
def test_percentiles_as_sorting(spark, bins, rounds):
    groups = GROUPS
    df = spark.createDataFrame([(g, v) for g, x in groups.items() for v in x], "g string, v long").repartition(5)
    ps = ("0", "0.25", "0.5", "0.75", "0.9", "1")
    got = {r.g: r[1:] for r in percentiles(df, group_stats(df, "g", "v"), "g", "v", ps, bins, rounds).collect()}
    want = {g: tuple(plain([v for v in x if v is not None], Fraction(p)) for p in ps) for g, x in groups.items() if any(v is not None for v in x)}
    assert {g: tuple(Fraction(x) for x in r) for g, r in got.items()} == want


def test_no_map_of_values(spark):
    df = spark.createDataFrame([("a", 1)], "g string, v long")
    plan = percentiles(df, group_stats(df, "g", "v"), "g", "v", ("0.5",))._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower().replace("percentiles", "") and "collect_" not in plan
    assert percentiles(df.limit(0), group_stats(df.limit(0), "g", "v"), "g", "v", ("0.5",)).collect() == []
    assert percentiles(df, group_stats(df, "g", "v"), "g", "v", ("0.5",)).first()["p0"] == Decimal("1.0000")
