"""Generic relational helpers shared by the models and marts.

* ``latest_per_key`` (W1 + F11): top-1 per key via ``row_number() = 1``,
  which Catalyst plans as a partial ``WindowGroupLimit`` before the shuffle,
  so a hot key sends at most one row per map task.
* ``union_distinct`` (U1/U2).
* ``semi_filter`` (J2): referential filter with ``left_semi``.
* ``share_of_total`` (W3): ``x / SUM(x) OVER ()`` without moving every row
  into one partition: the total is a scalar subquery.

No join carries a broadcast hint: the planner and AQE broadcast a side whose
bytes are known to be small.
"""

from __future__ import annotations

import contextlib
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per ``key`` under ``order`` (a total order makes it
    deterministic).  Returns ``df``'s columns."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """SQL ``UNION`` (distinct) by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def semi_filter(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Keep rows of ``df`` whose key exists in ``keys`` (no duplication)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on), on, "left_semi")


def share_of_total(df: DataFrame, col: str, alias: str, scale: int = 2) -> DataFrame:
    """Add ``ROUND(100.0 * col / SUM(col) OVER (), scale)`` as ``alias``.

    The total is a scalar subquery (a partial + final aggregate run once; its
    value is handed to every task), so every task keeps its rows;
    ``Window.partitionBy()`` with no key would gather all rows in a single
    partition.
    """
    total = df.agg(F.sum(col).cast("decimal(20,0)")).scalar()
    # narrow operands keep 16 decimals in the quotient before the final
    # rounding (wide ones would leave fewer and could round twice)
    pct = (F.col(col).cast("decimal(20,0)") * 100).cast("decimal(22,0)") / total
    return df.withColumn(alias, F.when(total != 0, F.round(pct, scale)))


@contextlib.contextmanager
def persisted(*dfs: DataFrame):
    """Persist DataFrames (memory, spilling to disk) for the duration of a
    block that reads them several times, then release them.  Lost blocks are
    recomputed from lineage, so this is safe when executors die."""
    held = [d.persist(StorageLevel.MEMORY_AND_DISK) for d in dfs]
    try:
        yield held
    finally:
        for d in held:
            d.unpersist()
