"""A join of rows with per-group facts that no single group can hold up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``groups`` (one row per key, ``size`` of its rows among the ``total`` of ``rows``).

    A group with more than 1/HOT_SHARE of all rows is hot; there are fewer than HOT_SHARE of them whatever the data, so
    their facts are broadcast and their rows stay where they are.  Only the others are shuffled, in groups none of which
    is large against a partition."""
    hot = F.col(size) * HOT_SHARE > total
    few = F.broadcast(groups.filter(hot))
    return rows.join(few, keys, "inner").unionByName(rows.join(few, keys, "left_anti").join(groups.filter(~hot), keys, how))
