"""S13 row hash: MD5 over the data values in file column order."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aulastar.config import HASH_SEPARATOR, MISSING_HASH_TEXT


def row_hash(columns: Sequence[str], sep: str = HASH_SEPARATOR, missing: str = MISSING_HASH_TEXT) -> Column:
    """``md5(v1 || sep || v2 ...)`` where a missing value prints as ``missing``.

    ``concat_ws`` skips nulls, so every value is coalesced first; the result
    equals the hex MD5 of the Python join of ``str`` values.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns]
    return F.md5(F.concat_ws(sep, *parts))
