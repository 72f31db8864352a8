"""Extract profile report — row and column counts, lineage columns,
rows in the place, and the first rows of key columns (a sample is the
feature here)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulastar.config import LINEAGE_COLUMNS, PLACE_PATTERN
from aulastar.functions import matches_place


@dataclass
class ExtractReport:
    rows: int
    columns: int
    lineage_columns: list[str]
    rows_in_place: int
    sample: list


def report_counts(df: DataFrame, place_col: str, pattern: str = PLACE_PATTERN) -> DataFrame:
    """S20 counts as one aggregate: rows, columns, lineage columns present and
    rows in the place."""
    lineage = [c for c in df.columns if c in LINEAGE_COLUMNS]
    return df.agg(F.count(F.lit(1)).alias("filas"),
                  F.count_if(matches_place(place_col, pattern)).alias("filas_en_lugar")).select(
        "filas", F.lit(len(df.columns)).alias("columnas"), F.lit(len(lineage)).alias("columnas_linaje"),
        "filas_en_lugar")


def extract_report(df: DataFrame, place_col: str, key_cols: list[str], pattern: str = PLACE_PATTERN,
                   sample_rows: int = 3) -> ExtractReport:
    """One aggregate pass for the counts plus a ``limit`` for the sample."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(matches_place(place_col, pattern)).alias("p")).first()
    sample = [r.asDict() for r in df.select(*key_cols).limit(sample_rows).collect()]
    return ExtractReport(agg["n"], len(df.columns), [c for c in df.columns if c in LINEAGE_COLUMNS], agg["p"], sample)
