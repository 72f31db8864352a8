"""Source catalog: S1 lookup, S2 years, S3 year check, S18 workload.

The catalog is a handful of entries (one per yearly file); plan-time
lookups run on the Python list, and ``catalog_frame`` gives the same entries
as a DataFrame for joins (it is broadcast where it meets file-level data).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.config import SourceEntry, default_catalog

CATALOG_SCHEMA = "anio int, perfil string, sheet_name string, header_row int, filename string, url string"


def catalog_frame(spark: SparkSession, entries: Sequence[SourceEntry] | None = None) -> DataFrame:
    entries = default_catalog() if entries is None else entries
    rows = [(e.anio, e.perfil, e.sheet_name, e.header_row, e.filename, e.url) for e in entries]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def get_source_config(anio: int, perfil: str, entries: Sequence[SourceEntry] | None = None) -> SourceEntry:
    """The entry of (year, profile); unknown values raise ``KeyError``
    naming what is available."""
    entries = default_catalog() if entries is None else entries
    years = sorted({e.anio for e in entries})
    if anio not in years:
        raise KeyError(f"year {anio} not in the catalog; available years: {years}")
    for e in entries:
        if e.anio == anio and e.perfil == perfil:
            return e
    profiles = [e.perfil for e in entries if e.anio == anio]
    raise KeyError(f"profile {perfil!r} not available for {anio}; available profiles: {profiles}")


def list_available_years(entries: Sequence[SourceEntry] | None = None) -> list[int]:
    """S2 (plan time)."""
    entries = default_catalog() if entries is None else entries
    return sorted({e.anio for e in entries})


def available_years(catalog: DataFrame, year_col: str = "anio") -> DataFrame:
    """S2 as a DataFrame: distinct years, ascending."""
    return catalog.select(year_col).distinct().orderBy(year_col)


def validate_year(anio, entries: Sequence[SourceEntry] | None = None) -> int:
    """S3: the year parameter must be in the catalog."""
    y = int(anio)
    years = list_available_years(entries)
    if y not in years:
        raise ValueError(f"year {y} is not in the catalog; available: {years}")
    return y


def workload(catalog: DataFrame, profiles: Sequence[str] | None = None, year_col: str = "anio",
             profile_col: str = "perfil") -> DataFrame:
    """Every year x every profile.  The profiles are a handful of
    names (from the catalog when not given), so each distinct year is
    expanded with a literal array of them; no join is needed."""
    if profiles is None:
        profiles = sorted(r[profile_col] for r in catalog.select(profile_col).distinct().collect())  # catalog-sized
    years = catalog.select(year_col).distinct()
    return (years.select(year_col, F.explode(F.array(*[F.lit(p) for p in profiles])).alias(profile_col))
            .orderBy(year_col, profile_col))
