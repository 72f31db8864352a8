"""Tabular files as a *cell grid* ``(source_file, row_idx, cells)``.

Workbooks are re-aimed to delimited exports (or to grids stored as parquet).
Files are read as lines, so a row is as wide as its record and blank lines
keep their place: nothing is declared about the number of columns and no
cell can be lost to a schema.

Row numbers.  Within one input split, lines come out in file order and
``monotonically_increasing_id`` is consecutive, so a line's index is the
number of lines in the earlier splits of the same file plus its position
inside its own split.  Per-split line counts are a partial aggregate (one row
per split); a running sum over each file's splits, ordered by
``_metadata.file_block_start``, gives the offsets, which are joined back.

Records.  With ``splittable=True`` every line is a record.  Otherwise quoted
cells may hold line breaks (spreadsheet headers do): each split cuts its own
records once the splits before it are known to end inside a quoted cell or
not (:mod:`aulastar.sources.records`).  Either way a file is read by as many
tasks as it has splits.  Blank records count, as spreadsheet rows do.

Cells equal to one of the reader's missing-value tokens are null (S11 tests
its own tokens later).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aulastar.sources.records import RECORDS, cut_heads, cut_records, leaves_open, split_cells, with_functions

WHOLE_FILE = 1 << 40   # bytes of a partition, and of opening one: no two files share one, none is split below a TB
GRID_SCHEMA = "source_file string, row_idx bigint, cells array<string>"


def read_csv_grid(spark: SparkSession, paths: str | list[str], sep: str = ",", encoding: str = "UTF-8",
                  splittable: bool = False) -> DataFrame:
    """Read delimited files, every cell as text, as a cell grid (see the
    module doc for the row index and ``splittable``)."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"), F.col("value"))
    return records_grid(lines, sep, encoding, splittable)


def read_csv_head(spark: SparkSession, paths: str | list[str], rows: int, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The first ``rows`` rows of every file's grid, without scanning the
    files: each file is one partition and its task stops reading after them.

    That takes two scan settings of its own, so the lines are read in a session
    that shares everything but those.  A record that is still open after the
    last row wanted is left out, as is one that never closes."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(WHOLE_FILE))
    own.conf.set("spark.sql.files.openCostInBytes", str(WHOLE_FILE))
    lines = own.read.text(paths).select(
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"), F.col("value"))
    lines = with_functions(_decoded(lines, encoding), sep).filter("__block = 0")
    cut = lines.select("source_file", "__file", "__block", "value", "__s", "__q").mapInArrow(cut_heads(rows), RECORDS)
    return _cells(cut, sep)


def records_grid(lines: DataFrame, sep: str = ",", encoding: str = "UTF-8", splittable: bool = False) -> DataFrame:
    """``(source_file, __file, __block, __id, value)`` lines -> the cell grid of
    their records.  Files are told apart by path (``__file``), as folders may hold files of one name."""
    lines = _decoded(lines, encoding)
    # a line is a record: quotes that it leaves open are text
    records = with_row_index(lines).withColumn("plain", leaves_open(F.col("value"), sep)) if splittable else cut_records(lines, sep)
    return _cells(records, sep)


def _decoded(lines: DataFrame, encoding: str) -> DataFrame:
    if encoding.upper() in ("UTF-8", "UTF8"):
        return lines
    return lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))


def _cells(records: DataFrame, sep: str) -> DataFrame:
    text = F.when(F.col("row_idx") == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value"))
    cells = split_cells(text, sep, F.col("plain"))
    return records.select("source_file", "row_idx", trim_trailing_nulls(cells).alias("cells"))


def with_row_index(rows: DataFrame) -> DataFrame:
    """Add ``row_idx`` to rows carrying ``__file`` (path), ``__block`` (split
    start) and ``__id`` (``monotonically_increasing_id`` taken right at the
    scan).  One row per split is aggregated and windowed per file; the
    offsets (one row per split) are joined back, in the way their size at run
    time allows."""
    blocks = rows.groupBy("__file", "__block").agg(F.min("__id").alias("__first"),
                                                        F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("__file", "__block", "__first",
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    return (rows.join(offsets, ["__file", "__block"])
            .withColumn("row_idx", F.col("__before") + F.col("__id") - F.col("__first"))
            .drop("__block", "__id", "__first", "__before"))


def read_parquet_grid(spark: SparkSession, path: str) -> DataFrame:
    """A grid stored as parquet with the grid schema."""
    return spark.read.parquet(path).select("source_file", F.col("row_idx").cast("bigint"), "cells")


def text_grid(df: DataFrame, file_col: str | Column, text_col: str, line_sep: str = "\n",
              cell_sep: str = " ") -> DataFrame:
    """A grid from whole texts: one row per line, one cell per field.

    ``line_sep`` and ``cell_sep`` are regular expressions (Spark ``split``).
    The whole text is processed; ``posexplode`` keeps the line position.
    """
    fc = F.col(file_col) if isinstance(file_col, str) else file_col
    lines = df.select(fc.alias("source_file"), F.posexplode(F.split(F.col(text_col), line_sep, -1)))
    return lines.select("source_file", F.col("pos").cast("bigint").alias("row_idx"),
                        F.split(F.col("col"), cell_sep, -1).alias("cells"))


def trim_trailing_nulls(cells: str | Column) -> Column:
    """Drop null cells after the last non-null one (the fixed-width CSV
    schema pads short rows)."""
    c = F.col(cells) if isinstance(cells, str) else cells
    idx = F.transform(c, lambda x, i: F.when(x.isNotNull(), i + 1).otherwise(F.lit(0)))
    last = F.array_max(idx)
    return F.when(F.coalesce(last, F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.slice(c, 1, last))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows over the cluster's cores where the scan has fewer
    partitions than cores (a file of one row group is otherwise the work of a
    single task).  A scan with a partition per core or more is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
