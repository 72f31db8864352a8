"""File-arrival ingest with Structured Streaming.

The reference chains jobs with scheduler events ("a year was loaded, now
transform").  The Spark-native equivalent of "ingest what newly landed" is a
file-source stream over a landing folder, run with ``availableNow`` (process
everything new, then stop) and a checkpoint in the shared folder, so each
file is loaded exactly once even if the job is restarted.  Every micro-batch
is a set of new files; ``foreachBatch`` runs the ordinary batch extract +
replace-by-file load on it (S15 + K5), so streaming and batch share one code
path.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulastar.config import IngestProfile
from aulastar.operators.relational import persisted
from aulastar.plans.ingest import ingest_profile, log_path
from aulastar.sinks.bronze import log_events
from aulastar.sources.grid import records_grid


MAX_FILES = 256   # files of a micro-batch, whose lines are kept while it is read twice


def landing_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    """The lines of delimited files landing in ``folder``; each micro-batch is
    a static DataFrame and becomes a cell grid (see
    :func:`aulastar.sources.grid.records_grid`)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder).select(F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("__file"),
                                      F.col("_metadata.file_block_start").alias("__block"), "value")


def start_landing_ingest(spark: SparkSession, folder: str, catalog: DataFrame, profile: IngestProfile, root: str,
                         checkpoint: str, run_id: str = "stream", sep: str = ",", encoding: str = "UTF-8",
                         max_files_per_trigger: int | None = MAX_FILES,
                         on_batch: Callable[[int, list], None] | None = None):
    """Start the stream; returns the ``StreamingQuery`` (call
    ``awaitTermination`` — it stops by itself after the files present at
    start are processed).

    A file of another profile of the catalog is left to that profile's
    stream.  A file that the catalog does not know, or whose header or rows
    are unusable, is logged ``failed`` with the reason; the other files of
    the batch are loaded.  ``max_files_per_trigger`` bounds a micro-batch."""
    lines = landing_stream(spark, folder, max_files_per_trigger)

    def load(batch: DataFrame, epoch: int) -> None:
        # the batch is read for its file names, the headers and the rows: keep
        # it (at most max_files_per_trigger files)
        with persisted(batch.withColumn("__id", F.monotonically_increasing_id())) as (b,):
            run = f"{run_id}-{epoch}"
            names = b.select(F.col("source_file").alias("filename")).distinct()
            unknown = names.join(catalog, "filename", "left_anti").collect()  # file names only
            log_events(spark, log_path(root), [
                dict(log_id=str(uuid.uuid4()), run_id=run, perfil=profile.name, anio=None, source_url=None,
                     source_file=r["filename"], status="failed", error="the catalog has no entry for this file")
                for r in unknown])
            mine = catalog.filter(F.col("perfil") == profile.name).join(names, "filename", "left_semi")
            if mine.isEmpty():
                return
            done = ingest_profile(records_grid(b, sep, encoding), mine, profile, root, run)
        if on_batch:
            on_batch(epoch, done.results)

    return (lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
