"""A corpus pipeline of five stages: quality, exact copies, near copies, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and
reads it again as the next stage's ``docs``.  All but the last return the columns of ``docs`` and drop rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aulastar.llm import decontaminate, exact_dedup, mixing, quality, simhash
from aulastar.llm.store import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that score below 0.5 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal texts one row stays."""
    return exact_dedup.ExactIndex(docs, carry=docs.columns).survivors()


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of linked fingerprints the document of smallest id stays."""
    return simhash.survivors(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a test item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every copy that the mix takes, numbered by ``mix_copy``."""
    return mixing.mix(docs)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("simhash_dedup", simhash_stage), ("decontamination", benchmark_stage), ("mixing", mix_stage)]

#: A learned score and bit-distance groups are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
