"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

Every executor can read them, so a lost executor costs a re-read and never a recomputation of what came before."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from aulastar.session import remove_at_exit, shared_path


def new_path(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back (cuts the lineage).  The table lasts as long as the
    session."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(f)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
