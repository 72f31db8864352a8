"""Seed lookup CSV with declared column types, replaced in full on load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Declared types of the membership seed (integer key joins the parsed code).
SEED_SCHEMA = ("codigo_snies int, nombre_oficial string, departamento_principal string, universidad_sue string")


def read_seed(spark: SparkSession, path: str, schema: str = SEED_SCHEMA) -> DataFrame:
    """Read the seed with its declared schema (no inference)."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def load_seed(spark: SparkSession, path: str, target: str, schema: str = SEED_SCHEMA) -> DataFrame:
    """``seed --full-refresh``: replace the stored seed table and read it back."""
    spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
    return spark.read.parquet(target)
