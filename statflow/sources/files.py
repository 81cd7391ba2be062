"""Captured payloads, stored pages, Parquet tables and the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """One row per captured API response: (source, payload).

    By default each file is one response (one JSON document, parsed by one
    task); responses are paged by the API (its row counter), so each stays
    bounded, and many small files are packed into shared tasks by the file
    source. ``one_per_line`` reads JSON Lines captures (one response per
    line), which split across tasks however large the file is.
    """
    raw = spark.read.text(path) if one_per_line else spark.read.text(path, wholetext=True)
    return raw.select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("payload")
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored HTML page: (source, html)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("html")
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
               partition_by: list[str] | None = None,
               bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Catalog table twin of the JDBC sink (``saveAsTable``).

    ``bucket_by=(n, ["PLAYER_ID"])`` stores the table hash-bucketed (and
    sorted) by its join key: later joins and aggregations between tables
    bucketed the same way on that key read co-located buckets instead of
    shuffling. ``partition_by`` lays out directories for partition pruning
    (e.g. by game date)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")
