"""Tables that a query writes for its own run, in the shared folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from statflow.session import ensure_checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in a new folder below ``spark.checkpoint.dir``, read
    again: later plans start from the files, also when executors are lost."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that nothing refers to any
    more. Its cleaner acts when their objects are collected, which a driver with
    room to spare may put off for long. What listens to queries refers to the
    last one until another has run: a small one."""
    gc.collect()
    spark.range(0, 1, 1, 1).collect()
    spark.sparkContext._jvm.System.gc()
