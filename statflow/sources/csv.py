"""CSV landings: header row, every value a string, no schema inference.

Paths are Hadoop URIs (``s3a://bucket/x.csv``, ``hdfs://...``, a shared
folder), read directly by the executors: no copy through the driver's disk.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from statflow.operators.profile import check_columns


def read_string_csv(
    spark: SparkSession,
    path: str | list[str],
    required: Iterable[str] = (),
    check_headers: bool = True,
) -> DataFrame:
    """Columns named by the header, all strings (ids keep leading zeros).

    Spark binds columns by position under the first file's header. With
    ``check_headers`` every file's header is compared with it while the
    file is read, so a landing with reordered columns fails instead of
    silently swapping values. ``required`` names are checked up front.
    Plain (non-multiline) CSV stays splittable across tasks.
    """
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", not check_headers)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    check_columns(df, required)
    return df


def table_path(base: str, name: str, ext: str = "csv") -> str:
    return f"{base.rstrip('/')}/{name}.{ext}"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row, no index column, written in parallel."""
    df.write.mode(mode).option("header", True).csv(path)
