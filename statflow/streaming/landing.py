"""Incremental version of the daily load: new CSV drops in a landing folder
are typed with the same profile and appended to a Parquet table.

The source job re-reads and overwrites everything daily. With a file stream
each drop is read once; the checkpoint folder, which the caller names and
keeps (in storage that all machines share), records which files were
processed, so a restarted or failed job resumes without duplicates.
``availableNow`` processes what is there and stops, so it fits the same daily
schedule. Only tables that need no other table can be landed so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from statflow.operators.profile import Profile, apply_profile


def string_schema(header: Sequence[str]) -> StructType:
    """All-string schema for a landing header (streams need one up front)."""
    return StructType([StructField(h, StringType(), True) for h in header])


def land_stream(
    spark: SparkSession,
    source_dir: str,
    header: Sequence[str],
    profile: Profile,
    sink_dir: str,
    checkpoint_dir: str,
    name: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream ``source_dir`` (CSV, ``header``) -> profile -> Parquet
    ``sink_dir``. ``checkpoint_dir`` belongs to this source and sink alone. A
    drop whose header line is not ``header``, in that order, fails the stream
    instead of being read by position."""
    raw = (
        spark.readStream.schema(string_schema(header))
        .option("header", True)
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", 64)
        .csv(source_dir)
    )
    typed = apply_profile(raw, profile)
    writer = (
        typed.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .queryName(name)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute"
    )
    return writer.start()
