"""Objects landed once: a manifest of what has been taken in.

The objects of a landing folder are listed by Spark (path, length, modification
time; nothing is read). An anti-join with the manifest leaves those that are new
or were replaced; they are landed into a folder of their run, and only then the
run's entries are added to the manifest. A run that fails before that is as if
it had not been: its folder is in no manifest, readers do not see it, and the
next run takes its objects again. All paths are Hadoop URIs.

One loader at a time works on a manifest (a daily job); readers may come at any
time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRIES = "path string, length long, modified timestamp, run string"
#: Objects that one landing pass reads (the paths of a pass are the driver's).
OBJECTS_PER_PASS = 10_000


def list_objects(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The objects below ``path`` whose names fit the glob ``pattern``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The entries of all committed runs (none yet: an empty table)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(manifest)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(manifest)


def new_objects(listed: DataFrame, entries: DataFrame) -> DataFrame:
    """What is not landed: the path is new, or its length or time is another
    than when it was last landed."""
    return listed.join(entries.select("path", "length", "modified").distinct(),
                       ["path", "length", "modified"], "left_anti")


def land_new(
    spark: SparkSession,
    source: str,
    manifest: str,
    land: Callable[[list[str], str], None],
    pattern: str | None = None,
    per_pass: int = OBJECTS_PER_PASS,
) -> int:
    """Calls ``land(paths, run)`` for the objects below ``source`` that are not
    in ``manifest``, at most ``per_pass`` at a time, each pass a run that is
    committed after it. Returns the number of objects landed."""
    # the listing is fixed before anything is read: what comes later is the
    # next call's, and what is replaced meanwhile is landed again then
    found = new_objects(list_objects(spark, source, pattern), read_manifest(spark, manifest))
    todo = sorted(found.collect(), key=lambda r: r["path"])  # names, no contents
    for at in range(0, len(todo), per_pass):
        own, run = todo[at:at + per_pass], uuid.uuid4().hex
        land([r["path"] for r in own], run)
        entries = spark.createDataFrame([(*r, run) for r in own], ENTRIES)
        entries.coalesce(1).write.mode("append").parquet(manifest)
    return len(todo)


def land_table(spark: SparkSession, source: str, manifest: str, out: str,
               read: Callable[[list[str]], DataFrame], pattern: str | None = None,
               per_pass: int = OBJECTS_PER_PASS) -> int:
    """:func:`land_new` into Parquet below ``out``, one folder per run, by a
    reader of several paths (e.g. ``lambda p: read_string_csv(spark, p)``)."""
    return land_new(spark, source, manifest,
                    lambda paths, run: read(paths).write.parquet(f"{out.rstrip('/')}/run={run}"),
                    pattern, per_pass)


def read_landed(spark: SparkSession, manifest: str, out: str) -> DataFrame:
    """The rows of the committed runs; of an object that was landed again only
    the last run's rows would be wanted, so landings that are replaced keep
    their ``source`` column and :func:`current_objects` tells the run."""
    entries = read_manifest(spark, manifest).select("run").distinct()
    landed = spark.read.option("mergeSchema", True).parquet(out)
    return landed.join(entries, "run", "left_semi")


def current_objects(spark: SparkSession, manifest: str) -> DataFrame:
    """For every path its last landed state: length, time and run."""
    last = F.max_by(F.struct("length", "modified", "run"), F.col("modified"))
    return read_manifest(spark, manifest).groupBy("path").agg(last.alias("o")).select("path", "o.*")
