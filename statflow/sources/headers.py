"""CSV landings whose files have their columns in different orders, or more or
fewer of them.

Spark binds the columns of all files of a scan by position. Here the header
line of every file is read first (in tasks, a few kilobytes of each file); files
with the same header are one group, read in one scan under their own header, and
the groups are united by name. There are as many scans as different headers,
however many files.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterable, Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statflow.sources.captures import _open

#: Bytes read at a time until the header line is whole.
HEAD_BYTES = 1 << 14
#: Most different headers of a landing (each is a scan).
MAX_HEADERS = 256


def first_record(chunks: Iterable[bytes]) -> list[str] | None:
    """The values of a CSV text's first record (quotes may hold line feeds);
    None for an empty file."""
    text = b""
    for chunk in [*chunks, b""]:
        text += chunk
        quotes = newline = 0
        for k, b in enumerate(text):
            if b == 0x22:
                quotes += 1
            elif b == 0x0A and quotes % 2 == 0:
                newline = k + 1
                break
        if newline or (not chunk and text):
            line = text[:newline or len(text)].decode("utf-8-sig", "replace").rstrip("\r\n")
            return next(csv.reader(io.StringIO(line)), [])
    return None


def read_headers(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their headers. Empty files are left out;
    the names of files and headers come to the driver."""
    files = (spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
             .select("path", "length").filter("length > 0"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            paths = batch.column(0).to_pylist()
            headers = []
            for p in paths:
                with _open(p) as file:
                    headers.append(first_record(iter(lambda f=file: f.read(HEAD_BYTES), b"")))
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(headers, pa.list_(pa.string()))],
                                             names=["path", "header"])

    found = files.select("path").mapInArrow(run, "path string, header array<string>")
    out: dict[tuple[str, ...], list[str]] = {}
    for r in found.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect():
        out[tuple(r["header"] or ())] = r["paths"]
    return out


def read_any_csv(spark: SparkSession, path: str | Sequence[str], header: Sequence[str] | None = None,
                 required: Iterable[str] = (), source: bool = False) -> DataFrame:
    """All files below ``path`` as strings, columns bound by name. ``header``
    fixes the columns (others are left out, absent ones NULL); without it they
    are those of all headers, in order of first appearance. A file without one
    of the ``required`` columns, or with a repeated name, is an error that names
    it; so are more than ``MAX_HEADERS`` different headers. ``source`` adds the
    file's path."""
    groups = read_headers(spark, path)
    if len(groups) > MAX_HEADERS:
        raise ValueError(f"{len(groups)} different headers")
    for names, files in groups.items():
        missing = [c for c in required if c not in names]
        if missing:
            raise ValueError(f"{files[0]}: no column {missing}")
        if len(set(names)) < len(names):
            raise ValueError(f"{files[0]}: repeated names in {list(names)}")
    order = sorted(groups, key=lambda names: groups[names][0])
    wanted = list(header) if header is not None else list(dict.fromkeys(n for names in order for n in names))
    extra = [F.col("_metadata.file_path").alias("source")] if source else []
    out = spark.createDataFrame([], StructType([StructField(n, StringType()) for n in wanted]
                                               + [StructField("source", StringType())] * source))
    for names in order:
        schema = StructType([StructField(n, StringType()) for n in names])
        one = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
               .csv(groups[names]))
        out = out.unionByName(one.select(
            *[F.col(f"`{n}`") if n in names else F.lit(None).cast("string").alias(n) for n in wanted], *extra))
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])
