"""Captured API responses larger than a task, read by byte ranges.

A capture is one JSON document ``{"resultSet": {"headers": [...], "rowSet":
[[...], ...]}}`` (or ``resultSets: [{...}, ...]``, of which the first counts).
Its rows are dealt to tasks by byte ranges; a row belongs to the range in which
it begins, and its task reads on until the row ends. What a byte means depends
on all bytes before it (inside a string? how deep in brackets?), so there are
two passes, each a Python data source with one range a partition:

1. ``statflow_capture_states``: each range says how it changes the state, for
   each state in which it could begin (outside a string, inside one, inside one
   after a backslash): the state at its end and by how much the depth changes.
   These few numbers per range are composed to every range's true start.
2. ``statflow_capture_parts``: each range, from its true start, gives the text
   of every array that opens where a row stands (depth 4, or 5 below
   ``resultSets``; the first range says which), and the outline: what stands
   outside these arrays. A comma between two of them is left out.

The parts are written to the shared folder. The outline of a file, as small as
its headers and parameters, says where the rows of its first result set lie and
whether the document is sound; the rows there are parsed by Spark expressions.
Files are listed by Spark; their bytes are read through pyarrow's file systems
(local or shared folders, HDFS, S3, GCS), never whole, and never collected: the
driver sees a few numbers per range.

The rows and the verdicts are those of
:func:`statflow.operators.unpack.unpack_rowset_flagged`, but that an unreadable
capture is told by its path, not by its text, and a document that names both
``resultSet`` and ``resultSets`` at its top is unreadable.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from statflow.functions.strings import plain_number
from statflow.operators.unpack import OK, OVER_LONG, UNREADABLE
from statflow.session import ensure_checkpoint_dir

#: Bytes of a range; bytes read at a time after its end.
RANGE_BYTES = 64 << 20
READ_ON = 1 << 20
#: Tasks a core that small ranges are dealt to.
TASKS_PER_CORE = 4
#: Bytes of text handed to Spark at a time.
BATCH_BYTES = 4 << 20
#: Most bytes of a file's outline (headers, parameters; no rows). A file with
#: more is unreadable: it is not a capture.
OUTLINE_BYTES = 1 << 24
# The depth of a row below each name, and what a byte is.
ROW_DEPTHS = {"resultSet": 4, "resultSets": 5}
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("["), ord("{")]] = 1
_STEP[[ord("]"), ord("}")]] = -1
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2


def quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Places of the quotes that no backslash escapes (``escaped``: one stands
    right before the data)."""
    places = np.flatnonzero(data == _QUOTE)
    slashes = data == _BACKSLASH
    if not escaped and not slashes.any():
        return places
    # a quote is escaped by an odd run of backslashes before it
    other = np.flatnonzero(~slashes)
    at = np.searchsorted(other, places)  # places are no backslashes themselves
    before = np.where(at > 0, other[np.maximum(at - 1, 0)], -1)
    run = places - before - 1 + ((before == -1) & escaped)
    return places[run % 2 == 0]


def _tail_escapes(data: np.ndarray, escaped: bool) -> bool:
    """Whether the data end in an odd run of backslashes."""
    n = len(data)
    k = n
    while k > 0 and data[k - 1] == _BACKSLASH:
        k -= 1
    return bool((n - k + (escaped if k == 0 else 0)) % 2)


def inside_strings(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Which bytes stand inside strings (opening quotes do, closing ones do
    not), and the state at the end."""
    own = quotes(data, state == ESCAPED)
    change = np.zeros(len(data), np.int8)
    change[own] = 1
    inside = (np.cumsum(change, dtype=np.int64) + (state != OUTSIDE)) % 2 == 1
    end = (len(own) + (state != OUTSIDE)) % 2 == 1
    if not end:
        return inside, OUTSIDE
    return inside, ESCAPED if _tail_escapes(data, state == ESCAPED) else INSIDE


def depths(data: np.ndarray, state: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Depth after every byte, which bytes stand inside strings, end state."""
    inside, end = inside_strings(data, state)
    return depth + np.cumsum(np.where(inside, 0, _STEP[data]), dtype=np.int64), inside, end


def summary(data: np.ndarray) -> list[int]:
    """For each start state: end state and change of depth."""
    out = []
    for state in (OUTSIDE, INSIDE, ESCAPED):
        depth, _, end = depths(data, state, 0)
        out += [end, int(depth[-1]) if len(depth) else 0]
    return out


def compose(summaries: Sequence[Sequence[int]]) -> list[tuple[int, int]]:
    """Start state and depth of every range of a file, and of its end."""
    state, depth, out = OUTSIDE, 0, []
    for s in summaries:
        out.append((state, depth))
        depth += s[2 * state + 1]
        state = s[2 * state]
    return [*out, (state, depth)]


def _open(uri: str):
    """The file system and path of a Hadoop URI."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        uri = "file:///" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


class _Range(InputPartition):
    """Byte ranges that one task reads: small files share a task."""

    def __init__(self, ranges: list):
        super().__init__(None)
        self.ranges = ranges


class _RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.ranges = json.loads(options["ranges"])
        self.bytes = int(options["bytes"])

    def __getstate__(self) -> dict:
        return {}  # a task gets its partition's ranges, never those of all

    def partitions(self) -> list[InputPartition]:
        tasks, room = [], 0
        for own in self.ranges:
            size = own[3] - own[2]
            if size > room:
                tasks.append([])
                room = self.bytes
            tasks[-1].append(own)
            room -= size
        return [_Range(t) for t in tasks]


def _reader(source: DataSource, kind: type[_RangeReader]) -> _RangeReader:
    """The reader of a source, whose options (all ranges) stay behind: Spark
    sends both to every task."""
    made = kind(source.options)
    source.options = {}
    return made


class _StatesReader(_RangeReader):
    def read(self, partition: _Range) -> Iterator[tuple]:
        for file, path, start, end, *_ in partition.ranges:
            with _open(path) as source:
                data = np.frombuffer(source.read_at(end - start, start), np.uint8)
                form = _row_depth(source, data) if start == 0 else 0
            yield (file, start, form, *summary(data))


class CaptureStates(DataSource):
    """What each byte range does to the state, by start state; the depth of
    rows (first ranges only; 0: no result set)."""

    @classmethod
    def name(cls) -> str:
        return "statflow_capture_states"

    def schema(self) -> str:
        return "file int, start long, form int, e0 int, d0 long, e1 int, d1 long, e2 int, d2 long"

    def reader(self, schema):
        return _reader(self, _StatesReader)


def _row_depth(source, data: np.ndarray) -> int:
    """The depth of a file's rows, by the first name of a result set at its
    top; read on until there is one."""
    state, depth, at, size, name = OUTSIDE, 0, 0, source.size(), b""
    while True:
        after, inside, end = depths(data, state, depth)
        # the bytes of strings at depth 1; a name's closing quote ends it
        top = np.flatnonzero((after == 1) & (inside | (data == _QUOTE)))
        cuts = np.flatnonzero(np.diff(top) > 1) + 1
        for run in np.split(top, cuts) if len(top) else []:
            text = data[run].tobytes()
            name = name + text if run[0] == 0 else text
            for word in name.split(b'"'):
                if word.decode("utf-8", "replace") in ROW_DEPTHS:
                    return ROW_DEPTHS[word.decode()]
        if not (len(top) and top[-1] == len(data) - 1):
            name = b""
        at, state, depth = at + len(data), end, int(after[-1]) if len(after) else depth
        if at >= size:
            return 0
        data = np.frombuffer(source.read_at(min(READ_ON, size - at), at), np.uint8)


class _PartsReader(_RangeReader):
    def read(self, partition: _Range) -> Iterator:
        import pyarrow as pa

        out, held = [], 0

        def batch() -> pa.RecordBatch:
            types = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            columns = zip(*out) if out else [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=["file", "at", "upto", "is_row", "text"])

        for file, path, start, end, state, depth, wanted in partition.ranges:
            if not wanted:
                continue
            with _open(path) as source:
                for at, upto, is_row, text in _parts(source, start, end, state, depth, wanted):
                    out.append((file, at, upto, is_row, text.decode("utf-8", "replace")))
                    held += len(text)
                    if held > BATCH_BYTES:
                        yield batch()
                        out, held = [], 0
        yield batch()


class CaptureParts(DataSource):
    """Arrays where rows stand, and what stands between them."""

    @classmethod
    def name(cls) -> str:
        return "statflow_capture_parts"

    def schema(self) -> str:
        return "file int, at long, upto long, is_row boolean, text string"

    def reader(self, schema):
        return _reader(self, _PartsReader)


def _parts(source, start: int, end: int, state: int, depth: int, wanted: int
           ) -> Iterator[tuple[int, int, bool, bytes]]:
    """(place, end, whether it is an array, text) of the arrays that open at
    depth ``wanted`` in the range, and of the outline."""
    raw = source.read_at(end - start, start)
    data = np.frombuffer(raw, np.uint8)
    after, inside, state_end = depths(data, state, depth)
    step = np.where(inside, 0, _STEP[data])
    opens = np.flatnonzero((step == 1) & (after == wanted))
    closes = np.flatnonzero((step == -1) & (after == wanted - 1))
    last, before = 0, False  # the end of the last array, whether there is one
    if depth >= wanted:  # an array of the range before goes on
        last, before = (int(closes[0]) + 1 if len(closes) else len(raw)), True
        closes = closes[1:]
    for k, at in enumerate(opens.tolist()):
        # a comma between two arrays says nothing; all else does, also nothing
        if not before or raw[last:at].strip(b" \t\r\n") != b",":
            yield start + last, start + at, False, raw[last:at]
        before = True
        if k < len(closes):
            last = int(closes[k]) + 1
            yield start + at, start + last, True, raw[at:last]
        else:
            text = _read_on(source, raw[at:], end, state_end, int(after[-1]), wanted)
            yield start + at, start + at + len(text), True, text
    if not len(after) or after[-1] < wanted:  # no array goes on after the range
        yield start + last, end, False, raw[last:]


def _read_on(source, text: bytes, at: int, state: int, depth: int, wanted: int) -> bytes:
    """The text of an array that is open at byte ``at``, to its end (or the
    file's)."""
    parts, size = [text], source.size()
    while at < size:
        more = source.read_at(min(READ_ON, size - at), at)
        after, _, state = depths(np.frombuffer(more, np.uint8), state, depth)
        done = np.flatnonzero(after < wanted)
        if len(done):
            parts.append(more[:int(done[0]) + 1])
            break
        parts.append(more)
        at, depth = at + len(more), int(after[-1])
    return b"".join(parts)


def outline_of(pieces: Sequence[tuple[int, int, str]]) -> tuple[list[str | None], int, int] | None:
    """(headers, first and last byte of the first result set's rows) from a
    file's outline pieces (place, end, text), in order; None if the document is
    not one response. Where pieces leave bytes out, arrays stood: each such gap
    becomes a string that tells its bytes."""
    text, last = [], 0
    for at, upto, own in pieces:
        if at > last:
            text.append(json.dumps(f"\0{last}:{at}"))
        text.append(own)
        last = upto
    try:
        tree = json.loads("".join(text))
    except ValueError:
        return None
    if not isinstance(tree, dict) or ("resultSet" in tree) == ("resultSets" in tree):
        return None
    one = tree.get("resultSet")
    if one is None:
        sets = tree.get("resultSets")
        one = sets[0] if isinstance(sets, list) and sets else None
    if not isinstance(one, dict):
        return None
    headers, rows = one.get("headers"), one.get("rowSet")
    if not isinstance(headers, list) or not isinstance(rows, list):
        return None
    gaps = [r[1:].split(":") if isinstance(r, str) and r.startswith("\0") else None for r in rows]
    if None in gaps:
        return None  # something else than arrays among the rows
    names = [h if h is None or isinstance(h, str) else json.dumps(h) for h in headers]
    return (names, int(gaps[0][0]), int(gaps[-1][1])) if gaps else (names, 0, 0)


def _read(spark: SparkSession, kind: type[DataSource], ranges: list, task_bytes: int) -> DataFrame:
    spark.dataSource.register(kind)
    return (spark.read.format(kind.name()).option("ranges", json.dumps(ranges))
            .option("bytes", str(task_bytes)).load())


def task_bytes(spark: SparkSession, ranges: Sequence[Sequence], range_bytes: int) -> int:
    """Bytes that a task reads, one range after the other: a range at least,
    and where there are more ranges than tasks to keep all cores busy, so many
    as a range has by default. A task costs more than a small range."""
    fair = sum(r[3] - r[2] for r in ranges) // (TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return max(range_bytes, min(fair, RANGE_BYTES))


def capture_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES
                   ) -> tuple[list[str], list[list], set[int]]:
    """The files below ``path`` (listed by Spark), every byte range (file, path,
    start, end, state, depth, depth of rows) and the files that are no whole
    document. A few numbers per range come to the driver."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    sizes = sorted((f.path, f.length) for f in listed)
    ranges = [[k, name, at, min(at + range_bytes, size)]
              for k, (name, size) in enumerate(sizes) for at in range(0, max(size, 1), range_bytes)]
    found = {(r["file"], r["start"]): r for r in
             (_read(spark, CaptureStates, ranges, task_bytes(spark, ranges, range_bytes)).collect()
              if ranges else [])}
    own: list[list[list]] = [[] for _ in sizes]
    for r in ranges:
        own[r[0]].append(r)
    broken = set()
    for k, parts in enumerate(own):
        *starts, end = compose([list(found[k, r[2]])[3:] for r in parts])
        form = found[k, 0]["form"]
        if end != (OUTSIDE, 0) or not form:
            broken.add(k)
            form = 0
        for r, (state, depth) in zip(parts, starts):
            r += [state, depth, form]
    return [name for name, _ in sizes], ranges, broken


def read_capture_rows(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                      range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The rows of all captures below ``path``: ``source``, the columns
    (``columns``, or all headers found), ``status``, ``headers`` and ``values``
    of an over-long row. Runs jobs: the states, the parts, and the headers if no
    columns are given."""
    names, ranges, broken = capture_ranges(spark, path, range_bytes)
    files = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "file int, source string")
    sound = [r for r in ranges if r[0] not in broken]
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/captures-{uuid.uuid4().hex}"
    parts = _read(spark, CaptureParts, sound, task_bytes(spark, sound, range_bytes)) if sound else spark.createDataFrame(
        [], "file int, at long, upto long, is_row boolean, text string")
    parts.write.parquet(folder)
    parts = spark.read.parquet(folder)

    def outlines(key, group):
        import pandas as pd

        group = group.sort_values(["at", "upto"])
        found = outline_of(list(zip(group["at"].tolist(), group["upto"].tolist(), group["text"])))
        row = (key[0], *(found or (None, 0, 0)))
        return pd.DataFrame([row], columns=["file", "headers", "first", "last"])

    pieces = parts.filter("NOT is_row")
    small = pieces.groupBy("file").agg(F.sum(F.octet_length("text")).alias("_n")).filter(
        F.col("_n") <= OUTLINE_BYTES).select("file")
    found = (pieces.join(small, "file", "left_semi").groupBy("file")
             .applyInPandas(outlines, "file int, headers array<string>, first long, last long")
             .filter("headers IS NOT NULL"))
    found.write.parquet(f"{folder}-outlines")
    found = spark.read.parquet(f"{folder}-outlines")
    if columns is None:
        ordered = (found.select(F.posexplode("headers").alias("i", "h")).groupBy("h").agg(F.min("i").alias("i"))
                   .filter("h IS NOT NULL").orderBy("i", "h"))
        columns = [r["h"] for r in ordered.collect()]
    wanted = list(columns)
    placed = found.withColumn("places", F.array(
        *[(F.array_position("headers", F.lit(n)) - 1).cast("int") for n in wanted]).cast("array<int>"))
    rows = (parts.filter("is_row").join(placed, "file")
            .filter((F.col("at") >= F.col("first")) & (F.col("at") < F.col("last")))
            .withColumn("values", F.from_json("text", "array<string>")))
    unsound = rows.filter("values IS NULL").select("file").distinct()
    long = F.size("values") > F.size("headers")
    nulls = F.lit(None).cast("array<string>")
    good = rows.join(unsound, "file", "left_anti").join(files, "file").select(
        "source",
        *[F.when(~long, plain_number(F.get("values", F.get("places", F.lit(i))))).alias(n)
          for i, n in enumerate(wanted)],
        F.when(long, OVER_LONG).otherwise(OK).alias("status"),
        F.when(long, F.col("headers")).alias("headers"), F.when(long, F.col("values")).alias("values"))
    bad = (files.join(found.select("file").join(unsound, "file", "left_anti"), "file", "left_anti")
           .select("source", *[F.lit(None).cast("string").alias(n) for n in wanted],
                   F.lit(UNREADABLE).alias("status"), nulls.alias("headers"), nulls.alias("values")))
    return good.unionByName(bad)


# The readers go to the Python workers with the job: executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CaptureParts", "CaptureStates", "capture_ranges", "read_capture_rows"]
