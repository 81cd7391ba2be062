"""A set of tables that is published together.

Every table of a publication is written to a folder of its own,
``<base>/<table>/v=<version>``; nothing refers to these folders until one
manifest file, ``<base>/_manifests/<number>.json``, names them all. Readers
take the tables of the manifest with the highest number, so they see either all
tables of a publication or none. A failed publication leaves the tables of the
one before, and folders that :func:`vacuum` removes. The manifest is created as
a new file that must not exist: of two publications at a time that started from
the same one, the second fails.

Paths are Hadoop URIs; the manifest, a few names, is read and written by the
driver through Hadoop's file system.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "_manifests"


class VersionConflict(RuntimeError):
    """Another publication came first."""


def _fs(spark: SparkSession, path: str):
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def _list(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def _read(spark: SparkSession, path: str) -> dict | None:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except ValueError:
        return None  # not written to its end
    return found if found.get("end") else None


def _numbers(spark: SparkSession, base: str) -> list[int]:
    names = _list(spark, f"{base.rstrip('/')}/{_FOLDER}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, base: str, number: int | None = None) -> dict | None:
    """The manifest with ``number``, or the newest whole one (None: nothing was
    published)."""
    base = base.rstrip("/")
    for n in reversed(_numbers(spark, base)) if number is None else [number]:
        found = _read(spark, f"{base}/{_FOLDER}/{n}.json")
        if found is not None:
            return {"number": n, **found}
    return None


def _create(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    try:
        stream = fs.create(where, False)
    except Exception as e:  # noqa: BLE001 - the file system's own "exists" error
        if fs.exists(where):
            raise VersionConflict(path) from e
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_tables(spark: SparkSession, base: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables published together under ``base``, by name."""
    found = manifest(spark, base, number)
    if found is None:
        raise FileNotFoundError(f"nothing published in {base}")
    return {name: spark.read.parquet(path) for name, path in found["tables"].items()}


class Publication:
    """One publication: tables are added by :meth:`write` (in any order, also
    at the same time), then :meth:`commit` shows them all."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.version = spark, base.rstrip("/"), uuid.uuid4().hex
        before = manifest(spark, self.base)
        self.kept: dict[str, str] = dict(before["tables"]) if before else {}
        self.number = max([-1, *_numbers(spark, self.base)])
        self.tables: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> None:
        path = f"{self.base}/{name}/v={self.version}"
        df.write.parquet(path)
        self.tables[name] = path

    def commit(self) -> int:
        """Shows the written tables together; tables not written stay as they
        were. Returns the manifest's number."""
        _create(self.spark, f"{self.base}/{_FOLDER}/{self.number + 1}.json",
                json.dumps({"tables": {**self.kept, **self.tables}, "version": self.version, "end": True}))
        return self.number + 1


def publish_together(spark: SparkSession, base: str, tables: Mapping[str, DataFrame],
                     concurrent_writes: int = 1) -> int:
    """Write all ``tables`` and show them at once; returns the manifest's
    number."""
    own = Publication(spark, base)
    with ThreadPoolExecutor(max_workers=max(1, concurrent_writes)) as pool:
        for done in [pool.submit(own.write, df, name) for name, df in tables.items()]:
            done.result()
    return own.commit()


def vacuum(spark: SparkSession, base: str, keep: int = 2, running: Callable[[str], bool] = lambda v: False
           ) -> list[str]:
    """Removes table folders that the newest ``keep`` manifests do not name,
    and older manifests; returns the folders. ``running(version)`` tells
    publications that are being written."""
    base = base.rstrip("/")
    numbers = _numbers(spark, base)
    kept = [m for n in numbers[-keep:] if (m := _read(spark, f"{base}/{_FOLDER}/{n}.json"))]
    wanted = {path for m in kept for path in m["tables"].values()}
    gone = []
    for name in _list(spark, base):
        if name == _FOLDER:
            continue
        for version in _list(spark, f"{base}/{name}"):
            path = f"{base}/{name}/{version}"
            if version.startswith("v=") and path not in wanted and not running(version[2:]):
                fs, where = _fs(spark, path)
                fs.delete(where, True)
                gone.append(path)
    for n in numbers[:-keep]:
        fs, where = _fs(spark, f"{base}/{_FOLDER}/{n}.json")
        fs.delete(where, False)
    return gone
