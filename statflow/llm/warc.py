"""WARC archives of pages, read back and merged into capture histories.

:func:`write` gives every page a record: a response with its payload, or a
revisit of the first page with an equal payload. :func:`read` parses the
archives, one file a row, and sorts each file's captures: one run per file.
:func:`merge_runs` range-partitions the runs by URL key, time and page, so that
every task gets a slice of every run, and merges the k sorted slices of a
task by a loser tree: captures come out in one global order.

Archives are written by Spark's text sink with the record separator as the
line separator (gzip; one stream per file, not one per record), so a lost
executor's file is written again under Spark's commit protocol.

Defined results: NULL html is an empty payload; NULL urls have no target and
the empty URL key; NULL page ids can be revisits but nothing refers to them;
rows equal in id and payload are alike (all responses, or all revisits); an
empty table gives no rows; other columns are not archived.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.session import ensure_checkpoint_dir

#: Payloads under so many bytes are never revisits.
REVISIT_BYTES = 100
#: Payload bytes per archive file, about.
FILE_BYTES = 64 << 20
#: Captures get times from here on, a second per page id, where none are given.
FIRST_CAPTURE = 1_700_000_000

CAPTURE = ("run string, seq long, urlkey string, captured string, page_id long, url string, "
           "record_type string, refers_to long, payload_bytes long, payload_digest string, "
           "offset long, record_bytes long")
_ORDER = ("urlkey", "captured", "page_id", "run", "seq")


def decisions(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per different (id, payload): its digest, size and ``first``, the
    smallest id with the payload (NULL for small ones)."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    facts = pages.select(F.col(key).cast("long").alias("_id"), F.sha2(payload, 256).alias("_digest"),
                         F.octet_length(payload).alias("_bytes")).distinct()
    firsts = (facts.filter(F.col("_bytes") >= REVISIT_BYTES).groupBy("_digest")
              .agg(F.min("_id").alias("_first")))
    return facts.join(firsts, "_digest", "left")


def _header(value: Column) -> Column:
    """A header value: control characters are percent-coded."""
    return F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")


def _utc(seconds: Column) -> Column:
    t = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def records(pages: DataFrame, files: int, captured: Column | None = None, key: str = "page_id",
            url: str = "url", html: str = "html") -> DataFrame:
    """One text per record, without the closing separator. Payloads shuffle
    once, by a hash of id and payload."""
    payload = F.coalesce(F.col(html), F.lit(""))
    mark = F.xxhash64(F.col("_id"), F.col("_digest"))
    if captured is None:
        captured = F.lit(FIRST_CAPTURE) + F.coalesce(F.col(key).cast("long"), F.lit(0))
    rows = pages.select(F.col(key).cast("long").alias("_id"), payload.alias("_payload"),
                        F.col(url).alias("_url"), _utc(captured).alias("_date"),
                        F.sha2(payload.cast("binary"), 256).alias("_digest"))
    rows = rows.withColumn("_mark", mark).repartition(files, "_mark").drop("_id", "_digest")
    made = decisions(pages, key, html).withColumn("_mark", mark).repartition(files, "_mark")
    both = rows.join(made, "_mark")
    crlf = "\r\n"
    revisit = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + crlf + "Content-Type: text/html; charset=utf-8" + crlf
                          + "Content-Length: "), F.col("_bytes").cast("string"), F.lit(crlf + crlf))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("_bytes"))

    def named(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(crlf)), F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1" + crlf),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", named(F.col("_id"))),
        line("WARC-Date", F.col("_date")),
        line("WARC-Target-URI", _header(F.col("_url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", F.when(revisit, named(F.col("_first")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(crlf))
    return both.select(F.concat(head, http, F.when(revisit, "").otherwise(F.col("_payload")))
                       .alias("record"))


def write(pages: DataFrame, folder: str, captured: Column | None = None, key: str = "page_id",
          url: str = "url", html: str = "html") -> None:
    """Archives ``pages`` as WARC files in ``folder``."""
    size = pages.agg(F.sum(F.octet_length(html))).first()[0] or 0
    shuffles = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(min(shuffles, 1 + size // (1 << 20)), -(-size // FILE_BYTES))
    (records(pages, int(files), captured, key, url, html).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder))


def _parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, bytes, headers, block) of every record of a gzip file."""
    import gzip
    import io

    with gzip.open(io.BytesIO(data)) as stream:
        at = 0
        while True:
            head = []
            size = 0
            while line := stream.readline():
                size += len(line)
                if line == b"\r\n":
                    if head:
                        break
                    continue
                head.append(line[:-2].decode())
            if not head:
                return
            fields = dict(x.split(": ", 1) for x in head[1:])
            n = int(fields["Content-Length"])
            block = stream.read(n)
            if head[0] != "WARC/1.1" or len(block) != n or stream.read(4) != b"\r\n\r\n":
                raise ValueError(f"broken record at {at}")
            yield at, size + n + 4, fields, block
            at += size + n + 4


def url_key(url: str | None) -> str:
    """Host labels last to first, then the rest: ``com,example)/a?b``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return url or ""
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = rest[:cut].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:].partition("#")[0]


def _page(name: str | None) -> int | None:
    number = (name or "")[len("<urn:page:"):-1]
    return int(number) if number else None


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives; those of a file are one sorted run."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pandas as pd

        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                rows = []
                for at, size, fields, block in _parse(data):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    n = int(http.rpartition(b"Content-Length: ")[2])
                    if fields["WARC-Type"] == "response" and (
                            hashlib.sha256(payload).hexdigest() != digest or len(payload) != n):
                        raise ValueError(f"payload and digest differ in {path} at {at}")
                    url = fields.get("WARC-Target-URI")
                    rows.append((url_key(url), fields["WARC-Date"], _page(fields["WARC-Record-ID"]),
                                 url, fields["WARC-Type"], _page(fields.get("WARC-Refers-To")),
                                 n, digest, at, size))
                rows.sort(key=lambda r: (r[0], r[1], -1 if r[2] is None else r[2]))
                out = pd.DataFrame(rows, columns=["urlkey", "captured", "page_id", "url", "record_type",
                                                  "refers_to", "payload_bytes", "payload_digest",
                                                  "offset", "record_bytes"])
                out = out.astype({"page_id": "Int64", "refers_to": "Int64"})
                out.insert(0, "seq", range(len(rows)))
                out.insert(0, "run", path.rpartition("/")[2])
                yield out

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInPandas(run, CAPTURE)


def merge_sorted(runs: list[list]) -> Iterator:
    """k sorted lists as one, by a loser tree: each inner node keeps the loser
    of its match, so the next smallest costs one match per level."""
    k = len(runs)
    heads = [0] * k

    def less(a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; ended runs come last."""
        if a < 0 or heads[a] >= len(runs[a]):
            return False
        if b < 0 or heads[b] >= len(runs[b]):
            return True
        x, y = runs[a][heads[a]], runs[b][heads[b]]
        return x < y or (x == y and a < b)

    loser = [-1] * max(k, 1)
    winner = -1
    for leaf in range(k):  # runs enter one by one and wait where they have no opponent yet
        node, mine = (leaf + k) // 2, leaf
        while node > 0 and loser[node] >= 0:
            if less(loser[node], mine):
                loser[node], mine = mine, loser[node]
            node //= 2
        if node > 0:
            loser[node] = mine
        else:
            winner = mine
    while winner >= 0 and heads[winner] < len(runs[winner]):
        yield runs[winner][heads[winner]]
        heads[winner] += 1
        node, mine = (winner + k) // 2, winner
        while node > 0:
            if less(loser[node], mine):
                loser[node], mine = mine, loser[node]
            node //= 2
        winner = mine


def merge_runs(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """The captures in global order of URL key, time and page."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parts = list(batches)
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        page = [-1 if x is None else x for x in rows["page_id"].to_pylist()]
        columns = [rows[c].to_pylist() for c in ("urlkey", "captured", "run", "seq")]
        runs, last = [], None
        for i, (k, p) in enumerate(zip(zip(*columns), page)):
            if k[2] != last:  # the task's rows stand run by run, each in its order
                runs.append([])
                last = k[2]
            runs[-1].append((k[0], k[1], p, k[2], k[3], i))
        yield from rows.take([k[5] for k in merge_sorted(runs)]).combine_chunks().to_batches()

    spark = captures.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    slices = captures.repartitionByRange(n, *order).sortWithinPartitions("run", "seq")
    return slices.mapInArrow(run, CAPTURE)


def history(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url",
            html: str = "html", captured: Column | None = None) -> DataFrame:
    """Archives ``pages`` (in the shared folder, if none is given), reads the
    archives back and returns all captures in global order."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, folder, captured, key, url, html)
    return merge_runs(read(spark, folder).checkpoint())  # archives are parsed once
