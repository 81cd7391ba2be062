"""Landing semi-structured captures as string tables.

* API payloads ``{"resultSet": {"headers": [...], "rowSet": [[...], ...]}}``
  or ``{"resultSets": [{...}, ...]}`` -> one string row per ``rowSet`` entry.
* Stored profile pages -> one positional row of block values per page.

Both run per record inside the scan stage (``from_json`` /
``regexp_extract_all`` + higher-order functions), with no shuffle and no
Python on the hot path. Bad records are not swallowed: they can be routed to
a quarantine DataFrame with :func:`split_malformed`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions import every_other, pad_array, positional_columns
from statflow.functions.strings import let, plain_number

# Fixed value: the envelope of the statistics API responses. The payload is
# read as the one element of an array, so that text after its end (a second
# response, say) makes it unreadable instead of being ignored.
_RESULT = "struct<headers: array<string>, rowSet: array<array<string>>>"
PAYLOAD_SCHEMA = f"array<struct<resultSet: {_RESULT}, resultSets: array<{_RESULT}>>>"
_HEADERS = "struct<headers: array<string>>"
_HEADERS_SCHEMA = f"array<struct<resultSet: {_HEADERS}, resultSets: array<{_HEADERS}>>>"

#: What a row of a payload landing is: a row, a row with more values than its
#: payload has headers, or a payload that is no (one) response.
OK, OVER_LONG, UNREADABLE = "ok", "over_long", "unreadable"


def _result_set(payload: str, schema: str) -> Column:
    """The payload's first result set, NULL if it is unreadable; one parse."""
    parsed = F.from_json(F.concat(F.lit("["), F.col(payload), F.lit("]")), schema)

    def first(p: Column) -> Column:
        one = F.when(F.size(p) == 1, F.get(p, F.lit(0)))
        return F.coalesce(one["resultSet"], F.get(one["resultSets"], F.lit(0)))

    return let(parsed, first)


def payload_headers(df: DataFrame, payload: str = "payload",
                    max_headers: int | None = None) -> list[str]:
    """Header names found in the payloads, in header order. Only the headers
    are materialised (the row arrays are skipped by the parser) and only the
    distinct names reach the driver, like a schema inference pass. With
    ``max_headers``, more names are an error, never a silent cut."""
    headers = df.select(_result_set(payload, _HEADERS_SCHEMA)["headers"].alias("h"))
    names = headers.select(F.posexplode("h").alias("i", "h")).groupBy("h").agg(F.min("i").alias("i"))
    rows = names.orderBy("i", "h").collect()
    if max_headers is not None and len(rows) > max_headers:
        raise ValueError(f"more than {max_headers} distinct headers; pass columns explicitly")
    return [r["h"] for r in rows]


def unpack_rowset_flagged(
    df: DataFrame,
    payload: str = "payload",
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per ``rowSet`` entry, named by its payload's ``headers``, and one
    per unreadable payload; ``status`` tells which (:data:`OK`,
    :data:`OVER_LONG`, :data:`UNREADABLE`).

    ``columns`` fixes the output columns (absent headers give NULL); when
    omitted they are discovered with :func:`payload_headers`. Every value is a
    string; JSON numbers are printed from their parsed value as the CSV
    landing does (``4.50`` -> ``'4.5'``, ``1e10`` -> ``'10000000000.0'``);
    nested values keep their JSON text. Bad rows have NULL in these columns
    and keep what they were: ``headers`` and ``values`` of an over-long row,
    ``payload`` text of an unreadable one. ``keep`` carries columns of the
    payload row along (e.g. its path).

    A payload is parsed once; the places of its columns are found once, and its
    rows are made inside the payload's own array, so the work is linear in
    their number and neither headers nor rows ride along with each of them.
    """
    if columns is None:
        columns = payload_headers(df, payload)
    names = list(columns)
    parsed = df.select(*keep, F.col(payload).alias("__payload"),
                       _result_set(payload, PAYLOAD_SCHEMA).alias("__rs"))

    def entry(values: Sequence[Column], status: Column, headers: Column, raw: Column,
              text: Column) -> Column:
        return F.struct(*[v.alias(n) for n, v in zip(names, values)], status.alias("status"),
                        headers.alias("headers"), raw.alias("values"), text.alias("payload"))

    null = F.lit(None).cast("string")
    nulls = F.lit(None).cast("array<string>")

    def rows(x: Column) -> Column:
        places, headers = x["places"], x["headers"]

        def row(r: Column) -> Column:
            long = F.coalesce(F.size(r) > F.size(headers), F.lit(True))
            got = [F.when(~long, plain_number(F.get(r, F.get(places, F.lit(i))))) for i in range(len(names))]
            return entry(got, F.when(long, OVER_LONG).otherwise(OK), F.when(long, headers),
                         F.when(long, r), null)

        return F.transform(x["rows"], row)

    headers, row_set = F.col("__rs.headers"), F.col("__rs.rowSet")
    places = F.array(*[(F.array_position(headers, F.lit(n)) - 1).cast("int") for n in names])
    readable = let(F.struct(places.alias("places"), headers.alias("headers"), row_set.alias("rows")), rows)
    unreadable = F.array(entry([null] * len(names), F.lit(UNREADABLE), nulls, nulls, F.col("__payload")))
    bad = headers.isNull() | row_set.isNull()
    return parsed.select(*keep, F.inline(F.when(bad, unreadable).otherwise(readable)))


_BAD_COLUMNS = ("status", "headers", "values", "payload")


def split_flagged(flagged: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of an :func:`unpack_rowset_flagged` table. Both read
    it: checkpoint or write it first where both are used."""
    good = flagged.filter(F.col("status") == OK).drop(*_BAD_COLUMNS)
    bad = flagged.filter(F.col("status") != OK).select(*keep, *_BAD_COLUMNS)
    return good, bad


def unpack_rowset(
    df: DataFrame,
    payload: str = "payload",
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The good rows of :func:`unpack_rowset_flagged` alone; a landing keeps
    the others too (:func:`unpack_rowset_checked`)."""
    return split_flagged(unpack_rowset_flagged(df, payload, columns, keep))[0]


def unpack_rowset_checked(
    df: DataFrame,
    payload: str = "payload",
    columns: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine): the quarantine holds rows with more values than
    their payload has headers, and payloads that are not one response."""
    return split_flagged(unpack_rowset_flagged(df, payload, columns, keep), keep)


# HTML entities decoded when taking an element's text.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_text(c: Column) -> Column:
    """Visible text of an HTML fragment: tags removed, basic entities decoded."""
    t = F.regexp_replace(c, "<[^>]*>", "")
    for ent, ch in _ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return t


# Tags whose boundaries start a new line of rendered text.
_LINE_BREAK_TAGS = r"(?i)<br\s*/?>|</?(p|div|li|h[1-6]|tr|ul|ol|table|section|article)(\s[^>]*)?>"


def html_lines(c: Column) -> Column:
    """Text of an HTML fragment as a browser lays it out in lines: source
    whitespace (newlines included) collapses to one space, ``<br>`` and
    block-element boundaries start a new line, empty lines vanish
    (``<p>PPG</p><p>25.1</p>`` -> ``'PPG\n25.1'``)."""
    t = F.regexp_replace(c, "[ \\t\\n\\f\\r]+", " ")  # HTML whitespace renders as one space
    t = html_text(F.regexp_replace(t, _LINE_BREAK_TAGS, "\n"))
    t = F.regexp_replace(t, " ?\n[ \n]*", "\n")
    return F.regexp_replace(t, "^[ \n]+|[ \n]+$", "")


def _blocks(html: Column, pattern: str, value_line: int | None,
            text: Callable[[Column], Column] = html_text) -> Column:
    texts = F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), text)
    if value_line is None:
        return texts
    return F.transform(
        texts, lambda t: F.try_element_at(F.split(t, "\n"), F.lit(value_line + 1))
    )


def positional_values(key: Column, stats: Column, info: Sequence[Column], position: Column,
                      min_stats: int) -> Column:
    """``[key] + stats + info + [position]``: stats are the values at odd
    positions, padded to ``min_stats``; info those at even positions, counted
    from the start of each info group."""
    groups = [every_other(g, 0) for g in info]
    return F.concat(F.array(key.cast("string")), pad_array(every_other(stats, 1), min_stats),
                    *groups, F.array(position))


def extract_page_row(
    df: DataFrame,
    html: str,
    key: str,
    stat_pattern: str,
    info_pattern: str | Sequence[str],
    position_pattern: str,
    value_line: int | None = 1,
    min_stats: int = 4,
    text: Callable[[Column], Column] = html_text,
) -> DataFrame:
    """One positional row per page: ``[key] + stats + info + [position]``.

    Stats are the block values at odd positions, padded with ``'--'`` to
    ``min_stats``; info values are the blocks at even positions of each info
    group (``info_pattern``: one pattern per group, in order; a separator may
    stand last in a group without moving the next group's values); the
    position text is ``''`` when absent. ``value_line`` picks the line under
    each block's label (``None`` keeps the whole block text); a block without
    that line yields NULL, which :func:`split_malformed` can quarantine.
    ``text`` renders a block (:func:`html_text`, or :func:`html_lines` for
    pages whose label and value sit in separate elements).

    Blocks are taken once per different pattern, and the row stands behind a
    generator, so that filters on it do not take them again.
    """
    infos = [info_pattern] if isinstance(info_pattern, str) else list(info_pattern)
    patterns = list(dict.fromkeys([stat_pattern, *infos]))
    names = {p: f"b{i}" for i, p in enumerate(patterns)}
    h = F.col(html)
    taken = F.struct(*[_blocks(h, p, value_line, text).alias(names[p]) for p in patterns])
    position = text(F.regexp_extract(h, position_pattern, 1))

    def row(b: Column) -> Column:
        return F.struct(positional_values(F.col(key), b[names[stat_pattern]],
                                          [b[names[p]] for p in infos], position, min_stats).alias("values"))

    return df.select(F.col(key), F.inline(F.array(let(taken, row))))


def name_positional(df: DataFrame, values: str, header: Sequence[str]) -> DataFrame:
    """Name array positions with a fixed header (missing positions NULL)."""
    return df.select(*positional_columns(values, header))


def drop_short_rows(df: DataFrame, values: str, min_len: int) -> DataFrame:
    return df.filter(F.size(values) >= min_len)


def flag_malformed(df: DataFrame, bad: Column, name: str = "malformed") -> DataFrame:
    """Tag records as malformed (``bad`` NULL counts as good) in one pass."""
    return df.withColumn(name, F.coalesce(bad, F.lit(False)))


def split_malformed(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): keep going past bad records instead of failing or
    silently skipping them. ``bad`` NULL counts as good. Each side is meant
    for its own sink; to report on both in one pass use
    :func:`flag_malformed`."""
    flag = F.coalesce(bad, F.lit(False))
    return df.filter(~flag), df.filter(flag)


def page_row_is_bad(values: str, width: int) -> Column:
    """A page row is malformed when the page was missing, the row is longer
    than the header, or a block lacked its value line."""
    arr = F.col(values)
    return arr.isNull() | (F.size(arr) > width) | F.exists(arr, lambda x: x.isNull())
