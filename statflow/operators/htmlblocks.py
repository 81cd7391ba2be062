"""Page blocks found by CSS class with a real HTML parser (``mapInArrow``).

The regex route (:func:`statflow.operators.unpack.extract_page_row`) suits
fixed templates. When a block nests elements with its own closing tag
(``<div class="stat"><div>PPG</div><div>25.1</div></div>``) a lazy regex
stops at the first inner ``</div>``; this route tracks nesting instead. It
runs per Arrow batch inside the scan's tasks (no shuffle), one standard-library
parser pass per page, and hands back plain arrays for the Spark expressions
that build the row.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from statflow.operators.unpack import positional_values

# HTML elements without an end tag, elements whose boundaries
# start a new rendered line, and elements whose text is never rendered.
_VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link",
                   "meta", "source", "track", "wbr"})
_BLOCK = frozenset({"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "ul", "ol",
                    "table", "section", "article", "br"})
_HIDDEN = frozenset({"script", "style"})


# Marks a rendered line break between blocks (source newlines are whitespace).
_BREAK = "\x00"

# HTML's whitespace characters (space, tab, LF, FF, CR); a no-break space
# is text, not whitespace.
_HTML_SPACE = re.compile("[ \t\n\f\r]+")


def _render(parts: list[str]) -> str:
    """Browser-like text: whitespace runs -> one space, block marks -> lines."""
    lines = []
    for chunk in "".join(parts).split(_BREAK):
        line = _HTML_SPACE.sub(" ", chunk).strip(" ")
        if line:
            lines.append(line)
    return "\n".join(lines)


class _ClassBlocks(HTMLParser):
    def __init__(self, classes: Mapping[str, str]):
        super().__init__(convert_charrefs=True)
        self.classes = classes
        self.found: dict[str, list[str]] = {name: [] for name in classes}
        self.open: list[tuple[str, str, int, list[str]]] = []  # (name, tag, depth, parts)
        self.hidden = 0  # inside <script>/<style>: not rendered

    def handle_starttag(self, tag, attrs):
        if tag in _HIDDEN:
            self.hidden += 1
        if tag in _BLOCK:
            self._emit(_BREAK)
        if tag in _VOID:
            return
        # an open block counts nested elements of its own tag name, so only
        # its matching end tag closes it
        self.open = [(n, t, d + (t == tag), p) for n, t, d, p in self.open]
        css = (dict(attrs).get("class") or "").split()
        for name, selector in self.classes.items():
            if selector.startswith(".") and selector[1:] in css or selector == tag:
                self.open.append((name, tag, 1, []))

    def handle_startendtag(self, tag, attrs):
        if tag in _BLOCK:
            self._emit(_BREAK)

    def handle_endtag(self, tag):
        if tag in _HIDDEN:
            self.hidden = max(self.hidden - 1, 0)
        if tag in _BLOCK:
            self._emit(_BREAK)
        still = []
        for name, t, depth, parts in self.open:
            if t == tag:
                depth -= 1
            if depth == 0:
                self.found[name].append(_render(parts))
            else:
                still.append((name, t, depth, parts))
        self.open = still

    def handle_data(self, data):
        if not self.hidden:
            self._emit(data)

    def _emit(self, text: str) -> None:
        for _, _, _, parts in self.open:
            parts.append(text)

    def result(self) -> dict[str, list[str]]:
        self.close()
        for name, _, _, parts in self.open:  # unclosed at the end of the page
            self.found[name].append(_render(parts))
        return self.found


def blocks_by_class(html: str | None, classes: Mapping[str, str]) -> dict[str, list[str]] | None:
    """Rendered text of every element matching each selector, in page order.
    A selector is ``.name`` (a CSS class) or a tag name (``li``)."""
    if html is None:
        return None
    parser = _ClassBlocks(classes)
    parser.feed(html)
    return parser.result()


def parsed_blocks(df: DataFrame, html: str, classes: Mapping[str, str],
                  keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` and one ``array<string>`` column per ``classes``
    entry (output name -> selector: ``.class`` or tag name) holding the
    rendered texts of the matching elements. The pages themselves stay in the
    Python worker."""
    rows = df.select(*keep, F.col(html).cast("string").alias("__html"))
    schema = StructType(
        rows.schema.fields[:-1] + [StructField(n, ArrayType(StringType()), True) for n in classes]
    )
    names, chosen = list(classes), dict(classes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [blocks_by_class(h, chosen) for h in batch.column("__html").to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array([None if f is None else f[n] for f in found], pa.list_(pa.string()))
                        for n in names]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], *names])

    return rows.mapInArrow(run, schema)


def extract_page_row_parsed(
    df: DataFrame,
    html: str,
    key: str,
    stat_class: str,
    info_class: str | Sequence[str],
    position_class: str,
    value_line: int | None = 1,
    min_stats: int = 4,
) -> DataFrame:
    """Same row as :func:`statflow.operators.unpack.extract_page_row`
    (``[key] + stats + info + [position]``), blocks found by selector: a
    bare name is a CSS class (``stat``), ``<li>`` selects a tag. Several info
    selectors are several info groups."""

    def selector(s: str) -> str:
        return s[1:-1] if s.startswith("<") and s.endswith(">") else f".{s}"

    infos = [info_class] if isinstance(info_class, str) else list(info_class)
    chosen = {"__stat": selector(stat_class), "__pos": selector(position_class)}
    chosen |= {f"__info{i}": selector(c) for i, c in enumerate(infos)}
    parsed = parsed_blocks(df, html, chosen, [key])

    def value(arr: str):
        if value_line is None:
            return F.col(arr)
        return F.transform(F.col(arr), lambda t: F.try_element_at(F.split(t, "\n"),
                                                                  F.lit(value_line + 1)))

    position = F.coalesce(F.try_element_at(F.col("__pos"), F.lit(1)), F.lit(""))
    values = positional_values(F.col(key), value("__stat"),
                               [value(f"__info{i}") for i in range(len(infos))], position, min_stats)
    return parsed.select(F.col(key), values.alias("values"))


# The parser goes to the Python workers with the job: executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["blocks_by_class", "extract_page_row_parsed", "parsed_blocks"]
