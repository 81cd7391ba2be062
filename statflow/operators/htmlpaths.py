"""Page blocks addressed by their place in the element tree (``mapInArrow``).

A path such as ``/html/body/div[1]/section/div[2]`` names, step by step, a
child of the element before: its tag (``*``: any) and, in brackets, which of
the children with that tag it is, counted from 1; without brackets every such
child. Several paths are followed in one pass over a page's parser events:
every open element counts its children by tag and knows which paths lead to it,
so a start tag costs the paths that reach its parent and nothing is kept of a
page but the open elements and the texts of the blocks.

Stored pages are read as a browser would: ``html``, ``head`` and ``body`` are
implied where their tags are missing, void elements have no children, end tags
that HTML lets one leave out (``p``, ``li``, ``dt``, ``dd``, ``option``, table
parts) are implied, an end tag closes what is open inside its element, and one
without an open element is ignored.
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

from statflow.operators.htmlblocks import _BLOCK, _BREAK, _HIDDEN, _VOID, _render
from statflow.operators.unpack import positional_values

_STEP = re.compile(r"/([A-Za-z][A-Za-z0-9-]*|\*)(?:\[([1-9][0-9]*)\])?")

# Elements that belong in a page's head; start tags that end an
# open paragraph; elements that a later sibling ends, with those siblings, and
# the elements between which that holds.
_HEAD = frozenset({"base", "link", "meta", "noscript", "script", "style", "template", "title"})
_ENDS_P = frozenset({"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer",
                     "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol",
                     "p", "pre", "section", "table", "ul"})
_SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
                 "td": {"td", "th", "tr", "tbody", "thead", "tfoot"},
                 "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
                 "tr": {"tr", "tbody", "thead", "tfoot"}, "tbody": {"tbody", "tfoot"},
                 "thead": {"tbody", "tfoot"}}
_ENDED_BY: dict[str, list[str]] = {}  # the same by the tag that ends them
for _open_tag, _enders in _SIBLING_ENDS.items():
    for _tag in _enders:
        _ENDED_BY.setdefault(_tag, []).append(_open_tag)
_ENDS_P_STOP = frozenset({"button", "td", "th", "table", "object", "template"})
_SIBLING_STOP = frozenset({"ul", "ol", "dl", "select", "table", "template"})

# Most tags have neither attributes nor a content that is read differently
# (scripts, titles, ...): they need no scan for attributes.
_PLAIN_START = re.compile(r"<([A-Za-z][A-Za-z0-9]*)>")
_PLAIN_END = re.compile(r"</([A-Za-z][A-Za-z0-9]*)>")
_RAW_CONTENT = frozenset({"iframe", "noembed", "noframes", "noscript", "plaintext", "script", "style", "textarea",
                          "title", "xmp"})


def parse_path(path: str) -> list[tuple[str, int | None]]:
    """The steps of a path: (tag or ``*``, place among its like or None)."""
    steps = [(m[1].lower(), int(m[2]) if m[2] else None) for m in _STEP.finditer(path)]
    if not steps or _STEP.sub("", path):
        raise ValueError(f"not a path of child steps: {path!r}")
    return steps


class _Element:
    __slots__ = ("tag", "counts", "leads", "blocks")

    def __init__(self, tag: str, leads: list[tuple[str, int]], blocks: list[tuple[str, list[str]]]):
        self.tag, self.leads, self.blocks = tag, leads, blocks
        self.counts: dict[str, int] = {}


class _PathBlocks(HTMLParser):
    def __init__(self, paths: Mapping[str, list[tuple[str, int | None]]]):
        super().__init__(convert_charrefs=True)
        self.paths = paths
        self.found: dict[str, list[list[str]]] = {name: [] for name in paths}
        self.stack = [_Element("", [(name, 0) for name in paths], [])]
        self.texts: list[list[str]] = []  # of the open blocks
        self.hidden = 0

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def parse_starttag(self, i):
        m = _PLAIN_START.match(self.rawdata, i)
        tag = m and m[1].lower()
        if not m or tag in _RAW_CONTENT:
            return super().parse_starttag(i)
        self.handle_starttag(tag, [])
        return m.end()

    def parse_endtag(self, i):
        m = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        tag = m and m[1].lower()
        if not m or tag in _RAW_CONTENT:
            return super().parse_endtag(i)
        self.handle_endtag(tag)
        return m.end()

    def _open(self, tag: str) -> None:
        parent = self.stack[-1]
        place = parent.counts[tag] = parent.counts.get(tag, 0) + 1
        every = parent.counts["*"] = parent.counts.get("*", 0) + 1
        leads, blocks = [], []
        for name, depth in parent.leads:
            want, at = self.paths[name][depth]
            if (want == tag and at in (None, place)) or (want == "*" and at in (None, every)):
                if depth + 1 < len(self.paths[name]):
                    leads.append((name, depth + 1))
                else:
                    text: list[str] = []
                    self.found[name].append(text)  # in the order of the start tags
                    blocks.append((name, text))
                    self.texts.append(text)
        self.stack.append(_Element(tag, leads, blocks))

    def _close(self) -> None:
        element = self.stack.pop()
        if element.blocks:
            own = [id(text) for _, text in element.blocks]
            self.texts = [t for t in self.texts if id(t) not in own]

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._close()

    def _inside(self, tag: str, stop: frozenset = frozenset()) -> int:
        """Depth of the innermost open ``tag`` (0: none before a ``stop``)."""
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                return depth
            if self.stack[depth].tag in stop:
                return 0
        return 0

    def _imply(self, tag: str) -> None:
        """Opens html, head and body where their tags are missing."""
        if len(self.stack) == 1 and tag != "html":
            self._open("html")
        if len(self.stack) == 2 and self.stack[1].tag == "html" and tag not in ("html", "head", "body"):
            counts = self.stack[1].counts
            self._open("head" if tag in _HEAD and not counts else "body")
        elif len(self.stack) == 3 and self.stack[2].tag == "head" and tag not in _HEAD and tag != "head":
            self._close()
            if tag != "body":
                self._open("body")

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "head", "body") and self._inside(tag):
            return  # a second such tag adds nothing
        self._imply(tag)
        if tag in _ENDS_P:
            depth = self._inside("p", _ENDS_P_STOP)
            if depth:
                self._close_to(depth)
        for open_tag in _ENDED_BY.get(tag, ()):
            depth = self._inside(open_tag, _SIBLING_STOP)
            if depth:
                self._close_to(depth)
        if tag in _HIDDEN:
            self.hidden += 1
        self._open(tag)
        if tag in _BLOCK:  # the element's own text starts inside
            self._emit(_BREAK)
        if tag in _VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # HTML has no empty-element tags but the void ones

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return  # what follows still stands in the body
        if tag in _HIDDEN:
            self.hidden = max(self.hidden - 1, 0)
        depth = self._inside(tag)
        if depth:
            if tag in _BLOCK:
                self._emit(_BREAK)
            self._close_to(depth)
            if tag in _BLOCK:
                self._emit(_BREAK)

    def handle_data(self, data):
        if data.strip(" \t\n\f\r") and not self.hidden:
            self._imply("#text")
        if not self.hidden:
            self._emit(data)

    def _emit(self, text: str) -> None:
        for parts in self.texts:
            parts.append(text)


def blocks_by_path(html: str | None, paths: Mapping[str, list[tuple[str, int | None]]]
                   ) -> dict[str, list[str]] | None:
    """Rendered text of every element that each path leads to, in page order."""
    if html is None:
        return None
    parser = _PathBlocks(paths)
    parser.feed(html)
    parser.close()
    return {name: [_render(t) for t in texts] for name, texts in parser.found.items()}


def path_blocks(df: DataFrame, html: str, paths: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` and one ``array<string>`` column per ``paths``
    entry (output name -> path) with the rendered texts of the elements there
    (NULL page: NULL). The pages themselves stay in the Python worker."""
    steps = {name: parse_path(path) for name, path in paths.items()}
    rows = df.select(*keep, F.col(html).cast("string").alias("__html"))
    schema = StructType(rows.schema.fields[:-1]
                        + [StructField(n, ArrayType(StringType()), True) for n in steps])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [blocks_by_path(h.as_py(), steps) for h in batch.column(batch.num_columns - 1)]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array([None if f is None else f[n] for f in found], pa.list_(pa.string()))
                        for n in steps]
            yield pa.record_batch(columns, names=[*batch.schema.names[:-1], *steps])

    return rows.mapInArrow(run, schema)


def extract_page_row_paths(
    df: DataFrame,
    html: str,
    key: str,
    stat_path: str,
    info_path: str | Sequence[str],
    position_path: str,
    value_line: int | None = 1,
    min_stats: int = 4,
) -> DataFrame:
    """Same row as :func:`statflow.operators.unpack.extract_page_row`
    (``[key] + stats + info + [position]``), blocks addressed by their places
    in the tree; of several positions the first counts."""
    infos = [info_path] if isinstance(info_path, str) else list(info_path)
    chosen = {"__stat": stat_path, "__pos": position_path}
    chosen |= {f"__info{i}": p for i, p in enumerate(infos)}
    taken = path_blocks(df, html, chosen, [key])

    def value(name: str):
        if value_line is None:
            return F.col(name)
        return F.transform(F.col(name), lambda t: F.try_element_at(F.split(t, "\n"), F.lit(value_line + 1)))

    position = F.when(F.col("__pos").isNotNull(),
                      F.coalesce(F.try_element_at(F.col("__pos"), F.lit(1)), F.lit("")))
    values = positional_values(F.col(key), value("__stat"),
                               [value(f"__info{i}") for i in range(len(infos))], position, min_stats)
    return taken.select(F.col(key), values.alias("values"))


# The evaluator goes to the Python workers with the job: executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["blocks_by_path", "extract_page_row_paths", "parse_path", "path_blocks"]
