"""Alignment of two tokenizers' tokens over the same bytes.

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B).
An A and a B token are linked where their byte ranges overlap; linked tokens
form groups. The groups are found by pointer jumping over all tokens of many
texts at once (:func:`groups_of`): every token points to its farthest-right
overlapping token, the last token of a group, where both tokenizations end, to
itself; replacing all successors by their successors' successors doubles the
reach, so after as many rounds as the longest group has binary digits every
token points to its group's last token, its label.

Both tokenizations always cut before a space that follows another character
than white space. What lies between two such cuts is aligned once and
remembered in the worker (a bounded table); texts with other white space before
a space, or with one at an end, are aligned whole.

Corpus-wide counts are made from a written table with the link counts of every
document (:func:`pair_counts`): an id pair counts a document once. The
``FREQUENT`` most frequent pairs go to every task and are looked up there; the
others are joined (:func:`scored`). Both ways give the same numbers.

Defined results: texts that are NULL, empty, or whose tokens do not give back
the text's bytes with a space before (a text with U+2581) have no tokens; every
row is a document of its own, also with a repeated or NULL id; an empty table
gives no rows; other columns, whatever their names, are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.store import written
from statflow.llm.tokens import byte_level, worker_store

#: Most id pairs that are looked up in the workers; others are joined.
FREQUENT = 1 << 20
#: Most bytes, about, of remembered alignments in a worker.
BYTES_KEPT = 96 << 20
#: About what an alignment costs beside its strings.
ENTRY_BYTES = 380
#: Characters of text aligned at a time (a longer text is taken alone).
CHARS_AT_ONCE = 1 << 20
#: Pairs counted in a task before they are merged, and sent on.
PAIRS_HELD = 1 << 22
LINKED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "pairs binary, times binary")


def groups_of(end_a: np.ndarray, end_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """The numbers (from 0, in order) of the groups of the A and B tokens that
    cover the same bytes, by their bounds."""
    n = len(end_a)
    # the farthest-right overlapping token: the other side's last that starts before the end
    right_of_a = np.searchsorted(start_b, end_a) - 1 + n
    right_of_b = np.searchsorted(start_a, end_b) - 1
    last = end_a[right_of_b] == end_b
    successor = np.concatenate([right_of_a, np.where(last, np.arange(len(end_b)) + n, right_of_b)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    number = np.cumsum(last) - 1  # of the group that a terminal B token ends
    label = number[successor - n]
    return label[:n], label[n:]


class Aligner:
    """Links and groups of texts in a worker. ``a`` is the file of a byte-level
    vocabulary, ``b`` that of a piece vocabulary with byte fallback."""

    def __init__(self, a: str, b: str):
        import re

        import public_tokenizers
        import sentencepiece
        import tiktoken

        ranks, _ = byte_level(a)
        self.encode_a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={}).encode_ordinary
        pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        self.encode_b = lambda texts: pieces.encode(texts, num_threads=1)
        # bytes of each id's token
        byte = re.compile(r"<0x([0-9A-F]{2})>").fullmatch
        size_a = max(ranks.values()) + 1
        if max(size_a, pieces.vocab_size()) > 1 << 16:
            raise ValueError("an id pair is two 16-bit numbers")
        self.bytes_b = []
        for i in range(pieces.vocab_size()):
            raw = byte(pieces.id_to_piece(i)) if pieces.is_byte(i) else None
            self.bytes_b.append(bytes([int(raw[1], 16)]) if raw else
                                pieces.id_to_piece(i).replace("▁", " ").encode())
        self.length_a = np.zeros(size_a, np.int64)
        self.length_a[list(ranks.values())] = [len(t) for t in ranks]
        self.length_b = np.array([len(t) for t in self.bytes_b])
        # the text of a token in the list of groups, by what follows it
        self.signs = [b"%d%c" % (i, sign) for sign in b",|;" for i in range(1 << 16)]
        self.sign_length = np.array([len(s) for s in self.signs])
        self.whole = re.compile(r"\s |^ | $").search
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0

    def align(self, chunks: list[str]) -> list[tuple | None]:
        """For each text (a space goes before it): its groups, its linked id
        pairs, and the numbers of its A and B tokens; None where the tokens
        are not the text's bytes."""
        with_space = [(" " + c).encode("utf-8", "replace") for c in chunks]
        a = [self.encode_a(" " + c) for c in chunks]
        b = self.encode_b(chunks)
        joined = [b"".join(map(self.bytes_b.__getitem__, own)) for own in b]
        good = [k for k, (x, y) in enumerate(zip(joined, with_space)) if x == y]
        out: list[tuple | None] = [None] * len(chunks)
        if not good:
            return out
        count_a, count_b = (np.array([len(x[k]) for k in good]) for x in (a, b))
        id_a = np.fromiter((i for k in good for i in a[k]), np.int64, count_a.sum())
        id_b = np.fromiter((i for k in good for i in b[k]), np.int64, count_b.sum())
        end_a, end_b = np.cumsum(self.length_a[id_a]), np.cumsum(self.length_b[id_b])
        start_a, start_b = end_a - self.length_a[id_a], end_b - self.length_b[id_b]
        group_a, group_b = groups_of(end_a, end_b, start_a, start_b)
        # links of an A token: the B tokens from the first that ends after its start on
        first = np.searchsorted(end_b, start_a, side="right")
        links = np.searchsorted(start_b, end_a) - first
        at = np.cumsum(links) - links
        partner = np.repeat(first - at, links) + np.arange(links.sum())
        pairs = (np.repeat(id_a, links) << 16 | id_b[partner]).astype("<u4").tobytes()
        # the list of groups: A tokens of a group, then its B tokens
        group = np.concatenate([group_a, group_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        is_b = order >= len(id_a)
        ids, side = np.concatenate([id_a, id_b])[order], 2 * group[order] + is_b
        ends = np.append(side[1:] != side[:-1], True)
        sign = np.where(ends, 1 + is_b, 0) * (1 << 16) + ids
        text = b"".join(map(self.signs.__getitem__, sign.tolist()))
        upto = np.cumsum(self.sign_length[sign])
        cut_text = upto[np.cumsum(count_a + count_b) - 1].tolist()
        cut_pairs = (4 * np.cumsum(links)[np.cumsum(count_a) - 1]).tolist()
        last_text = last_pairs = 0
        for k, t, p, n_a, n_b in zip(good, cut_text, cut_pairs, count_a.tolist(), count_b.tolist()):
            out[k] = (text[last_text:t], pairs[last_pairs:p], n_a, n_b)
            last_text, last_pairs = t, p
        return out

    def texts(self, texts: list[str]) -> Iterator[tuple[bytes, bytes, int, int]]:
        """For each text its groups, linked pairs and numbers of tokens."""
        cut = [[t] if not t or self.whole(t) else t.split(" ") for t in texts]
        if self.held > BYTES_KEPT // 2:
            self.old, self.young, self.held = self.young, {}, 0
        young, new = self.young, []
        for c in {c for own in cut for c in own if c}:
            if c not in young:
                kept = self.old.get(c)
                if kept is None:
                    new.append(c)
                else:
                    self._keep(c, kept)
        for c, own in zip(new, self.align(new)):
            self._keep(c, own)
        for text, own in zip(texts, cut):
            found = [young[c] for c in own] if text else [None]
            if None in found:
                yield b"", b"", 0, 0
            else:
                groups, pairs, n_a, n_b = zip(*found)
                yield b"".join(groups), b"".join(pairs), sum(n_a), sum(n_b)

    def _keep(self, chunk: str, own: tuple | None) -> None:
        self.young[chunk] = own
        self.held += len(chunk) + ENTRY_BYTES + (len(own[0]) + len(own[1]) if own else 0)


def linked(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text",
           digest: bool = False) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, the list of
    groups (``digest``: its SHA-256 instead), and the different linked id
    pairs (A id, B id as one 32-bit number) with their number of links.
    ``row`` tells the rows of the table written from this apart."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        from pyspark import TaskContext

        aligner = worker_store(f"aligner_{a}_{b}", lambda: Aligner(a, b))
        row = TaskContext.get().partitionId() << 40
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()),
                            ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                            ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])

        def rows_of(ids: list, texts: list[str]) -> pa.RecordBatch:
            nonlocal row
            out = []
            for doc_id, (groups, pairs, n_a, n_b) in zip(ids, aligner.texts(texts)):
                different, times = np.unique(np.frombuffer(pairs, "<u4"), return_counts=True)
                listed = groups[:-1]
                shown = hashlib.sha256(listed).hexdigest() if digest and listed else listed.decode()
                out.append((row, doc_id, n_a, n_b, groups.count(b";"), len(pairs) // 4, shown,
                            different.tobytes(), times.astype("<u4").tobytes()))
                row += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)],
                                              schema=schema)

        for batch in batches:
            ids, texts, chars = [], [], 0
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py() or ""
                if texts and chars + len(value) > CHARS_AT_ONCE:
                    yield rows_of(ids, texts)
                    ids, texts, chars = [], [], 0
                ids.append(doc_id)
                texts.append(value)
                chars += len(value)
            if texts:
                yield rows_of(ids, texts)

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, LINKED)


def pair_counts(table: DataFrame) -> DataFrame:
    """For every linked id pair the documents that hold it, summed in the tasks
    before they are shuffled, and whether no pair of its A id has more."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def merged(pairs: list, counts: list) -> tuple[list, list]:
            different, at = np.unique(np.concatenate(pairs), return_inverse=True)
            total = np.zeros(len(different), np.int64)
            np.add.at(total, at, np.concatenate(counts))
            return [different], [total]

        def batch_of(pairs: list, counts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[0].astype(np.int64)), pa.array(counts[0])],
                                              names=["pair", "docs"])

        pairs, counts, held = [], [], 0
        for batch in batches:
            for own in batch.column(0):
                pairs.append(np.frombuffer(own.as_py(), "<u4"))
                counts.append(np.ones(len(pairs[-1]), np.int64))
                held += len(pairs[-1])
                if held > PAIRS_HELD:
                    pairs, counts = merged(pairs, counts)
                    held = len(pairs[0])
                    if held > PAIRS_HELD // 2:
                        yield batch_of(pairs, counts)
                        pairs, counts, held = [], [], 0
        if pairs:
            yield batch_of(*merged(pairs, counts))

    total = (table.select("pairs").mapInArrow(run, "pair long, docs long")
             .groupBy("pair").agg(F.sum("docs").alias("docs")))
    a = F.shiftright("pair", 16)
    # an A id has at most as many pairs as there are B ids
    return written(total.withColumn("a", a), "pairs").transform(
        lambda t: t.join(t.groupBy("a").agg(F.max("docs").alias("most")), "a")
        .select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")))


def scored(table: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``table`` (without its pairs) plus n_best, the links whose count is their
    A id's highest, and count_sum, the sum of the links' counts."""
    counts = written(counts, "counts")
    # at most ``frequent`` rows come to the driver and go to the tasks
    top = counts.orderBy(F.col("docs").desc(), "pair").limit(frequent).toArrow()
    pair = np.asarray(top.column("pair"), np.int64)
    order = np.argsort(pair)
    spread = table.sparkSession.sparkContext.broadcast(
        (pair[order], np.asarray(top.column("docs"), np.int64)[order],
         np.asarray(top.column("best")).astype(np.int64)[order]))
    names = [n for n in table.columns if n not in ("pairs", "times")]
    found = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.select(names).schema)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known, docs, best = spread.value
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            raw = [x.as_py() for x in column["pairs"]]
            own = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
            times = np.frombuffer(b"".join(x.as_py() for x in column["times"]), "<u4").astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int64)
            at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
            hit = known[at] == own if len(known) else np.zeros(len(own), bool)

            def sums(values: np.ndarray) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(values)])
                return total[bounds[1:]] - total[bounds[:-1]]

            factor = np.where(hit, times, 0)
            pick = at if len(known) else np.zeros(0, np.int64)
            n_best = sums(factor * best[pick]) if len(known) else sums(factor)
            count_sum = sums(factor * docs[pick]) if len(known) else sums(factor)
            rest = np.flatnonzero(~hit)
            offsets = pa.array(np.searchsorted(rest, bounds).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x[rest])) for x in (own, times)]
            yield pa.RecordBatch.from_arrays(
                [*(column[n] for n in names), pa.array(n_best), pa.array(count_sum), *lists],
                names=[*names, "n_best", "count_sum", "_rest", "_times"])

    head = written(table.mapInArrow(run, f"{found}, n_best long, count_sum long, _rest array<long>, "
                                         "_times array<long>"), "scored")
    rare = head.select("row", F.explode(F.arrays_zip("_rest", "_times")).alias("_p")).select(
        "row", F.col("_p._rest").alias("pair"), F.col("_p._times").alias("_n"))
    more = (rare.join(counts, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("_n")).otherwise(0)).alias("_more_best"),
                 F.sum(F.col("_n") * F.col("docs")).alias("_more_sum")))
    zero = F.lit(0).cast("long")
    return (head.drop("_rest", "_times").join(more, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("_more_best", zero))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("_more_sum", zero))
            .select(*names, "n_best", "count_sum"))


def align(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text",
          digest: bool = False, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups (with
    ``digest`` their SHA-256), n_best, count_sum."""
    table = written(linked(docs, a, b, key, text, digest), "linked")
    return scored(table, pair_counts(table), frequent).drop("row")
