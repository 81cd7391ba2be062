"""Ranked lexical search by presence masks.

Terms are the longest runs of ASCII letters, digits and other characters than
ASCII, in whole texts, with A-Z lower-cased. Items are taken in blocks of a
bounded number of terms (:func:`item_blocks`); a block's terms, weights and
items go to every task. For a block all documents are read once
(:func:`matched`): each is reduced to its number of terms and the places and
frequencies of those that the block's items ask for, and written. The counts
that the weights need (documents N, terms L, documents per term) are sums over
that table.

Scoring (:func:`best`) works on groups of documents. Every term has a bitmap of
the documents that hold it; an item's bitmaps, turned, give each document's
mask, the set of the item's terms that it holds, and documents with equal masks
are one group. No document of a group can score more than the weights of its
mask, each times the term's largest contribution among the documents at hand.
Masks are evaluated by falling maximum until the k-th best score found so far in
the task is above all that is left, so nothing is missed. Each task keeps its k
best of every item, which are merged in two steps (by item and part, by item).

Terms are found by a 64-bit hash and then compared byte by byte.

Defined results: documents without terms (NULL, empty, signs only) count
nowhere and are found by no item; every row is a document of its own, also with
a repeated or NULL id (NULL first among equal scores); an item_id that stands
several times asks for the terms of all its texts, once each; items without
terms, or whose documents all score 0, have no rows; empty tables give no rows;
other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.store import written
from statflow.llm.wordhash import IS_PUNCTUATION, LOWER, Block, blocks
from statflow.operators.ordered import running_totals

#: Terms of the items of one block (an item with more is a block alone).
BLOCK_TERMS = 1 << 16
#: Documents of a group, and cells (documents x terms of an item) at most.
GROUP_ROWS = 1 << 13
GROUP_CELLS = 1 << 25
#: Parts in which an item's candidates are merged first.
PARTS = 64
#: Fixed values of the score.
SCALE, B_PERCENT = 1_000_000_000, 90
MATCHED = "doc_id long, n long, places binary, counts binary"
FOUND = "item int, doc_id long, score long, part int"


def _terms(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, number of each text's first term, and hashes."""
    starts, ends, first = block.words(IS_PUNCTUATION)
    return starts, ends, first, block.hashes(block.rolled(), starts, ends)


def terms_of(text: str) -> list[bytes]:
    """The different terms of one text, in UTF-8, in order of appearance."""
    import pyarrow as pa

    out: dict[bytes, None] = {}
    for block in blocks(pa.array([text])):
        starts, ends, _, _ = _terms(block)
        data = LOWER[block.data].tobytes()
        out.update((data[a:b], None) for a, b in zip(starts, ends))
    return list(out)


def item_blocks(items: DataFrame, key: str = "item_id", text: str = "text",
                block_terms: int = BLOCK_TERMS) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items as (id, terms), in blocks of bounded size: a block is what
    the driver holds at a time."""
    letters = F.regexp_count(F.col(text), F.lit("[0-9A-Za-z\\x80-\\x{10FFFF}]+"))
    sized = items.select(F.col(key).alias("_key"), F.col(text).alias("_text"),
                         F.coalesce(letters, F.lit(0)).cast("long").alias("_n"))
    whole = sized.groupBy("_key").agg(F.sum("_n").alias("_n"))
    numbered = running_totals(whole, [F.col("_key")], {"_before": F.col("_n")})
    blocked = written(numbered.select(F.col("_key").alias("_id"),
                                      F.floor(F.col("_before") / block_terms).alias("_block")), "items")
    for (b,) in blocked.select("_block").distinct().sort("_block").collect():
        own = blocked.filter(F.col("_block") == b)
        rows = sized.join(own, F.col("_key").eqNullSafe(F.col("_id"))).select("_key", "_text").collect()
        found: dict[object, dict[bytes, None]] = {}
        for r in sorted(rows, key=lambda r: (r["_key"] is not None, r["_key"] or 0, r["_text"] or "")):
            found.setdefault(r["_key"], {}).update(dict.fromkeys(terms_of(r["_text"] or "")))
        yield [(k, list(v)) for k, v in found.items() if v]


class Vocabulary:
    """The terms of a block of items, numbered, found by hash and then compared
    by their bytes."""

    def __init__(self, terms: list[bytes]):
        self.bytes = np.frombuffer(b"".join(terms), np.uint8)
        self.ends = np.cumsum([len(t) for t in terms])
        self.lengths = np.array([len(t) for t in terms])
        bounds = np.concatenate([[0], self.ends])
        block = Block(self.bytes, bounds, 0, len(terms))
        hashes = block.hashes(block.rolled(), bounds[:-1], self.ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences that are terms: their places in ``starts``, and the
        numbers of the terms."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        where = np.flatnonzero(self.hashes[at] == hashes)
        term = self.order[at[where]]
        # compared by length, all occurrences of one length at once
        same = (ends - starts)[where] == self.lengths[term]
        where, term = where[same], term[same]
        equal = np.ones(len(where), bool)
        for n in np.unique(self.lengths[term]):
            rows = np.flatnonzero(self.lengths[term] == n)
            span = np.arange(n)
            equal[rows] = (LOWER[data[starts[where[rows], None] + span]]
                           == self.bytes[(self.ends[term[rows]] - n)[:, None] + span]).all(axis=1)
        return where[equal], term[equal]


def matched(docs: DataFrame, terms: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's number of terms, and which of ``terms`` it holds how
    often (two lists of little-endian 32-bit numbers)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        vocabulary = Vocabulary(terms)
        for batch in batches:
            for block in blocks(batch.column(1)):
                starts, ends, first, hashes = _terms(block)
                where, term = vocabulary.find(block.data, starts, ends, hashes)
                text_of = np.searchsorted(first, where, side="right") - 1
                pairs, tf = np.unique(text_of * len(terms) + term, return_counts=True)
                cuts = np.searchsorted(pairs // len(terms), np.arange(block.hi - block.lo + 1))
                places, counts = (pairs % len(terms)).astype("<u4"), tf.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.lo, block.hi - block.lo), pa.array(np.diff(first)),
                     pa.array([places[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                     pa.array([counts[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                    names=["doc_id", "n", "places", "counts"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, MATCHED)


def document_counts(table: DataFrame, n_terms: int) -> np.ndarray:
    """For each term the documents that hold it: summed in every task, then
    over the tasks (as many rows as a block has terms come to the driver)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for places in batch.column(0):
                total[np.frombuffer(places.as_py(), "<u4")] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in (table.select("places").mapInArrow(run, "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):
        out[r["term"]] = r["df"]
    return out


class Best:
    """The k best (score, document) of one item so far in a task."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.null = k, *(np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def floor(self) -> int:
        """The k-th best score; what scores less is out."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = (np.concatenate(x) for x in
                            ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, ~null, -score))[:self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def _group(item_rows: np.ndarray, maps: np.ndarray, n_docs: int, bound: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents by mask: the documents that hold any term, sorted by falling
    maximum of their mask; the start of every mask's run; the maxima of the
    masks. ``maps`` are the terms' bitmaps, ``bound`` a term's most."""
    own = maps[item_rows]
    any_term = np.bitwise_or.reduce(own, axis=0)
    docs = np.flatnonzero(np.unpackbits(any_term, count=n_docs))
    bits = np.unpackbits(own, axis=1, count=n_docs)[:, docs].T
    masks = np.packbits(bits, axis=1)
    wide = np.zeros((len(docs), -(-masks.shape[1] // 8) * 8), np.uint8)
    wide[:, :masks.shape[1]] = masks
    words = wide.view(np.uint64)
    most = (bits.astype(np.float64) @ bound.astype(np.float64)).astype(np.int64)  # exact below 2^53
    order = np.lexsort((*words.T, -most))
    words, most = words[order], most[order]
    new = np.ones(len(docs), bool)
    new[1:] = (words[1:] != words[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return docs[order], starts, most[starts]


def best(table: DataFrame, items: list[tuple[object, list[int]]], weights: np.ndarray, n_docs: int,
         n_all: int, k: int) -> DataFrame:
    """Each task's k best documents of every item: item (number), doc_id,
    score, part."""
    shared = table.sparkSession.sparkContext.broadcast(
        ([np.array(sorted(t), np.int64) for _, t in items], weights))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        asked, weight = shared.value
        found = [Best(k) for _ in asked]
        widest = max(map(len, asked), default=1)
        rows = max(8, min(GROUP_ROWS, GROUP_CELLS // widest))
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                _search(batch.slice(lo, rows), asked, weight, found, n_docs, n_all)
        part = TaskContext.get().partitionId() % PARTS
        sizes = [len(f.score) for f in found]
        doc = np.concatenate([f.doc for f in found] or [np.zeros(0, np.int64)])
        null = np.concatenate([f.null for f in found] or [np.zeros(0, bool)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(found), dtype=np.int32), sizes)), pa.array(doc, mask=null),
             pa.array(np.concatenate([f.score for f in found] or [np.zeros(0, np.int64)])),
             pa.array(np.full(len(doc), part, np.int32))],
            names=["item", "doc_id", "score", "part"])

    return table.mapInArrow(run, FOUND)


def _search(batch, asked: list[np.ndarray], weight: np.ndarray, found: list[Best], n_docs: int,
            n_all: int) -> tuple[int, int]:
    """One group of documents against all items. Returns how many masks there
    were and how many of them were evaluated."""
    import pyarrow.compute as pc

    ids = batch.column(0)
    null = np.asarray(pc.is_null(ids).to_numpy(zero_copy_only=False), bool)
    doc = np.asarray(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), np.int64)
    n = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    places = [x.as_py() for x in batch.column(2)]
    sizes = np.array([len(x) // 4 for x in places])
    term = np.frombuffer(b"".join(places), "<u4").astype(np.int64)
    tf = np.frombuffer(b"".join(x.as_py() for x in batch.column(3)), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(n)), sizes)
    m = 100 - B_PERCENT + B_PERCENT * n * n_docs // max(n_all, 1)
    part = SCALE * tf // (1000 * tf + 8 * m[row]) * weight[term]  # a term's share of a document's score
    used, number = np.unique(term, return_inverse=True)  # terms that stand here, numbered anew
    most = np.zeros(len(used), np.int64)
    np.maximum.at(most, number, part)
    width = -(-len(n) // 8)
    maps = np.zeros(len(used) * width, np.uint8)
    np.bitwise_or.at(maps, number * width + row // 8, (128 >> (row % 8)).astype(np.uint8))
    maps = maps.reshape(len(used), width)
    first = np.concatenate([[0], np.cumsum(sizes)])
    masks = evaluated = 0
    local = np.full(len(weight), -1, np.int64)
    local[used] = np.arange(len(used))
    wanted = np.zeros(len(used) + 1, np.int64)
    for terms, own in zip(asked, found):
        here = local[terms]
        here = here[here >= 0]
        if not len(here) or int(most[here].sum()) < own.floor():
            continue
        docs, starts, bounds = _group(here, maps, len(n), most[here])
        masks += len(starts)
        ends = np.append(starts[1:], len(docs))
        wanted[here] = 1
        at, step = 0, 16
        while at < len(starts) and bounds[at] >= own.floor():
            upto = min(at + step, int(np.searchsorted(-bounds, -own.floor(), side="right")))
            chosen = docs[starts[at]:ends[upto - 1]]
            # the postings of the chosen documents, end to end
            count = sizes[chosen]
            cells = np.repeat(first[chosen] - np.cumsum(count) + count, count) + np.arange(count.sum())
            value = np.bincount(np.repeat(np.arange(len(chosen)), count),
                                part[cells] * wanted[number[cells]], len(chosen)).astype(np.int64)
            some = value >= own.floor()
            own.add(value[some], doc[chosen[some]], null[chosen[some]])
            evaluated += upto - at
            at, step = upto, step * 2
        wanted[here] = 0
    return masks, evaluated


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Each item's k highest-scoring documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in item_blocks(items, item_key, item_text, block_terms):
        terms = sorted({t for _, own in block for t in own})
        number = {t: i for i, t in enumerate(terms)}
        table = written(matched(docs, terms, key, text), "matched")
        sums = table.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"),
                         F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = document_counts(table, len(terms))
        weights = np.array([math.floor(1000 * math.log((2 * sums["docs"] + 2) / (2 * int(d) + 1))) for d in df],
                           np.int64)
        asked = [(i, [number[t] for t in own]) for i, own in block]
        found = best(table, asked, weights, sums["docs"], sums["terms"], k)
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], "item int, item_id long")
        for keys in (["item", "part"], ["item"]):
            order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
            found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        # a block's items are bounded by its terms
        out = out.unionByName(found.join(F.broadcast(names), "item")
                              .select("item_id", "rank", "doc_id", "score"))
    return out
