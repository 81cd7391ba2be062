"""Best-fit packing of documents into sequences, by exact complements.

Documents are tokenized once (:func:`pieces`); those longer than a sequence
are cut into whole sequences and a shorter first piece. Packing is planned on
the histogram of piece lengths, which has at most as many entries as a
sequence has tokens, however large the corpus (:func:`plan`). The sums of one,
two and three lengths are indexed once (:class:`Sums`); from the longest length
down, the gap it leaves is looked up there, and every combination that fills
the gap exactly is used as often as its lengths are available. A gap without
an exact complement takes the longest length that fits, and the index is asked
again for what that leaves. The plan
says how many sequences of which lengths there are; pieces get their slots by
their rank within their length (:func:`assign`), found over hash ranges, so
that a length shared by a third of all pieces is no single task.

Where the documents come in training order, :func:`pack_in_order` keeps it: the
same plan is made for each block of consecutive pieces, of bounded size, and
the sequences are numbered block by block.

Defined results: NULL or empty texts are one end token; repeated rows are
packed each on its own; an empty table gives no rows; other columns are not
carried.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.places import place_ranges, place_rows
from statflow.operators.ordered import running_totals
from statflow.llm.tokens import encoder
from statflow.session import ensure_checkpoint_dir

SEQUENCE = 2048
#: Consecutive pieces that are packed together where order is kept.
BLOCK_PIECES = 1 << 14
END_ID = 0
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, key: str = "doc_id",
           text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per piece: its document's ids before it, length and CRC-32 of
    its ids (unsigned little-endian 32-bit), and the document's columns
    ``keep``. ``tokenizer`` is a file that every executor has."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        ids = encoder(tokenizer).ids
        end = END_ID.to_bytes(4, "little")
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int32()), ("ids_crc32", pa.int64())])
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            rows = []
            for row, (doc_id, value) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                data = ids(value.as_py() or "") + end
                n = len(data) // 4
                start, piece = 0, 0
                while start < n:
                    length = (n - start) % sequence or sequence if piece == 0 else sequence
                    crc = zlib.crc32(data[4 * start:4 * (start + length)])
                    for column, x in zip(out, (doc_id, piece, start, length, crc)):
                        column.append(x)
                    rows.append(row)
                    start, piece = start + length, piece + 1
            kept = batch.select(batch.schema.names[2:]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(out, schema.types)), *kept.columns],
                names=[*schema.names, *kept.schema.names])

    found = docs.select(F.col(key).cast("long").alias("doc_id"), text, *keep)
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in found.schema.fields[2:])
    return found.mapInArrow(run, PIECES + more)


class Sums:
    """Which combinations of one, two or three available lengths add up to a
    sum: an index from sums to combinations, made once from the lengths there
    are. Counts only fall, so a combination that has run out never returns: every
    list is walked once, by a mark that only moves on."""

    def __init__(self, free: np.ndarray):
        self.free = free
        there = np.flatnonzero(free)
        largest = len(free) - 1
        # sum -> the smaller lengths of its pairs; sum -> the largest lengths of
        # its triples (whose rest is a pair)
        self.pairs: dict[int, list[int]] = defaultdict(list)
        for low in there.tolist():
            partners = there[(there >= low) & (there <= largest - low)]
            for s in (partners + low).tolist():
                self.pairs[s].append(low)
        self.triples: dict[int, list[int]] = defaultdict(list)
        sums = np.array(sorted(self.pairs), np.int64)
        for x in there[::-1].tolist():
            for s in sums[(sums <= 2 * x) & (sums <= largest - x)].tolist():
                self.triples[s + x].append(x)
        self.pair_mark: dict[int, int] = defaultdict(int)
        self.triple_mark: dict[int, int] = defaultdict(int)

    def pair(self, s: int, beside: int = 0) -> tuple[int, int] | None:
        """Two lengths with the sum ``s``, ``beside`` being used once already."""
        own, k = self.pairs.get(s, ()), self.pair_mark[s]
        gone = True
        while k < len(own):
            low, high = own[k], s - own[k]
            if self.free[low] > (low == high) and self.free[high] > 0:
                gone = False
                if beside not in (low, high) or self.free[beside] > 1 + (low == high):
                    return high, low
            k += 1
            if gone:
                self.pair_mark[s] = k
        return None

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """A combination that fills ``gap`` exactly, of as few lengths as
        possible."""
        if self.free[gap] > 0:
            return (gap,)
        two = self.pair(gap)
        if two:
            return two
        own, k = self.triples.get(gap, ()), self.triple_mark[gap]
        while k < len(own):
            x = own[k]
            two = self.pair(gap - x, x) if self.free[x] > 0 else None
            self.triple_mark[gap] = k
            if two:
                return (x, *two)
            k += 1
        self.triple_mark[gap] = k
        return None


def plan(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, number of such sequences)."""
    free = np.zeros(sequence + 1, dtype=np.int64)
    for length, n in counts.items():
        free[length] += n
    done = [((sequence,), int(free[sequence]))] if free[sequence] else []
    free[sequence] = 0
    index = Sums(free)
    for a in range(sequence - 1, 0, -1):
        while free[a] > 0:
            free[a] -= 1
            rest: list[int] = []
            gap = sequence - a
            while gap:
                found = index.complement(gap)
                # else the longest that fits, and the sums for what it leaves
                fits = np.flatnonzero(free[:gap + 1])
                if found is None and len(fits):
                    found = (int(fits[-1]),)
                if found is None:
                    break
                for x in found:
                    free[x] -= 1
                rest += found
                gap -= sum(found)
            for x in (a, *rest):
                free[x] += 1
            lengths = (a, *rest)
            copies = min(int(free[x]) // lengths.count(x) for x in set(lengths))
            for x in lengths:
                free[x] -= copies
            done.append((lengths, copies))
    return done


def assign(cut: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``cut`` (rows with a ``length`` up to ``sequence``) plus sequence_id and
    offset."""
    spark = cut.sparkSession
    keys = [c for c in ("doc_id", "piece", "ids_crc32") if c in cut.columns]
    marked, ranges = place_ranges(cut, ["length"], F.xxhash64(*keys), F.lit(1))
    # at most one row per length comes to the driver
    counts = {r["length"]: r["n"] for r in
              ranges.groupBy("length").agg(F.sum("_range_total").alias("n")).collect()}
    slots, ranked, base = [], defaultdict(int), 0
    for lengths, copies in plan(counts, sequence):
        offset = 0
        for x in lengths:
            slots.append((x, ranked[x], ranked[x] + copies, base - ranked[x], offset))
            ranked[x] += copies
            offset += x
        base += copies
    table = spark.createDataFrame(
        slots, "length int, _first long, _last long, _base long, offset long")
    placed = place_rows(marked, ranges, ["length"], keys, F.lit(1), "_rank")
    # the plan's size is bounded by the lengths there are, not by the corpus
    return (placed.join(F.broadcast(table), (placed["length"] == table["length"])
                        & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_last")))
            .withColumn("sequence_id", F.col("_base") + F.col("_rank"))
            .select(*[placed[c] for c in cut.columns], "sequence_id", "offset"))


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """The packed pieces of ``docs``: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    ensure_checkpoint_dir(docs.sparkSession)
    cut = pieces(docs, tokenizer, sequence, key, text).checkpoint()  # texts are tokenized once
    return assign(cut, sequence)


def pack_in_order(docs: DataFrame, tokenizer: str, order: Sequence[str], sequence: int = SEQUENCE,
                  key: str = "doc_id", text: str = "text", block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """As :func:`pack`, but sequences follow the documents' ``order`` (columns
    that together are unique): pieces are packed with those near them, and
    sequence_id grows with the first of a sequence's pieces within a block, and
    from block to block. ``take`` is the document's place in the order, which
    tells several takes of one document apart."""
    ensure_checkpoint_dir(docs.sparkSession)
    named = docs.select(key, text, *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)])
    names = [f"_order{i}" for i in range(len(order))]
    cut = pieces(named, tokenizer, sequence, key, text, names).checkpoint()
    first = F.when(F.col("piece") == 0, 1).otherwise(0)
    placed = (running_totals(cut, [*map(F.col, names), F.col("piece")], {"_rank": F.lit(1), "take": first})
              .withColumn("take", (F.col("take") - 1 + first).cast("long"))
              .withColumn("_block", F.floor(F.col("_rank") / block_pieces)))

    def run(group):
        group = group.sort_values("_rank", ignore_index=True)
        by_length = {n: own.tolist() for n, own in group.groupby("length").indices.items()}
        own = []
        for lengths, copies in plan({n: len(rows) for n, rows in by_length.items()}, sequence):
            for _ in range(copies):
                # the earliest pieces of a length are used first
                own.append([by_length[n].pop(0) for n in lengths])
        at = np.zeros((len(group), 2), np.int64)
        for number, rows in enumerate(sorted(own, key=min)):
            offset = 0
            for row in sorted(rows):
                at[row] = number, offset
                offset += int(group["length"][row])
        group["sequence_id"] = group["_block"] * (1 << 20) + at[:, 0]
        group["offset"] = at[:, 1]
        return group[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "take"]]

    return placed.groupBy("_block").applyInPandas(run, f"{PIECES}, sequence_id long, offset long, take long")
