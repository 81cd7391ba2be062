"""Hierarchical packing of documents into windows of several context sizes.

Documents are tokenized once and cut into pieces of the longest window at most
(:func:`pieces`). A piece belongs to the tier of the smallest window that holds
it. The tiers are packed from the longest window down, on the histogram of
piece lengths, which has at most as many entries as a window has tokens,
however large the corpus (:func:`plan`): the longest piece left opens a window,
and what it leaves is filled with pieces of shorter tiers, exactly by one or by
two of them where that is possible, else longest first; what then remains is
cut from the longest piece left, whose rest is packed as a piece of its own.
So every window is full, but for one at the end.

The windows of a tier are numbered by falling attention cost (the sum of the
squared piece lengths) and dealt to training steps in serpentine order: the
steps of a tier have equally many windows (one more or less), the same number of
tokens and nearly the same cost.

The plan is a list of ranges of ranks: pieces of one length are exchangeable,
and a piece finds its window by its rank within its length, counted over hash
ranges (a length that a third of all pieces have is no single task). Ids travel
only with pieces whose length has cuts in the plan.

Defined results: NULL or empty texts are one end token; repeated rows are
packed each on its own; a NULL id stays NULL; an empty table gives no rows;
other columns, whatever their names, are not carried.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.places import place_ranges, place_rows
from statflow.llm.store import written
from statflow.llm.tokens import word_encoder

#: Context sizes, powers of two, longest first.
TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Tokens of a training step: 16 of the longest windows, 128 of the shortest.
STEP_TOKENS = 1 << 15
#: Shortest piece worth cutting off, where there is a choice.
LEAST_CUT = 32
#: Texts of about so many characters are one batch of rows on the way out.
BATCH_CHARS = 1 << 22
PIECES = "doc_id long, doc_tokens long, start long, length int, ids_crc32 long, ids binary"
PLACED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long")


def pieces(docs: DataFrame, tokenizer: str, window: int = TIERS[0], key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per piece of at most ``window`` tokens, with its ids as
    little-endian 16-bit numbers. ``tokenizer`` is a file that every executor
    has."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        ids = word_encoder(tokenizer).ids
        end = END_ID.to_bytes(2, "little")
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        names = ("doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids")

        def batch_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, types)], names)

        for batch in batches:
            out, chars = [], 0
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py() or ""
                data = ids(value) + end
                n = len(data) // 2
                wide = np.frombuffer(data, "<u2").astype("<u4")
                for start in range(0, n, window):
                    own = wide[start:start + window]
                    out.append((doc_id, n, start, len(own), zlib.crc32(own),
                                data[2 * start:2 * (start + window)]))
                chars += len(value)
                if chars > BATCH_CHARS:
                    yield batch_of(out)
                    out, chars = [], 0
            yield batch_of(out)

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, PIECES)


class Pool:
    """What is left of every length: runs of (origin, first rank, count, from),
    the pieces or rests of pieces of that length. Origin is the length of the
    whole piece, from the number of its tokens packed before."""

    def __init__(self, counts: dict[int, int], longest: int):
        self.free = np.zeros(longest + 1, np.int64)
        self.runs = [deque() for _ in range(longest + 1)]
        for length, n in counts.items():
            self.put(length, [(length, 0, n, 0)])

    def put(self, length: int, runs: list[tuple[int, int, int, int]]) -> None:
        if length:
            self.runs[length].extend(runs)
            self.free[length] += sum(r[2] for r in runs)

    def take(self, length: int, copies: int) -> list[tuple[int, int, int, int]]:
        self.free[length] -= copies
        out, own = [], self.runs[length]
        while copies:
            origin, first, n, at = own.popleft()
            used = min(n, copies)
            out.append((origin, first, used, at))
            if n > used:
                own.appendleft((origin, first + used, n - used, at))
            copies -= used
        return out

    def tokens(self) -> int:
        return int((self.free * np.arange(len(self.free))).sum())


def _fill(free: np.ndarray, gap: int) -> tuple[list[int], int]:
    """Whole pieces for ``gap`` and what they leave of it; ``free`` is used up
    by them."""
    out: list[int] = []
    while gap:
        if free[gap] > 0:
            out.append(gap)
            free[gap] -= 1
            return out, 0
        low = np.arange(1, gap // 2 + 1)
        fits = (free[low] > 0) & (free[gap - low] > (low == gap - low))
        if fits.any():
            x = int(low[fits.argmax()])
            free[x] -= 1
            free[gap - x] -= 1
            return [*out, gap - x, x], 0
        # the longest that leaves room for a piece worth cutting off, if one is
        # left that is long enough to cut
        room = gap - LEAST_CUT if free[gap:].any() else gap
        fitting = np.flatnonzero(free[:max(room, 0) + 1])
        if not len(fitting) or fitting[-1] == 0:
            return out, gap
        out.append(int(fitting[-1]))
        free[fitting[-1]] -= 1
        gap -= int(fitting[-1])
    return out, 0


def plan(counts: dict[int, int], tiers: tuple[int, ...] = TIERS,
         step_tokens: int = STEP_TOKENS) -> np.ndarray:
    """The slots of all pieces, one row per range of ranks: origin, from,
    first, last (rank), length (tokens that go here), sequence (of the first
    rank), offset, tier, step base, steps, place (of the first rank's window in
    its tier)."""
    pool = Pool(counts, tiers[0])
    windows = []  # (tier, cost, copies, [(offset, length, runs)])

    def close(tier: int, lengths: list[int], cut: int) -> None:
        """As many windows as there are pieces for: ``lengths`` whole, and
        ``cut`` tokens of the longest piece left."""
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        donor = 0
        if cut:
            rest = pool.free.copy()
            for x, n in need.items():
                rest[x] -= n
            donor = int(np.flatnonzero(rest > 0)[-1])
            need[donor] = need.get(donor, 0) + 1
        copies = min(int(pool.free[x]) // n for x, n in need.items())
        members, offset = [], 0
        for x in lengths:
            members.append((offset, x, pool.take(x, copies)))
            offset += x
        if cut:
            runs = pool.take(donor, copies)
            members.append((offset, cut, runs))
            pool.put(donor - cut, [(o, f, n, at + cut) for o, f, n, at in runs])
        windows.append((tier, sum(m[1] ** 2 for m in members), copies, members))

    for tier in tiers:
        low = tier // 2 if tier != tiers[-1] else 0
        while pool.free.any() and pool.tokens() >= tier:
            longest = int(np.flatnonzero(pool.free)[-1])
            if longest <= low:
                break
            if longest > tier:
                close(tier, [], tier)
                continue
            free = pool.free.copy()
            free[longest] -= 1
            lengths, gap = _fill(free, tier - longest)
            close(tier, [longest, *lengths], gap)
    while pool.free.any():  # less than the shortest window is left
        lengths = [int(x) for x in np.flatnonzero(pool.free)[::-1] for _ in range(int(pool.free[x]))]
        close(tiers[-1], lengths, 0)

    rows, base, steps_base = [], 0, 0
    for tier in tiers:
        own = sorted((w for w in windows if w[0] == tier), key=lambda w: -w[1])
        total = sum(w[2] for w in own)
        steps = -(-total // max(1, step_tokens // tier))
        at = 0
        for _, _, copies, members in own:
            for offset, length, runs in members:
                done = 0
                for origin, first, n, begin in runs:
                    rows.append((origin, begin, first, first + n, length, base + at + done, offset, tier,
                                 steps_base, steps, at + done))
                    done += n
            at += copies
        base, steps_base = base + total, steps_base + steps
    return np.array(sorted(rows), np.int64).reshape(-1, 11)


def _runs_of(slots: np.ndarray):
    """For pieces of given length and rank, all their slots, vectorised: each
    (row of the piece, slot)."""
    at = slots[:, 0] * 4096 + slots[:, 1]
    groups, first = np.unique(at, return_index=True)
    keys = np.searchsorted(groups, at) * (1 << 42) + slots[:, 2]

    def find(length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rows, begin = np.arange(len(length)), np.zeros(len(length), np.int64)
        while len(rows):
            group = np.searchsorted(groups, length[rows] * 4096 + begin)
            slot = np.searchsorted(keys, group * (1 << 42) + rank[rows], side="right") - 1
            yield rows, slot
            begin = begin + slots[slot, 4]
            more = begin < length[rows]
            rows, begin = rows[more], begin[more]

    return find


def place(ranked: DataFrame, slots: np.ndarray) -> DataFrame:
    """The pieces at their places, cut where the plan says so. ``slots`` goes
    to every task; its size is bounded by the number of lengths."""
    spread = ranked.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        table = spread.value
        find = _runs_of(table)
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, rank, start, crc, tokens = (
                np.asarray(column[n].to_numpy(zero_copy_only=False), np.int64)
                for n in ("length", "_rank", "start", "ids_crc32", "doc_tokens"))
            ids = column["ids"]
            for rows, slot in find(length, rank):
                s = table[slot]
                own = crc[rows].copy()
                for k in np.flatnonzero(s[:, 4] < length[rows]):
                    data = np.frombuffer(ids[int(rows[k])].as_py(), "<u2")
                    own[k] = zlib.crc32(data[s[k, 1]:s[k, 1] + s[k, 4]].astype("<u4"))
                shift = rank[rows] - s[:, 2]
                steps, place = s[:, 9], s[:, 10] + shift
                turn, step = place // steps, place % steps
                group = s[:, 8] + np.where(turn % 2 == 0, step, steps - 1 - step)
                yield pa.RecordBatch.from_arrays(
                    [column["doc_id"].take(pa.array(rows)),
                     *(pa.array(x) for x in (start[rows] + s[:, 1], s[:, 4], own, tokens[rows],
                                             s[:, 5] + shift, s[:, 6], s[:, 7].astype(np.int32), group))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                           "offset", "tier", "step_group"])

    return ranked.select("doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids", "_rank") \
        .mapInArrow(run, PLACED)


def assign(cut: DataFrame, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """The places of the pieces ``cut`` (a table that reads the same every
    time)."""
    keys = ["doc_id", "start", "ids_crc32"]
    order = F.xxhash64(*keys)
    _, ranges = place_ranges(cut.drop("ids"), ["length"], order, F.lit(1))
    # at most one row per length comes to the driver
    counts = {r["length"]: r["n"] for r in
              ranges.groupBy("length").agg(F.sum("_range_total").alias("n")).collect()}
    slots = plan(counts, tiers, step_tokens)
    cuts = sorted({int(x) for x in slots[slots[:, 4] < slots[:, 0], 0]})
    light = cut.withColumn("ids", F.when(F.col("length").isin(cuts), F.col("ids")))
    marked, _ = place_ranges(light, ["length"], order, F.lit(1), totals=False)
    return place(place_rows(marked, ranges, ["length"], keys, F.lit(1), "_rank"), slots)


def pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS,
         step_tokens: int = STEP_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The packed pieces of ``docs``: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, tier, step_group."""
    return assign(written(pieces(docs, tokenizer, tiers[0], key, text), "tiers"), tiers, step_tokens)
