"""N-gram Jaccard join with set-relation skipping.

Documents are sets of 5-word shingles. Equal sets are one class, and classes
meet in the lists of an inverted index over their prefixes: the rarest quarter
of a set, of which similar sets must share tokens. "Rare" is told by a sketch,
one array of counters over all shingles of the corpus; any order of tokens is
right, this one keeps lists short.

* Block skipping: a list is cut into blocks by set size and by the token's
  position in its set. Blocks whose sizes or positions leave too small an
  overlap are skipped as a whole. Pairs must then share enough prefix tokens,
  counted over all lists, before their sets are compared.
* Answer skipping: classes in long lists are cut into blocks and counted
  against each other block by block. Each is first compared with the few
  partners that share most of its prefix; sets in one component after that
  have their pairs answered, and only pairs across components are left, so
  that a large group of near copies costs a few comparisons per member.

Sets that take part in a comparison are made again from their texts, found by
a bit array of fixed size (whose false hits an exact join removes), so whole
sets are never shuffled for documents without candidates.

Defined results: NULL, empty and blank texts have no shingles, are linked with
nothing and are their own component; texts of fewer words are one shingle;
repeated rows are members of one class; NULL ids belong to their class but do
not name it; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statflow.llm.components import components
from statflow.llm.shingles import shingle_sets
from statflow.llm.wordhash import blocks, mix
from statflow.session import ensure_checkpoint_dir

#: Similar: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Counters of the sketch, and per row of it on its way.
SKETCH = 1 << 21
CHUNK = 1 << 16
#: Tokens so much more frequent than the sketch's noise have long lists.
LONG_LEVEL = 7
#: Classes of long lists per block; partners a class is first compared with, per
#: pair of blocks.
BLOCK = 512
LIKELIEST = 4
#: Bits of the array that finds texts whose sets are needed, at most.
FIND_BITS = 1 << 24


def prefix_size(n: np.ndarray | int):
    """Tokens of a set of which a similar set must have one."""
    return n - (-(-PERCENT * n // 100)) + 1


def overlap_needed(a: Column, b: Column) -> Column:
    """Least intersection of similar sets of sizes a and b."""
    return F.ceil((a + b) * PERCENT / (100 + PERCENT) - 1e-9)


def _chunk(chunk: int, values: np.ndarray):
    """One row of the sketch on its way: 16-bit counters where they suffice."""
    import pyarrow as pa
    from pyspark import TaskContext

    small = values.max(initial=0) < 1 << 16
    part = TaskContext.get().partitionId() % 64
    data = zlib.compress(values.astype(np.uint16 if small else np.int64).tobytes(), 1)
    return pa.record_batch([pa.array([chunk], pa.int32()), pa.array([part], pa.int32()),
                            pa.array([data], pa.binary())], names=["chunk", "part", "data"])


def _counters(data: bytes) -> np.ndarray:
    data = zlib.decompress(data)
    return np.frombuffer(data, np.uint16 if len(data) == 2 * CHUNK else np.int64)


def sketch(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Level of each bucket of tokens: 0 for buckets as full as by chance, else
    1 + log2 of what they have above. Counters are added up in two steps; only
    the array itself, of fixed size, comes to the driver."""

    def count(batches: Iterator) -> Iterator:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                tokens = np.concatenate([*shingle_sets(block), np.zeros(0, np.uint64)])
                total += np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        for chunk in range(SKETCH // CHUNK):
            yield _chunk(chunk, total[chunk * CHUNK:(chunk + 1) * CHUNK])

    def add(batches: Iterator) -> Iterator:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + _counters(data).astype(np.int64)
        for chunk, values in sums.items():
            yield _chunk(chunk, values)

    schema = "chunk int, part int, data binary"
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = docs.select(text).mapInArrow(count, schema)
    some = parts.repartition(n, "chunk", "part").mapInArrow(add, schema)
    whole = some.repartition(n, "chunk").mapInArrow(add, schema)
    total = np.zeros(SKETCH, np.int64)
    for row in whole.collect():
        total[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] += _counters(row["data"])
    noise = total.mean() + 3 * np.sqrt(total.mean())
    return np.where(total > noise, 1 + np.log2(np.maximum(1, total - noise)), 0).astype(np.uint8)


def _fingerprint(tokens: np.ndarray) -> np.int64:
    """The class of a set: equal sets have equal ones."""
    added = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64, keepdims=True)
    return mix(added + np.uint64(len(tokens))).view(np.int64)[0]


def _prefix(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The rarest tokens, in the order (level, hash) that all sets share."""
    level = levels[(tokens % np.uint64(SKETCH)).astype(np.int64)]
    order = np.argsort(level, kind="stable")  # tokens are sorted by hash
    return tokens[order[:prefix_size(len(tokens))]]


def _mark(key: str, text: str) -> Column:
    """Tells a document's row from all others but its repetitions."""
    return F.xxhash64(F.col(key), F.col(text))


def sets(docs: DataFrame, levels, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, mark, class (0: no shingles), n and prefix
    (64-bit tokens, rarest first)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        order = levels.value
        for batch in batches:
            classes, sizes, prefixes = [], [], []
            for block in blocks(batch.column(2)):
                for tokens in shingle_sets(block):
                    n = len(tokens)
                    classes.append(_fingerprint(tokens) if n else 0)
                    sizes.append(n)
                    prefixes.append(_prefix(tokens, order).tobytes() if n else b"")
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(classes, pa.int64()),
                                   pa.array(sizes, pa.int64()), pa.array(prefixes, pa.binary())],
                                  names=["doc_id", "mark", "class", "n", "prefix"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), _mark(key, text).alias("mark"), text)
    return rows.mapInArrow(run, "doc_id long, mark long, class long, n long, prefix binary")


def entries(classes: DataFrame, levels) -> DataFrame:
    """The inverted index: one row per class and prefix token, with the size
    and the token's position; ``long`` marks tokens far above the noise."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        order = levels.value
        for batch in batches:
            prefix = batch.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(prefix.buffers()[1], np.int64)[prefix.offset:prefix.offset + len(prefix) + 1]
            tokens = np.frombuffer(prefix.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.uint64)
            many = np.diff(offsets) // 8
            rank = np.arange(len(tokens)) - np.repeat((offsets[:-1] - offsets[0]) // 8, many)
            level = order[(tokens % np.uint64(SKETCH)).astype(np.int64)]
            for lo in range(0, len(tokens), 200_000):
                own = slice(lo, lo + 200_000)
                yield pa.record_batch([
                    pa.array(tokens[own].view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), many)[own]),
                    pa.array(np.repeat(batch.column(1).to_numpy(), many)[own].astype(np.int32)),
                    pa.array(rank[own].astype(np.int32)), pa.array(level[own] >= LONG_LEVEL)],
                    names=["token", "id", "n", "pos", "long"])

    return classes.select("class", "n", "prefix").mapInArrow(
        run, "token long, id long, n int, pos int, long boolean")


def _fits(na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Sizes and positions of a shared token leave room for enough overlap."""
    room = F.least(pa_, pb) + F.least(na - pa_, nb - pb)  # tokens before, and from it on
    return ((F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT)
            & (room >= overlap_needed(na, nb)))


def list_pairs(index: DataFrame) -> DataFrame:
    """A row (a < b, their sizes) for every token two classes share, from lists
    cut into blocks of similar size and position. ``comp`` answers pairs."""
    size = _size_block(F.col("n"))
    place = F.floor(F.col("pos") * 16 / F.col("n")).cast("int")
    member = F.struct("id", "n", "pos", "comp")
    cut = (index.withColumn("_size", size).withColumn("_place", place)
           .groupBy("token", "_size", "_place").agg(
               F.collect_list(member).alias("members"), F.min("n").alias("n0"), F.max("n").alias("n1"),
               F.min("pos").alias("p0"), F.max("pos").alias("p1"),
               F.min("comp").alias("c0"), F.max("comp").alias("c1")))
    left, right = (cut.select("token", *[F.col(c).alias(s + c) for c in cut.columns[1:]])
                   for s in ("l", "r"))
    # the largest overlap any two members may have, and one that is enough
    room = (F.least("lp1", "rp1") + F.least(F.col("ln1") - F.col("lp0"), F.col("rn1") - F.col("rp0")))
    skip = (F.least(F.col("ln1") / F.col("rn0"), F.col("rn1") / F.col("ln0")) * 100 < PERCENT) | (
        room < overlap_needed(F.col("ln0"), F.col("rn0")))
    answered = (F.col("lc0") == F.col("lc1")) & (F.col("rc0") == F.col("rc1")) & (F.col("lc0") == F.col("rc0"))
    order = F.col("l_size") * 32 + F.col("l_place") <= F.col("r_size") * 32 + F.col("r_place")
    met = left.join(right, "token").filter(order & ~skip & ~answered)
    same = (F.col("l_size") == F.col("r_size")) & (F.col("l_place") == F.col("r_place"))
    one = met.select(same.alias("_same"), F.explode("lmembers").alias("x"), F.col("rmembers"))
    two = one.select("_same", "x", F.explode("rmembers").alias("y"))
    wanted = ((~F.col("_same") | (F.col("x.id") < F.col("y.id"))) & (F.col("x.id") != F.col("y.id"))
              & (F.col("x.comp") != F.col("y.comp"))
              & _fits(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos")))
    return two.filter(wanted).select(*_ordered("x", "y"))


def _ordered(x: str, y: str) -> list[Column]:
    first = F.col(f"{x}.id") < F.col(f"{y}.id")
    return [F.when(first, F.col(f"{x}.id")).otherwise(F.col(f"{y}.id")).alias("a"),
            F.when(first, F.col(f"{y}.id")).otherwise(F.col(f"{x}.id")).alias("b"),
            F.when(first, F.col(f"{x}.n")).otherwise(F.col(f"{y}.n")).alias("na"),
            F.when(first, F.col(f"{y}.n")).otherwise(F.col(f"{x}.n")).alias("nb")]


def enough_shared(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Pairs that share enough prefix tokens: what lies behind the prefix of
    the set whose prefix ends first can add no more than its size. ``pairs``
    has a row per token shared in short lists; in long lists two sets may
    share as many tokens as both have there."""
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.first("na").alias("na"),
                                          F.first("nb").alias("nb"))
    extra = listed.filter("long").groupBy("id").agg(F.count(F.lit(1)).alias("_k"))
    for end in ("a", "b"):
        counted = counted.join(extra.select(F.col("id").alias(end), F.col("_k").alias(f"_k{end}")), end, "left")

    def behind(n: Column) -> Column:
        return F.ceil(n * PERCENT / 100) - 1

    most = (F.col("shared") + F.least(F.coalesce("_ka", F.lit(0)), F.coalesce("_kb", F.lit(0)))
            + F.greatest(behind(F.col("na")), behind(F.col("nb"))))
    return counted.filter(most >= overlap_needed(F.col("na"), F.col("nb"))).select("a", "b")


def _size_block(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(4 / 3)))).cast("int")


def long_blocks(listed: DataFrame) -> DataFrame:
    """The classes in long lists, one row each (id, n, tokens: those in long
    lists, other: the number of those in short ones, g: a group of classes
    that long lists connect), cut into blocks of a group by size, so that two
    classes of different groups, or of distant blocks, cannot be similar by
    their long lists."""
    member = listed.groupBy("id").agg(
        F.first("n").alias("n"), F.collect_list(F.when(F.col("long"), F.col("token"))).alias("tokens"),
        F.sum(F.when(F.col("long"), 0).otherwise(1)).alias("other")).filter(F.size("tokens") > 0)
    long_lists = listed.filter("long").select("token", "id")
    heads = long_lists.groupBy("token").agg(F.min("id").alias("b"))
    group = components(long_lists.join(heads, "token").select(F.col("id").alias("a"), "b"))
    named = (member.join(group.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("g", F.coalesce("component", "id")).drop("component")
             .withColumn("size", _size_block(F.col("n"))))
    cuts = named.groupBy("g", "size").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_cuts"))
    return (named.join(cuts, ["g", "size"])
            .withColumn("cut", F.pmod(F.xxhash64("id", F.lit(2)), F.col("_cuts"))).drop("_cuts"))


def block_pairs(member: DataFrame, top: int | None = None) -> DataFrame:
    """Pairs (a, b) of classes of different ``comp`` that share enough of their
    prefixes; with ``top``, of each class and pair of blocks only the ``top``
    that share most. Two blocks are compared in one task by the product of
    their incidence matrices; blocks that one component answers are skipped."""
    block = ["g", "size", "cut"]
    blocks = member.groupBy(*block).agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    left, right = (blocks.select("g", *[F.col(c).alias(s + c) for c in ("size", "cut", "c0", "c1")])
                   for s in ("l", "r"))
    order = ((F.col("lsize") < F.col("rsize"))
             | ((F.col("lsize") == F.col("rsize")) & (F.col("lcut") <= F.col("rcut"))))
    answered = (F.col("lc0") == F.col("lc1")) & (F.col("rc0") == F.col("rc1")) & (F.col("lc0") == F.col("rc0"))
    met = left.join(right, "g").filter(order & (F.col("rsize") - F.col("lsize") <= 1) & ~answered)
    ends = met.select("g", F.struct("lsize", "lcut", "rsize", "rcut").alias("meet"), F.explode(F.array(
        F.struct(F.col("lsize").alias("size"), F.col("lcut").alias("cut"), F.lit(0).alias("side")),
        F.struct(F.col("rsize").alias("size"), F.col("rcut").alias("cut"), F.lit(1).alias("side")))).alias("e"))
    asks = ends.select("g", "meet", "e.*")

    def find(rows):
        import pandas as pd

        sides = [rows[rows["side"] == k].sort_values("id") for k in (0, 1)]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        parts = [(x["id"].to_numpy(), x["n"].to_numpy(), x["other"].to_numpy(), x["comp"].to_numpy(),
                  [np.asarray(t, np.int64) for t in x["tokens"]]) for x in sides]
        shared = _shared(parts[0][4], parts[1][4])
        (ia, na, oa, ca, _), (ib, nb, ob, cb, _) = parts
        need = np.ceil((na[:, None] + nb[None, :]) * PERCENT / (100 + PERCENT) - 1e-9)
        behind = np.maximum((-(-PERCENT * na // 100) - 1)[:, None], (-(-PERCENT * nb // 100) - 1)[None, :])
        most = shared + np.minimum(oa[:, None], ob[None, :]) + behind
        fits = ((shared > 0) & (most >= need) & (ca[:, None] != cb[None, :])
                & (np.minimum(na[:, None], nb[None, :]) * 100 >= np.maximum(na[:, None], nb[None, :]) * PERCENT))
        if np.array_equal(ia, ib):
            fits &= ia[:, None] < ib[None, :]
        if top is not None:
            likely = np.where(fits, shared / need, -1.0)
            best = np.zeros_like(fits)
            for axis in (0, 1):
                order = np.argsort(-likely, axis=axis, kind="stable")
                np.put_along_axis(best, order[:top] if axis == 0 else order[:, :top], True, axis)
            fits &= best
        x, y = np.nonzero(fits)
        return pd.DataFrame({"a": np.minimum(ia[x], ib[y]), "b": np.maximum(ia[x], ib[y])})

    rows = member.join(asks, block).select("g", "meet", "side", "id", "n", "other", "comp", "tokens")
    return rows.groupBy("g", "meet").applyInPandas(find, "a long, b long").distinct()


def _shared(left: list, right: list) -> np.ndarray:
    """Numbers of tokens that each of ``left`` shares with each of ``right``."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (left, right)]
    both = np.intersect1d(*flat)
    who = [np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (left, right)]
    for lo in range(0, len(both), 2048):
        own = both[lo:lo + 2048]
        made = []
        for tokens, of, x in zip(flat, who, (left, right)):
            at = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
            hit = own[at] == tokens
            one = np.zeros((len(x), len(own)), np.float32)
            one[of[hit], at[hit]] = 1
            made.append(one)
        out += made[0] @ made[1].T
    return out


class Join:
    """One self-join: its documents and where it keeps tables."""

    def __init__(self, docs: DataFrame, key: str, text: str):
        self.docs, self.key, self.text = docs, key, text
        self.spark: SparkSession = docs.sparkSession
        self.folder = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/jaccard-{uuid.uuid4().hex}"

    def kept(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` as a written table in the shared folder."""
        rows.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def links(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """The similar ones of ``pairs`` (a, b: classes), by their whole sets."""
        spark, key, text = self.spark, self.key, self.text
        pairs = self.kept(pairs, f"pairs-{name}")
        ids = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        needed = ids.join(classes.select("class", "mark"), "class").checkpoint()
        found = spark.sparkContext.broadcast(_find_bits(needed))

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            bits = found.value
            for batch in batches:
                marks = batch.column(0).to_numpy().view(np.uint64)
                at = mix(marks) % np.uint64(8 * len(bits))
                hit = bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                own = batch.filter(pa.array(hit.astype(bool)))
                data = [t.tobytes() for b in blocks(own.column(1)) for t in shingle_sets(b)]
                for lo in range(0, len(data), 500):
                    yield pa.record_batch([own.column(0)[lo:lo + 500],
                                           pa.array(data[lo:lo + 500], pa.binary())],
                                          names=["mark", "tokens"])

        made = (self.docs.select(_mark(key, text).alias("mark"), text)
                .mapInArrow(run, "mark long, tokens binary"))
        whole = self.kept(made.join(needed, "mark").dropDuplicates(["class"]).select("class", "tokens"),
                          f"sets-{name}")
        # sets go to the pairs: first to the end that more pairs may share
        with_b = pairs.join(whole.select(F.col("class").alias("b"), F.col("tokens").alias("tb")), "b")
        both = with_b.join(whole.select(F.col("class").alias("a"), F.col("tokens").alias("ta")), "a")

        def similar(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                keep = []
                for ta, tb in zip(batch.column("ta"), batch.column("tb")):
                    x, y = (np.frombuffer(t.as_buffer(), np.uint64) for t in (ta, tb))
                    if len(x) > len(y):
                        x, y = y, x
                    at = np.searchsorted(y, x)
                    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return both.select("a", "b", "ta", "tb").mapInArrow(similar, "a long, b long")


def _find_bits(needed: DataFrame) -> np.ndarray:
    """Bits of the marks that are needed, made in the tasks and joined up."""
    n = needed.count()
    size = 1 << max(13, min(FIND_BITS, 16 * max(1, n)).bit_length())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        places: list[np.ndarray] = [np.zeros(0, np.uint64)]
        for batch in batches:
            places.append(mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(size))
        at = np.unique(np.concatenate(places))
        if len(at):
            yield pa.record_batch([pa.array((at >> np.uint64(3)).astype(np.int64)),
                                   pa.array((1 << (at & np.uint64(7))).astype(np.int64))],
                                  names=["byte", "bits"])

    rows = (needed.select("mark").mapInArrow(run, "byte long, bits long")
            .groupBy("byte").agg(F.bit_or("bits").alias("bits")))
    got = rows.toArrow()  # at most FIND_BITS / 8 rows
    out = np.zeros(size // 8, np.uint8)
    out[got["byte"].to_numpy()] = got["bits"].to_numpy().astype(np.uint8)
    return out


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, mark, n_shingles, component_id (smallest
    id of the documents reachable by links), n_members and group (the same for
    all members of a component; NULL without shingles)."""
    join = Join(docs, key, text)
    spark = join.spark
    levels = spark.sparkContext.broadcast(sketch(docs, text))
    member = join.kept(sets(docs, levels, key, text), "members")
    classes = member.filter("n > 0").groupBy("class").agg(
        F.min("mark").alias("mark"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    listed = join.kept(
        _with_company(entries(classes, levels)).withColumn("comp", F.col("id")), "entries")
    marks = member.filter("n > 0").groupBy("class").agg(F.min("mark").alias("mark"))

    # long lists: their likeliest pairs first, then what these leave open
    links = None
    if not listed.filter("long").isEmpty():
        crowd = join.kept(long_blocks(listed).withColumn("comp", F.col("id")), "crowd")
        for k, top in enumerate((LIKELIEST, None)):
            found = join.kept(join.links(block_pairs(crowd, top), marks, f"long-{k}"), f"links-long-{k}")
            links = found if links is None else links.unionByName(found)
            if top is None:
                break
            answered = components(links).checkpoint()
            crowd = join.kept(_answered(crowd.drop("comp"), answered), f"crowd-{k}")
            listed = _answered(listed.drop("comp"), answered)
        listed = join.kept(listed, "answered")
    pairs = enough_shared(list_pairs(listed.filter("NOT long")), listed)
    short_links = join.links(pairs, marks, "short")
    links = short_links if links is None else links.unionByName(short_links)
    comps = components(links).select(F.col("node").alias("class"), "component").checkpoint()

    # linked or repeated classes get their component's smallest id; others keep their own
    facts = member.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("_id"),
                                                        F.count(F.lit(1)).alias("_k"))
    heads = facts.join(comps, "class").groupBy("component").agg(
        F.min("_id").alias("_first"), F.sum("_k").alias("_all"))
    named = (facts.join(comps, "class", "left").join(heads, "component", "left")
             .filter(F.col("component").isNotNull() | (F.col("_k") > 1))
             .select("class", "component", F.coalesce("_first", "_id").alias("_name"),
                     F.coalesce("_all", "_k").alias("_members")))
    group = F.when(F.col("n") > 0, F.coalesce("component", "class"))
    return (member.join(named, "class", "left")
            .select("doc_id", "mark", F.col("n").alias("n_shingles"),
                    F.coalesce("_name", "doc_id").alias("component_id"),
                    F.coalesce("_members", F.lit(1)).alias("n_members"), group.alias("group")))


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id,
    and all documents without shingles."""
    found = jaccard_components(docs, key, text).select("doc_id", "mark", "group")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    name = "_jaccard_mark"
    kept = (found.filter("group IS NOT NULL").groupBy("group").agg(first.alias("_f"))
            .select(F.col("_f.mark").alias(name)))
    bare = found.filter("group IS NULL").select(F.col("mark").alias(name)).distinct()
    marked = docs.withColumn(name, _mark(key, text))
    own = marked.join(kept, name, "left_semi").dropDuplicates([name])
    rest = marked.join(bare, name, "left_semi")
    return own.unionByName(rest).drop(name)


def _answered(rows: DataFrame, answered: DataFrame) -> DataFrame:
    """``rows`` (by id) with the component found for the id so far."""
    return (rows.join(answered.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("comp", F.coalesce("component", "id")).drop("component"))


def _with_company(index: DataFrame) -> DataFrame:
    """Entries of tokens with more than one class. Long lists (by the sketch)
    are not counted, so that no token's rows need to meet in one task."""
    short = index.filter("NOT long")
    company = F.count(F.lit(1)).over(Window.partitionBy("token"))
    return (short.withColumn("_k", company).filter("_k > 1").drop("_k")
            .unionByName(index.filter("long")))
