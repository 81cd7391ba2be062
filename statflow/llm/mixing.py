"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the training run, piecewise linear
in time from 0 to 1. Its integral is the source's total weight; total weights
set the targets (:func:`targets`). A source's cumulative demand at time t is
target x W(t) / W(1), W being the integral of its schedule. Its documents
stand in a fixed order (by a hash of id and text) with their words one after
the other, repeated once per epoch; the words up to the target are taken. A
document's training position is the time at which demand reaches its first
word: W is inverted in closed form (a quadratic per piece). The mix is sorted
by position over range partitions.

Sources with very many rows are split into hash ranges (``places``), so no
task holds a source.

Defined results: NULL source is a source of its own, last in order; NULL and
blank texts have size 0, take 0 words and get a position like any other, once
(at the end, where their source's target is reached before them); rows that are equal share their source's place in any order; an empty table gives
no rows; other columns pass through, but names starting with ``_mix`` or
``_place`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.places import place_ranges, place_rows
from statflow.llm.words import WHITE_SPACE, word_count
from statflow.operators.ordered import running_totals

#: Schedules given to sources in order of their names, over and over: weights
#: at equal distances in time. Their integrals are 5, 2 and 1; the heavy
#: sources fade, the light ones come in late.
SCHEDULES = ((7.5, 5.0, 2.5), (2.0, 2.0, 2.0), (0.5, 1.0, 1.5))
SHARE = 1.5
MAX_EPOCHS = 2

_SKEY = "_mix_source"


def source_key(source: Column) -> Column:
    """A non-NULL join key: '' for NULL, else '=' and the name."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _pieces(schedule: Sequence[float]) -> Column:
    """The schedule's linear pieces with the integral before each of them."""
    n = len(schedule) - 1
    rows, area = [], 0.0
    for i in range(n):
        w0, w1 = float(schedule[i]), float(schedule[i + 1])
        step = (w0 + w1) / 2 / n
        rows.append(F.struct(F.lit(i / n).alias("t0"), F.lit(w0).alias("w0"),
                             F.lit((w1 - w0) * n).alias("slope"), F.lit(area).alias("a0"),
                             F.lit(area + step).alias("a1")))
        area += step
    return F.array(*rows)


def _integral(schedule: Sequence[float]) -> float:
    n = len(schedule) - 1
    return sum((schedule[i] + schedule[i + 1]) / 2 / n for i in range(n))


def invert(pieces: Column, area: Column) -> Column:
    """The time at which the schedule's integral reaches ``area``."""
    inside = F.filter(pieces, lambda p: (p.a0 <= area) & (area < p.a1))
    piece = F.coalesce(F.get(inside, F.lit(0)), F.element_at(pieces, -1))

    def solve(p: Column) -> Column:
        y = F.greatest(area - p.a0, F.lit(0.0))
        root = F.sqrt(F.greatest(p.w0 * p.w0 + 2 * p.slope * y, F.lit(0.0)))
        down = p.w0 + root
        return p.t0 + F.when(down > 0, 2 * y / down).otherwise(0.0)

    return F.get(F.transform(F.array(piece), solve), F.lit(0))


def targets(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to one row per source (``weight``, ``source_size``).

    Targets are min(max_epochs x size, level x weight) with the one level at
    which they add up to ``share`` of all sizes: what stopped sources leave is
    reshared by weight among the others until none is above its limit. With
    sources sorted by limit / weight, the stopped ones come first, so running
    totals of limits and weights give the level a source would see if all
    before it stopped; the first source not stopped by it sets the level.
    """
    limited = sources.withColumn("_mix_limit", (max_epochs * F.col("source_size")).cast("double"))
    order = [(F.col("_mix_limit") / F.col("weight")).asc(), F.col(_SKEY).asc()]
    placed = running_totals(limited, order, {"_mix_limits": F.col("_mix_limit"),
                                             "_mix_weights": F.col("weight")})
    # two sums, then one number, come to the driver
    whole = limited.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("w")).first()
    level = ((F.lit(share * (whole["all"] or 0)) - F.col("_mix_limits"))
             / (F.lit(float(whole["w"] or 0)) - F.col("_mix_weights")))
    seen = placed.withColumn("_mix_level", level)
    running = F.struct((F.col("_mix_limit") / F.col("weight")).alias("r"), F.col(_SKEY),
                       F.col("_mix_level").alias("level"))
    first = (seen.filter(F.col("_mix_limit") > F.col("_mix_level") * F.col("weight"))
             .agg(F.min(running).alias("f")).select("f.level").first())
    target = F.col("_mix_limit")
    if first["level"] is not None:
        target = F.least(target, F.lit(first["level"]) * F.col("weight"))
    return placed.withColumn("target", target).drop("_mix_limit", "_mix_limits", "_mix_weights")


def mix(docs: DataFrame, schedules: Sequence[Sequence[float]] = SCHEDULES, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, size: Column | None = None, text: str = "text",
        source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` (columns named as the result's give way) plus size, source_size,
    target, taken (words the mix takes, all epochs together) and takes: one (epoch, words, position) per epoch in which
    words are taken, by position; of documents without words the first epoch's."""
    size = word_count(F.col(text)) if size is None else size
    sized = docs.withColumn("size", size).withColumn(_SKEY, source_key(F.col(source)))
    marked, ranges = place_ranges(sized, [_SKEY], F.xxhash64(F.col(key), F.col(text)), F.col("size"))

    stats = ranges.groupBy(_SKEY).agg(F.sum("_range_total").alias("source_size"))
    by_name = [F.when(F.col(_SKEY) == "", 1).otherwise(0), F.col(_SKEY)]
    ranked = running_totals(stats, by_name, {"_mix_rank": F.lit(1)})
    turn = F.col("_mix_rank") % len(schedules)
    weight = pieces = None
    for i, s in enumerate(schedules):
        w, p = F.lit(float(_integral(s))), _pieces(s)
        weight = F.when(turn == i, w) if weight is None else weight.when(turn == i, w)
        pieces = F.when(turn == i, p) if pieces is None else pieces.when(turn == i, p)
    plan = (targets(ranked.withColumn("weight", weight), share, max_epochs)
            .withColumn("_mix_pieces", pieces).drop("_mix_rank"))

    placed = place_rows(marked, ranges.join(plan, _SKEY), [_SKEY], [key, "size"],
                        F.col("size"), "_mix_at")
    whole_target = F.round(F.col("target")).cast("long")
    takes = []
    for epoch in range(max_epochs):
        first = F.col("_mix_at") + epoch * F.col("source_size")
        words = F.greatest(F.least(whole_target - first, F.col("size")), F.lit(0))
        area = (F.when(F.col("target") > 0, F.least(first / F.col("target"), F.lit(1.0))).otherwise(0.0)
                * F.col("weight"))
        takes.append(F.struct(F.lit(epoch).alias("epoch"), words.cast("long").alias("words"),
                              invert(F.col("_mix_pieces"), area).alias("position")))
    taken = F.aggregate(F.array(*takes), F.lit(0).cast("long"), lambda a, t: a + t["words"])
    wordless = F.col("size") == 0
    return (placed.withColumn("taken", taken)
            .withColumn("takes", F.filter(F.array(*takes), lambda t: (t["words"] > 0) | (wordless & (t["epoch"] == 0))))
            .drop(_SKEY, "_mix_at", "_mix_pieces"))


def by_position(mixed: DataFrame) -> DataFrame:
    """One row per document and epoch taken, range-sorted by position."""
    return (mixed.select("*", F.explode("takes").alias("_mix_take"))
            .withColumn("position", F.col("_mix_take.position"))
            .withColumn("words", F.col("_mix_take.words"))
            .drop("_mix_take", "takes").orderBy("position"))


def mixed_documents(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mix as documents: a row per epoch taken, in training order. The one
    document per source at which its target is reached gives its first words."""
    # the other columns ride along in one, so that their names are free
    own = (key, "text", "source")
    other = [c for c in docs.columns if c not in own]
    carried = F.struct(*[F.col(f"`{c}`") for c in other]) if other else F.lit(None)
    out = by_position(mix(docs.select(*own, carried.alias("_mix_row")), key=key))
    cut = F.when(F.col("words") < F.col("size"), first_words_at(F.col("text"), F.col("words")))
    return out.withColumn("text", F.coalesce(cut, F.col("text"))).select(
        *[F.col("_mix_row").getField(c).alias(c) if c in other else F.col(f"`{c}`") for c in docs.columns])


def first_words_at(text: Column, n: Column) -> Column:
    """The first n words, with single spaces (for the few cut documents)."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    return F.array_join(F.slice(F.split(trimmed, r"[\x20\x09-\x0D]+"), F.lit(1), n.cast("int")), " ")
