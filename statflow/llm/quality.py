"""Quality rules: a table of thresholds compiled into one Spark projection.

Each rule bounds one measure of a document: lengths, and ratios of symbols,
stop words and repeated lines. :func:`measures` makes the measures with
built-in functions only; :func:`compile_rules` turns the table into one
boolean expression and the list of rules a document breaks.

Defined results: NULL, empty and blank texts have no words, 0 in every count
and break the base rule; a measure whose divisor is 0 is 0; repeated rows are
judged alike; an empty table gives no rows; other columns pass through unless
they carry a measure's name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.words import WHITE_SPACE, words

#: The counted symbols; frequent function words by language.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be on are this by an not",
    "de": "der die und das von zu den mit ist auf des ein im nicht sich dem für",
    "fr": "le la de et les des en un une du que est pour qui dans par au sur",
    "es": "el la de que y en los del las un por con una se para es al lo",
}

MIN_WORDS = 50


@dataclass(frozen=True)
class Rule:
    """``low`` <= measure <= ``high``; None is unbounded."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table. The two base rules come first.
BASE_RULES = (
    Rule("enough_words", "n_words", low=MIN_WORDS),
    Rule("few_repeats", "repeat_percent", high=50),
)
RULES = (
    Rule("not_endless", "n_words", high=100_000),
    Rule("word_length", "mean_word_length", low=2, high=14),
    Rule("few_symbols", "symbols_per_word", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("few_dup_lines", "dup_line_ratio", high=0.5),
)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_windows(w: Column) -> Column:
    """Words covered by the 3-word windows that stand in ``w`` twice or more.

    Windows are sorted by hash, those equal to a neighbour are kept and sorted
    by place; each then covers at most three words not covered before it.
    """
    def window(i: Column) -> Column:
        return F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                        i.alias("i"))

    def repeated(s: Column) -> Column:
        def same(e: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k).getField("h") == e["h"], F.lit(False))

        return F.filter(s, lambda e, k: same(e, k + 1) | ((k > 0) & same(e, F.greatest(k - 1, F.lit(0)))))

    def cover(acc: Column, i: Column) -> Column:
        return F.struct(i.alias("last"),
                        (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"))

    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)
    places = let(F.sort_array(windows), repeated)
    covered = F.aggregate(F.sort_array(F.transform(places, lambda e: e["i"])), start, cover,
                          lambda a: a["n"])
    return F.when(F.size(w) >= 4, covered).otherwise(0)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures that rules may bound."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != "")
    w = words(F.col(text))
    stops = F.array(*[F.lit(x) for x in sorted({x for v in STOP_WORDS.values() for x in v.split()})])
    per_words = let(w, lambda a: F.struct(
        F.size(a).cast("long").alias("n_words"),
        _repeated_windows(a).cast("long").alias("n_repeat_words"),
        F.size(F.filter(a, lambda x: F.array_contains(stops, F.lower(x)))).alias("n_stop_words")))
    per_lines = let(lines, lambda a: F.struct(
        F.size(a).alias("n_lines"),
        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines")))

    def rest(chars: str) -> Column:
        return F.length(F.translate(value, chars, ""))

    counted = docs.select(
        "*", per_words.alias("_w"), per_lines.alias("_l"),
        rest(WHITE_SPACE).cast("long").alias("word_chars"),
        (F.length(value) - rest(SYMBOLS)).cast("long").alias("n_symbols"))

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    out = counted.select("*", "_w.*", "_l.*").drop("_w", "_l")
    return (out.withColumn("repeat_percent", 100 * ratio("n_repeat_words", "n_words"))
            .withColumn("mean_word_length", ratio("word_chars", "n_words"))
            .withColumn("symbols_per_word", ratio("n_symbols", "n_words"))
            .withColumn("stop_word_ratio", ratio("n_stop_words", "n_words"))
            .withColumn("dup_line_ratio", ratio("n_dup_lines", "n_lines")))


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules a row of measures breaks, as one array."""
    broken = []
    for r in rules:
        m = F.col(r.measure)
        low = m < r.low if r.low is not None else F.lit(False)
        high = m > r.high if r.high is not None else F.lit(False)
        broken.append(F.when(low | high, F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
          base: tuple[Rule, ...] = BASE_RULES, text: str = "text") -> DataFrame:
    """``docs`` with its measures, ``broken`` (rule names), ``base_failed`` and
    ``kept``."""
    judged = measures(docs, text).withColumn("base_broken", compile_rules(base)).withColumn(
        "rules_broken", compile_rules(rules))
    return (judged.withColumn("base_failed", F.size("base_broken") > 0)
            .withColumn("kept", (F.size("base_broken") + F.size("rules_broken")) == 0)
            .withColumn("broken", F.concat("base_broken", "rules_broken"))
            .drop("base_broken", "rules_broken"))
