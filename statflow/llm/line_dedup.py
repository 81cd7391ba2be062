"""Line dedup: a segment-partition edit join over the lines of all documents.

All lines that are not blank are compared, without white space at their ends.
Of equal lines, and of lines a few edits apart, the later ones are dropped;
"later" is by document id, then by place in the document. A pair may differ by
one edit for every ``CHARS_PER_EDIT`` characters of its shorter line, ``EDITS``
at the most: short lines must be equal.

Different lines are split into one segment more than they have edits. If two
lines are that close, one segment of the shorter stands unchanged in the longer,
within a small shift that depends on the lengths and the segment
(multi-match-aware windows). So each line is indexed by its segments and probes
the indexes of the lines that may be shorter with its substrings. This is done
in two rounds, since one earlier witness is enough for a line to go:

1. Each probe meets one line of an index list, the first by document id. In a
   group of near copies that is the one that the others are copies of, so a
   group costs as many pairs as it has lines.
2. What no witness was found for probes the rest of the lists that have more
   than one line, for earlier lines with close numbers of some frequent letters
   (an edit takes one away and adds one at the most). In long lists these
   numbers must be close in every prefix of some fixed lengths as well: an edit
   changes one character there, or moves one over its end. Answered lines stay
   in the lists as witnesses. No list is cut.

Pairs are verified, without the words that both have at the start and the end,
by banded edit distance on bit vectors: the vertical differences of a band of a
column are the bits of two numbers, and a character moves the band down by one
in a few operations. All of it is built-in functions.

Repeated lines are pre-aggregated to one, told apart by 128 bits, before they
are joined. The different lines are kept in a table bucketed by these bits,
so that verification, by text, moves the candidates, not the lines.

Defined results: NULL and empty texts have no lines; blank lines always stay;
repeated rows are documents whose lines repeat, in any order; NULL ids come
first; an empty table gives no rows; other columns keep their values, but those
named as the result's. Names starting with ``_line`` are reserved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions.casts import apart
from statflow.llm.words import WHITE_SPACE
from statflow.session import ensure_checkpoint_dir

EDITS = 2
#: A line of so many characters may have one edit, of twice as many two.
CHARS_PER_EDIT = 12
#: Fixed value: characters whose numbers are compared first, in groups about as
#: frequent as each other.
LETTERS = ("e", "a", "n", "r", "i", "t", "os", "hdl", "ucm", "pgbfy", "vkwjxqz", "0123456789")
#: Of these, so many are counted in a pair before the others.
FIRST_LETTERS = 4
#: Lists of more lines compare letters in prefixes, too: so many, and each so
#: many characters longer than the one before.
LONG_LIST = 16
PREFIXES, PREFIX_STEP = 8, 48


def _mark(key: str, text: str) -> Column:
    """Tells a document's row from all others but its repetitions."""
    return F.unhex(F.md5(F.concat_ws(":", F.col(key), F.col(text).isNull(), F.col(text))))


def _line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _trimmed(line: Column) -> Column:
    """``line`` without white space at its ends. Trimming walks the whole line,
    so only lines that begin or end with such a character are trimmed."""
    at_end = F.lit(False)
    for c in WHITE_SPACE:
        at_end = at_end | F.startswith(line, F.lit(c)) | F.endswith(line, F.lit(c))
    return F.when(at_end, F.btrim(line, F.lit(WHITE_SPACE))).otherwise(line)


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every line that is not blank: _line_at (doc id, mark, place), its hash
    and text without white space at the ends."""
    # the mark is made before the lines are dealt out, once per text
    whole = docs.select(F.col(key).cast("long").alias("_id"), _mark(key, text).alias("_m"),
                        _line_array(F.col(text)).alias("_ls"))
    # every text has a line, so outer adds no row, and spares the filter for
    # empty arrays that would split the texts twice
    rows = whole.select("_id", "_m", F.posexplode_outer("_ls").alias("_p", "_raw"))
    line = _trimmed(F.col("_raw"))
    return (rows.select(F.struct(F.col("_id").alias("id"), F.col("_m").alias("mark"),
                                 F.col("_p").alias("place")).alias("_line_at"), line.alias("_line"))
            .filter(F.col("_line") != "")
            .withColumn("_line_hash", F.unhex(F.md5("_line"))))


def letter_counts(line: Column) -> Column:
    """The numbers of characters of each of ``LETTERS``, mod 32, side by side
    in 64 bits."""
    out = F.lit(0).cast("long")
    for k, letters in enumerate(LETTERS):
        n = _number_of(letters, line).cast("long")
        out = out.bitwiseOR(F.shiftleft(n.bitwiseAND(F.lit(31)), 5 * k))
    return out


def _number_of(letters: str, line: Column) -> Column:
    """Few letters are replaced one by one: by bytes, where ``translate`` makes
    a string of every character."""
    rest = line
    if len(letters) > 3:
        rest = F.translate(line, letters, "")
    else:
        for c in letters:
            rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.char_length(line) - F.char_length(rest)


def first_letters_apart(a: Column, b: Column) -> Column:
    """What the first of ``LETTERS`` alone give for :func:`letters_apart`, or
    more where the numbers differ by 16 and up: most pairs end here, at a
    fraction of the work."""
    return sum((F.abs(_number_of(x, a) - _number_of(x, b)) for x in LETTERS[:FIRST_LETTERS]), F.lit(0))


def letters_apart(a: Column, b: Column) -> Column:
    """At least so many characters does one line have more than the other."""
    out = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        d = (F.shiftright(a, 5 * k) - F.shiftright(b, 5 * k)).bitwiseAND(F.lit(31))
        out = out + F.least(d, 32 - d)
    return out


def prefix_counts(line: Column) -> Column:
    """``letter_counts`` of the prefixes of fixed lengths that are shorter than
    the line."""
    ends = F.sequence(F.lit(1), F.lit(PREFIXES))
    within_line = F.filter(ends, lambda k: k * PREFIX_STEP < F.char_length(line))
    return F.transform(within_line, lambda k: letter_counts(F.substr(line, F.lit(1), k * PREFIX_STEP)))


def prefixes_apart(a: Column, b: Column) -> Column:
    """The most that two lines' prefixes (:func:`prefix_counts`) of one length
    are apart; without any in both: 0."""
    far = F.zip_with(a, b, lambda x, y: F.coalesce(letters_apart(x, y), F.lit(0).cast("long")))
    return F.coalesce(F.array_max(far), F.lit(0).cast("long"))


def _segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """(start, length) of the segments of a line of ``length`` characters."""
    base, rest = F.floor(length / (edits + 1)).cast("int"), length % (edits + 1)
    out, start = [], F.lit(1)
    for i in range(edits + 1):
        size = base + F.when(rest >= edits + 1 - i, 1).otherwise(0)
        out.append((start, size))
        start = start + size
    return out


def _piece(line: Column, i: int, length: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(i), length, F.substr(line, start, size))


def edits_of(length: Column, edits: int = EDITS) -> Column:
    """Edits that a pair may have whose shorter line has so many characters."""
    return F.least(F.lit(edits), F.floor(length / CHARS_PER_EDIT)).cast("int")


def index_keys(line: Column, length: Column, edits: int = EDITS) -> Column:
    """The keys of a line's segments, by the edits it may have."""
    out = F.array().cast("array<long>")
    for k in range(edits, 0, -1):
        own = F.array(*[_piece(line, i, length, start, size)
                        for i, (start, size) in enumerate(_segments(length, k))])
        out = F.when(edits_of(length, edits) == k, own).otherwise(out)
    return out


def probe_keys(line: Column, length: Column, edits: int = EDITS) -> Column:
    """The keys of substrings that may be a segment of a line that is shorter
    by at most the edits which that line may have."""
    lists = []
    for less in range(edits + 1):
        short = length - less
        for k in range(max(less, 1), edits + 1):
            keys = []
            for i, (start, size) in enumerate(_segments(short, k)):
                first = max(-i, less - (k - i))
                last = min(i, less + (k - i))
                keys += [_piece(line, i, short, start + shift, size) for shift in range(first, last + 1)]
            lists.append(F.when(edits_of(short, edits) == k, F.array(*keys))
                         .otherwise(F.array().cast("array<long>")))
    return F.concat(*lists)


def within(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether strings are at most ``edits`` edits apart, their lengths being at
    most that apart: edit distance in a diagonal band of 2 x edits + 1 rows.

    The vectors' highest bit is the band's lowest row, ``edits`` rows below the
    diagonal. The score follows the band's lowest row down to the end
    of ``a``, then the last row of the matrix to the end of ``b``.
    """
    bits = 2 * edits + 1
    full, top = (1 << bits) - 1, bits - 1

    def long(x: int) -> Column:
        return F.lit(x).cast("long")

    def run(both: Column) -> Column:
        s, t = both["s"], both["t"]
        n, m = F.size(s), F.size(t)

        def step(acc: Column, j: Column) -> Column:
            c = F.get(t, j)
            x = None
            for k in range(bits):
                row = j + (edits - (top - k))
                hit = F.when((row >= 0) & (row < n) & (F.get(s, F.greatest(row, F.lit(0))) == c),
                             long(1 << k)).otherwise(long(0))
                x = hit if x is None else x.bitwiseOR(hit)
            return _let(F.struct(x.alias("x"), acc.alias("o")), lambda v: _move(v["x"], v["o"], j))

        def _move(x: Column, o: Column, j: Column) -> Column:
            vp, vn = o["vp"], o["vn"]
            d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(long(full))
            return _let(F.struct(d0.alias("d"), vp.alias("p"), vn.alias("n")),
                        lambda v: _next(v["d"], v["p"], v["n"], o, j))

        def _next(d0: Column, vp: Column, vn: Column, o: Column, j: Column) -> Column:
            hp = vn.bitwiseOR(long(full) - d0.bitwiseOR(vp).bitwiseAND(long(full)))
            hn = d0.bitwiseAND(vp)
            down = F.shiftright(d0, 1)
            diagonal = F.when(d0.bitwiseAND(long(1 << top)) > 0, 0).otherwise(1)
            # past the end of s the last row stands ever higher in the band
            past = j - (n - edits)
            mask = F.call_function("shiftright", long(1 << top), (past + 1).cast("int"))
            flat = (F.when(hp.bitwiseAND(mask) > 0, 1).otherwise(0)
                    - F.when(hn.bitwiseAND(mask) > 0, 1).otherwise(0))
            return F.struct(
                hn.bitwiseOR(long(full) - down.bitwiseOR(hp).bitwiseAND(long(full))).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (o["score"] + F.when(past < 0, diagonal).otherwise(flat)).cast("int").alias("score"))

        start = F.struct(long((full << edits) & full).alias("vp"),
                         long(0).alias("vn"), F.lit(edits).alias("score"))
        return F.aggregate(F.sequence(F.lit(0), m - 1), start, step, lambda o: o["score"])

    whole = F.struct(F.split(a, "").alias("s"), F.split(b, "").alias("t"))
    return _let(whole, run) <= edits


def _between(a: Column, b: Column, edits: int) -> Column:
    """``a`` and ``b`` (fields s and t) without the words they share at the
    start and at the end, which do not count for their distance. Every word
    keeps the space behind it; a common lead-in makes both long enough."""
    def ends(x: Column) -> Column:
        def same(v: Column, w: Column) -> Column:
            first = F.array_position(F.zip_with(v, w, lambda y, z: y.eqNullSafe(z)), False)
            return F.when(first > 0, first - 1).otherwise(F.least(F.size(v), F.size(w))).cast("int")

        def rest(v: Column, skip: Column) -> Column:
            return F.slice(v, skip + 1, F.size(v))

        def cut(head: Column) -> Column:
            left = F.struct(F.reverse(rest(x["v"], head)).alias("v"), F.reverse(rest(x["w"], head)).alias("w"))
            return _let(left, lambda y: _let(same(y["v"], y["w"]), lambda tail: F.struct(
                spelled(rest(y["v"], tail)).alias("s"), spelled(rest(y["w"], tail)).alias("t"))))

        return _let(same(x["v"], x["w"]), cut)

    def spelled(backwards: Column) -> Column:
        words = F.transform(F.reverse(backwards), lambda y: F.concat(y, F.lit(" ")))
        return F.concat(F.lit("." * (2 * edits + 2)), F.array_join(words, ""))

    return _let(F.struct(F.split(a, " ").alias("v"), F.split(b, " ").alias("w")), ends)


def similar(a: Column, b: Column, edits: int = EDITS) -> Column:
    """Whether lines are at most as many edits apart as the shorter may have."""
    def check(k: int):
        def run(x: Column) -> Column:
            longer = F.abs(F.char_length(x["s"]) - F.char_length(x["t"]))
            return F.when(longer > k, False).otherwise(within(x["s"], x["t"], k))

        return run

    may = edits_of(F.least(F.char_length(a), F.char_length(b)), edits)
    out = F.lit(False)
    for k in range(1, edits + 1):
        out = F.when(may == k, _let(_between(a, b, k), check(k))).otherwise(out)
    return out


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _texts(pairs: DataFrame, kept: DataFrame, name: str) -> DataFrame:
    """``pairs`` plus the hash, text and place of the lines whose handles are
    in the column ``name``. Few handles meet light rows, then their lines where
    these are: what is few is hashed, the lines stream by."""
    ids = kept.select(F.col("_handle").alias(name), F.col("_line_hash").alias(f"_h{name}"))
    lines_there = kept.select(F.col("_line_hash").alias(f"_h{name}"), F.col("_line").alias(f"_l{name}"),
                              F.col("_first").alias(f"_f{name}"))
    return pairs.hint("shuffle_hash").join(ids, name).hint("shuffle_hash").join(lines_there, f"_h{name}")


def _verified(pairs: DataFrame, kept: DataFrame, edits: int) -> DataFrame:
    """The later line (its 64-bit handle and its hash) of every pair of handles
    (a, b) that is close enough."""
    both = _texts(_texts(pairs, kept, "a"), kept, "b")
    # letters first: most pairs that share a segment by chance end there. The
    # lambda keeps Spark from counting all letters before it knows the first
    counts = F.struct(letter_counts(F.col("_la")).alias("s"), letter_counts(F.col("_lb")).alias("t"))
    may = _let(counts, lambda x: letters_apart(x["s"], x["t"])) <= 2 * edits
    at_once = first_letters_apart(F.col("_la"), F.col("_lb")) > 2 * edits
    near = both.filter(F.when(at_once, False).when(may, similar(F.col("_la"), F.col("_lb"), edits)).otherwise(False))
    later = F.col("_fa") < F.col("_fb")
    return near.select(F.when(later, F.col("b")).otherwise(F.col("a")).alias("_handle"),
                       F.when(later, F.col("_hb")).otherwise(F.col("_ha")).alias("_line_hash")).distinct()


def probes(own: DataFrame, edits: int = EDITS) -> DataFrame:
    """(b, _key): the probe keys of the lines ``own`` (_handle, _line) of at
    least ``CHARS_PER_EDIT`` characters."""
    line = F.col("_line")
    # in one method with the rest of the stage the keys are too large for the
    # JVM to compile; each of the lines has keys, so outer adds no row, and
    # spares the filter for empty lists that would make the keys twice
    keys = own.select(apart("_handle").alias("b"), probe_keys(line, F.char_length(line), edits).alias("_keys"))
    return keys.select("b", F.explode_outer("_keys").alias("_key"))


def near_lines(kept: DataFrame, folder: str, edits: int = EDITS) -> DataFrame:
    """The hashes of the different lines ``kept`` (_handle, _line_hash, _line,
    _first) that are close to an earlier one."""
    spark = kept.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    length = F.char_length("_line")
    own = kept.filter(length >= CHARS_PER_EDIT).select(
        F.col("_handle"), F.coalesce(F.col("_first.id"), F.lit(-(1 << 63))).alias("_id"), F.col("_line"))
    index = own.select("_handle", "_id", F.explode(index_keys(F.col("_line"), length, edits)).alias("_key"))
    heads = index.groupBy("_key").agg(F.min_by("_handle", "_id").alias("a"), F.count(F.lit(1)).alias("_n"))
    met = stored(probes(own, edits).join(heads, "_key").filter((F.col("a") != F.col("b")) | (F.col("_n") > 1)), "met")
    ordered = met.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    first = stored(_verified(ordered, kept, edits), "first")

    # second round: the lists that an open probe asks for. A line probes with
    # its own segments too, so all lines of a list stand in ``met`` under its key
    open_probes = met.filter("_n > 1").join(first.select(F.col("_handle").alias("b")), "b", "left_anti")
    asked = open_probes.select("_key").distinct()
    listed = stored(met.filter("_n > 1").join(asked, "_key", "left_semi").select(
        F.col("b").alias("_handle"), "_key", "_n").distinct(), "listed")
    few = (listed.select("_handle", "_n").union(open_probes.select("b", "_n"))
           .groupBy(F.col("_handle").alias("a")).agg(F.max("_n").alias("_most")))
    line = F.col("_la")
    prefixes = F.when(F.col("_most") > LONG_LIST, prefix_counts(line)).otherwise(F.array().cast("array<long>"))
    letters = stored(_texts(few, kept, "a").select(
        "a", F.coalesce(F.col("_fa.id"), F.lit(-(1 << 63))).alias("_ida"), letter_counts(line).alias("_ca"),
        prefixes.alias("_pa")), "letters")
    rows = listed.select(F.col("_handle").alias("a2"), "_key").join(letters.withColumnRenamed("a", "a2"), "a2")
    asking = open_probes.join(letters.select(F.col("a").alias("b"), F.col("_ida").alias("_idb"),
                                             F.col("_ca").alias("_cb"), F.col("_pa").alias("_pb")), "b")
    near = ((letters_apart(F.col("_ca"), F.col("_cb")) <= 2 * edits)
            & (prefixes_apart(F.col("_pa"), F.col("_pb")) <= 2 * edits))
    rest = (asking.join(rows, "_key")
            .filter((F.col("a2") != F.col("b")) & (F.col("a2") != F.col("a")) & (F.col("_ida") <= F.col("_idb")) & near)
            .select(F.least("a2", "b").alias("a"), F.greatest("a2", "b").alias("b")).distinct())
    second = _verified(rest.join(ordered, ["a", "b"], "left_anti"), kept, edits)
    return first.select("_line_hash").union(second.select("_line_hash")).distinct()


def decide(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS) -> DataFrame:
    """One row per document that loses lines: _line_m (mark), _line_repeats and
    _line_nears (arrays of the places of lines equal, or only close, to an
    earlier line)."""
    spark = docs.sparkSession
    folder = ensure_checkpoint_dir(spark).rstrip("/") + "/lines-" + uuid.uuid4().hex
    every = lines(docs, key, text)
    different = every.groupBy("_line_hash").agg(
        F.min("_line_at").alias("_first"), F.count(F.lit(1)).alias("_k"), F.first("_line").alias("_line"))
    table = "lines_" + uuid.uuid4().hex
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # its files are in the shared folder; only its name is in the catalog
    (different.withColumn("_handle", F.xxhash64("_line")).write.bucketBy(buckets, "_line_hash")
     .option("path", f"{folder}/different").saveAsTable(table))
    try:
        kept = spark.table(table)
        near_lines(kept, folder, edits).write.parquet(f"{folder}/near")
        later = spark.read.parquet(f"{folder}/near").withColumn("_near", F.lit(True))
        # of the lines only those that are dropped somewhere go on
        verdicts = (kept.select("_line_hash", "_first", "_k").join(later, "_line_hash", "left")
                    .filter((F.col("_k") > 1) | F.col("_near"))
                    .select("_line_hash", "_first", F.coalesce("_near", F.lit(False)).alias("_near")))
        verdicts.write.parquet(f"{folder}/verdicts")
    finally:
        spark.sql(f"DROP TABLE {table}")
    verdicts = spark.read.parquet(f"{folder}/verdicts")

    found = every.select("_line_hash", "_line_at").join(verdicts, "_line_hash")
    first = F.col("_line_at") == F.col("_first")
    dropped = found.filter(~first | F.col("_near"))
    place = F.col("_line_at.place")
    return dropped.groupBy(F.col("_line_at.mark").alias("_line_m")).agg(
        F.sort_array(F.collect_set(F.when(~first, place))).alias("_line_repeats"),
        F.sort_array(F.collect_set(F.when(first, place))).alias("_line_nears"))


#: Columns of the result; columns of the documents with these names give way.
RESULT = ("n_lines", "n_repeats", "n_nears", "dropped")


def _judged(docs: DataFrame, key: str, text: str, edits: int, with_text: bool = True) -> DataFrame:
    """``docs``, all columns as they are (or all but the text), plus _line_m,
    _line_n (number of lines), _line_repeats, _line_nears and _line_dropped."""
    none = F.array().cast("array<int>")
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(_line_array(F.col(text))))
    made = docs.withColumns({"_line_m": _mark(key, text), "_line_n": n_lines})
    if not with_text:  # before the join, so that it does not move the texts
        made = made.drop(text)
    dropped = F.coalesce(F.sort_array(F.concat("_line_repeats", "_line_nears")), none)
    return made.join(decide(docs, key, text, edits), "_line_m", "left").withColumn("_line_dropped", dropped)


def _text_left(text: str) -> Column:
    left = F.filter(_line_array(F.col(text)), lambda x, i: ~F.array_contains(F.col("_line_dropped"), i))
    return F.when(F.size("_line_dropped") > 0, F.array_join(left, "\n")).otherwise(F.col(text))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS,
                with_text: bool = True) -> DataFrame:
    """``docs`` plus n_lines, n_repeats, n_nears and dropped (places, from 0);
    its text without the dropped lines, if ``with_text``. Of rows equal in id
    and text, all lose the same lines."""
    none = F.lit(0)
    own = [_text_left(text).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns
           if c not in RESULT and (with_text or c != text)]
    return _judged(docs, key, text, edits, with_text).select(
        *own, F.col("_line_n").alias("n_lines"), F.coalesce(F.size("_line_repeats"), none).alias("n_repeats"),
        F.coalesce(F.size("_line_nears"), none).alias("n_nears"), F.col("_line_dropped").alias("dropped"))


def deduped_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the dropped lines; documents that lost lines and have
    no word left go. Columns as in ``docs``."""
    left = _judged(docs, key, text, EDITS).withColumn("_line_left", _text_left(text))
    empty = F.btrim(F.coalesce(F.col("_line_left"), F.lit("")), F.lit(WHITE_SPACE)) == ""
    return left.filter((F.size("_line_dropped") == 0) | ~empty).select(
        *[F.col("_line_left").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
