"""URL filters: host and path rules, then a list of canonical URLs behind a
blocked Bloom filter.

The list's canonical URLs set bits in blocks of eight 64-bit words, one bit a
word; blocks are made by one aggregation and joined to the pages on the block
number. Pages whose bits are not all set are not listed and go no further; the
few others meet the list in an exact hash join, which removes false positives.
Built-in functions only. Nothing is broadcast by hint: the filter and the list
grow with the list, so Spark chooses by their measured sizes.

Defined results: a NULL url, or one without ``://``, has an empty host and
path, fits no rule and is not listed; repeated rows and ties are judged alike;
an empty list blocks nothing; an empty table gives no rows; other columns pass
through, but names starting with ``_url`` are reserved.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter per listed URL, and bits per block.
BITS_PER_URL = 16
BLOCK_WORDS = 8
BLOCK_BITS = BLOCK_WORDS * 64
#: Odd multipliers under 2^31, one per word of a block.
MULTIPLIERS = (0x47B6137B, 0x44974D91, 0x5824AD5B, 0x22B7289D,
               0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1),
                       string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(host: Column, path: Column) -> Column:
    """Host without ``www.``, path without closing slashes; scheme, query and
    fragment do not count. NULL without a host."""
    bare = F.regexp_replace(host, r"^www\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, "/+$", "")))


def first_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (as host + path) and its verdict, or NULLs.
    ``rules``: (verdict, host, path); a rule fits its host and subdomains."""
    name = verdict = F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = (((host == rule_host) | F.endswith(host, F.lit("." + rule_host)))
                & F.startswith(path, F.lit(rule_path)))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def _block_and_masks(url: Column, blocks: int) -> list[Column]:
    h = F.xxhash64(url)
    block = F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks).cast("long"))
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    one = F.lit(1).cast("long")
    bits = [F.shiftright((low * F.lit(m)).bitwiseAND(F.lit(0xFFFFFFFF)), 26).cast("int")
            for m in MULTIPLIERS]
    return [block.alias("_url_block")] + [
        F.call_function("shiftleft", one, b).alias(f"_url_m{i}") for i, b in enumerate(bits)]


def bloom_blocks(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """The filter: one row per block that has bits set."""
    marks = listed.select(*_block_and_masks(F.col(url), blocks))
    return marks.groupBy("_url_block").agg(
        *[F.bit_or(f"_url_m{i}").alias(f"_url_w{i}") for i in range(BLOCK_WORDS)])


def bloom_size(urls: int) -> int:
    """Blocks for a list of so many URLs."""
    return max(1, -(-urls * BITS_PER_URL // BLOCK_BITS))


def mark_listed(pages: DataFrame, listed: DataFrame, canonical: str, blocks: int,
                name: str = "listed") -> DataFrame:
    """``pages`` plus boolean ``name``: its ``canonical`` is in ``listed``
    (one column of that name, distinct and not NULL). Rows without one are
    dealt over all blocks, by a hash of the row."""
    columns = [F.col(f"`{c}`") for c in pages.columns]
    block, *masks = _block_and_masks(F.col(canonical), blocks)
    spread = F.pmod(F.xxhash64(*columns), F.lit(blocks).cast("long"))
    masks = [F.when(F.col(canonical).isNull(), spread).otherwise(block).alias("_url_block"), *masks]
    probed = pages.select("*", *masks).join(bloom_blocks(listed, canonical, blocks),
                                            "_url_block", "left")
    possible = F.col(canonical).isNotNull()
    for i in range(BLOCK_WORDS):
        possible &= F.col(f"_url_w{i}").bitwiseAND(F.col(f"_url_m{i}")) == F.col(f"_url_m{i}")
    marked = probed.withColumn("_url_possible", F.coalesce(possible, F.lit(False)))
    misses = marked.filter(~F.col("_url_possible")).select(*columns, F.lit(False).alias(name))
    exact = listed.select(F.col(canonical).alias("_url_listed")).hint("shuffle_hash")
    hits = (marked.filter("_url_possible")
            .join(exact, F.col(canonical) == F.col("_url_listed"), "left")
            .select(*columns, F.col("_url_listed").isNotNull().alias(name)))
    return misses.unionByName(hits)


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]],
               url: str = "url", listed_url: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule (or NULL) and verdict: the longest
    fitting rule's, else block for listed canonical URLs and allow for others."""
    host, path = url_parts(F.col(url))
    parts = pages.withColumn("_url_host", host).withColumn("_url_path", path)
    parts = parts.withColumn("_url_canon", canonical_url(F.col("_url_host"), F.col("_url_path")))
    lhost, lpath = url_parts(F.col(listed_url))
    canon = (listed.select(canonical_url(lhost, lpath).alias("_url_canon"))
             .filter(F.col("_url_canon").isNotNull()).distinct())
    marked = mark_listed(parts, canon, "_url_canon", bloom_size(canon.count()), "_url_is_listed")
    name, verdict = first_rule(F.col("_url_host"), F.col("_url_path"), rules)
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    method = F.when(F.col("_url_is_listed"), "block").otherwise("allow")
    return marked.select(*[F.col(f"`{c}`") for c in kept], F.col("_url_host").alias("host"), F.col("_url_path").alias("path"),
                         name.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
