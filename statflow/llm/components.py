"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.session import ensure_checkpoint_dir

EDGES_PER_FILE = 50_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest node around it."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).filter("a <> b").distinct()


def _stored(edges: DataFrame, parts: int | None = None) -> DataFrame:
    """``edges`` in the shared folder, in at most ``parts`` files."""
    return (edges if parts is None else edges.coalesce(parts)).checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of ``edges`` (a, b: long) the smallest
    node it is connected to. A round halves the distances, about; each is
    checkpointed. No edges: no rows; NULL ends are ignored."""
    ensure_checkpoint_dir(edges.sparkSession)
    now, mark = _stored(edges.select("a", "b").filter("a <> b").distinct()), None
    while True:
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())
        if new[0] == 0 or new == mark:
            break
        mark = new
        # what a round leaves is at most its edges: few edges go to few files
        parts = 1 + new[0] // EDGES_PER_FILE
        now = _stored(_small_star(_large_star(now)), parts)
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
