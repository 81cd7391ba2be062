"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors of length 1 are rotated by one random rotation, which spreads their
differences evenly over the dimensions, and put into the lists of the nearest
of a number of centroids (k-means over a bounded sample: ``SAMPLE`` vectors by
hash). A query probes the lists whose centroids are nearest, and scans their
vectors in blocks of dimensions: a candidate whose distance so far, scaled to
all dimensions, exceeds the best known k-th distance by more than chance allows
is given up. That bound starts from the sampled vectors in the probed lists and
tightens within a list; the nearest lists that hold enough candidates are scanned
without it, so a query never finds fewer. The sample gives no rows.
Scores of what is left are cosines of the original vectors, in double precision.

Every vector is in a list. Long lists are cut into chunks and their queries
into blocks, so a task gets at most ``CHUNK`` vectors and as many queries.

Defined results: vectors that are NULL, zero, hold NULL or non-finite
components, or differ in length from most, take no part; NULL ids take no part;
a repeated id is found once, by its best vector; ties go to the smaller id; with fewer
candidates than k all are found; an empty table gives no rows; other columns
are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.session import ensure_checkpoint_dir

K = 5
SAMPLE = 20_000
#: Sampled vectors that give a query its first bound.
BOUND_SAMPLE = 4_000
MAX_LISTS = 1024
#: Share of the lists that a query probes.
PROBES = 0.7
CHUNK = 4096
#: Dimensions per block, and how many standard errors a partial distance may
#: be above the bound.
BLOCK = 16
EPSILON = 2.1
ROUNDS = 10

_MATCH = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): ids and vectors that take part, each pair once."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0]["d"] if sizes else 0)).distinct()


def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small values stay above 0
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (0.5 * (centroids * centroids).sum(axis=1) - x @ centroids.T).argmin(axis=1)


def kmeans(x: np.ndarray, lists: int, seed: int = 12) -> np.ndarray:
    """Centroids of at most ``lists`` non-empty clusters."""
    different = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    lists = min(lists, len(different))
    c = different[rng.choice(len(different), lists, replace=False)]
    for _ in range(ROUNDS):
        own = nearest(x, c)
        n = np.bincount(own, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _bytes(rows: DataFrame) -> DataFrame:
    """(id, x): vectors as bytes of doubles."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            v = batch.column(1)
            x = v.flatten().to_numpy().reshape(len(v), -1) if len(v) else np.zeros((0, 1))
            yield pa.record_batch([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())],
                                  names=["id", "x"])

    return rows.mapInArrow(run, "id long, x binary")


def scan(queries: np.ndarray, bounds: np.ndarray, block: np.ndarray, k: int,
         ids: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For every query the rows of ``block`` that survive, of ``k`` different
    ids at the least. Rows and queries are rotated unit vectors; ``bounds`` are
    squared distances."""
    ids = np.arange(len(block)) if ids is None else ids
    d = block.shape[1]
    columns = [np.ascontiguousarray(block[:, lo:lo + BLOCK]) for lo in range(0, d, BLOCK)]
    for i, q in enumerate(queries):
        bound = bounds[i] + 1e-9
        alive, so_far, seen = np.arange(len(block)), np.zeros(len(block)), 0
        for part, lo in zip(columns, range(0, d, BLOCK)):
            diff = part[alive] - q[lo:lo + BLOCK]
            so_far = so_far + (diff * diff).sum(axis=1)
            seen += part.shape[1]
            limit = bound if seen == d else bound * seen / d * (1 + EPSILON / np.sqrt(seen)) ** 2 + 1e-9
            keep = so_far <= limit
            alive, so_far = alive[keep], so_far[keep]
            if not len(alive):
                break
        if len(alive) > k:
            different, back = np.unique(ids[alive], return_inverse=True)
            if len(different) > k:
                own = np.full(len(different), np.inf)
                np.minimum.at(own, back, so_far)
                alive = alive[so_far <= np.partition(own, k - 1)[k - 1] + 1e-9]
        yield i, alive


def search(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id",
           vector: str = "embedding", probes: float = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row
    for which ``is_query`` (a condition on ``id``) holds, itself left out."""
    spark = vectors.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ann-{uuid.uuid4().hex}"
    rows = usable(vectors, key, vector)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    picked = _bytes(rows.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE)).collect()
    picked_ids = np.array([r["id"] for r in picked])
    sample = unit(_matrix([r["x"] for r in picked]))
    turn = rotation(sample.shape[1])
    sample = sample @ turn
    centroids = kmeans(sample, max(1, min(MAX_LISTS, int(np.sqrt(n)))))
    known = sample[:BOUND_SAMPLE]
    shared = spark.sparkContext.broadcast((turn, centroids, picked_ids[:BOUND_SAMPLE], known,
                                           nearest(known, centroids)))

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        r, c, _, _, _ = shared.value
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist()) if batch.num_rows else np.zeros((0, len(r)))
            own = nearest(unit(x) @ r, c) if len(x) else np.zeros(0, int)
            yield pa.record_batch([*batch.columns, pa.array(own, pa.int32())], names=["id", "x", "list"])

    _bytes(rows).mapInArrow(assign, "id long, x binary, list int").write.parquet(folder)
    stored = spark.read.parquet(folder)
    # one row per list comes to the driver
    sizes = np.zeros(len(centroids), np.int64)
    asked = 0
    for row in stored.groupBy("list").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(is_query.cast("int")).alias("q")).collect():
        sizes[row["list"]] = row["n"]
        asked += row["q"]
    different = np.zeros(len(centroids), np.int64)  # every id counts in one list
    for row in stored.groupBy("id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        different[row["list"]] = row["count"]
    chunks = np.maximum(1, -(-sizes // CHUNK))
    probed = max(1, int(np.ceil(probes * len(centroids))))
    query_blocks = int(max(1, -(-asked * probed // len(centroids) // CHUNK)))

    def probe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        r, c, ids, known, lists = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            data, qids = batch.column(1).to_pylist(), batch.column(0).to_numpy()
            q = unit(_matrix(data)) @ r
            far = 2 - 2 * (q @ known.T)
            far[qids[:, None] == ids[None, :]] = 4.0
            order = np.argsort(0.5 * (c * c).sum(axis=1) - q @ c.T, axis=1, kind="stable")
            out = ([], [], [], [], [])
            for i in range(len(q)):
                reach = np.cumsum(different[order[i]])
                enough = int(np.searchsorted(reach, k + 1)) + 1
                most = max(probed, enough)
                there = np.isin(lists, order[i][:most])
                _, one = np.unique(ids[there], return_inverse=True)
                near = np.full(len(one), np.inf)  # by id
                np.minimum.at(near, one, far[i][there])
                near = np.sort(near[near < np.inf])
                kth = float(max(0.0, near[k - 1])) if len(near) >= k else 4.0
                for place, own in enumerate(order[i][:most]):
                    bound = float("inf") if place < enough else kth
                    for chunk in range(chunks[own]):
                        for column, value in zip(out, (own, chunk, qids[i], data[i], bound)):
                            column.append(value)
            for lo in range(0, len(out[0]), 20_000):
                own = [column[lo:lo + 20_000] for column in out]
                yield pa.record_batch([pa.array(own[0], pa.int32()), pa.array(own[1], pa.int32()),
                                       pa.array(own[2], pa.int64()), pa.array(own[3], pa.binary()),
                                       pa.array(own[4])], names=["list", "chunk", "query_id", "q", "bound"])

    block_of = F.pmod(F.xxhash64("query_id", F.lit(5)), F.lit(query_blocks)).cast("int")
    asks = (stored.filter(is_query).select("id", "x")
            .mapInArrow(probe, "list int, chunk int, query_id long, q binary, bound double")
            .withColumn("block", block_of))
    count = F.element_at(F.array(*[F.lit(int(x)) for x in chunks]), F.col("list") + 1) \
        if len(set(chunks.tolist())) > 1 else F.lit(int(chunks[0]))
    held = (stored.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(4)), count).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))

    def find(_, left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        r = shared.value[0]
        x, ids = _matrix(left["x"].tolist()), left["id"].to_numpy()
        q, qids = _matrix(right["q"].tolist()), right["query_id"].to_numpy()
        rows_q, rows_v, scores = [], [], []
        norm = np.sqrt((x * x).sum(axis=1))
        turned_q = unit(q) @ r
        for i, alive in scan(turned_q, right["bound"].to_numpy(), unit(x) @ r, k + 1, ids):
            alive = alive[ids[alive] != qids[i]]
            score = (x[alive] * q[i]).sum(axis=1) / (norm[alive] * np.sqrt((q[i] * q[i]).sum()))
            best = np.lexsort((ids[alive], -score))
            best = best[np.sort(np.unique(ids[alive][best], return_index=True)[1])[:k]]
            rows_q.append(np.full(len(best), qids[i]))
            rows_v.append(ids[alive][best])
            scores.append(score[best])
        return pd.DataFrame({"query_id": np.concatenate(rows_q), "vec_id": np.concatenate(rows_v),
                             "score": np.concatenate(scores)})

    keys = ["list", "chunk", "block"]
    matches = held.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(find, _MATCH)
    matches = matches.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (matches.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
