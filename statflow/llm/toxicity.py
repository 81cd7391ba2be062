"""Toxicity: a convolutional text classifier trained in numpy.

Words (runs of letters and digits, A-Z lower-cased) are looked up as sums of
hashed embeddings: of the whole word and of its first bytes, so that endings
matter less. Filters of several widths slide over the words; each filter's
largest value over the whole text, whatever its length, goes into a logistic
layer. Embedding rows start with their feature's log-odds between the labels
(rows seen in too few sampled texts stay zero) and everything is trained by
gradient descent; a max passes its gradient to the place that gave it.

The classifier is fitted on all words of all labelled texts, in shards of about
``SHARD`` bytes by a hash of the id. In each epoch every shard goes on from the
same model; what its descent has changed is averaged, a row of the embedding
table over the shards that have changed it. Changes are added up as whole
numbers, so the model does not depend on the order of tasks. A fifth of the
labelled texts (by a hash of the id) is not descended on: it sets Platt scaling
of the scores and, for each language with enough of them, the threshold with the
best F1. Scores see the text alone. Scoring runs over all words of all texts.

Defined results: texts without words (NULL, empty, blank) get the score of the
bias alone; repeated rows score alike; of labelled texts with one id the least is
fitted; an empty table gives no rows; without
usable labels of both kinds every score is the share of toxic labels (0 with
no labels); other columns pass through, but ``held_out``, ``score``,
``predicted``, ``threshold`` and ``toxic`` are set here. A language without a
threshold of its own uses ``THRESHOLD``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.store import release, written
from statflow.llm.tokens import forget_encoders
from statflow.llm.wordhash import IS_PUNCTUATION, blocks

BUCKETS = 1 << 18
PREFIXES = (4, 6)
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 8
MIN_TEXTS = 5
#: Bytes of labelled text, about, that are fitted in one task.
SHARD = 16 << 20
#: Words of a text that are embedded at a time.
PIECE = 1 << 16
EPOCHS = 6
THRESHOLD = 0.3
LANGUAGE_ROWS = 40
#: About so many bytes of rows are scored, and given back, at a time.
SLICE = 4 << 20
#: Sums are of whole multiples of 1 / ONE; logits of held-out texts
#: are counted in steps of 1 / STEPS.
ONE = float(1 << 32)
STEPS = 1 << 12
#: Columns of what an epoch has changed in a row.
CHANGES = [f"{kind}{i}" for kind in ("value", "square") for i in range(DIM)]
#: A word's features: rows of the embedding table it adds up.
FEATURES = 1 + len(PREFIXES)


def features(block) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's features (words x FEATURES) and each text's
    first word."""
    starts, ends, first = block.words(IS_PUNCTUATION)
    rolled = block.rolled()
    spans = [ends] + [np.minimum(ends, starts + p) for p in PREFIXES]
    # which of the features it is counts, so a short word and a prefix differ
    out = [(block.hashes(rolled, starts, e) + np.uint64(i * 0x9E3779B9)) % np.uint64(BUCKETS)
           for i, e in enumerate(spans)]
    return np.stack(out, axis=1).astype(np.int32), first


@dataclass
class Model:
    rows: np.ndarray  # bucket -> row of the embedding table (0: none)
    table: np.ndarray  # row x DIM
    filters: dict[int, np.ndarray]  # width -> width x DIM x FILTERS
    shift: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def products(self) -> np.ndarray:
        """Embedding table times each filter position, side by side."""
        return np.concatenate([self.table @ self.filters[w][k] for w in WIDTHS for k in range(w)],
                              axis=1).astype(np.float32)


def labelled(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id",
             text: str = "text", lang: str = "lang") -> DataFrame:
    """Every labelled text, on disk: key, toxic, lang, text, held (not descended
    on) and shard."""
    usable = (labels.select(F.col(key).alias("_key"), F.col("toxic").cast("int").alias("_toxic"))
              .filter(F.col("_toxic").isin(0, 1) & F.col("_key").isNotNull())
              .groupBy("_key").agg(F.max("_toxic").alias("_toxic")))
    usable = usable.withColumn(key, F.col("_key")).filter(train).drop(key)
    language = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    texts = docs.filter(train).select(F.col(key).alias("_key"), F.struct(
        F.col(text).alias("text"), language.alias("lang")).alias("_row"))
    found = texts.join(usable, "_key").groupBy("_key").agg(
        F.max("_toxic").alias("toxic"), F.min("_row").alias("_row"))
    found = written(found.select(
        F.col("_key").cast("long").alias("key"), "toxic", "_row.lang", "_row.text",
        (F.pmod(F.xxhash64("_key", F.lit(5)), F.lit(5)) == 0).alias("held")), "labelled")
    release(docs.sparkSession)
    size = found.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return found.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(-(-size // SHARD) or 1)))


class _Text:
    __slots__ = ("rows", "y", "weight", "lang")

    def __init__(self, rows, y, weight, lang):
        self.rows, self.y, self.weight, self.lang = rows, y, weight, lang


def _texts(table, rows: np.ndarray | None = None, weight=(1.0, 1.0)) -> list[_Text]:
    """A shard's texts by their keys, words as buckets or as ``rows`` of these."""
    table = table.sort_by("key")
    if "words" in table.column_names:
        words = [np.frombuffer(w.as_buffer(), np.int32).reshape(-1, FEATURES) for w in table["words"]]
        words = words if rows is None else [rows[w] for w in words]
    else:
        words = []
        for chunk in table["text"].chunks:
            for block in blocks(chunk):
                buckets, first = features(block)
                buckets = buckets if rows is None else rows[buckets]
                words += [buckets[lo:hi] for lo, hi in zip(first[:-1], first[1:])]
    return [_Text(w, y, weight[y], lang) for w, y, lang in
            zip(words, table["toxic"].to_pylist(), table["lang"].to_pylist())]


def _summed(found, run, sums: list[str], by: str = "id long"):
    """What ``run`` makes of each shard's table, its ``sums`` added up ``by``
    columns of which it gives no two equal rows; of an Arrow table, a single shard."""
    if not isinstance(found, DataFrame):
        return run(found)
    rows = found.groupBy("shard").applyInArrow(run, ", ".join([by, *(f"{name} long" for name in sums)]))
    names = [c for c in rows.columns if c not in sums]
    got = rows.groupBy(*names).agg(*(F.sum(name).alias(name) for name in sums)).toArrow()
    del rows
    release(found.sparkSession)
    return got


def _forward(model: Model, rows: np.ndarray):
    """Filter values' maxima and the places that gave them."""
    n, more = len(rows), max(WIDTHS) - 1
    if n == 0:
        return np.zeros(FILTERS * len(WIDTHS)), [np.zeros(FILTERS, int) for _ in WIDTHS]
    top, at = [], []
    for lo in range(0, n, PIECE):
        x, here = _embedded(model, rows[lo:lo + PIECE + more]), min(PIECE, n - lo)
        x = np.concatenate([x, np.zeros((here + more - len(x), DIM))])
        for i, w in enumerate(WIDTHS):
            z = sum(x[k:k + here] @ model.filters[w][k] for k in range(w)) + model.shift[w]
            place = z.argmax(axis=0)
            value = np.maximum(z[place, np.arange(FILTERS)], 0.0)
            if lo == 0:
                top.append(value)
                at.append(place)
            else:
                at[i] = np.where(value > top[i], place + lo, at[i])
                top[i] = np.maximum(value, top[i])
    return np.concatenate(top), at


def _embedded(model: Model, rows: np.ndarray) -> np.ndarray:
    return model.table[rows].sum(axis=1)


def _logit(model: Model, rows: np.ndarray) -> float:
    return float(_forward(model, rows)[0] @ model.weights + model.bias)


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _counted(table):
    """Texts of each label with a bucket (those descended on), and numbers of
    texts descended on (-1) and held (-2)."""
    import pyarrow as pa

    forget_encoders()
    seen, texts = np.zeros((2, BUCKETS), np.int64), np.zeros((2, 2), np.int64)
    for t, held in zip(_texts(table), table.sort_by("key")["held"].to_pylist()):
        texts[t.y, int(held)] += 1
        if not held:
            seen[t.y, np.unique(t.rows)] += 1
    at = np.flatnonzero(seen.any(axis=0))
    clean, toxic = np.concatenate([texts, seen[:, at]], axis=1)
    return pa.table({"id": np.concatenate([[-1, -2], at]), "clean": clean, "toxic": toxic})


def train(found, share: dict[int, int], seed: int = 5) -> Model | None:
    """Fits the classifier to all labelled texts: shards as :func:`labelled` gives
    them, or an Arrow table with their words. ``share``: labelled rows of each
    label in the whole table. None without both labels."""
    rng = np.random.default_rng(seed)
    if not isinstance(found, DataFrame):
        held = rng.random(found.num_rows) < 0.2
        found = found.sort_by("key").append_column("held", [held]).append_column("shard", [np.zeros(len(held), int)])
    got = _summed(found, _counted, ["clean", "toxic"])
    at, seen = got["id"].to_numpy(), np.stack([got[y].to_numpy() for y in ("clean", "toxic")])
    n, n_held = (seen[:, at == i].sum(axis=1) for i in (-1, -2))
    counts = n + n_held
    if not counts.all():
        return None
    kept = (at >= 0) & (seen.sum(axis=0) >= MIN_TEXTS)
    order = np.argsort(at[kept])
    kept, seen = at[kept][order], seen[:, kept][:, order]
    rows = np.zeros(BUCKETS, np.int32)
    rows[kept] = np.arange(1, len(kept) + 1)
    odds = (np.log((seen[1] + 0.5) / (max(1, n[1]) + 1))
            - np.log((seen[0] + 0.5) / (max(1, n[0]) + 1)))
    flat = np.zeros((_size(len(kept) + 1), DIM))
    own = _views(flat)
    own["weights"][:], own["bias"][:] = 0.1, -1.0
    own["table"][:] = rng.normal(0, 0.02, own["table"].shape)
    own["table"][1:, 0] += odds / 4
    own["table"][0] = 0
    for w in WIDTHS:
        own[f"f{w}"][:] = rng.normal(0, 0.1, (w, DIM, FILTERS))
        own[f"f{w}"][:, 0, :] += 1 / w
    weight = tuple(share[y] / int(counts[y]) for y in (0, 1))
    _descend_all(_held(found, False), flat, rows, weight, float(np.dot(n, weight) / max(1, n.sum())), seed)
    model = _model(rows, flat)
    _calibrate(model, *_logits(_held(found, True) if n_held.any() else found, model), weight)
    return model


def _held(found, held: bool):
    if isinstance(found, DataFrame):
        return found.filter(F.col("held") == held)
    return found.filter(found["held"] if held else [not h for h in found["held"].to_pylist()])


def _shapes() -> dict[str, tuple[int, ...]]:
    return {"weights": (FILTERS * len(WIDTHS),), "bias": (1,), **{f"f{w}": (w, DIM, FILTERS) for w in WIDTHS},
            **{f"s{w}": (FILTERS,) for w in WIDTHS}}


def _size(rows: int) -> int:
    """Rows of DIM numbers that hold all parameters, ``rows`` of them the table."""
    return rows + sum(-(-int(np.prod(shape)) // DIM) for shape in _shapes().values())


def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The parameters that rows of DIM numbers hold, by name."""
    out, lo = {}, 0
    for name, shape in _shapes().items():
        n = int(np.prod(shape))
        out[name] = flat[lo:].reshape(-1)[:n].reshape(shape)
        lo += -(-n // DIM)
    return {**out, "table": flat[lo:]}


def _model(rows: np.ndarray, flat: np.ndarray) -> Model:
    own = _views(flat)
    return Model(rows, own["table"], {w: own[f"f{w}"] for w in WIDTHS}, {w: own[f"s{w}"] for w in WIDTHS},
                 own["weights"], float(own["bias"][0]))


def _descend_all(found, flat: np.ndarray, rows: np.ndarray, weight: tuple[float, float], mean: float,
                 seed: int) -> None:
    """The epochs: every shard goes on from the same parameters and sums of
    squares; a row's changes are averaged over the shards that have changed it."""
    squares = np.full(flat.shape, 1e-3)
    for epoch in range(EPOCHS):
        shared = _shared(found, (flat, squares, rows))
        got = _summed(found, _epoch(shared, weight, mean, (seed, epoch)), ["shards", *CHANGES])
        change = np.stack([got[name].to_numpy() for name in CHANGES], axis=1) / ONE / got["shards"].to_numpy()[:, None]
        flat[got["id"].to_numpy()] += change[:, :DIM]
        squares[got["id"].to_numpy()] += change[:, DIM:]
        shared.unpersist()


def _epoch(shared, weight: tuple[float, float], mean: float, seed: tuple[int, int]):
    def run(table):
        """The rows that an epoch over a shard has changed, and by what."""
        import pyarrow as pa

        forget_encoders()
        before, old, rows = shared.value
        after, new = before.copy(), old.copy()
        rng = np.random.default_rng([*seed, table["shard"][0].as_py()])
        _descend(after, new, rows, _texts(table, rows, weight), mean, rng)
        at = np.flatnonzero((new != old).any(axis=1))
        change = np.rint(np.concatenate([after[at] - before[at], new[at] - old[at]], axis=1) * ONE)
        return pa.table([at, np.ones(len(at), np.int64), *change.astype(np.int64).T], names=["id", "shards", *CHANGES])

    return run


class _Here:
    """What a broadcast is to the workers, in the driver."""

    def __init__(self, value):
        self.value = value

    def unpersist(self):
        pass


def _shared(found, value):
    return found.sparkSession.sparkContext.broadcast(value) if isinstance(found, DataFrame) else _Here(value)


def _descend(flat: np.ndarray, squares: np.ndarray, rows: np.ndarray, texts: list[_Text], mean: float, rng,
             rate: float = 0.05, batch: int = 32) -> None:
    """An epoch of Adagrad over the weighted log loss, by the ``mean`` weight."""
    model, values, sums = _model(rows, flat), _views(flat), _views(squares)

    def step(name, grad, at=slice(None)):
        s = sums[name]
        s[at] += grad * grad
        values[name][at] -= rate * grad / np.sqrt(s[at])

    order = rng.permutation(len(texts))
    for lo in range(0, len(order), batch):
        part = [texts[i] for i in order[lo:lo + batch]]
        g_w, g_b = np.zeros_like(model.weights), np.zeros(1)
        g_f = {w: np.zeros_like(model.filters[w]) for w in WIDTHS}
        g_s = {w: np.zeros(FILTERS) for w in WIDTHS}
        hit_rows, hit_grads = [], []
        model.bias = float(values["bias"][0])
        for t in part:
            top, at = _forward(model, t.rows)
            d = (_sigmoid(top @ model.weights + model.bias) - t.y) * t.weight / mean / len(part)
            g_w += d * top
            g_b += d
            if not len(t.rows):
                continue
            for i, w in enumerate(WIDTHS):
                own = slice(i * FILTERS, (i + 1) * FILTERS)
                dz = d * model.weights[own] * (top[own] > 0)
                g_s[w] += dz
                for k in range(w):
                    place = at[i] + k
                    inside = place < len(t.rows)
                    there = t.rows[place[inside]]
                    g_f[w][k][:, inside] += _embedded(model, there).T * dz[inside]
                    hit_rows.append(there.ravel())
                    hit_grads.append(np.repeat((model.filters[w][k] * dz).T[inside], FEATURES, axis=0))
        step("weights", g_w + 1e-4 * model.weights)
        step("bias", g_b)
        for w in WIDTHS:
            step(f"f{w}", g_f[w] + 1e-4 * model.filters[w])
            step(f"s{w}", g_s[w])
        if hit_rows:
            ids, back = np.unique(np.concatenate(hit_rows), return_inverse=True)
            g = np.zeros((len(ids), DIM))
            np.add.at(g, back, np.concatenate(hit_grads))
            step("table", g, ids)
            model.table[0] = 0


def _logits(found, model: Model):
    """Logits of texts, those up to 1 / STEPS apart as one: logits, labels,
    numbers, languages."""
    shared = _shared(found, model)

    def run(table):
        import pyarrow as pa

        forget_encoders()
        own, sums = shared.value, {}
        for t in _texts(table, own.rows):
            z = _logit(own, t.rows)
            place = (t.lang or "", 2 * int(np.floor(z * STEPS)) + t.y)
            n, total = sums.get(place, (0, 0))
            sums[place] = n + 1, total + round(z * ONE)
        return pa.table({"lang": pa.array([k[0] for k in sums], pa.string()),
                         "id": pa.array([k[1] for k in sums], pa.int64()),
                         "n": pa.array([v[0] for v in sums.values()], pa.int64()),
                         "total": pa.array([v[1] for v in sums.values()], pa.int64())})

    got = _summed(found, run, ["n", "total"], "lang string, id long").sort_by([("lang", "ascending"), ("id", "ascending")])
    shared.unpersist()
    n = got["n"].to_numpy()
    return got["total"].to_numpy() / ONE / n, got["id"].to_numpy() % 2, n, np.array(got["lang"].to_pylist())


def _calibrate(model: Model, z: np.ndarray, y: np.ndarray, n: np.ndarray, langs: np.ndarray,
               weight: tuple[float, float]) -> None:
    """Platt scaling, then each language's best threshold."""
    weight, toxic = np.where(y == 1, weight[1], weight[0]) * n, int((n * y).sum())
    if 0 < toxic < n.sum():
        target = np.where(y == 1, (toxic + 1) / (toxic + 2), 1 / (n.sum() - toxic + 2))
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps with a little damping
            p = _sigmoid(a * z + b)
            g = np.array([(weight * (p - target) * z).sum(), (weight * (p - target)).sum()])
            r = weight * np.maximum(p * (1 - p), 1e-9)
            h = np.array([[(r * z * z).sum(), (r * z).sum()], [(r * z).sum(), r.sum()]])
            da, db = np.linalg.solve(h + 1e-2 * np.eye(2), g)
            a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
        if a > 0.05:
            model.scale = (float(a), float(b))
    score = _sigmoid(model.scale[0] * z + model.scale[1])
    for lang in sorted(set(langs.tolist()) - {""}):
        own = langs == lang
        if n[own].sum() < LANGUAGE_ROWS or not 5 <= (n * y)[own].sum() < n[own].sum():
            continue
        best = (-1.0, THRESHOLD)
        for t in np.round(np.arange(0.1, 0.91, 0.05), 2):
            hit = score[own] >= t
            good = (weight[own] * y[own] * hit).sum()
            f1 = 2 * good / max(1e-9, (weight[own] * hit).sum() + (weight[own] * y[own]).sum())
            if f1 > best[0] + 1e-9 or (abs(f1 - best[0]) <= 1e-9
                                       and abs(t - THRESHOLD) < abs(best[1] - THRESHOLD)):
                best = (f1, float(t))
        model.thresholds[str(lang)] = best[1]


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, key: str = "doc_id",
        text: str = "text", lang: str = "lang") -> tuple[Model | None, float]:
    """The model, and the share of toxic labels, counted over all rows. The table
    of at most BUCKETS rows is what comes to the driver, once an epoch."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col(key).isNotNull()).filter(train_rows)
    share = {r["y"]: r["n"] for r in usable.groupBy(F.col("toxic").cast("int").alias("y"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    found = labelled(docs, labels, train_rows, key, text, lang)
    toxic = share.get(1, 0) / max(1, sum(share.values()))
    return train(found, share), toxic


def score(docs: DataFrame, model: Model | None, share: float = 0.0, text: str = "text",
          lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) plus score, predicted (score >=
    THRESHOLD), the language's threshold and toxic (score >= threshold)."""
    kept = [c for c in keep or docs.columns if c not in ("score", "predicted", "threshold", "toxic")]
    if model is None:
        scored = docs.select(*kept, F.lit(float(share)).alias("score"))
    else:
        products, weights, bias = model.products(), model.weights, model.bias
        shifts = np.concatenate([model.shift[w] for w in WIDTHS])
        a, b = model.scale
        # the model is bounded by the number of buckets
        shared = docs.sparkSession.sparkContext.broadcast((model.rows, products))

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            forget_encoders()
            rows_of, table = shared.value
            for batch in _slices(batches):
                out = np.empty(batch.num_rows)
                for block in blocks(batch.column(source)):
                    buckets, first = features(block)
                    top = _maxima(table, rows_of[buckets], first, shifts)
                    out[block.lo:block.hi] = _sigmoid(a * (top @ weights + bias) + b)
                columns = [batch.column(i) for i in range(len(kept))]
                yield pa.record_batch([*columns, pa.array(out)], names=[*kept, "score"])

        schema = docs.select(*kept, F.lit(0.0).alias("score")).schema
        source = kept.index(text) if text in kept else len(kept)
        scored = docs.select(*kept, *([] if text in kept else [text])).mapInArrow(run, schema)
    threshold = F.lit(THRESHOLD)
    if model is not None and lang in kept:
        for name, t in sorted(model.thresholds.items()):
            threshold = F.when(F.col(lang) == name, F.lit(t)).otherwise(threshold)
    return (scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
            .withColumn("threshold", threshold)
            .withColumn("toxic", F.col("score") >= F.col("threshold")))


def _slices(batches: Iterator) -> Iterator:
    """The batches in slices of at most about ``SLICE`` bytes."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE // max(1, batch.nbytes))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)


def _maxima(table: np.ndarray, rows: np.ndarray, first: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Largest filter values of every text: texts x filters."""
    n, texts = len(rows), len(first) - 1
    out = np.zeros((texts, len(shifts)), np.float32)
    full = np.flatnonzero(first[1:] > first[:-1])
    if not n:
        return out
    y = table[rows[:, 0]]
    for i in range(1, rows.shape[1]):
        y += table[rows[:, i]]
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)  # words up to the text's end
    column = 0
    for i, w in enumerate(WIDTHS):
        z = y[:, column:column + FILTERS].copy()
        for k in range(1, w):
            own = slice(column + k * FILTERS, column + (k + 1) * FILTERS)
            z[:n - k] += np.where((left > k)[:n - k, None], y[k:, own], 0)
        column += w * FILTERS
        own = slice(i * FILTERS, (i + 1) * FILTERS)
        out[full, own] = np.maximum(np.maximum.reduceat(z, first[full], axis=0) + shifts[own], 0)
    return out


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             lang: str = "lang", held_out: Column | None = None,
             keep: list[str] | None = None) -> DataFrame:
    """Fits on the labelled rows that ``held_out`` (a condition on the key)
    leaves, and scores all of ``docs``."""
    if held_out is None:
        held_out = F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
    model, share = fit(docs, labels, ~held_out, key, text, lang)
    return score(docs, model, share, text, lang, keep).withColumn("held_out", held_out)
