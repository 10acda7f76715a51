"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios.

1. Counts. Every labelled training document adds the hashed character n-grams
   it has (each once) to the counts of its class; all labelled training rows
   count, summed within tasks and then by bucket.
2. Scaling. Each bucket's feature is 1 (present) times the log ratio of its
   smoothed shares in toxic and clean documents. Every bucket takes part.
3. Fit. L2 logistic regression on the scaled features and a constant, on a
   sample of labelled rows with a documented bound (``max_fit`` per class, by hash
   of doc_id), by coordinate steps in the dual: one number for each row, a step
   costs the row's n-grams; the intercept is put back to the classes' true shares.
4. Scoring of every whole text is one pass without a shuffle; the weights are
   one array of ``buckets`` floats.

Only the text enters a score. Defined cases: null text is empty and, having no
n-grams, scores the intercept; a row whose label or doc_id is null is not
learned from; conflicting label rows all count; repeated documents count and
are scored each; texts of any length are read whole; rows are fitted in the order of
their class and n-grams, so neither partitions nor ties change the model; with
no label of one class every score is that class's share (0.0 without labels);
empty tables give empty results. Extra columns are ignored unless named in
``keep``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import kept, prepare, schema_of, written

BUCKETS = 1 << 18
SIZES = (4, 6, 8)
SMOOTHING = 1.0
#: Most sampled rows of each class that the linear fit sees (about, by hash).
MAX_FIT = 3000
#: The fit ends when no row's number moves further, or after so many rounds.
TOLERANCE, ROUNDS = 1e-3, 100
THRESHOLD = 0.3


class Grams:
    """The distinct hashed character n-grams of a text."""

    def __init__(self, buckets: int, sizes=SIZES):
        self.shift = np.uint32(32 - int(buckets).bit_length() + 1)
        self.sizes = sizes
        self.seen = np.zeros(buckets, np.int64)

    def __call__(self, text: str) -> np.ndarray:
        c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
        c = c * np.uint32(2654435761) + np.uint32(97)
        parts = []
        for n in self.sizes:
            if len(c) >= n:
                h = c[:len(c) - n + 1].copy()
                for k in range(1, n):
                    h *= np.uint32(16777619)
                    h += c[k:len(c) - n + 1 + k]
                h ^= h >> np.uint32(15)
                h *= np.uint32(2246822519) + np.uint32(2 * n)
                parts.append(h >> self.shift)
        if not parts:
            return np.zeros(0, np.uint32)
        h = np.concatenate(parts)
        at = np.arange(len(h))
        self.seen[h] = at  # of equal ones, one stays
        return h[self.seen[h] == at]


def _count(batches, buckets: int):
    """Counts of a task's documents, and the texts chosen for the fit."""
    grams = Grams(buckets)
    counts = np.zeros((2, buckets), np.int64)
    docs = [0, 0]
    for batch in batches:
        texts, labels, chosen = (batch.column(k).to_pylist() for k in range(3))
        for t, y, c in zip(texts, labels, chosen):
            counts[y][grams(t or "")] += 1
            docs[y] += 1
        mask = pa.array(chosen, pa.bool_())
        rest = batch.filter(mask)
        if rest.num_rows:
            none = pa.nulls(rest.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, rest.column(0), rest.column(1)], names=["bucket", "clean", "toxic", "text", "label"])
    at = np.flatnonzero(counts.any(axis=0))
    if sum(docs):
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at.tolist()], pa.int64()), pa.array([docs[0], *counts[0][at].tolist()], pa.int64()),
             pa.array([docs[1], *counts[1][at].tolist()], pa.int64()),
             pa.nulls(len(at) + 1, pa.string()), pa.nulls(len(at) + 1, pa.int32())],
            names=["bucket", "clean", "toxic", "text", "label"])


def log_ratios(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Log ratio of each bucket's smoothed shares in toxic and clean documents."""
    return (np.log((toxic + SMOOTHING) / (n_toxic + 2 * SMOOTHING))
            - np.log((clean + SMOOTHING) / (n_clean + 2 * SMOOTHING)))


def _step(a: float, margin: float, norm: float) -> float:
    """The share t that solves norm * (t - a) + margin + log(t / (1 - t)) = 0,
    by Newton steps on its log odds within a shrinking bracket."""
    low, high = -margin - norm * (1.0 - a), -margin + norm * a
    u = min(max(math.log(a / (1.0 - a)) if 0.0 < a < 1.0 else 0.0, low), high)
    for _ in range(60):
        t = 1.0 / (1.0 + math.exp(-max(u, -700.0)))
        gap = norm * (t - a) + margin + u
        if gap > 0:
            high = u
        else:
            low = u
        following = u - gap / (1.0 + norm * t * (1.0 - t))
        if not low < following < high:
            following = 0.5 * (low + high)
        if abs(following - u) < 1e-10:
            break
        u = following
    return 1.0 / (1.0 + math.exp(-max(u, -700.0)))


def logistic(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, l2: float = 1.0,
             rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """Weights and intercept of L2 logistic regression on the rows' buckets,
    scaled by ``ratio``, and a constant 1. Each row has a share in (0, 1), by
    which it counts in the weights; a step solves one row's share exactly. Rows
    that stood still rest until all do; the fit ends with a round over all rows."""
    order = np.random.default_rng(1)
    sign = np.where(labels > 0, 1.0, -1.0)
    scaled = np.zeros(len(ratio))
    constant = 0.0
    share = np.full(len(rows), 0.5)
    norm = np.zeros(len(rows))
    for r, s, k in zip(rows, sign, range(len(rows))):
        x = ratio[r]
        norm[k] = (x @ x + 1.0) / l2
        scaled[r] += 0.5 * s / l2 * x
        constant += 0.5 * s / l2
    active = np.arange(len(rows))
    for _ in range(rounds):
        moved = np.zeros(len(rows))
        for k in order.permutation(active):
            r, s = rows[k], sign[k]
            x = ratio[r]
            t = _step(share[k], s * (float(x @ scaled[r]) + constant), norm[k])
            move = moved[k] = t - share[k]
            if move:
                share[k] = t
                scaled[r] += s * move / l2 * x
                constant += s * move / l2
        whole = len(active) == len(rows)
        active = np.flatnonzero(np.abs(moved) >= tolerance)
        if not len(active):
            if whole:
                break
            active = np.arange(len(rows))
    return scaled * ratio, float(constant)


def _fit(batches, buckets: int, ratio: np.ndarray):
    grams = Grams(buckets)
    rows, labels = [], []
    for batch in batches:
        for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append(np.sort(grams(t or "")).astype(np.int32))
            labels.append(y)
    order = sorted(range(len(rows)), key=lambda k: (labels[k], xxhash.xxh64_intdigest(rows[k].tobytes())))
    w, b = logistic([rows[k] for k in order], np.array([labels[k] for k in order], float), ratio)
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *at.tolist()], pa.int64()), pa.array([b, *w[at].tolist()], pa.float64())], names=["bucket", "w"])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", buckets: int = BUCKETS,
          max_fit: int = MAX_FIT) -> tuple[np.ndarray, float]:
    """(weights by bucket, intercept) from ``labels`` (doc_id, toxic 0/1)."""
    spark = docs.sparkSession
    prepare(spark)
    labels = (labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
              .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)))
    total = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        return np.zeros(buckets), (np.inf if 1 in total else -np.inf)
    share = F.when(F.col("label") == 1, min(1.0, max_fit / total[1])).otherwise(min(1.0, max_fit / total[0]))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    rows = (docs.select("doc_id", F.col(text).cast("string").alias("text")).join(labels.hint("merge"), "doc_id")
            .select("text", "label", (place < share).alias("chosen")))
    made = written(rows.mapInArrow(lambda it: _count(it, buckets),
                                   "bucket long, clean long, toxic long, text string, label int"), "toxicity")
    # At most ``buckets`` + 1 rows come to the driver.
    counts = (made.filter(F.col("bucket").isNotNull()).groupBy("bucket")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow())
    at, clean, toxic = (counts.column(c).to_numpy() for c in ("bucket", "clean", "toxic"))
    n0, n1 = (int(c[at == -1].sum()) for c in (clean, toxic))
    if not n0 or not n1:
        return np.zeros(buckets), (np.inf if n1 else -np.inf)
    p, q = np.zeros(buckets), np.zeros(buckets)
    own = at >= 0
    q[at[own]], p[at[own]] = clean[own], toxic[own]
    ratio = log_ratios(q, p, n0, n1)
    chosen = made.filter(F.col("bucket").isNull()).select("text", "label")
    sent = spark.sparkContext.broadcast(ratio)
    # One task fits the model: its rows are bounded by max_fit.
    fitted = (chosen.repartition(1).mapInArrow(lambda it: _fit(it, buckets, sent.value), "bucket long, w double")
              .toArrow())
    bucket, w = fitted.column("bucket").to_numpy(), fitted.column("w").to_numpy()
    weights = np.zeros(buckets)
    weights[bucket[bucket >= 0]] = w[bucket >= 0]
    s1, s0 = min(max_fit, total[1]), min(max_fit, total[0])
    return weights, float(w[bucket == -1].sum()) + np.log(n1 / n0) - np.log(s1 / s0)


def score(docs: DataFrame, weights: np.ndarray, intercept: float, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """``keep`` columns and ``score`` in 0..1."""
    prepare(docs.sparkSession)
    own = kept(docs, keep, ("score",))
    model = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        w = model.value
        grams = Grams(len(w))
        for batch in batches:
            z = np.array([w[grams(t or "")].sum(dtype=np.float64) for t in batch.column(len(own)).to_pylist()])
            s = 1.0 / (1.0 + np.exp(-np.clip(z + intercept, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(own))), pa.array(s, pa.float64())], names=[*own, "score"])

    schema = ", ".join(filter(None, [schema_of(docs, own), "score double"]))
    return docs.select(*own, F.col(text).cast("string")).mapInArrow(run, schema)


def held_out(doc_id) -> F.col:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
