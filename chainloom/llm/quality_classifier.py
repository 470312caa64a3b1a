"""Quality classifier: supervised subword embeddings.

A text's features are its words, the character n-grams of its words (with word edges), and
repetition n-grams (a word equal to the one k places before). Each is hashed to a learned vector;
a document is the average of its features' vectors, and a softmax layer reads the average. Vectors
and layer are trained together by stochastic gradient descent in numpy.

As the layer is linear in the average, a trained model is one number a bucket: a document's logit
is the mean of its features' numbers. Scoring is then vectorised over the bytes of whole texts.

Learning takes at most ``per_class`` labelled texts of each class, those with the smallest hash of
the id, in one task whose size that bounds. The logit is corrected for the classes' true shares.

Defined cases: null, empty or blank text has no features and gets the share of good documents.
Documents labelled with both classes, or with null, are not learned from. With a single class or
none every document gets that share (0.5 if there are no labels). Extra columns are ignored;
repeated rows score alike. A null id is not held out and not learned from. An empty table gives no
rows. Very long texts are scored whole, in parts; only the
learning sample is without texts beyond ``max_bytes``, so that it stays within its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, least_hashes, table, utf8

BITS = 18
PRIME = 0x9E3779B97F4A7C15
GRAMS = (3, 4, 5)
LAGS = 8
#: Bytes handled at once; texts are cut for this at white space only, and their sums added.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Training:
    per_class: int = 3000
    max_bytes: int = 1 << 20
    dim: int = 8
    epochs: int = 4
    #: Steps at least, for small samples.
    updates: int = 12_000
    rate: float = 0.5
    seed: int = 13


def _mixed(h: np.ndarray, kind: int) -> np.ndarray:
    """Buckets of 64-bit hashes; ``kind`` keeps the sorts of features apart."""
    h = (h + np.uint64(kind * 0x1000193 + 1)) * np.uint64(PRIME)
    h ^= h >> np.uint64(32)
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int32)


def features(text: bytes) -> Iterator[np.ndarray]:
    """Arrays of buckets, one entry for each occurrence of a feature in the text."""
    words = text.split()
    if not words:
        return
    flat = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    gap = flat == 32
    wide = flat.astype(np.uint64)
    inner = np.cumsum(gap, dtype=np.int32)
    rolled = wide[: len(flat) - 2] * np.uint64(0x100000001B3) + wide[1 : len(flat) - 1]
    for n in GRAMS:
        if len(flat) < n:
            break
        m = len(flat) - n + 1
        rolled = rolled[:m] * np.uint64(0x100000001B3) + wide[n - 1 :]
        # No gap inside; one at an edge marks the word's edge.
        whole = inner[n - 2 : n - 2 + m] == inner[:m]
        yield _mixed(rolled[whole], n)
    # Words: sums of mixed characters by place, from one cumulative sum.
    starts = np.flatnonzero(gap)[:-1] + 1
    sizes = np.diff(np.append(starts, len(flat)))  # each word with the gap after it
    within = (np.arange(1, len(flat)) - np.repeat(starts, sizes)).astype(np.uint64)[:-1]
    letters = wide[1 : len(flat) - 1]
    part = (letters + np.uint64(257) * (within + np.uint64(1))) * np.uint64(PRIME)
    part ^= part >> np.uint64(29)
    part *= np.uint64(0xBF58476D1CE4E5B9)
    part[gap[1:-1]] = 0
    word = np.add.reduceat(part, starts - 1)
    yield _mixed(word, 1)
    for k in range(1, LAGS + 1):
        n = int(np.count_nonzero(word[k:] == word[:-k])) if len(word) > k else 0
        if n:
            yield np.full(n, _mixed(np.array([k], np.uint64), 2)[0], np.int32)


def parts_of(text: bytes) -> Iterator[bytes]:
    """A very long text in parts, cut at white space (or, inside a word beyond BLOCK, not at all)."""
    start = 0
    while len(text) - start > BLOCK:
        end = max(text.rfind(b" ", start, start + BLOCK), text.rfind(b"\n", start, start + BLOCK))
        if end <= start:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def train(examples: list[tuple[bytes, int]], conf: Training) -> np.ndarray:
    """One number a bucket, then the bias (for even classes), as float32."""
    rng = np.random.default_rng(conf.seed)
    size = 1 << BITS
    vectors = rng.uniform(-1 / conf.dim, 1 / conf.dim, (size, conf.dim)).astype(np.float32)
    layer, bias = np.zeros((2, conf.dim), np.float32), np.zeros(2, np.float32)
    bags = []
    for text, y in examples:
        found = [f for part in parts_of(text) for f in features(part)]
        if found:
            buckets, n = np.unique(np.concatenate(found), return_counts=True)
            bags.append((buckets, (n / n.sum()).astype(np.float32), y))
    epochs = max(conf.epochs, -(-conf.updates // max(1, len(bags))))
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs if bags else 0):
        for i in rng.permutation(len(bags)):
            buckets, weight, y = bags[i]
            rate = np.float32(conf.rate * (1 - done / steps))
            done += 1
            hidden = weight @ vectors[buckets]
            logits = layer @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ layer
            layer -= rate * np.outer(p, hidden).astype(np.float32)
            bias -= rate * p
            # The average divides each feature's gradient; the root gives it back in part, as rare features would hardly move.
            vectors[buckets] -= rate * np.outer(np.sqrt(weight), back)
    return np.append(vectors @ (layer[1] - layer[0]), bias[1] - bias[0]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: bytes | None
    #: Log odds of the good class among all labels, and its share.
    prior: float
    share: float


def fit(docs: DataFrame, labels: DataFrame, conf: Training = Training()) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, quality. Only rows of both are learned from."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z").select("doc_id", "y", F.xxhash64("doc_id").alias("h"))
    totals = {int(r["y"]): int(r["n"]) for r in known.groupBy((F.col("y") == 1).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(totals.values())
    share = (totals.get(1, 0) + 0.5) / (n + 1)
    if len(totals) < 2:
        return Model(None, 0.0, share)
    ranked = least_hashes(known, "y", conf.per_class)
    chosen = docs.select("doc_id", utf8().alias("text")).where(F.length("text") <= conf.max_bytes).join(F.broadcast(ranked.select("doc_id", "y", "h")), "doc_id")  # per_class rows a class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((h, d, t, int(y == 1)) for b in batches for h, d, t, y in zip(*(b.column(c).to_pylist() for c in ("h", "doc_id", "text", "y"))))
        yield pa.RecordBatch.from_arrays([pa.array([train([(t, y) for _, _, t, y in rows], conf).tobytes()])], names=["weights"])

    rows = chosen.repartition(1).mapInArrow(run, "weights binary").collect()  # one model
    odds = np.log((totals[1] + 0.5) / (totals[0] + 0.5))
    return Model(bytes(rows[0]["weights"]) if rows else None, float(odds), share)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model.weights)  # 2 ** BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = None if shared.value is None else np.frombuffer(shared.value, np.float32)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                total, n = 0.0, 0
                if weights is not None:
                    for part in parts_of(text):
                        for f in features(part):
                            total += float(weights[f].sum(dtype=np.float64))
                            n += len(f)
                out.append(model.share if not n else 1 / (1 + np.exp(-np.clip(total / n + weights[-1] + model.prior, -50, 50))))
            scores = np.array(out, np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "doc_id long, score double, predicted int")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(fold_of(F.col("doc_id"), 4) != 2))
    return score(docs, model).select("doc_id", (F.coalesce(fold_of(F.col("doc_id"), 4), F.lit(0)) == 2).alias("held_out"), "score", "predicted")
