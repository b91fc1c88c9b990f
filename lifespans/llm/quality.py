"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .storage import bounded_batches
from .textual import runs_of_words

BUCKETS = 1 << 18
_CLASS = np.ones(256, np.uint64)  # a byte's class in a word shape: letters and digits pooled, each punctuation its own
_CLASS[65:91], _CLASS[48:58] = 2, 3
for _c in range(33, 128):
    if not chr(_c).isalnum():
        _CLASS[_c] = _c
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def _bucket(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    return (x >> np.uint64(46)).astype(np.int32)


def ngram_buckets(data: bytes) -> tuple[list[np.ndarray], int]:
    """Hash buckets of a text's word n-grams and its number of words.

    N-grams are single words, pairs of words, word shapes and pairs of shapes; a shape is the classes of a word's first
    two and last two bytes and whether the word repeats the one before.  A long text is read in parts of about 1 MB; the
    last word of a part goes on into the next, so the n-grams are those of the whole text.
    """
    out, n = [], 0
    word = shape = np.empty(0, np.uint64)
    for words in runs_of_words(data):
        if not words:
            continue
        n += len(words)
        words_before, shape_before = word[-1:], shape[-1:]
        word = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        ends = np.frombuffer(b"".join([(w[:2] + w[-2:])[:4].ljust(4, b"~") for w in words]), np.uint8).reshape(-1, 4)
        c = _CLASS[ends]
        run = np.r_[words_before, word]
        repeats = np.r_[np.zeros(1 - len(words_before), bool), run[1:] == run[:-1]].astype(np.uint64)
        shape = (((c[:, 0] * np.uint64(128) + c[:, 1]) * np.uint64(128) + c[:, 2]) * np.uint64(128) + c[:, 3]) * np.uint64(2) + repeats
        shape = shape * _MIX[1] + np.uint64(1)
        shapes = np.r_[shape_before, shape]
        out += [_bucket(word), _bucket(shape)]
        if len(run) > 1:
            out += [_bucket(run[:-1] * _MIX[1] ^ run[1:] * _MIX[2]), _bucket(shapes[:-1] * _MIX[2] ^ shapes[1:])]
    return out, n


def _features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values): counts over the square root of the number of words."""
    parts, n = ngram_buckets(data)
    if not n:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    index, count = np.unique(np.concatenate(parts), return_counts=True)
    return index.astype(np.int32), (count / np.sqrt(n)).astype(np.float32)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs=2, alpha=0.1, beta=1.0, l1=0.05, l2=1.0) -> tuple[np.ndarray, float]:
    """Weights and bias after ``epochs`` passes of follow-the-regularised-leader updates, one document at a time."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for index, value, label in rows:
            i, x = np.r_[index, BUCKETS], np.r_[value, 1.0]
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def _trained(batches):
    """The task that trains: the bounded sample's sparse rows in, one row of weights out."""
    rows = []
    for batch in batches:
        for index, value, label in zip(*(batch.column(c).to_pylist() for c in ("buckets", "counts", "label"))):
            rows.append((np.frombuffer(index, np.int32), np.frombuffer(value, np.float32), label))
    weights, bias = train_ftrl(rows)
    yield pa.RecordBatch.from_pydict({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": pa.array([bias], pa.float64())})


def fit(docs: DataFrame, labels: DataFrame, use: Column | None = None, max_rows: int = 8000) -> tuple[np.ndarray, float]:
    """Fit on at most about ``max_rows`` labelled documents for which ``use`` (over doc_id) holds.

    Executors turn the sampled texts into sparse rows; one task, whose input that parameter bounds, runs the updates.
    Without labels all weights are zero and every score is 0.5.
    """
    bounded_batches(docs.sparkSession)

    def hashed(batches):
        for batch in batches:
            made = [_features(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([a.tobytes() for a, _ in made], pa.binary()),
                 pa.array([b.tobytes() for _, b in made], pa.binary()), batch.column("label")],
                ["doc_id", "buckets", "counts", "label"],
            )

    sample = labelled_sample(docs, labels, "quality", max_rows, use)
    sample = sample.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), "label")
    sparse = sample.mapInArrow(hashed, "doc_id long, buckets binary, counts binary, label int")
    one = sparse.groupBy("doc_id").agg(F.min(F.struct("buckets", "counts", "label")).alias("r"))
    ordered = one.select("doc_id", "r.*").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"))
    row = ordered.mapInArrow(_trained, "weights binary, bias double").first()
    return np.frombuffer(bytes(row["weights"]), np.float32), row["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the probability of label 1 from a sparse dot product over the whole text.

    Null and empty texts have no n-gram and get the bias alone; repeated rows get equal scores; an empty table gives no
    rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(batches):
        weights, bias = sent.value
        for batch in batches:
            logits = np.empty(batch.num_rows)
            for k, text in enumerate(batch.column(1).to_pylist()):
                parts, n = ngram_buckets(text or b"")
                logits[k] = bias + sum(float(weights[p].sum(dtype=np.float64)) for p in parts) / max(1.0, n) ** 0.5
            scores = 1 / (1 + np.exp(-np.clip(logits, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return pairs.mapInArrow(per_batch, "doc_id long, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves remainder 1 by 3; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
