"""Toxicity: cumulative-link ordinal regression over sparse word features, with weights shared by all thresholds."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .storage import bounded_batches
from .textual import SEGMENT, spaced_words

BUCKETS = 1 << 20
GRADES = 4  # 0 clean, then three grades of toxic texts
PREFIX = 4


def distinct_words(data: bytes) -> tuple[set[bytes], int]:
    """The different words of a whole text and its number of words."""
    text, seen, n, at = spaced_words(data), set(), 0, 0
    while at < len(text):
        to = text.find(b" ", at + SEGMENT) if at + SEGMENT < len(text) else len(text)
        to = len(text) if to < 0 else to
        words = text[at:to].split()
        seen.update(words)
        n += len(words)
        at = to
    return seen, n


def buckets(words: set[bytes]) -> np.ndarray:
    """Buckets of the words that occur and of their openings, so that unseen endings of a known stem count too."""
    stems = {b"\x01" + w[:PREFIX] for w in words if len(w) > PREFIX}
    found = np.fromiter(map(zlib.crc32, [*words, *stems]), np.uint32, len(words) + len(stems))
    return np.unique(found % np.uint32(BUCKETS)).astype(np.int32)


def evidence_buckets(rows: list[tuple[np.ndarray, int, int]], least_z: float = 3.0) -> np.ndarray:
    """Mask of the buckets whose smoothed log-odds of toxic rows exceed zero by ``least_z`` standard errors.

    Only these carry weight: in long texts thousands of rare words would otherwise add up to chance scores.
    """
    df, sizes = np.zeros((2, BUCKETS)), np.zeros((2, 1))
    for index, _, toxic in rows:
        df[toxic, index] += 1
        sizes[toxic] += 1
    yes, no = df + 0.5, sizes - df + 0.5
    odds = np.log(yes / no)
    return odds[1] - odds[0] >= least_z * np.sqrt((1 / yes + 1 / no).sum(axis=0))


def severity_grades(rows: list[tuple[np.ndarray, int, int]], evidence: np.ndarray) -> np.ndarray:
    """Ordered grades of training rows (buckets, words, toxic).

    The labels say yes or no.  A toxic row's grade is the tercile, among toxic rows, of its evidence buckets over the
    square root of its words.
    """
    toxic = np.array([t for *_, t in rows], bool)
    share = np.array([evidence[index].sum() / max(1, n) ** 0.5 for index, n, _ in rows])
    grades = np.zeros(len(rows), np.int64)
    if toxic.any():
        grades[toxic] = 1 + np.searchsorted(np.quantile(share[toxic], [1 / 3, 2 / 3]), share[toxic], side="right")
    return grades


def train_ordinal(rows: list[tuple[np.ndarray, int, int]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4, least_z: float = 3.0):
    """(weights, thresholds) of P(grade <= k) = sigmoid(threshold[k] - weights . x), by AdaGrad on the likelihood."""
    evidence = evidence_buckets(rows, least_z)
    grades = severity_grades(rows, evidence)
    kept = [index[evidence[index]] for index, *_ in rows]
    w, g2 = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    gaps, gap2 = np.array([2.0, 0.0, 0.0]), np.full(GRADES - 1, 1e-2)  # first threshold, then logs of the steps

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -35, 35)))

    for _ in range(epochs):
        for index, grade in zip(kept, grades):
            theta = gaps[0] + np.r_[0.0, np.cumsum(np.exp(gaps[1:]))]
            below = np.r_[0.0, sigmoid(theta - w[index].sum()), 1.0]
            p = max(below[grade + 1] - below[grade], 1e-9)
            slope = below * (1 - below)
            up, down = slope[grade + 1] / p, slope[grade] / p  # d log p by the upper and lower threshold
            g = up - down + decay * w[index]
            g2[index] += g * g
            w[index] -= rate * g / np.sqrt(g2[index])
            by_theta = np.zeros(GRADES - 1)
            if grade < GRADES - 1:
                by_theta[grade] -= up
            if grade > 0:
                by_theta[grade - 1] += down
            by_gap = np.r_[by_theta.sum(), [by_theta[k:].sum() * np.exp(gaps[k]) for k in range(1, GRADES - 1)]]
            gap2 += by_gap * by_gap
            gaps -= rate * by_gap / np.sqrt(gap2)
            gaps[1:] = np.clip(gaps[1:], -4, 4)
    return w.astype(np.float32), gaps[0] + np.r_[0.0, np.cumsum(np.exp(gaps[1:]))]


def expected_grade(total: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """Expected grade, the sum over thresholds of P(grade > k)."""
    return (1 / (1 + np.exp(-np.clip(total[:, None] - thresholds[None, :], -35, 35)))).sum(axis=1)


def _trained(batches):
    rows = []
    for batch in batches:
        for index, n, label in zip(*(batch.column(c).to_pylist() for c in ("buckets", "words", "label"))):
            rows.append((np.frombuffer(index, np.int32), n, label))
    w, theta = train_ordinal(rows)
    index = np.flatnonzero(w).astype(np.int32)
    yield pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in (("at", index), ("weights", w[index]), ("thresholds", theta))})


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8000) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds), fitted on at most about ``max_rows`` labelled documents, a quarter of them toxic.

    Executors turn the sampled texts into sparse rows; one task, whose input that parameter bounds, runs the updates.
    Documents without a label, and labels without a document or of null value, take no part; without any label, or
    without a toxic one, no bucket carries weight and all texts get the same severity.
    """
    bounded_batches(docs.sparkSession)

    def hashed(batches):
        for batch in batches:
            made = [distinct_words(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([buckets(s).tobytes() for s, _ in made], pa.binary()),
                 pa.array([n for _, n in made], pa.int64()), batch.column("label")],
                ["doc_id", "buckets", "words", "label"],
            )

    sample = labelled_sample(docs, labels, "toxic", max_rows, positive=0.25)
    sample = sample.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), "label")
    sparse = sample.mapInArrow(hashed, "doc_id long, buckets binary, words long, label int")
    one = sparse.groupBy("doc_id").agg(F.min(F.struct("buckets", "words", "label")).alias("r"))
    ordered = one.select("doc_id", "r.*").repartition(1).sortWithinPartitions(F.xxhash64("doc_id"))
    row = ordered.mapInArrow(_trained, "at binary, weights binary, thresholds binary").first()
    weights = np.zeros(BUCKETS, np.float32)
    weights[np.frombuffer(bytes(row["at"]), np.int32)] = np.frombuffer(bytes(row["weights"]), np.float32)
    return weights, np.frombuffer(bytes(row["thresholds"]), np.float64)


def severity(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity): the expected grade (0 clean to 3 worst) of every whole text.

    Null and empty texts have no feature, so they get the severity of no evidence; repeated rows get equal values; an
    empty table gives no rows; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(batches):
        weights, thresholds = sent.value
        for batch in batches:
            total = np.array([float(weights[buckets(distinct_words(x or b"")[0])].sum(dtype=np.float64)) for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(expected_grade(total, thresholds))], ["doc_id", "severity"])

    kind = docs.schema[id_col].dataType.simpleString()
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return pairs.mapInArrow(per_batch, f"doc_id {kind}, severity double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = 8000) -> DataFrame:
    """The rows of ``docs``, all columns, whose expected severity stays below ``threshold``.

    An id goes if any of its rows is toxic; rows with a null id are told apart by their text's hash.  ``docs`` needs the
    columns doc_id and text, once each; others may have any names.  An empty table stays empty.
    """
    model = fit(docs, labels, max_rows)
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("#"), F.sha2(F.col("text"), 256)))
    scored = severity(docs.select(key.alias("key"), "text"), model, "key", "text")
    bad = scored.where(F.col("severity") >= threshold).select(F.col("doc_id").alias("bad")).distinct()
    packed = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return packed.join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*")
