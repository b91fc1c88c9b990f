"""Masked pseudo-likelihood: a window network predicts every token from both sides; log-probabilities score texts."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import SEGMENT_ROWS, Scratch, bounded_batches
from .textual import SEGMENT, spaced_words

WORDS, RARE, CLASSES, WIDTH, SIDE = 4096, 1024, 64, 16, 2
SLOTS = (WORDS + RARE) // CLASSES  # tokens of a class
MORE = 1 << 17  # words after the first WORDS whose shares of their buckets are sent to the tasks
OFFSETS = [d for d in range(-SIDE, SIDE + 1) if d]
BLOCKS = 64
ONES, TINY = np.ones(max(CLASSES, SLOTS), np.float32), np.float32(1e-30)


def segments(data: bytes):
    """Lists of words of about 1 MB of a text each."""
    text, at = spaced_words(data), 0
    while at < len(text):
        to = text.find(b" ", at + SEGMENT) if at + SEGMENT < len(text) else len(text)
        to = len(text) if to < 0 else to
        yield text[at:to].split()
        at = to


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; each task sums before the shuffle."""
    bounded_batches(docs.sparkSession)

    def per_partition(batches):
        counts: Counter[bytes] = Counter()

        def flush():
            for at in range(0, len(items := list(counts.items())), SEGMENT_ROWS):
                part = items[at : at + SEGMENT_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())], ["word", "n"])
            counts.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for words in segments(text or b""):
                    counts.update(words)
            if len(counts) > 500_000:
                yield from flush()
        yield from flush()

    parts = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(per_partition, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Numbers(dict):
    """Numbers of words, 0 for a word without one."""

    def __missing__(self, word: bytes) -> int:
        return 0


@dataclass
class Vocabulary:
    """Ids of words: 0 is a border, then the most frequent words, then buckets shared by the others.

    The ids in the order of their counts fill the classes one after another, ``SLOTS`` to a class.  Of the words that
    share buckets the most frequent, ``MORE`` at most, are known here with their shares; those of the rest are joined.
    """

    known: Numbers  # number of a known word, from 1
    ids: np.ndarray  # id of each known word
    share: np.ndarray  # log of its share of its id's count
    group: np.ndarray  # class of each id
    slot: np.ndarray  # place of each id within its class
    counts: np.ndarray
    last: tuple[bytes, int] | None  # the last known word and its count

    @classmethod
    def build(cls, top: list[tuple[bytes, int]], rare: dict[int, int]) -> Vocabulary:
        """From the most frequent words in order, WORDS + MORE at most, and the counts of all others by bucket."""
        counts = np.zeros(1 + WORDS + RARE)
        ids = np.array([0, *range(1, min(len(top), WORDS) + 1), *(1 + WORDS + zlib.crc32(w) % RARE for w, _ in top[WORDS:])], np.int16)
        n = np.array([1, *(n for _, n in top)], np.float64)
        np.add.at(counts, ids[1:], n[1:])
        for bucket, more in rare.items():
            counts[1 + WORDS + bucket] += more
        share = np.log(n / np.maximum(counts[ids], 1))
        counts[1 + WORDS :] += 0.5  # a word that is not in the corpus keeps some mass
        rank = np.zeros(len(counts), np.int64)
        rank[1 + np.argsort(-counts[1:], kind="stable")] = np.arange(len(counts) - 1)
        return cls(Numbers((w, k) for k, (w, _) in enumerate(top, 1)), ids, share, (rank // SLOTS).astype(np.int16), rank % SLOTS, counts, top[-1] if top else None)

    def encode(self, data: bytes) -> np.ndarray:
        """Ids of the words of a text."""
        return self.encode_shares(data, {})[0]

    def encode_shares(self, data: bytes, rare: dict[bytes, int]) -> tuple[np.ndarray, float]:
        """Ids of the words of a text and the sum of the known words' log-shares; ``rare`` counts the words not known."""
        parts, total = [], 0.0
        for words in segments(data):
            number = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
            ids = self.ids[number]
            for k in np.flatnonzero(number == 0).tolist():
                word = words[k]
                ids[k] = 1 + WORDS + zlib.crc32(word) % RARE
                rare[word] = rare.get(word, 0) + 1
            total += float(self.share[number].sum())  # number 0 has share 0
            parts.append(ids)
        return (np.concatenate(parts) if parts else np.empty(0, np.int16)), total


def _beyond(words: Vocabulary):
    """The condition for rows of a count table whose word is not known to ``words``."""
    word, least = words.last
    return (F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > F.lit(word)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The vocabulary from the counts of all words; the driver gets WORDS + MORE rows at most and one row a bucket."""
    top = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(WORDS + MORE).collect()]
    words = Vocabulary.build(top, {})
    if not top:
        return words
    rare = counts.where(_beyond(words)).groupBy((F.crc32("word") % RARE).cast("int").alias("b")).agg(F.sum("n").alias("n")).collect()
    return Vocabulary.build(top, {r["b"]: r["n"] for r in rare}) if rare else words


def _softmax(logits: np.ndarray, own: tuple[np.ndarray, np.ndarray], chosen: np.ndarray, total: np.ndarray, slopes: bool) -> None:
    """Fill ``chosen`` with each row's logit at ``own`` (row, column) and ``total`` with its sum of exponentials.

    With ``slopes`` the loss's slopes then stand in ``logits``: probabilities, less one at ``own``.
    """
    if len(logits) and logits.max() > 60:  # beyond float32's range only after a shift
        logits -= logits.max(axis=1, keepdims=True)
    chosen[:] = logits[own]
    np.exp(logits, out=logits)
    np.matmul(logits, ONES[: logits.shape[1]], out=total)
    if slopes:
        logits /= np.maximum(total, TINY)[:, None]
        logits[own] -= 1


@dataclass
class Network:
    """A softmax over classes and one over the tokens of the class, both from the sum of both sides' embeddings.

    The last row of an output holds the biases, which stay at the corpus counts; the other rows start at zero, so an
    untrained network is the unigram model.  Steps are AdaGrad's; the sums of squares (squares_*) belong to the state
    that tasks hand on.
    """

    embedding: np.ndarray  # positions x ids x width
    to_class: np.ndarray  # (width and bias) x classes
    to_word: np.ndarray  # classes x (width and bias) x slots
    squares_embedding: np.ndarray  # positions x ids
    squares_class: np.ndarray  # width x classes
    squares_word: np.ndarray  # classes x width x slots

    @classmethod
    def start(cls, words: Vocabulary, seed: int = 7) -> Network:
        ids = len(words.counts)
        mass = np.bincount(words.group[1:], words.counts[1:], CLASSES)
        here = 1 + np.flatnonzero(words.counts[1:])
        to_class, to_word = np.zeros((WIDTH + 1, CLASSES)), np.zeros((CLASSES, WIDTH + 1, SLOTS))
        to_class[-1] = np.log(np.maximum(mass, 1e-12) / mass.sum())
        to_word[:, -1] = -30  # ids without a word
        to_word[words.group[here], -1, words.slot[here]] = np.log(words.counts[here] / mass[words.group[here]])
        arrays = (
            np.random.default_rng(seed).normal(0, 0.1, (len(OFFSETS), ids, WIDTH)), to_class, to_word,
            np.full((len(OFFSETS), ids), 1e-6), np.full((WIDTH, CLASSES), 1e-6), np.full((CLASSES, WIDTH, SLOTS), 1e-6),
        )
        return cls(*(a.astype(np.float32) for a in arrays))

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    def filled(self, flat: np.ndarray) -> Network:
        """A network of this one's shapes with the numbers of ``flat``."""
        parts = [getattr(self, f.name) for f in fields(self)]
        ends = np.cumsum([p.size for p in parts])
        return Network(*(flat[z - p.size : z].reshape(p.shape).astype(np.float32) for p, z in zip(parts, ends)))

    def hidden(self, around: list[np.ndarray]) -> np.ndarray:
        """The summed embeddings of the ids ``around`` (an array for each offset), and a last column of ones for the biases."""
        out = np.ones((len(around[0]), WIDTH + 1), np.float32)
        total = self.embedding[0].take(around[0], axis=0)
        for k, near in enumerate(around[1:], 1):
            total += self.embedding[k].take(near, axis=0)
        out[:, :-1] = total
        return out

    def log_probabilities(self, stream: np.ndarray, at: np.ndarray, words: Vocabulary, rate: float = 0.0) -> np.ndarray:
        """log P(token | both sides) at the masked positions ``at``; a ``rate`` above 0 also takes a gradient step."""
        group = words.group[stream[at]]
        order = np.argsort(group, kind="stable")  # a class's positions together
        at, group = at[order], group[order]
        slot, row = words.slot[stream[at]], np.arange(len(at))
        around = [stream[at + d].astype(np.intp) for d in OFFSETS]
        h, rate = self.hidden(around), np.float32(rate)
        chosen, total = np.empty((2, len(at)), np.float32), np.empty((2, len(at)), np.float32)  # class, word
        p = h @ self.to_class
        _softmax(p, (row, group), chosen[0], total[0], rate > 0)
        if rate:
            back, slopes = p @ self.to_class[:-1].T, np.zeros_like(self.squares_word)
            slope = h[:, :-1].T @ p
            self.squares_class += slope * slope
            self.to_class[:-1] -= rate * slope / np.sqrt(self.squares_class)
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(at)] if len(at) else []):
            c = group[a]
            p = h[a:z] @ self.to_word[c]
            _softmax(p, (row[: z - a], slot[a:z]), chosen[1, a:z], total[1, a:z], rate > 0)
            if rate:
                back[a:z] += p @ self.to_word[c, :-1].T
                np.matmul(h[a:z, :-1].T, p, out=slopes[c])
        logs = (chosen - np.log(np.maximum(total, TINY))).sum(axis=0)
        if rate:
            self.squares_word += slopes * slopes
            self.to_word[:, :-1] -= rate * slopes / np.sqrt(self.squares_word)
            square = np.einsum("ij,ij->i", back, back) / np.float32(WIDTH)
            columns = back.T.astype(np.float64, order="C")
            for k, near in enumerate(around):
                ids = np.flatnonzero(np.bincount(near))
                self.squares_embedding[k, ids] += np.bincount(near, square)[ids].astype(np.float32)
                slope = np.array([np.bincount(near, c)[ids] for c in columns], np.float32).T
                self.embedding[k, ids] -= slope * (rate / np.sqrt(self.squares_embedding[k, ids]))[:, None]
        out = np.empty(len(at), np.float32)
        out[order] = logs
        return out


def joined_stream(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after another with borders between them, and where each text starts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = SIDE + np.r_[0, np.cumsum(sizes + SIDE)[:-1]] if len(sizes) else np.empty(0, np.int64)
    stream = np.zeros(int(sizes.sum()) + SIDE * (len(sizes) + 1), np.int16)  # sorted by radix
    for s, t in zip(starts, texts):
        stream[s : s + len(t)] = t
    return stream, starts


def masks(starts: np.ndarray, texts: list[np.ndarray], every: int, phase: int = 0):
    """Positions to mask, one array for each of ``every`` passes: each token of each text is in exactly one.

    A pass masks one token in ``every`` of a text; the phase goes round the texts.
    """
    for turn in range(every):
        at = [np.arange(s + (phase + 3 * k + turn) % every, s + len(t), every) for k, (s, t) in enumerate(zip(starts, texts))]
        yield np.concatenate(at) if at else np.empty(0, np.int64)


def encoded(docs: DataFrame, words: Vocabulary, id_col: str = "doc_id", text_col: str = "text", rounds: int = 1) -> DataFrame:
    """The texts as ids: row (a number of its own), doc_id, turn (a residue of a hash of the text), ids (16-bit numbers), share
    (sum of the known words' log-shares) and the counts of the words that ``words`` doesn't know (rare, times)."""
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def per_batch(batches):
        known, row = sent.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            rare: list[dict[bytes, int]] = [{} for _ in range(batch.num_rows)]
            coded = [known.encode_shares(x or b"", r) for x, r in zip(batch.column(2).to_pylist(), rare)]
            columns = [pa.array(np.arange(row, row + len(coded))), batch.column(0), batch.column(1), pa.array([t.tobytes() for t, _ in coded], pa.binary()), pa.array([x for _, x in coded], pa.float64()),
                       pa.array([list(r) for r in rare], pa.list_(pa.binary())), pa.array([list(r.values()) for r in rare], pa.list_(pa.int64()))]
            row += len(coded)
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "turn", "ids", "share", "rare", "times"])

    text = F.col(text_col)
    turn = F.pmod(F.xxhash64(text), F.lit(rounds)).cast("int").alias("turn")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), turn, text.cast("binary").alias("text"))
    return rows.mapInArrow(per_batch, "row long, doc_id long, turn int, ids binary, share double, rare array<binary>, times array<long>")


def fit(
    docs: DataFrame, scratch: Scratch, text_col: str = "text", id_col: str = "doc_id", every: int = 8, rate: float = 0.2, batch_size: int = 8192, rounds: int = 4, task_tokens: int = 2_000_000
) -> tuple[Vocabulary, Network]:
    """Train on all documents in ``rounds`` synchronous rounds, each over the texts of one residue of a text hash.

    The texts are encoded once, into the table "coded" of ``scratch``, which the rounds (and the scoring) read.

    In a round every task goes on from the same network over its own texts; then the networks are averaged by the number
    of tokens and sent out again.  Every token is masked once and predicted from both sides, one in ``every`` of a text
    at a time.  Input partitions are put together until a task has about ``task_tokens`` in all, so that what a task
    learns does not shrink as partitions multiply.  A task returns its numbers in blocks, times the number of tokens it
    trained on; the blocks are summed in Spark on two levels, so the driver gets one network a round and no task gathers
    all, whatever the number of tasks.
    """
    counts = scratch.table(word_counts(docs, text_col), "counts")
    words = vocabulary(counts)
    total = counts.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, math.ceil(total / task_tokens))
    net = Network.start(words)
    coded = scratch.table(encoded(docs, words, id_col, text_col, rounds), "coded")
    for turn in range(rounds if total else 0):
        net = _round(coded.where(F.col("turn") == turn).select("ids").coalesce(tasks), words, net, every, rate, batch_size)
    return words, net


def _round(texts: DataFrame, words: Vocabulary, net: Network, every: int, rate: float, batch_size: int) -> Network:
    """The mean of the networks that tasks train from ``net``, each on its partition of ``texts`` (ids)."""
    bounded_batches(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast((words, net))

    def trained(batches):
        known, start = sent.value
        net, seen, phase = start.filled(start.flat()), 0, 0
        for batch in batches:
            texts = [np.frombuffer(x, np.int16) for x in batch.column(0).to_pylist()]
            stream, starts = joined_stream(texts)
            for at in masks(starts, texts, every, phase):
                for k in range(0, len(at), batch_size):
                    net.log_probabilities(stream, at[k : k + batch_size], known, rate)
                seen += len(at)
            phase += 3 * len(texts)
        if seen:
            for k, block in enumerate(np.array_split(net.flat(), BLOCKS)):
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "task": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  "seen": pa.array([seen], pa.int64()), "weights": pa.array([(block.astype(np.float64) * seen).tobytes()], pa.binary())})

    def summed(batches):
        """Sums of seen and of seen x weights over runs of equal (block, part)."""
        key, total, n = None, None, 0

        def done():
            return pa.RecordBatch.from_pydict({"block": pa.array([key[0]], pa.int32()), "part": pa.array([key[1]], pa.int32()),
                                               "seen": pa.array([n], pa.int64()), "weights": pa.array([total.tobytes()], pa.binary())})

        for batch in batches:
            for k, part, seen, weights in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "seen", "weights"))):
                if key is not None and (k, part) != key:
                    yield done()
                    total, n = None, 0
                key = (k, part)
                values = np.frombuffer(weights, np.float64)
                total = values if total is None else total + values
                n += seen
        if key is not None:
            yield done()

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.repartition("block", "part").sortWithinPartitions("block", "part", "task").mapInArrow(summed, "block int, part int, seen bigint, weights binary")

    rows = texts.mapInArrow(trained, "block int, task int, seen bigint, weights binary")
    # two levels: no task of the first meets more than a few hundred others, whatever their number
    parts = gathered(rows.withColumn("part", F.floor(F.col("task") / 256).cast("int")))
    mean = gathered(parts.select("block", F.lit(0).alias("part"), "seen", "weights", F.col("part").alias("task")))
    total = {r["block"]: np.frombuffer(bytes(r["weights"]), np.float64) / r["seen"] for r in mean.collect()}
    sent.destroy()
    return net.filled(np.concatenate([total[k] for k in sorted(total)])) if total else net


def rare_shares(counts: DataFrame, words: Vocabulary) -> DataFrame:
    """(word, log_share) of every word that ``words`` doesn't know: the log of its share of its bucket's count."""
    totals = [(b, float(n) - 0.5) for b, n in enumerate(words.counts[1 + WORDS :])]  # one row a bucket
    rare = counts.where(_beyond(words) if words.last else F.lit(False)).withColumn("b", (F.crc32("word") % RARE).cast("int"))
    every = F.broadcast(counts.sparkSession.createDataFrame(totals, "b int, all double"))
    return rare.join(every, "b").select("word", F.log(F.col("n") / F.col("all")).alias("log_share"))


def score(coded: DataFrame, words: Vocabulary, net: Network, slice_size: int = 8192) -> DataFrame:
    """row, doc_id, n_tokens and log_likelihood (sum over the tokens) of ``encoded`` texts; a word that ``words`` doesn't know scores as its bucket."""
    bounded_batches(coded.sparkSession)
    sent = coded.sparkSession.sparkContext.broadcast((words, net))

    def per_batch(batches):
        known, model = sent.value
        for batch in batches:
            texts = [np.frombuffer(x, np.int16) for x in batch.column(2).to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            stream, _ = joined_stream(texts)
            at = np.flatnonzero(stream)
            logs = [model.log_probabilities(stream, at[k : k + slice_size], known) for k in range(0, len(at), slice_size)]
            ends = np.cumsum(sizes)
            running = np.r_[0.0, np.cumsum(np.concatenate(logs, dtype=np.float64))] if logs else np.zeros(1)
            sums = running[ends] - running[ends - sizes] + batch.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), pa.array(sums)], ["row", "doc_id", "n_tokens", "log_likelihood"])

    return coded.select("row", "doc_id", "ids", "share").mapInArrow(per_batch, "row long, doc_id long, n_tokens long, log_likelihood double")


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on all of ``docs`` and score every whole text of it.

    Null and empty texts have no token, likelihood 0 and a null mean; repeated rows get equal scores; ids may be null;
    texts of any length are scored whole; an empty table gives no rows; other columns are not read, whatever their names.
    A word beyond the first ``WORDS`` has its bucket's probability times its share of the bucket's count.  The shares of
    the next ``MORE`` words go to the tasks, those of all others are joined to the texts' rare words.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    words, net = fit(docs, scratch, text_col, id_col)
    counts = docs.sparkSession.read.schema("word binary, n long").parquet(scratch.path("counts"))
    coded = docs.sparkSession.read.parquet(scratch.path("coded"))
    scored = scratch.table(score(coded, words, net), "scored")
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    shares = rare.join(rare_shares(counts, words), "word").groupBy("row").agg(F.sum(F.round(F.col("times") * F.col("log_share"), 9).cast("decimal(28,9)")).alias("more"))
    whole = F.col("log_likelihood") + F.coalesce(F.col("more").cast("double"), F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("mean_log_likelihood")
    summed = scored.join(shares, "row", "left").select("doc_id", "n_tokens", whole.alias("log_likelihood"))
    return summed.select("doc_id", "n_tokens", "log_likelihood", mean)
