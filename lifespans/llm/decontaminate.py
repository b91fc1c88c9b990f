"""Benchmark decontamination: suffix arrays over shards of the training words, binary-searched with benchmark suffixes."""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Scratch, bounded_batches, open_fs, write_file
from .textual import SEGMENT, spaced_words

WINDOW = 10
ITEMS = 500_000  # item ids of the rows that are put out at once
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class Block:
    """Benchmark items as word ids: ``stream`` holds the items one after another, each closed by a 0.

    Equal windows are one: ``places`` has a position of each different window, ``sizes`` its words, and its items are
    ``members[bounds[k] : bounds[k + 1]]``.  ``order`` is the suffix array of the stream.
    """

    vocab: dict[bytes, int]
    stream: np.ndarray
    item: np.ndarray  # at each position: number of its item
    begin: np.ndarray  # of each item: where it starts
    places: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray
    members: np.ndarray
    order: np.ndarray
    ids: list

    @classmethod
    def build(cls, items: list[tuple[object, list[bytes]]], window: int) -> Block:
        vocab: dict[bytes, int] = {}
        ids = [np.array([vocab.setdefault(x, len(vocab) + 1) for x in words] + [0], np.int32) for _, words in items]
        long = np.array([len(x) for x in ids], np.int64)
        begin = np.cumsum(long) - long
        stream = np.concatenate([*ids, np.zeros(0, np.int32)])
        item = np.repeat(np.arange(len(items), dtype=np.int32), long)
        places, sizes, of, owner = [], [], [], []
        words = np.minimum(long - 1, window)
        for w in np.unique(words[words > 0]).tolist():
            starts = np.concatenate([np.arange(b, b + n - w) for b, n in zip(begin[words == w], long[words == w])])
            rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(stream, w)[starts])
            _, first, which = np.unique(rows.view(f"V{4 * w}").ravel(), return_index=True, return_inverse=True)
            of.append(which + sum(map(len, places)))
            owner.append(item[starts])
            places.append(starts[first])
            sizes.append(np.full(len(first), w))
        none = np.zeros(0, np.int64)
        n = sum(map(len, places))
        both = np.unique(np.concatenate([none, *of]) * (len(items) + 1) + np.concatenate([none, *owner]))
        of_, members = np.divmod(both, len(items) + 1)
        return cls(
            vocab, stream, item, begin, np.concatenate([none, *places]), np.concatenate([none, *sizes]), np.searchsorted(of_, np.arange(n + 1)),
            members.astype(np.int32), suffix_array(stream, len(stream)).astype(np.int32), [i for i, _ in items],
        )


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> list[str]:
    """Files of the benchmark's blocks in the shared folder, built by tasks; the driver gets their names.

    Items fall into blocks by a hash, so many that a block holds half of ``block_words`` words on average, or into one
    block if all fit.  A null text has no words; repeated rows of an item give the same windows twice and count once.
    """
    spark, scratch = benchmark.sparkSession, Scratch(benchmark.sparkSession, "benchmark")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    total = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    if not total:
        return []
    n = 1 if total <= block_words else math.ceil(2 * total / block_words)
    root = scratch.path("blocks")

    def built(batches):
        block, held = None, []

        def done():
            path = f"{root}/{block:08d}"
            write_file(path, [pickle.dumps(Block.build(held, window), 5)])
            return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "path": [path]})

        for batch in batches:
            for k, item, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and k != block:
                    yield done()
                    held.clear()
                block = k
                if words := spaced_words(text).split():
                    held.append((item, words))
        if held:
            yield done()

    bounded_batches(spark)
    dealt = items.select(F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int").alias("block"), "item", F.col("text").cast("binary").alias("text"))
    dealt = dealt.repartition(min(n, 4096), "block").sortWithinPartitions("block", "item", "text")
    return [r["path"] for r in dealt.mapInArrow(built, "block int, path string").orderBy("block").collect()]


def read_block(path: str) -> Block:
    """A block that ``benchmark_blocks`` wrote."""
    system, name = open_fs(path)
    with system.open_input_stream(name) as f:
        return pickle.loads(f.read())


def suffix_array(stream: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``stream`` sorted by the ``depth`` (or more) ids that follow, by prefix doubling."""
    rank, k, n = stream.astype(np.int64), 1, len(stream)
    order = np.argsort(rank, kind="stable")
    while k < min(depth, n):
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1
        pair = rank * (rank.max() + 2) + after
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        rank[order] = np.cumsum(np.r_[False, pair[1:] != pair[:-1]])
        if rank[order[-1]] == n - 1:
            break
        k *= 2
    return order


def search(stream: np.ndarray, order: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(training position, window) of every occurrence of a different benchmark window.

    All windows are searched at once: step d halves, for each window still alive, the interval of training suffixes that
    share its first d words until those that also share the next one are left.  Windows of one size have intervals
    apart from each other, so a position meets at most one window of each of the few sizes.
    """
    which, start = np.arange(len(block.places)), block.places
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(order), np.int64)
    most = int(block.sizes.max(initial=0))
    padded = np.r_[stream, np.zeros(most + 1, stream.dtype)]
    found = []
    for d in range(most):
        if not len(start):
            break
        want = block.stream[start + d]

        def bound(after: bool) -> np.ndarray:
            a, z = lo.copy(), hi.copy()
            while (a < z).any():
                open_, mid = a < z, (a + z) // 2
                here = padded[order[np.minimum(mid, len(order) - 1)] + d]
                right = open_ & ((here <= want) if after else (here < want))
                a = np.where(right, mid + 1, a)
                z = np.where(open_ & ~right, mid, z)
            return a

        lo, hi = bound(False), bound(True)
        size = block.sizes[which]
        done = (size == d + 1) & (lo < hi)
        found.append((which[done], lo[done], hi[done]))
        live = (lo < hi) & (size > d + 1)
        which, start, lo, hi = which[live], start[live], lo[live], hi[live]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    which, lo, hi = (np.concatenate(x) for x in zip(*found))
    n = hi - lo
    return order[np.arange(int(n.sum())) + np.repeat(lo - np.cumsum(n) + n, n)], np.repeat(which, n)


class Sums:
    """Sums by which any two pieces of two streams can be compared: words times powers of a base, by two primes."""

    PRIMES, BASES = (4294967291, 4294967279), (2654435761, 1597334677)

    def __init__(self, streams: list[np.ndarray]):
        n = max(map(len, streams)) + 1
        self.powers = []
        for p, base in zip(self.PRIMES, self.BASES):
            power = np.ones(1, np.uint64)
            while len(power) < n:
                step = np.uint64(pow(base, len(power), p))
                power = np.r_[power, power * step % np.uint64(p)]
            self.powers.append(power[:n])
        self.sums = [[np.r_[np.uint64(0), np.cumsum(s.astype(np.uint64) * w[: len(s)] % np.uint64(p)) % np.uint64(p)] for s in streams] for p, w in zip(self.PRIMES, self.powers)]

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` words at ``a`` in the first and at ``b`` in the second stream are the same (but for chances of 2**-60)."""
        out = np.ones(len(a), bool)
        for p, w, (x, y) in zip(self.PRIMES, self.powers, self.sums):
            p = np.uint64(p)
            left, right = (x[a + n] + p - x[a]) % p, (y[b + n] + p - y[b]) % p
            low = np.minimum(a, b)
            out &= left * w[b - low] % p == right * w[a - low] % p
        return out


def longest(stream: np.ndarray, at: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(words, benchmark position) of the longest match that starts at each training position ``at``.

    The position's suffix is placed among the benchmark's suffixes by a binary search; one of its two neighbours there
    has the longest match.  Two suffixes are compared by the length of their common beginning, found by halving, so the
    work is that of the positions whatever repeats.
    """
    left, right = np.r_[stream, 0].astype(np.int64), np.r_[block.stream, 0].astype(np.int64)
    right[right == 0] = len(block.vocab) + 1  # the end of an item equals no word and no end of a run
    sums = Sums([left, right])
    ends = np.flatnonzero(left == 0)
    room_t = ends[np.searchsorted(ends, at)] - at

    def common(b: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(at), np.int64), np.minimum(room_t, len(block.stream) - b)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = sums.same(at, b, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo

    a, z = np.zeros(len(at), np.int64), np.full(len(at), len(block.order), np.int64)
    while (a < z).any():
        mid = (a + z) // 2
        b = block.order[np.minimum(mid, len(block.order) - 1)].astype(np.int64)
        n = common(b)
        here = np.r_[block.stream, 0][b + n]  # the order was made with ends of items before all words
        less = (a < z) & (here < np.r_[stream, 0][at + n])
        a, z = np.where(less, mid + 1, a), np.where((a < z) & ~less, mid, z)
    best, place = np.full(len(at), -1, np.int64), np.zeros(len(at), np.int64)
    for k in (a - 1, a):
        ok = (k >= 0) & (k < len(block.order))
        b = block.order[np.clip(k, 0, len(block.order) - 1)].astype(np.int64)
        n = np.where(ok, common(b), -1)
        place, best = np.where(n > best, b, place), np.maximum(best, n)
    return best, place


def _word_ids(data: bytes, vocab: dict[bytes, int]) -> np.ndarray:
    """Ids of the words of a text, 0 for words outside ``vocab``; long texts go in segments."""
    text, parts, at = spaced_words(data), [], 0
    while at < len(text):
        to = text.find(b" ", at + SEGMENT) if at + SEGMENT < len(text) else len(text)
        to = len(text) if to < 0 else to
        words = text[at:to].split()
        parts.append(np.fromiter(map(vocab.get, words, ZEROS), np.int32, len(words)))
        at = to
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


class _Zeros:
    def __iter__(self):
        return self

    def __next__(self):
        return 0


ZEROS = _Zeros()


@dataclass
class Found:
    """What one block shows of a shard: covered words, (text, window) that occur, and longest matches by rows."""

    cover: np.ndarray  # changes of the number of windows that cover a word of the shard
    text: np.ndarray
    window: np.ndarray
    matches: list[tuple[int, int, int, int, int]]  # text, start word, words, number of the item, item's start word


def _matches(texts: list[np.ndarray], block: Block) -> Found | None:
    """Search a shard for a block; memory and time grow with the words of both, however often they repeat."""
    if not texts or not len(block.places):
        return None
    sizes = np.array([len(x) for x in texts])
    base = np.r_[0, np.cumsum(sizes + 1)]
    whole = np.zeros(int(base[-1]), np.int32)
    for b, x in zip(base, texts):
        whole[b : b + len(x)] = x
    # Only runs of known words at least as long as the shortest window can hold an occurrence; the array is over those.
    known = np.r_[False, whole != 0, False]
    edge = np.flatnonzero(known[1:] != known[:-1])
    begin, end = edge[::2], edge[1::2]
    long_enough = end - begin >= block.sizes.min()
    begin, end = begin[long_enough], end[long_enough]
    if not len(begin):
        return None
    length = end - begin + 1  # with the 0 that closes the run
    at = np.r_[0, np.cumsum(length)]
    place = np.arange(int(at[-1])) + np.repeat(begin - at[:-1], length)
    stream = np.where(place < np.repeat(end, length), np.r_[whole, 0][place], 0).astype(np.int32)
    t, which = search(stream, suffix_array(stream, int(block.sizes.max())), block)
    if not len(t):
        return None
    where, n = place[t], block.sizes[which]
    doc = np.searchsorted(base, where, side="right") - 1
    cover = np.bincount(where, minlength=len(whole) + 1) - np.bincount(where + n, minlength=len(whole) + 1)
    pairs = np.unique(doc * (len(block.places) + 1) + which)
    starts = np.unique(t)
    words, source = longest(stream, starts, block)
    spot = place[starts]
    stop = spot + words
    outer = np.r_[True, stop[1:] > np.maximum.accumulate(stop)[:-1]]  # not inside a match that starts before
    spot, words, source = spot[outer], words[outer], source[outer]
    of = np.searchsorted(base, spot, side="right") - 1
    number = block.item[source]
    rows = zip(of.tolist(), (spot - base[of]).tolist(), words.tolist(), number.tolist(), (source - block.begin[number]).tolist())
    return Found(cover, *np.divmod(pairs, len(block.places) + 1), list(rows))


MATCH = "array<struct<start:bigint,words:bigint,item_id:{item},item_start:bigint>>"


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = 2_000_000,
    shard_words: int = 2_000_000,
) -> DataFrame:
    """Longest verbatim matches of benchmark items in every document.

    Words are runs of letters and digits after lower-casing A-Z (anything beyond ASCII is a letter).  Returns a row per
    input row: doc_id, n_words, n_hit (words inside an occurrence of a window of ``window`` item words; an item of
    fewer words is one window), item_ids (of every item with an occurring window; sorted, as strings) and matches
    (start, words, item_id, item_start): at each start of an occurrence the longest verbatim match and one item that
    holds it, but for those inside a match that starts before.  Null and empty texts have no words and no match; an
    empty benchmark matches nothing; repeated rows give equal rows; other columns are not read.

    A shard is what a task gathers up to ``shard_words`` words; the benchmark's blocks of about ``block_words`` words at
    most are read from the shared folder and searched in it one after another, so a task holds two blocks at most (the
    first stays).  Equal windows of a block are one, with a list of their items, and every position of a shard meets at
    most one window of each size, so memory is bounded by the two parameters, the longest item and the longest text,
    whatever repeats and however large the benchmark is, and by one row's item ids.
    """
    bounded_batches(docs.sparkSession)
    paths = benchmark_blocks(benchmark, item_col, item_text_col, window, block_words)
    match = MATCH.format(item=benchmark.schema[item_col].dataType.simpleString())
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_words bigint, n_hit bigint, item_ids array<string>, matches {match}"
    pairs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.array().cast(match).alias("matches"))
    return pairs.mapInArrow(_scan(paths, window, shard_words), schema)


def _scan(paths: list[str], window: int, shard_words: int):
    """A task: number the words, gather a shard, search each block in it, and describe its rows."""

    def flush(held: list[pa.RecordBatch], first: Block, ids: list[np.ndarray]):
        sizes = np.array([len(x) for x in ids])
        base = np.r_[0, np.cumsum(sizes + 1)]
        covered, matches = np.zeros(int(base[-1]), bool), [[] for _ in ids]
        items: list[list[list[str]]] = [[] for _ in ids]
        for k in range(max(1, len(paths))):
            if k:
                texts = (x for batch in held for x in batch.column(1).to_pylist())
                block = read_block(paths[k])
                numbered = [_word_ids(x or b"", block.vocab) for x in texts]
            else:
                block, numbered = first, ids
            found = _matches(numbered, block)
            if found is None:
                continue
            covered |= np.cumsum(found.cover)[: len(covered)] > 0
            for doc, start, n, item, item_start in found.matches:
                matches[doc].append({"start": start, "words": n, "item_id": block.ids[item], "item_start": item_start})
            lists: dict[bytes, list[str]] = {}  # texts with the same windows share their items
            edges = np.flatnonzero(np.r_[True, found.text[1:] != found.text[:-1], True])
            for a, z in zip(edges, edges[1:]):
                own = found.window[a:z]
                if own.tobytes() not in lists:
                    numbers = np.unique(np.concatenate([block.members[block.bounds[w] : block.bounds[w + 1]] for w in own]))
                    lists[own.tobytes()] = sorted({str(block.ids[i]) for i in numbers if block.ids[i] is not None})
                items[int(found.text[a])].append(lists[own.tobytes()])
        hit = np.diff(np.r_[0, np.cumsum(covered)][base])
        row = 0
        for batch in held:
            at = 0
            while at < batch.num_rows:  # a few rows if they have very many items
                to, n = at, 0
                while to < batch.num_rows and (to == at or n < ITEMS):
                    n += sum(map(len, items[row + to]))
                    to += 1
                mine = [_outermost(x) for x in matches[row + at : row + to]]
                named = [x[0] if len(x) == 1 else sorted({i for y in x for i in y}) for x in items[row + at : row + to]]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(at, to - at),
                    "n_words": pa.array(sizes[row + at : row + to], pa.int64()),
                    "n_hit": pa.array(hit[row + at : row + to], pa.int64()),
                    "item_ids": pa.array(named, pa.list_(pa.string())),
                    "matches": pa.array(mine, batch.schema.field("matches").type),
                })
                at = to
            row += batch.num_rows

    def per_partition(batches):
        first = read_block(paths[0]) if paths else Block.build([], window)
        held, ids, n = [], [], 0
        for batch in batches:
            new = [_word_ids(x or b"", first.vocab) for x in batch.column(1).to_pylist()]
            held.append(batch)
            ids += new
            n += sum(map(len, new))
            if n >= shard_words:
                yield from flush(held, first, ids)
                held, ids, n = [], [], 0
        if held:
            yield from flush(held, first, ids)

    return per_partition


def _outermost(matches: list[dict]) -> list[dict]:
    """The matches of all blocks by start, without those inside another."""
    out, reach = [], -1
    for m in sorted(matches, key=lambda m: (m["start"], -m["words"])):
        if m["start"] + m["words"] > reach:
            out.append(m)
            reach = m["start"] + m["words"]
    return out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", min_hit: int = 1, **options) -> DataFrame:
    """The rows of ``docs``, all columns, without documents of which at least ``min_hit`` words match a benchmark window.

    A document id goes if any of its rows matches; rows with a null id are compared by their text's hash instead.
    """
    text_col = options.pop("text_col", "text")
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("#"), F.sha2(F.col(text_col), 256)))
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    bad = benchmark_matches(keyed, benchmark, "key", "text", **options).where(F.col("n_hit") >= min_hit)
    bad = bad.select(F.col("doc_id").alias("bad")).distinct()
    packed = docs.select(F.struct("*").alias("row"), key.alias("key"))
    return packed.join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*")
