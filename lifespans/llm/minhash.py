"""Document fingerprints: minima of universal hash permutations over word shingles."""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import bounded_batches
from .textual import runs_of_words

PERMUTATIONS = 128
WIDTH = 5
_EMPTY = np.empty(0, np.uint64)
_families: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def shingle_set(data: bytes | None, width: int = WIDTH, seed: int = 42) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the space-joined ``width``-word shingles of the lower-cased UTF-8 text.

    A text of fewer words is one shingle; a text of none (or null) has an empty set.
    """
    carry: list[bytes] = []
    parts = []
    for words in runs_of_words((data or b"").lower()):
        words = carry + words
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
            parts.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(words) - width + 1))
            carry = words[len(words) - width + 1 :]
        else:
            carry = words
    if not parts and carry:
        parts.append(np.array([xxhash.xxh64_intdigest(b" ".join(carry), seed)], np.uint64))
    return np.unique(np.concatenate(parts)) if parts else _EMPTY


def family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors (odd) and shifts of ``count`` permutations x -> factor * x + shift of the 64-bit numbers."""
    if count not in _families:
        rng = np.random.default_rng(11)
        factor = rng.integers(0, 1 << 63, count, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        _families[count] = factor, rng.integers(0, 1 << 63, count, np.uint64)[:, None]
    return _families[count]


def minima(shingles: np.ndarray, count: int = PERMUTATIONS, step: int = 1024) -> np.ndarray:
    """The least value of a set under each permutation; an empty set has the greatest number everywhere."""
    factor, shift = family(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), step):
        moved = shingles[at : at + step] * factor
        moved += shift
        np.minimum(least, moved.min(axis=1), out=least)
    return least


def fingerprint(shingles: np.ndarray, count: int = PERMUTATIONS) -> np.ndarray:
    """The last 16 bits of each minimum, big-endian; those of different minima agree once in 65,536 times."""
    return minima(shingles, count).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of places where two fingerprints agree: an estimate of the Jaccard similarity of the sets."""
    return float((a == b).mean())


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity of two sorted sets; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _hex(prints: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes().hex() for x in prints])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, count: int = PERMUTATIONS) -> DataFrame:
    """(doc_id, fingerprint) of every row: four hexadecimal digits for each permutation.

    Null and empty texts have the fingerprint of the empty set, all f; equal texts have equal fingerprints.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def per_batch(batches):
        for batch in batches:
            prints = [fingerprint(shingle_set(x, width), count) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _hex(prints)], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(per_batch, f"doc_id {kind}, fingerprint string")


def _bucket(key: Column, starts: list[int]) -> Column:
    """How many of the sorted ``starts`` beyond the first are at most ``key``, found in two steps of about a root of their number."""
    step = max(1, int(len(starts) ** 0.5))
    coarse = F.array(*[F.lit(x).cast("long") for x in starts[::step]])
    fine = F.array(*[F.array(*[F.lit(x).cast("long") for x in starts[k : k + step]]) for k in range(0, len(starts), step)])
    at_most = lambda a: F.size(F.filter(a, lambda x: x <= key))
    block = F.greatest(at_most(coarse), F.lit(1))
    return F.greatest((block - 1) * step + at_most(F.element_at(fine, block)) - 1, F.lit(0))


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(bucket, after, doc_id, text): rows dealt to one partition a range of ids and sorted there, each range closed by the next one's first row.

    ``after`` is 0 for a range's own rows, 1 for rows of the id that the following range starts with (the last range is
    followed by the first), and -1 for rows without an id, which belong to no range and are spread by their text.  Ranges
    are cut at approximate quantiles and begin at ids that exist, so only rows of those ids are dealt twice; the driver
    gets one id a range.  Rows of one id are in the order of their texts' hash.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / parts for k in range(parts)], 20 * parts)).first()[0] or [0]
    rough = _bucket(F.col("doc_id"), sorted(set(cuts)))
    starts = rows.where("doc_id is not null").groupBy(rough.alias("bucket")).agg(F.min("doc_id").alias("start"))
    starts = sorted(r["start"] for r in starts.collect()) or [0]
    n = len(starts)
    bucket = _bucket(F.col("doc_id"), starts)
    first = F.element_at(F.array(*[F.lit(x).cast("long") for x in starts]), bucket + 1) == F.col("doc_id")
    own = F.struct(bucket.alias("bucket"), F.lit(0).alias("after"))
    copy = F.struct(F.pmod(bucket + n - 1, F.lit(n)).alias("bucket"), F.lit(1).alias("after"))
    alone = F.struct(F.pmod(F.xxhash64("text"), F.lit(n)).cast("int").alias("bucket"), F.lit(-1).alias("after"))
    places = F.when(F.col("doc_id").isNull(), F.array(alone)).when(first, F.array(own, copy)).otherwise(F.array(own))
    dealt = rows.select(F.explode(places).alias("p"), "doc_id", "text").select("p.bucket", "p.after", "doc_id", "text")
    return dealt.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "after", "doc_id", F.xxhash64("text"))


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 4, width: int = WIDTH, count: int = PERMUTATIONS,
    bands: int = 25, rows: int = 5,
) -> DataFrame:
    """How alike every document is to its edited text and to the next document, in ascending order of ids.

    The edited text has the last 1/``share`` of the code points replaced by as many first ones of the next document, or
    all if it has fewer; the first document follows the last.  Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next (likeness of the fingerprints), jaccard_edited, jaccard_next (of the
    shingle sets themselves) and bands_edited, bands_next: how many of ``bands`` bands of ``rows`` minima agree, so
    whether a join of the bands would meet the two.

    Null texts are empty.  A row without an id has no place in the order and is its own next document, as is the only
    document of a table.  Rows of one id follow one another by their texts' hash.  An empty table gives no rows; other
    columns are not read, whatever their names.  Texts are shuffled once; a task holds a batch and the longest text.
    """
    bounded_batches(docs.sparkSession)
    used = bands * rows

    def sketch(text: str):
        found = shingle_set(text.encode(), width)
        least = minima(found, max(count, used))
        return text, found, least, least[:count].astype(">u2")

    def compared(doc_id, mine, after):
        text, found, least, print_ = mine
        n = len(text)
        cut = n // share
        edited = sketch(text[: n - cut] + after[0][:cut]) if cut else mine
        shared = [int((x[:used].reshape(bands, rows) == least[:used].reshape(bands, rows)).all(axis=1).sum()) for x in (edited[2], after[2])]
        return (
            doc_id, n, hashlib.sha256(edited[0].encode()).hexdigest(), print_.tobytes().hex(), edited[3].tobytes().hex(),
            likeness(print_, edited[3]), likeness(print_, after[3]), jaccard(found, edited[1]), jaccard(found, after[1]), *shared,
        )

    names = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next jaccard_edited jaccard_next bands_edited bands_next".split()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4, pa.int32(), pa.int32()]

    def per_partition(batches):
        held = None  # (bucket, id, sketch) of the row whose next one is awaited
        for batch in batches:
            out = []
            for bucket, after, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if after > 0 and not (held and held[0] == bucket):
                    continue  # a further row of the id that follows the range
                mine = sketch(text)
                if after < 0:
                    out.append(compared(doc_id, mine, mine))
                    continue
                if held and held[0] == bucket:
                    out.append(compared(held[1], held[2], mine))
                held = None if after else (bucket, doc_id, mine)
            columns = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
        "jaccard_edited double, jaccard_next double, bands_edited int, bands_next int"
    )
    return in_order(docs, id_col, text_col).mapInArrow(per_partition, schema)
