"""SimHash near-duplicates: fingerprints, blocks of their bits, verified links, components."""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import Scratch, bounded_batches
from .textual import runs_of_words

BITS = 64


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set; uint8 partial sums over up to 255 rows keep it vectorised."""
    bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS)
    full = len(bits) // 255 * 255
    counts = bits[full:].sum(axis=0, dtype=np.int64)
    if full:
        counts += bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(data: bytes | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit integer.

    Features are the space-joined ``width``-word shingles of the lower-cased text, repeats included; a text of fewer
    words is one shingle and a text of none (or null) has fingerprint zero.
    """
    carry: list[bytes] = []
    counts, n = np.zeros(BITS, np.int64), 0
    for words in runs_of_words((data or b"").lower()):
        words = carry + words
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(words) - width + 1)
            counts += _bit_counts(hashes)
            n += len(hashes)
            carry = words[len(words) - width + 1 :]
        else:
            carry = words
    if not n and carry:
        counts, n = _bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(carry), seed)], np.uint64)), 1
    return int(np.packbits(2 * counts > n).view(np.int64)[0])


def set_fingerprint(hashes: np.ndarray, words: int = 4) -> np.ndarray:
    """SimHash of a set of 64-bit hashes in ``words`` x 64 bits, as bytes: a bit is 1 if set in over half the hashes.

    The first 64 bits are those of the hashes themselves, the others those of the hashes mixed anew for each word.
    """
    counts = [_bit_counts(hashes)]
    for word in range(1, words):
        mixed = (hashes + np.uint64(word)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
        counts.append(_bit_counts(mixed))
    return np.packbits(2 * np.concatenate(counts) > len(hashes))


def near_forest(prints: np.ndarray, distance: int, step: int = 64) -> np.ndarray:
    """Spanning edges (rows of two positions) of the graph that links prints (rows of 64-bit words) at most ``distance`` bits apart.

    Most prints of a bucket are near no other; they are told by comparing ``step`` rows with all at a time.
    """
    columns = np.ascontiguousarray(prints.T)

    def apart(some: np.ndarray, all_: np.ndarray) -> np.ndarray:
        total = np.bitwise_count(some[0][:, None] ^ all_[0]).astype(np.uint16)
        for x, y in zip(some[1:], all_[1:]):
            total += np.bitwise_count(x[:, None] ^ y)
        return total

    near = np.zeros(len(prints), bool)
    for k in range(0, len(prints), step):
        linked = apart(columns[:, k : k + step], columns[:, k:]) <= distance
        near[k : k + step] |= linked.sum(axis=1) > 1
        near[k + step :] |= linked[:, step:].any(axis=0)
    some = np.flatnonzero(near)
    edges, left, held = [np.empty((0, 2), np.int64)], some, columns[:, some]
    while len(left):
        frontier, left, held = [left[0]], left[1:], held[:, 1:]
        while frontier and len(left):
            at = frontier.pop()
            linked = apart(columns[:, [at]], held)[0] <= distance
            if linked.any():
                found = left[linked]
                edges.append(np.column_stack([np.full(len(found), at), found]))
                frontier += found.tolist()
                left, held = left[~linked], held[:, ~linked]
    return np.concatenate(edges)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint long) per row of ``docs``; only the two named columns are read."""
    bounded_batches(docs.sparkSession)

    def per_batch(batches):
        for batch in batches:
            prints = [fingerprint(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fingerprint"])

    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return pairs.mapInArrow(per_batch, "doc_id long, fingerprint long")


def block_masks(distance: int = 3, blocks: int = 6) -> list[int]:
    """Masks of all choices of ``blocks - distance`` blocks: prints that differ in up to ``distance`` bits agree on one."""
    if not 0 < distance < blocks <= BITS:
        raise ValueError("blocks must exceed the distance")
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    return [sum(block[i] for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def _forest(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning edges (positions) of the graph that links prints at most ``distance`` bits apart."""
    edges, left = [], np.arange(len(prints))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= distance
            if near.any():
                found = left[near]
                edges += [(at, x) for x in found]
                frontier += found.tolist()
                left = left[~near]
    return edges


def whole_groups(batches, width: int):
    """(keys, table) of sorted batches, cut so that no group of equal first ``width`` columns is torn."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not table.num_rows:
            continue
        keys = np.column_stack([table.column(i).to_numpy().astype(np.int64) for i in range(width)])
        changed = np.flatnonzero((keys != keys[-1]).any(axis=1))
        cut = int(changed[-1]) + 1 if len(changed) else 0
        if cut:
            yield keys[:cut], table.slice(0, cut).combine_chunks()
        held = table.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield np.column_stack([held.column(i).to_numpy().astype(np.int64) for i in range(width)]), held


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(classes: DataFrame, distance: int = 3, blocks: int = 6, chunk: int = 4096) -> DataFrame:
    """Edges (u, v) between ``classes`` (fingerprint, rep) that keep its components whole.

    Classes are dealt by every block key.  A bucket of up to ``chunk`` distinct prints is one group; a larger one is
    cut into chunks, and each pair of chunks is a group of its own, so no group grows with the bucket and no pair is
    left out.  A group compares its prints in numpy and emits a spanning forest of the verified links, never all pairs.
    """
    masks = F.array(*[
        F.struct(F.lit(i).alias("b"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(block_masks(distance, blocks))
    ])
    keyed = classes.select("fingerprint", "rep", F.explode(masks).alias("k")).select("fingerprint", "rep", "k.b", "k.key")
    shared = keyed.groupBy("b", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    dealt = keyed.join(shared, ["b", "key"]).withColumn("s", parts).withColumn(
        "c", F.pmod(F.xxhash64("fingerprint"), F.col("s")).cast("int")
    )
    others = F.when(F.col("s") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("s") - 1), lambda x: x != F.col("c"))
    )
    groups = dealt.select("fingerprint", "rep", "b", "key", "c", F.explode(others).alias("o")).select(
        "b", "key", F.least("c", "o").alias("lo"), F.greatest("c", "o").alias("hi"), "fingerprint", "rep"
    )

    def per_partition(batches):
        for keys, table in whole_groups(batches, 4):
            prints = table.column("fingerprint").to_numpy().astype(np.int64).view(np.uint64)  # bit counts are of magnitudes
            reps = table.column("rep").to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(keys)]
            twos = starts[ends - starts == 2]
            twos = twos[np.bitwise_count(prints[twos] ^ prints[twos + 1]) <= distance]
            pairs = [np.column_stack([twos, twos + 1])]
            for a, z in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                pairs.append(np.array(_forest(prints[a:z], distance), np.int64).reshape(-1, 2) + a)
            found = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(reps[found[:, 0]]), pa.array(reps[found[:, 1]])], ["u", "v"])

    order = ["b", "key", "lo", "hi"]
    return groups.repartition(*order).sortWithinPartitions(*order).mapInArrow(per_partition, "u long, v long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 3, blocks: int = 6
) -> DataFrame:
    """Fingerprint and component of every document.

    Returns doc_id, fingerprint (16 lowercase hex digits) and component_id, the smallest doc_id reachable over links
    of at most ``distance`` differing bits, itself included.  One row per input row: repeated rows give equal rows;
    null and empty texts have fingerprint zero and link like any other; a null doc_id keeps a null doc_id and never
    names a component (a component of null ids only has a null component_id).  An empty table gives no rows.
    Equal fingerprints are one class with a number of its own, so a group of copies of any size is one row of the link
    search and ids may be any 64-bit integers.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.table(fingerprints(docs, id_col, text_col), "prints")
    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    classes = scratch.table(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    roots = connected_components(links(classes.select("fingerprint", "rep"), distance, blocks), scratch)
    placed = classes.join(roots, F.col("rep") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("root", "rep").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(named, "root").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(placed, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that name their component: one document of each near-duplicate group, all its columns.

    Of several rows with the kept id one stays, chosen by a hash of its text.  Rows with a null id can't be told apart by id; they all stay.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"))
    order = F.struct(F.xxhash64(F.col(f"row.`{text_col}`")), F.xxhash64("row"))
    rest = packed.join(kept, F.col("id") == F.col("kept"), "left_semi")
    one = rest.groupBy("id").agg(F.min_by("row", order).alias("row"))
    return one.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
