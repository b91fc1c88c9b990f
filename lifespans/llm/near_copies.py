"""Near copies by the Jaccard similarity of word shingles: SimHash prints within a distance are candidates, exact sets verify them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .minhash import shingle_set
from .simhash import near_forest, set_fingerprint, whole_groups
from .storage import Scratch, bounded_batches

PLACE = ["b", "key", "lo", "hi"]


def similar_forest(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Spanning edges (positions) of the graph that links sets of a Jaccard similarity of at least ``similarity``."""
    sizes = np.array([len(x) for x in sets])
    starts = np.r_[0, np.cumsum(sizes)]
    every, ids = np.unique(np.concatenate(sets), return_inverse=True)
    marked, alive = np.zeros(len(every), bool), np.ones(len(sets), bool)
    owner, held = np.repeat(np.arange(len(sets)), sizes), ids
    edges, left = [], np.arange(len(sets))
    while len(left):
        frontier, left = [left[0]], left[1:]
        alive[frontier[0]] = False
        while frontier and len(left):
            at = frontier.pop()
            own = ids[starts[at] : starts[at + 1]]
            marked[own] = True
            shared = np.bincount(owner[marked[held]], minlength=len(sets))[left]
            marked[own] = False
            near = shared >= similarity * (sizes[left] + sizes[at] - shared) - 1e-9
            if near.any():
                found = left[near]
                edges += [(at, x) for x in found]
                frontier += found.tolist()
                left, alive[found] = left[~near], False
                stays = alive[owner]
                owner, held = owner[stays], held[stays]
    return edges


def _text_class(text: Column) -> Column:
    """128 bits that are the same for all equal texts; texts without a word are one class."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.md5(F.when(text.rlike(r"[^\t-\r ]"), text).otherwise(F.lit(""))))


def _edges(groups: DataFrame, forest) -> DataFrame:
    """Edges (u, v) of ``forest`` (a table's slice to pairs of its positions) in each group of equal ``PLACE`` of ``groups``."""

    def per_partition(batches):
        for keys, table in whole_groups(batches, 4):
            names = table.column("node").to_numpy()
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            pairs = [np.empty((0, 2), np.int64)]
            for a, z in zip(starts, np.r_[starts[1:], len(keys)]):
                if z - a > 1:
                    pairs.append(np.array(forest(table.slice(a, z - a)), np.int64).reshape(-1, 2) + a)
            found = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(names[found[:, 0]]), pa.array(names[found[:, 1]])], ["u", "v"])

    return groups.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(per_partition, "u long, v long")


def _linked(members: DataFrame, compared, scratch: Scratch, chunk: int) -> DataFrame:
    """(node, root) of the components that the edges of ``compared`` make of buckets of any size.

    ``members`` (b, key, node, n, ...) of equal b and key are a bucket; ``compared`` gives the edges of members dealt to
    places (lo, hi).  A bucket of up to ``chunk`` in the sum of n is one place; a larger one is cut into chunks.  First
    each chunk is compared in itself and with one member of its bucket, which joins groups of near copies whatever their
    size.  Then, in larger buckets that are not one component yet, the members outside the largest component are compared
    with one another and with it, chunk by chunk; so no place grows with the bucket and no pair is left out.
    """
    sizes = members.groupBy("b", "key").agg(F.sum("n").alias("all"), F.min("node").alias("one")).where(F.col("all") > chunk)
    sizes = scratch.table(sizes, "sizes")
    cut = F.coalesce(F.ceil(F.col("all") / chunk).cast("int"), F.lit(1))
    dealt = members.join(F.broadcast(sizes), ["b", "key"], "left").withColumn("s", cut)
    own = F.array(F.pmod(F.xxhash64("node"), F.col("s")).cast("int"))
    every = F.when(F.col("node") == F.col("one"), F.sequence(F.lit(0), F.col("s") - 1)).otherwise(own)
    first = dealt.withColumn("lo", F.explode(every)).withColumn("hi", F.col("lo")).drop("all", "one", "s")
    edges = scratch.table(compared(first), "edges")
    roots = connected_components(edges, scratch)
    if sizes.isEmpty():
        return roots
    large = members.join(F.broadcast(sizes.select("b", "key")), ["b", "key"])
    large = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = large.groupBy("b", "key", "root").agg(F.sum("n").alias("n"))
    parts = parts.groupBy("b", "key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"))
    chunks = lambda n: F.ceil(n / chunk).cast("int")
    parts = parts.where("most < all").select("b", "key", "main", chunks(F.col("most")).alias("s"), chunks(F.col("all") - F.col("most")).alias("rest"))
    large = large.join(F.broadcast(parts), ["b", "key"])
    inside, last = F.col("root") == F.col("main"), F.col("s") + F.col("rest") - 1  # chunks of the main component, then the rest's
    mine = F.pmod(F.xxhash64("node"), F.when(inside, F.col("s")).otherwise(F.col("rest"))).cast("int")
    large = large.withColumn("c", F.when(inside, mine).otherwise(F.col("s") + mine))
    others = F.when(inside, F.sequence("s", last)).otherwise(F.filter(F.sequence(F.lit(0), last), lambda x: x != F.col("c")))
    rest = large.withColumn("o", F.explode(others)).withColumn("lo", F.least("c", "o")).withColumn("hi", F.greatest("c", "o"))
    more = scratch.table(compared(rest.drop("root", "main", "s", "rest", "c", "o")), "more-edges")
    return connected_components(edges.unionByName(more), Scratch(scratch.spark, "near-copies"))


def _differing(similarity: float) -> float:
    """The share of SimHash bits that differ between sets of a Jaccard similarity and of equal size: their angle over pi."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def distance_for(similarity: float, length: int = 256, deviations: float = 4.4) -> int:
    """The distance that pairs of the given similarity exceed by chance only: the mean and 4.4 standard deviations (64 of 256 bits at 0.8)."""
    share = _differing(similarity)
    return round(length * share + deviations * math.sqrt(length * share * (1 - share)))


def bands_for(bits: int, length: int = 256, distance: int = 64, similarity: float = 0.8, miss: float = 4e-4) -> int:
    """How many choices of ``bits`` of ``length`` SimHash bits leave a share of at most ``miss`` of pairs unmet.

    Each bit differs with the same probability, so the number that differs is binomial; pairs beyond ``distance`` count as unmet.
    """
    share = _differing(similarity)
    apart = np.arange(distance + 1)
    log_choose = np.array([math.lgamma(length + 1) - math.lgamma(k + 1) - math.lgamma(length - k + 1) for k in apart])
    weight = np.exp(log_choose + apart * math.log(max(share, 1e-12)) + (length - apart) * math.log1p(-share))
    agree = np.prod([(length - apart - k) / (length - k) for k in range(bits)], axis=0) if bits else np.ones(len(apart))
    miss, bands = max(miss, 1.01 * (1 - weight.sum())), 1  # what lies beyond the distance no choice can meet
    while 1 - (weight * (1 - (1 - agree) ** bands)).sum() > miss:
        bands += 1
    return bands


def candidates(classes: DataFrame, scratch: Scratch, distance: int, similarity: float, bucket: int, chunk: int) -> DataFrame:
    """(node, root) of the ``classes`` (node, print) that SimHash links join: prints that differ in at most ``distance`` bits.

    Prints meet in buckets of equal bits, once for each of several choices of bits.  With more classes a key has more
    bits, so that a bucket holds about ``bucket`` prints at most, and there are as many choices as ``bands_for`` says.
    """
    bits = max(0, math.ceil(math.log2(max(1, classes.count()) / bucket)))
    length = 8 * len(set_fingerprint(np.empty(0, np.uint64)))
    bands = bands_for(bits, length, distance, similarity)
    deal, chosen = np.random.default_rng(5), np.empty(0, np.int64)
    while len(chosen) < bands * bits:  # all bits once, in random order, before any is used again
        chosen = np.r_[chosen, deal.permutation(length)]
    chosen = chosen[: bands * bits].reshape(bands, bits)

    def keyed(batches):
        for batch in batches:
            prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            keys = np.unpackbits(prints, axis=1)[:, chosen] @ (1 << np.arange(bits, dtype=np.int64))
            row = np.repeat(np.arange(batch.num_rows), bands)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(bands), batch.num_rows)), pa.array(keys.ravel()), batch.column(0).take(row), batch.column(1).take(row)],
                                             ["b", "key", "node", "print"])

    def forest(table):
        return near_forest(np.frombuffer(b"".join(table.column("print").to_pylist()), np.uint64).reshape(table.num_rows, -1), distance)

    members = classes.select("node", "print").mapInArrow(keyed, "b long, key long, node long, print binary").withColumn("n", F.lit(1))
    return _linked(members, lambda rows: _edges(rows.select(*PLACE, "node", "print"), forest), scratch, chunk)


def verified(found: DataFrame, classes: DataFrame, texts: DataFrame, scratch: Scratch, width: int, similarity: float, chunk: int) -> DataFrame:
    """(node, root) of the ``classes`` (class, node, n) of ``texts`` (class, text) that links of exact similarity join.

    The members of a component of candidates ``found`` (node, root) are a bucket.  Only texts of such components are
    dealt (as texts: sets of 64-bit numbers are larger and can't be compressed); a place makes their sets, compares
    them exactly and emits a spanning forest.
    """
    roots = found.select("root").distinct().withColumn("node", F.col("root"))
    members = found.select("node", "root").unionByName(roots.select("node", "root")).distinct().join(classes.select("node", "n"), "node")
    members = scratch.table(members.select(F.lit(0).cast("long").alias("b"), F.col("root").alias("key"), "node", "n"), "members")
    own = texts.groupBy("class").agg(F.first("text").alias("text")).join(classes.select("class", "node"), "class").select("node", "text")

    def compared(rows):
        by_node = rows.groupBy("node").agg(F.collect_set(F.struct(*PLACE)).alias("places"))
        return _edges(by_node.join(own, "node").select(F.explode("places").alias("p"), "node", "text").select("p.*", "node", "text"), forest)

    def forest(table):
        return similar_forest([shingle_set(x, width) for x in table.column("text").to_pylist()], similarity)

    return _linked(members, compared, scratch, chunk)


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8,
    distance: int | None = None, bucket: int = 2048, prints: int = 8192, chunk: int = 2_000_000,
) -> DataFrame:
    """(doc_id, component_id) of every document: the smallest doc_id reachable over links, itself included.

    Documents are linked if the Jaccard similarity of their sets of ``width``-word shingles is at least ``similarity``
    and SimHash makes them candidates: the 256-bit SimHash prints of the sets are joined to components over prints that
    agree on a choice of bits and differ in at most ``distance`` (by default what ``distance_for`` says, 64 at 0.8), and the
    members of a component are compared.  A pair of similarity 0.8 is within 64 bits and meets with probability 0.9996 by the binomial law of ``bands_for``; very
    short texts (4 shingles against 5) are within 64 bits with 0.996.  Every link is verified on the whole sets.  Buckets
    beyond ``prints`` prints and components beyond ``chunk`` shingles are compared in chunks.  Texts of equal 128-bit MD5 are one
    class, and null, empty and blank texts are one class as well.  One row per input row; a null doc_id never names a
    component (one of null ids only has a null component_id).  An empty table gives no rows; other columns are not read,
    whatever their names.
    """
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near-copies")
    distance = distance_for(similarity) if distance is None else distance

    def per_batch(batches):
        for batch in batches:
            sets = [shingle_set(x, width) for x in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array([len(x) for x in sets], pa.int64()), pa.array([set_fingerprint(x).tobytes() for x in sets])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "class", "n", "print"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_class(F.col(text_col)).alias("class"), F.col(text_col).cast("binary").alias("text"))
    printed = scratch.table(texts.mapInArrow(per_batch, "doc_id long, class binary, n long, print binary"), "prints")
    classes = printed.groupBy("class").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("print").alias("print"))
    classes = scratch.table(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    found = candidates(classes.where("n > 0"), Scratch(scratch.spark, "near-copies"), distance, similarity, bucket, prints)
    roots = verified(found, classes, texts.select("class", "text"), scratch, width, similarity, chunk)
    placed = classes.join(roots, "node", "left").select("class", "least", F.coalesce("root", "node").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(named, "root").select("class", "component_id")
    return printed.select("doc_id", "class").join(placed, "class").select("doc_id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that name their component: one document of each group of near copies, all its columns.

    Of several rows with the kept id one stays, chosen by a hash of its text.  Rows with a null id can't be told apart by id; they all stay.
    An empty table stays empty; other columns may have any names but those of ``id_col`` and ``text_col`` twice.
    """
    found = near_copies(docs, id_col, text_col, **options)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"))
    order = F.struct(F.xxhash64(F.col(f"row.`{text_col}`")), F.xxhash64("row"))
    rest = packed.join(kept, F.col("id") == F.col("kept"), "left_semi")
    one = rest.groupBy("id").agg(F.min_by("row", order).alias("row"))
    return one.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
