"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, and how often ids are linked."""

from __future__ import annotations

import hashlib
import os
import struct
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import Scratch, bounded_batches
from .tokens import Encoder, Kept, byte_letters, sized_batches

SPACE = "▁"  # what stands for a space in pieces
BUCKETS = 64  # of ids of the first tokenizer; a bucket's pairs are bounded by the two vocabularies
BATCH = 1 << 20  # bytes of text that are aligned at once
WIDE = 4096  # links of a group from which on its ids are counted first
SLICE = 1_000_000  # links that are made at once
ENTRIES = 16 << 20  # bytes of postings that a scoring task reads


class ByteTokens(Encoder):
    """The byte-level tokenizer, special strings as plain text, with the bytes of each id."""

    def __init__(self, path: str, kept: int = 100_000):
        super().__init__(path, kept, plain_special=True)
        back = {letter: byte for byte, letter in byte_letters().items()}
        entry = [self.library.id_to_token(k) or "" for k in range(self.library.get_vocab_size())]
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.bytes = [x.encode() if x in special else bytes(map(back.__getitem__, x)) for x in entry]


class PieceTokens(Encoder):
    """A sentencepiece model that puts a space before each text; texts are given with that space.

    No piece of a model that may be cut has a space behind another character, so no token crosses from a character to a
    space after it: texts are cut there, and the ids of what stands between are kept.  Other models get whole texts.
    """

    def __init__(self, path: str, kept: int = 100_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules, size = model.normalizer_spec, self.library.get_piece_size()
        pieces = [self.library.id_to_piece(k) for k in range(size)]
        self.bytes = [bytes([int(x[3:5], 16)]) if self.library.is_byte(k) else x.replace(SPACE, " ").encode() for k, x in enumerate(pieces)]
        self.lone = self.library.piece_to_id(SPACE)
        plain = rules.name == "identity" and rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
        self.by_piece = (
            plain and not rules.precompiled_charsmap and not self.library.is_unknown(self.lone)
            and not any(y != SPACE and z == SPACE for x in pieces for y, z in zip(x, x[1:]))
        )
        self.special, self.pieces = [], Kept(kept)
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32

    def _cuts(self, data: bytes, starts: np.ndarray) -> np.ndarray:
        space = np.frombuffer(data, np.uint8) == 32
        space[1:] &= ~(np.frombuffer(data, np.uint8)[:-1] == 32)
        space[starts] = True
        return np.flatnonzero(space)

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        """Texts come with the space that the model adds itself."""
        found = self.library.encode([t[1:].decode(errors="replace") for t in texts], num_threads=1)
        return [np.array(x if len(t) > 1 else [self.lone], self.dtype).tobytes() for t, x in zip(texts, found)]

    def _learn(self, pieces: list[bytes]) -> None:
        found = self.library.encode([p[1:].decode(errors="replace") for p in pieces], num_threads=1)
        found = [x if len(p) > 1 else [self.lone] for p, x in zip(pieces, found)]
        ids = np.array(list(chain.from_iterable(found)), self.dtype).tobytes()
        ends = list(accumulate([len(f) * self.dtype().itemsize for f in found]))
        self.pieces.new.update(zip(pieces, [ids[a:z] for a, z in zip([0, *ends], ends)]))


class Pair:
    """Both tokenizers with the tables that the alignment looks ids up in."""

    def __init__(self, a: str, b: str):
        pa.set_cpu_count(1)  # a task has one core
        self.coders = ByteTokens(a), PieceTokens(b)
        self.entry = [pa.array(c.bytes, pa.large_binary()) for c in self.coders]
        self.size = [pa.array([len(x) for x in c.bytes], pa.int64()) for c in self.coders]
        self.width = [len(c.bytes) for c in self.coders]
        decimal = [str(k) for k in range(max(self.width))]
        self.decimals = pa.array([x + end for end in (",", "|", ";", "") for x in decimal], pa.large_string())

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, list[pa.ListArray]]:
        """Which texts have tokens, and the ids of those in both tokenizers: texts whose tokens' bytes make up space and text."""
        some = np.flatnonzero([len(t) > 0 for t in texts])
        spaced = [b" " + texts[k] for k in some]
        good, lists = np.ones(len(some), bool), []
        data, ends = b"".join(spaced), np.cumsum([len(t) for t in spaced], dtype=np.int64)
        for coder, entry in zip(self.coders, self.entry):
            ids = coder.encode(spaced)
            flat = np.frombuffer(b"".join(ids), coder.dtype).astype(np.int32)
            offsets = np.r_[0, np.cumsum([len(x) // coder.dtype().itemsize for x in ids])].astype(np.int64)
            bytes_ = entry.take(pa.array(flat))
            at = np.frombuffer(bytes_.buffers()[1], np.int64, len(flat) + 1)[offsets] if len(flat) else np.zeros(len(offsets), np.int64)
            joined = bytes_.buffers()[2].to_pybytes()[: at[-1]] if len(flat) else b""
            if joined != data:
                good &= [joined[x:y] == t for x, y, t in zip(at.tolist(), at[1:].tolist(), spaced)]
            lists.append(pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat)))
        return some[good], [x.filter(pa.array(good)) for x in lists] if not good.all() else lists


def groups(a: pa.LargeListArray, b: pa.LargeListArray, size_a: pa.Array, size_b: pa.Array) -> dict[str, np.ndarray]:
    """Where tokens of both end: for each group its document and its last token's position among all of a and of b.

    Both flattened lists cover the same bytes, so running sums of the tokens' lengths over all documents are the
    documents' bases plus the ends inside them: a number that stands for (document, end) and that the two sides are
    joined on.
    """
    ids, ends = [pc.list_flatten(a), pc.list_flatten(b)], []
    parent = pc.list_parent_indices(a).to_numpy()
    for flat, size, name in zip(ids, (size_a, size_b), "ab"):
        end = pc.cumulative_sum(size.take(flat))
        ends.append(pa.table({"end": end, name: pa.array(np.arange(len(flat), dtype=np.int32))}))
    common = ends[0].join(ends[1], "end", join_type="inner", use_threads=False)
    at_a, at_b = np.sort(common["a"].to_numpy()), np.sort(common["b"].to_numpy())  # both rise with the end
    return {"a": ids[0].to_numpy(), "b": ids[1].to_numpy(), "at_a": at_a, "at_b": at_b, "doc": parent[at_a]}


def digests(found: dict[str, np.ndarray], docs: int, decimals: pa.Array) -> list[str]:
    """SHA-256 of every document's groups written as ``a1,a2|b1;a3|b2,b3``."""
    a, b, at_a, at_b, doc = (found[k] for k in ("a", "b", "at_a", "at_b", "doc"))
    count_a, count_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    n, text = len(decimals) // 4, np.empty(len(a) + len(b), np.int64)
    text[np.arange(len(a)) + np.repeat(at_b - count_b + 1, count_a)] = a  # behind the groups before
    text[np.arange(len(b)) + np.repeat(at_a + 1, count_b)] = b
    text[at_a + at_b - count_b + 1] += n
    last = at_a + at_b + 1
    final = np.r_[doc[1:] != doc[:-1], True] if len(doc) else np.zeros(0, bool)
    text[last] += np.where(final, 3 * n, 2 * n)
    written = decimals.take(pa.array(text))
    ends = np.zeros(docs + 1, np.int64)
    if len(doc):
        ends[1:] = np.frombuffer(written.buffers()[1], np.int64, len(text) + 1)[last[final] + 1]
    view = memoryview(written.buffers()[2]) if len(doc) else b""
    return [hashlib.sha256(view[x:y]).hexdigest() for x, y in zip(ends.tolist(), ends[1:].tolist())]


def linked(found: dict[str, np.ndarray], docs: int, width_a: int, width_b: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, links) of the different (id of a, id of b, document) of a batch; a key counts bucket, a, b, document.

    Links are made from the tokens slice by slice and counted in each.  Of a group with very many links the ids are
    counted first, so that its work and memory are those of its different pairs.
    """
    a, b, at_a, at_b, doc = (found[k] for k in ("a", "b", "at_a", "at_b", "doc"))
    count_a, count_b = np.diff(at_a, prepend=-1).astype(np.int64), np.diff(at_b, prepend=-1).astype(np.int64)
    parts: list[pa.Table] = []

    def key(x, y, d):
        x = x.astype(np.int64)
        return ((x % BUCKETS * width_a + x) * width_b + y) * docs + d

    def add(keys, links):
        table = pa.table({"key": keys, "n": links}).group_by("key", use_threads=False).aggregate([("n", "sum")])
        parts.append(table.rename_columns(["key", "n"]))

    wide = count_a * count_b > WIDE
    many = np.where(wide, 0, count_b)
    each = np.repeat(many, count_a)  # links of a token of a
    start, owner = np.repeat(at_b - count_b + 1, count_a), np.repeat(doc, count_a)
    total = np.cumsum(each)
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, side="right")))
        r = each[at:to]
        inside = np.arange(int(r.sum())) - np.repeat(np.cumsum(r) - r, r)
        if len(inside):
            add(key(np.repeat(a[at:to], r), b[np.repeat(start[at:to], r) + inside], np.repeat(owner[at:to], r)), np.ones(len(inside), np.int64))
        at = to
    for g in np.flatnonzero(wide):
        x, m = np.unique(a[at_a[g] - count_a[g] + 1 : at_a[g] + 1], return_counts=True)
        y, k = np.unique(b[at_b[g] - count_b[g] + 1 : at_b[g] + 1], return_counts=True)
        step = max(1, SLICE // len(y))
        for s in range(0, len(x), step):
            some = x[s : s + step]
            add(key(np.repeat(some, len(y)), np.tile(y, len(some)), doc[g]), np.outer(m[s : s + step], k).ravel().astype(np.int64))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    whole = pa.concat_tables(parts)
    if len(parts) > 1:
        whole = whole.group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])
    keys, links = whole["key"].to_numpy(), whole["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], links[order]


def _planes(x: np.ndarray) -> bytes:
    """Four bytes a number, all first bytes before all second ones: mostly zeros, which compress well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(data: bytes, n: int, at: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8, 4 * n, at).reshape(4, n).T.copy().view("<u4").ravel()


def pack(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, docs: np.ndarray, links: np.ndarray) -> bytes:
    """A bucket's postings: different pairs (a, b), how many documents hold each, the documents and their links."""
    body = b"".join(_planes(x) for x in (a, b, sizes, docs, links))
    return struct.pack("<III", len(a), len(docs), len(body)) + pa.Codec("zstd", 3).compress(body, asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    pairs, entries, size = struct.unpack_from("<III", blob)
    data = pa.Codec("zstd").decompress(blob[12:], size, asbytes=True)
    out, at = [], 0
    for n in (pairs, pairs, pairs, entries, entries):
        out.append(_numbers(data, n, at))
        at += 4 * n
    return tuple(out)


_pairs: dict[tuple[str, str], Pair] = {}


def pair(a: str, b: str) -> Pair:
    """The process's two tokenizers."""
    if (a, b) not in _pairs:
        _pairs[a, b] = Pair(a, b)
    return _pairs[a, b]


ROW = "batch long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket int, postings binary"
_NAMES = [x.split()[0] for x in ROW.split(", ")]
_KINDS = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.int32(), pa.binary()]


def aligned_batches(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (batch, place, sizes, digest) and rows of postings (batch, bucket, postings), one of each bucket a batch."""
    bounded_batches(docs.sparkSession)

    def rows(**columns):
        n = len(next(iter(columns.values())))
        arrays = [pa.array(columns[k], kind) if k in columns else pa.nulls(n, kind) for k, kind in zip(_NAMES, _KINDS)]
        return pa.RecordBatch.from_arrays(arrays, _NAMES)

    def per_partition(batches):
        both, number = pair(a, b), TaskContext.get().partitionId() << 36
        for batch in sized_batches(batches, BATCH, 1):
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            has, (left, right) = both.tokens(texts)
            found = groups(left, right, *both.size)
            n, sizes = len(texts), {}
            per_group = np.diff(found["at_a"], prepend=-1).astype(np.int64) * np.diff(found["at_b"], prepend=-1)
            last = np.searchsorted(found["doc"], np.arange(len(has)), side="right")
            values = [pc.list_value_length(left).to_numpy(), pc.list_value_length(right).to_numpy(), np.diff(last, prepend=0), np.diff(np.r_[0, np.cumsum(per_group)][last], prepend=0)]
            for name, x in zip(("n_a", "n_b", "n_groups", "n_links"), values):
                sizes[name] = np.zeros(n, np.int64)
                sizes[name][has] = x
            digest = [""] * n
            for k, x in zip(has.tolist(), digests(found, len(has), both.decimals)):
                digest[k] = x
            yield rows(batch=np.full(n, number), place=np.arange(n), doc_id=batch.column(0), groups_sha256=digest, **sizes)
            keys, links = linked(found, max(1, len(has)), *both.width)
            ids, where = np.divmod(keys, max(1, len(has)))
            first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, np.int64)
            counts = np.diff(np.r_[first, len(ids)])
            x, y = np.divmod(ids[first], both.width[1])
            of, x = np.divmod(x, both.width[0])
            edges = np.searchsorted(of, np.arange(BUCKETS + 1))
            begin = np.r_[first, len(ids)]
            some = [k for k in range(BUCKETS) if edges[k] < edges[k + 1]]
            packed = [
                pack(x[s:e], y[s:e], counts[s:e], has[where[begin[s] : begin[e]]], links[begin[s] : begin[e]])
                for s, e in ((edges[k], edges[k + 1]) for k in some)
            ]
            if some:
                yield rows(batch=np.full(len(some), number), bucket=some, postings=packed)
            number += 1

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(per_partition, ROW)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, count, best): in how many documents each pair of ids is linked, and whether no pair of its a is in more."""

    def per_partition(batches):
        held, n = [], 0

        def merged():
            table = pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("count", "sum")])
            return table.select(["a", "b", "count_sum"]).rename_columns(["a", "b", "count"])

        for batch in batches:
            for blob in batch.column(0).to_pylist():
                a, b, sizes, _, _ = unpack(blob)
                held.append(pa.table({"a": a.astype(np.int32), "b": b.astype(np.int32), "count": sizes.astype(np.int64)}))
                n += len(a)
            if n > 2_000_000:
                held, n = [merged()], 0
                if held[0].num_rows > 1_000_000:
                    yield from held[0].combine_chunks().to_batches()
                    held = []
        if held:
            yield from merged().combine_chunks().to_batches()

    partial = rows.where("bucket is not null").select("postings").mapInArrow(per_partition, "a int, b int, count long")
    counts = partial.groupBy("a", "b").agg(F.sum("count").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def _score(batches):
    """Rows of one (bucket, salt) after another: first the bucket's counts, then postings, one at a time."""
    where, counts, table = None, [], None
    for batch in batches:
        bucket, salt, kind = (batch.column(k).to_numpy() for k in range(3))
        edge = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1]) | (kind[1:] != kind[:-1]), True])
        for s, e in zip(edge, edge[1:]):
            if where != (bucket[s], salt[s]):
                where, counts, table = (bucket[s], salt[s]), [], None
            part = batch.slice(s, e - s)
            if kind[s] == 0:
                counts.append([part.column(k).to_numpy(zero_copy_only=False) for k in (4, 5, 6, 7)])
                continue
            if table is None:
                a, b, n, best = (np.concatenate(x) for x in zip(*counts))
                pairs = a.astype(np.int64) << 32 | b
                order = np.argsort(pairs)
                table = pairs[order], n[order], best[order]
            for number, blob in zip(part.column(3).to_pylist(), part.column(8).to_pylist()):
                a, b, sizes, docs, links = unpack(blob)
                at = np.searchsorted(table[0], a.astype(np.int64) << 32 | b)
                links = links.astype(np.int64)
                sums = np.zeros((2, int(docs.max()) + 1), np.int64)
                np.add.at(sums[0], docs, links * np.repeat(table[2][at], sizes))
                np.add.at(sums[1], docs, links * np.repeat(table[1][at], sizes))
                place = np.flatnonzero(sums[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), number)), pa.array(place.astype(np.int32)), pa.array(sums[0][place]), pa.array(sums[1][place])],
                    ["batch", "place", "n_best", "count_sum"],
                )


def alignment(
    docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """How the tokens of two tokenizers align in every document, and how common its links are in all documents.

    Both encode a space and the text; byte offsets where tokens of both end cut the tokens into groups, and each token of
    a in a group is linked with each of b.  A pair's count is the number of rows that hold it linked.  Returns doc_id,
    n_a, n_b (tokens), n_groups, n_links, n_best (links whose count no other pair of the same a exceeds), count_sum
    (counts summed over the links) and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).

    Null and empty texts and texts that a tokenizer doesn't give back byte by byte have no tokens: zeros and an empty
    digest.  Repeated rows count each; a null id is kept; an empty table gives no rows; other columns are not read,
    whatever their names.

    Texts are encoded and aligned once, in batches, and never shuffled.  A batch's links are counted by (a, b, document)
    and stored as compressed postings by bucket of a; partial counts of pairs are merged by Spark; then postings meet the
    counts of their bucket.  Buckets are dealt with a salt for every 16 MB of postings, so neither a frequent id nor a
    large corpus makes a task larger; a task holds the counts of one bucket, at most the product of the bucket's ids and
    b's vocabulary, and one batch's postings.
    """
    scratch = Scratch(docs.sparkSession, "align")
    rows = scratch.table(aligned_batches(docs, a, b, id_col, text_col), "rows")
    counts = scratch.table(pair_counts(rows), "counts")
    posted = rows.where("bucket is not null")
    size = posted.agg(F.sum(F.length("postings"))).first()[0] or 0
    salts = max(1, -(-size // (BUCKETS * ENTRIES)))
    none = lambda kind: F.lit(None).cast(kind)
    weights = counts.select(
        F.pmod("a", F.lit(BUCKETS)).alias("bucket"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"),
        none("long").alias("batch"), "a", "b", "count", "best", none("binary").alias("postings"),
    )
    entries = posted.select(
        "bucket", F.pmod(F.xxhash64("batch"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), "batch",
        none("int").alias("a"), none("int").alias("b"), none("long").alias("count"), none("boolean").alias("best"), "postings",
    )
    dealt = weights.unionByName(entries).repartitionById(BUCKETS * salts, F.col("bucket") * salts + F.col("salt"))
    scored = dealt.sortWithinPartitions("bucket", "salt", "kind").mapInArrow(_score, "batch long, place int, n_best long, count_sum long")
    sums = scored.groupBy("batch", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = rows.where("bucket is null").join(sums, ["batch", "place"], "left").na.fill(0, ["n_best", "count_sum"])
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def aligned_groups(
    docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, groups array<struct<a array<int>, b array<int>, bytes long>>): each document's aligned groups and their bytes; without tokens none."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def per_partition(batches):
        both = pair(a, b)
        for batch in sized_batches(batches, BATCH, 1):
            has, (left, right) = both.tokens([t or b"" for t in batch.column(1).to_pylist()])
            found = groups(left, right, *both.size)
            parts = [pa.ListArray.from_arrays(pa.array(np.r_[0, found[f"at_{k}"] + 1].astype(np.int32)), pa.array(found[k])) for k in "ab"]
            ends = np.cumsum(both.size[0].to_numpy()[found["a"]])[found["at_a"]]
            whole = pa.StructArray.from_arrays([*parts, pa.array(np.diff(ends, prepend=0))], ["a", "b", "bytes"])
            n = np.zeros(batch.num_rows, np.int64)
            n[has] = np.bincount(found["doc"], minlength=len(has))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), whole)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "groups"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(per_partition, f"doc_id {kind}, groups array<struct<a:array<int>,b:array<int>,bytes:bigint>>")
