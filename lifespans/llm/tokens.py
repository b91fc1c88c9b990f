"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes."""

from __future__ import annotations

import os
import re
import struct
import zlib
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import Scratch, bounded_batches, open_fs, write_file

END = 2
MAGIC = b"RANKTOK1"
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)  # by control byte
SEGMENT = 8 << 20  # bytes of a text that are cut into pieces at once
BATCH = 3 << 20  # bytes of texts that are encoded at once

# Kinds of bytes.  BEYOND: of a character whose class is not looked up; nothing is cut beside it but before white space.
LETTER, DIGIT, MARK, TICK, BEYOND, SPACE, BLANK = range(7)
_KIND = np.full(256, MARK, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_KIND[48:58], _KIND[39], _KIND[128:], _KIND[32], _KIND[9:14] = DIGIT, TICK, BEYOND, SPACE, BLANK
_WIDE = re.compile(b"|".join(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_BORDER = np.zeros((7, 7), bool)  # neighbours that the pre-tokenizer parts whatever stands around them
for _a in (LETTER, DIGIT, MARK):
    for _b in (LETTER, DIGIT, MARK):
        _BORDER[_a, _b] = _a != _b
_BORDER[LETTER, TICK] = _BORDER[DIGIT, TICK] = _BORDER[TICK, DIGIT] = True
_BORDER[:SPACE, SPACE:] = _BORDER[BLANK, :SPACE] = True
_BORDER = _BORDER.ravel()
_CUT = re.compile(rb"[!-~](?= [!-~])")
_PLAIN = re.compile(rb" ?(?:(?:[A-Za-z]|\xc3[^\x97\xb7]|[\xc4-\xc9].)+|[0-9]+)", re.S)  # one word or number


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def piece_starts(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of joined texts begin; ``starts`` are the texts' own beginnings.

    Every piece begins and ends where the byte-level pre-tokenizer has a border too, so a text's ids are those of its
    pieces: words, numbers and punctuation part from each other, a space stays with what follows, the last character of
    other white space stands apart from the run before it.  An apostrophe stays with the letters after it, and
    characters beyond Latin letters with their neighbours.
    """
    a = np.frombuffer(data, np.uint8)
    kind = _KIND[a]
    if not data.isascii():
        lead = np.flatnonzero((a >= 0xC3) & (a <= 0xC9))  # U+00C0 to U+027F: letters but for two signs
        lead = lead[lead + 1 < len(a)]
        lead = lead[(a[lead] != 0xC3) | ((a[lead + 1] != 0x97) & (a[lead + 1] != 0xB7))]
        kind[lead] = kind[lead + 1] = LETTER
        for m in _WIDE.finditer(data):
            kind[m.start() : m.end()] = BLANK
    cut = np.zeros(len(a), bool)
    cut[1:] = _BORDER[kind[:-1] * np.uint8(7) + kind[1:]]
    cut[starts] = True
    blank = kind >= SPACE
    run = np.flatnonzero(blank[1:] & blank[:-1]) + 1  # white space after white space
    run = run[~cut[run] & ((a[run] & 0xC0) != 0x80)]
    after = run + 1 + (a[run] >= 0x80) + (a[run] >= 0xE0)
    run, after = run[after < len(a)], after[after < len(a)]
    first = np.zeros(len(a), bool)
    first[starts] = True
    cut[run[~blank[after] & ~first[after]]] = True
    return np.flatnonzero(cut)


class Kept:
    """A mapping of bounded size that drops what has not been asked for lately, half at a time."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: list) -> list:
        """The keys that are not held; the held ones can then be read from ``new``."""
        if len(self.new) > self.size // 2:
            self.old, self.new = self.new, {}
        absent = [k for k in keys if k not in self.new]
        unknown = [k for k in absent if k not in self.old]
        for k in absent:
            if k in self.old:
                self.new[k] = self.old[k]
        return unknown


class Encoder:
    """A byte-level BPE of the tokenizers library, with the ids of pieces it has met kept.

    Texts are cut into pieces with numpy, Arrow finds the different ones, and the library encodes those that are new:
    single words and numbers through its model, other pieces whole.  Texts that name a special token go to the library
    whole (unless ``plain_special`` makes them plain text), and so does every text if the tokenizer's preparation is
    another one.
    """

    def __init__(self, path: str, kept: int = 300_000, plain_special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        self.library = Tokenizer.from_file(path)
        before = self.library.pre_tokenizer
        self.by_piece = (
            isinstance(before, pre_tokenizers.ByteLevel) and not before.add_prefix_space and before.use_regex and self.library.normalizer is None
        )
        self.library.encode_special_tokens = plain_special
        self.special = [] if plain_special else [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.dtype = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.letters, self.pieces = byte_letters(), Kept(kept)

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        decoded = [t.decode(errors="replace") for t in texts]
        return [np.array(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(decoded, add_special_tokens=False)]

    def _cuts(self, data: bytes, starts: np.ndarray) -> np.ndarray:
        return piece_starts(data, starts)

    def _learn(self, pieces: list[bytes]) -> None:
        plain = [p for p in pieces if _PLAIN.fullmatch(p)]
        tokenize, letters = self.library.model.tokenize, self.letters
        found = [[t.id for t in tokenize(p.decode("latin-1").translate(letters))] for p in plain]
        ids = np.array(list(chain.from_iterable(found)), self.dtype).tobytes()
        ends = list(accumulate([len(f) * self.dtype().itemsize for f in found]))
        self.pieces.new.update(zip(plain, [ids[a:z] for a, z in zip([0, *ends], ends)]))
        other = [p for p in pieces if p not in self.pieces.new]
        self.pieces.new.update(zip(other, self._whole(other)))

    def _joined(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts that are not empty, by their pieces."""
        data = b"".join(texts)
        starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
        at = self._cuts(data, starts)
        offsets = np.append(at, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        different = pieces.dictionary.to_pylist()
        missing = self.pieces.missing(different)
        if missing:
            self._learn(missing)
        values = list(map(self.pieces.new.__getitem__, different))
        size = np.fromiter(map(len, values), np.int32, len(values)) // np.int32(self.dtype().itemsize)
        begin = np.cumsum(size, dtype=np.int32) - size
        code = pieces.indices.to_numpy()
        long = size[code]
        ends = np.cumsum(long, dtype=np.int32)  # a text of 2 GB, the most that a column holds, has fewer ids
        place = np.repeat(begin[code] - (ends - long), long)
        place += np.arange(len(place), dtype=np.int32)
        ids = np.frombuffer(b"".join(values), self.dtype)[place]
        edge = np.append(np.r_[0, ends][np.searchsorted(at, starts)], len(ids))
        raw, width = ids.tobytes(), self.dtype().itemsize
        return [raw[x * width : y * width] for x, y in zip(edge.tolist(), edge[1:].tolist())]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of every text as little-endian integers of ``dtype``; long texts are cut where pieces part."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[bytes] = []
        owner: list[int] = []
        size = 0

        def done() -> None:
            for k, ids in zip(owner, self._joined(held) if held else []):
                out[k].append(ids)
            held.clear()
            owner.clear()

        for k, text in enumerate(texts):
            if not self.by_piece or any(s in text for s in self.special):
                out[k] += self._whole([text])
                continue
            at = 0
            while at < len(text):
                found = _CUT.search(text, at + SEGMENT) if at + SEGMENT < len(text) else None
                to = found.end() if found else len(text)
                held.append(text[at:to])
                owner.append(k)
                size += to - at
                at = to
                if size >= SEGMENT:
                    done()
                    size = 0
        done()
        return [p[0] if len(p) == 1 else b"".join(p) for p in out]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """(ids by rank, control bytes, data bytes): the most frequent id has rank 0; ties by id.

    A rank takes one to four bytes; a control byte holds the lengths of four ranks, two bits each, first lowest.
    """
    count = np.bincount(ids)  # as long as the vocabulary at most
    table = np.flatnonzero(count)
    table = table[np.argsort(-count[table], kind="stable")]
    rank = np.zeros(len(count), np.uint32)
    rank[table] = np.arange(len(table), dtype=np.uint32)
    ranks = rank[ids]
    length = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    four = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    four[: len(ranks)] = length
    four = four.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    used = np.arange(4, dtype=np.uint8)[None, :] <= length[:, None]
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used]
    return table.astype("<u4"), control.tobytes(), data.tobytes()


def unpack(table: np.ndarray, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids back, by table lookups: control bytes to lengths, ranks to ids."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    cells = np.zeros((n, 4), np.uint8)
    cells[np.arange(4, dtype=np.uint8)[None, :] < length[:, None]] = np.frombuffer(data, np.uint8)
    return table[cells.view("<u4").ravel()]


def dump(doc_ids: list[int | None], texts: list[np.ndarray]) -> bytes:
    """A file's bytes: counts, document ids and lengths, the rank table, control bytes, data bytes."""
    ids = np.concatenate(texts) if texts else np.empty(0, np.uint32)
    table, control, data = pack(ids)
    head = struct.pack("<8sQQQQ", MAGIC, len(texts), len(ids), len(table), len(data))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], "<i8")
    sizes = np.array([len(t) for t in texts], "<u8")
    return b"".join((head, known.tobytes(), keys.tobytes(), sizes.tobytes(), table.tobytes(), control, data))


def load(blob: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, tokens of each, all ids) of a file."""
    magic, docs, n, ranks, size = struct.unpack_from("<8sQQQQ", blob)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = 40
    known = np.frombuffer(blob, np.uint8, docs, at)
    at += docs
    keys = np.frombuffer(blob, "<i8", docs, at)
    at += 8 * docs
    sizes = np.frombuffer(blob, "<u8", docs, at).astype(np.int64)
    at += 8 * docs
    table = np.frombuffer(blob, "<u4", ranks, at)
    at += 4 * ranks
    quads = -(-n // 4)
    ids = unpack(table, blob[at : at + quads], blob[at + quads : at + quads + size], n)
    return [int(k) if f else None for k, f in zip(keys, known)], sizes, ids


def larger_batches(batches, size: int):
    """Arrow batches put together until they hold about ``size`` bytes: the more text, the fewer words come again."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def sized_batches(batches, size: int, column: int):
    """Arrow batches put together or cut so that each holds about ``size`` bytes of the texts of a column, or one longer text."""
    for batch in larger_batches(batches, size):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tie, row, n, ids) of every row: a hash of the text, a number of the row, and its whole text's ids.

    ``ids`` holds ``n`` bytes compressed by zstandard, so that less is stored and shuffled.
    """
    bounded_batches(docs.sparkSession)

    def per_partition(batches):
        coder, row, codec = encoder(tokenizer), TaskContext.get().partitionId() << 36, pa.Codec("zstd", 1)
        for rows in sized_batches(batches, BATCH, 2):
            ids = coder.encode([t or b"" for t in rows.column(2).to_pylist()])
            number = pa.array(np.arange(row, row + rows.num_rows))
            row += rows.num_rows
            size = pa.array([len(x) for x in ids], pa.int64())
            packed = pa.array([codec.compress(x, asbytes=True) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), number, size, packed], ["doc_id", "tie", "row", "n", "ids"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("text"))
    return texts.mapInArrow(per_partition, "doc_id long, tie long, row long, n long, ids binary")


def write_tokens(rows: DataFrame, folder: str, dtype: str, file_tokens: int = 4_000_000, end: int = END) -> DataFrame:
    """Write encoded rows with ``end`` after each, in ascending doc_id order; the manifest of the files.

    ``rows`` is a stored table of ``encoded``, so texts are read and encoded once and the range shuffle moves ids only.
    Rows of one id are in the order of the texts' hash and then of their numbers, so that no key is too large for a
    range.  Each task writes a file for every ``file_tokens`` ids: memory is bounded by that and the longest text.  A
    file ranks its own ids by frequency and carries the table, so files are read alone.  Manifest: part, file, path,
    n_docs, n_tokens.
    """

    def per_partition(batches):
        part, file, held, keys, n = TaskContext.get().partitionId(), 0, [], [], 0
        tail, codec = np.array([end], dtype), pa.Codec("zstd")

        def flush():
            path = f"{folder}/part-{part:06d}-{file:05d}.tok"
            write_file(path, [dump(keys, held)])
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": pa.array([file], pa.int32()), "path": [path],
                                               "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([n], pa.int64())})

        for batch in batches:
            for key, size, ids in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(np.append(np.frombuffer(codec.decompress(ids, size, asbytes=True), dtype), tail))
                keys.append(key)
                n += len(held[-1])
                if n >= file_tokens:
                    yield flush()
                    file, held, keys, n = file + 1, [], [], 0
        if keys:
            yield flush()

    order = [F.asc_nulls_first("doc_id"), "tie", "row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n", "ids")
    return ordered.mapInArrow(per_partition, "part int, file int, path string, n_docs bigint, n_tokens bigint")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files of a manifest."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row a task of the writer
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    based = manifest.withColumn("inside", F.coalesce(inside, F.lit(0))).join(before, "part").select(
        "part", "path", (F.col("before") + F.col("inside")).alias("base"), "file"
    )

    def per_partition(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                system, inner = open_fs(path)
                with system.open_input_file(inner) as f:
                    keys, sizes, ids = load(f.read())
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[a:z]) for a, z in zip((ends - sizes).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "start": pa.array(base + ends - sizes, pa.int64()),
                                                  "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    files = max(1, min(10_000, manifest.count()))  # a fixed number, which adaptive execution doesn't merge
    return based.repartition(files, "part", "file").mapInArrow(per_partition, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the token files of ``docs`` and read them back: doc_id, start, n_tokens, ids_crc32 of every row.

    Null and empty texts are the end id alone; texts of any length are encoded whole; null ids come first; rows of one
    id (also repeated rows) each have their own entry; an empty table writes no file and gives no rows; other columns
    are not read, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    rows = scratch.table(encoded(docs, tokenizer, id_col, text_col), "ids")
    return read_tokens(scratch.table(write_tokens(rows, scratch.path("files"), encoder(tokenizer).dtype.__name__, **options), "manifest"))
