"""Media columns: content-addressed PNG payloads in tar shards; rows carry digest, offset and length."""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import FileWriter, Scratch, bounded_batches, open_fs

# Fixed values of the PNG format and of the layout used here: RGB rows of 64 pixels, so 192 samples of 8 bits a row.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
ROW = 192
HEADER = 53  # signature, IHDR and the length chunk

SHARD_BYTES = 256 << 20
POINTER = "doc_id bigint, digest binary, shard string, offset bigint, length bigint"


def padded(data: bytes) -> bytes:
    """The text with spaces appended up to a positive multiple of 192 bytes."""
    return data + b" " * ((-len(data)) % ROW if data else ROW)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(data: bytes) -> bytes:
    """A lossless PNG whose samples are the padded text; a private chunk before the pixels tells the unpadded length."""
    rows = np.frombuffer(padded(data), np.uint8).reshape(-1, ROW)
    lines = np.zeros((len(rows), ROW + 1), np.uint8)  # each line opens with filter type 0
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 2, 0, 0, 0)
    return b"".join(
        (SIGNATURE, _chunk(b"IHDR", head), _chunk(b"nbYt", struct.pack(">Q", len(data))),
         _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)), _chunk(b"IEND", b""))
    )


def read_header(head: bytes) -> tuple[int, int, int, int]:
    """(width, height, bits a sample, unpadded bytes) from the first ``HEADER`` bytes of a stored payload."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or head[37:41] != b"nbYt":
        raise ValueError("not a payload of this store")
    width, height, bits = struct.unpack(">IIB", head[16:25])
    return width, height, bits, struct.unpack(">Q", head[41:49])[0]


def decode_png(media: bytes) -> bytes:
    """The padded samples of a stored payload; checks every chunk's checksum."""
    _, height, _, _ = read_header(media[:HEADER])
    at, packed = 8, []
    while at < len(media):
        size, kind = struct.unpack(">I", media[at : at + 4])[0], media[at + 4 : at + 8]
        body = media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack(">I", media[at + 8 + size : at + 12 + size])[0]:
            raise ValueError("damaged payload")
        if kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    return np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, ROW + 1)[:, 1:].tobytes()


def store(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write every text of ``docs`` to tar shards and return its pointer: doc_id, digest, shard, offset, length.

    Texts never shuffle.  A task writes its own shards (deterministic names, complete or absent), each payload as soon as
    it is made, and stores equal texts of a shard once; across shards, all rows of a digest point to the first copy.  A
    task holds one payload and the digests of its open shard, of which each stands for 1 KB of the shard or more.  Null
    texts are empty ones.
    """
    bounded_batches(docs.sparkSession)
    folder = scratch.path("shards")

    def per_partition(batches):
        task = TaskContext.get().partitionId()
        state = {"shard": 0, "known": {}, "writer": None}

        def name() -> str:
            return f"{folder}/shard-{task:06d}-{state['shard']:05d}.tar"

        def close():
            if state["writer"]:
                state["writer"].write(b"\0" * 1024)
                state["writer"].close()
            state.update(shard=state["shard"] + 1, known={}, writer=None)

        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                media = encode_png(text or b"")
                digest = hashlib.sha256(media).digest()
                if digest not in state["known"]:
                    if state["writer"] and state["writer"].size + len(media) > shard_bytes:
                        close()
                    if not state["writer"]:
                        state["writer"] = FileWriter(name())
                    info = tarfile.TarInfo(f"{digest.hex()}.png")
                    info.size = len(media)
                    head = info.tobuf(tarfile.GNU_FORMAT)
                    state["known"][digest] = (state["writer"].size + len(head), len(media))
                    state["writer"].write(head + media + b"\0" * (-len(media) % 512))
                rows.append((key, digest, name(), *state["known"][digest]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64()))],
                ["doc_id", "digest", "shard", "offset", "length"],
            )
        close()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    pointers = scratch.table(texts.mapInArrow(per_partition, POINTER), "pointers")
    first = pointers.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("m")).select("digest", "m.*")
    members = scratch.table(first, "members")
    return pointers.select("doc_id", "digest").join(members, "digest")


def _by_range(members: DataFrame, size, schema: str, make) -> DataFrame:
    """Range-read ``size(length)`` bytes of every member, neighbours in one task, and add what ``make(bytes)`` gives."""
    spread = members.select("digest", "shard", "offset", "length")
    spread = spread.repartition("shard", F.floor(F.col("offset") / (8 << 20))).sortWithinPartitions("shard", "offset")
    names = [c.split()[0] for c in schema.split(", ")]

    def per_partition(batches):
        opened = (None, None)
        for batch in batches:
            rows = []
            for digest, shard, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if opened[0] != shard:
                    system, path = open_fs(shard)
                    opened = (shard, system.open_input_file(path))
                opened[1].seek(offset)
                rows.append((digest, *make(opened[1].read(size(length)))))
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*rows) if rows else [[]] * len(names))},
                                             schema=pa.schema([(n, ARROW[c.split()[1]]) for n, c in zip(names, schema.split(", "))]))

    return spread.mapInArrow(per_partition, schema)


ARROW = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}


def header_columns(members: DataFrame) -> DataFrame:
    """digest, width, height, bits, n_bytes of every member, from range reads of its header alone."""
    return _by_range(members, lambda n: min(n, HEADER), "digest binary, width int, height int, bits int, n_bytes bigint", read_header)


def sample_feature(samples: bytes) -> str:
    """Mean, deviation, distinct values and entropy of the 8-bit samples, to four places."""
    counts = np.bincount(np.frombuffer(samples, np.uint8), minlength=256)
    p = counts / len(samples)
    mean = float(p @ np.arange(256))
    deviation = float(np.sqrt(max(0.0, p @ (np.arange(256) - mean) ** 2)))
    used = p[p > 0]
    return f"mean={mean:.4f};std={deviation:.4f};distinct={len(used)};entropy={abs(float(-(used * np.log2(used)).sum())):.4f}"


def payload_columns(members: DataFrame) -> DataFrame:
    """digest and what the payload itself tells, from full range reads: sizes, checksums, feature."""

    def made(media: bytes):
        samples = decode_png(media)
        return (len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media),
                hashlib.sha256(media).hexdigest(), sample_feature(samples))

    schema = ("digest binary, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, "
              "media_sha256 string, feature string")
    return _by_range(members, lambda n: n, schema, made)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text of ``docs`` as media and read the stored bytes back.

    A row per input row: doc_id, shard, offset, length, the header's width, height, bits and n_bytes (unpadded), and
    the payload's payload_bytes, payload_sha256, tail_crc32 (last 16 bytes), media_bytes, media_sha256 and feature.
    Null and empty texts are one row of 192 spaces; equal texts share one stored payload and have equal values; ids may
    be null or repeated; an empty table gives no rows.  Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "media")
    pointers = store(docs, scratch, id_col, text_col)
    members = docs.sparkSession.read.parquet(scratch.path("members"))
    read_back = header_columns(members).join(payload_columns(members), "digest")
    return pointers.join(scratch.table(read_back, "columns"), "digest").drop("digest")
