"""Cross-tokenizer alignment against the libraries and plain loops."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lifespans.llm import align, queries
from lifespans.llm.tokens import byte_letters

from ..conftest import DATA

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BACK = {letter: byte for byte, letter in byte_letters().items()}


def groups(text):
    """The document's groups of (A ids, B ids), or None."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    bytes_a = [bytes(BACK[c] for c in A.id_to_token(k)) for k in a]
    bytes_b = [bytes([k - 3]) if B.is_byte(k) else B.id_to_piece(k).replace("▁", " ").encode() for k in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    out, x, y, end_x, end_y = [([], [])], 0, 0, 0, 0
    while x < len(a) or y < len(b):
        if x < len(a) and (end_x <= end_y or y == len(b)):
            out[-1][0].append(a[x])
            end_x += len(bytes_a[x])
            x += 1
        else:
            out[-1][1].append(b[y])
            end_y += len(bytes_b[y])
            y += 1
        if end_x == end_y:
            out.append(([], []))
    return out[:-1]


def brute(rows):
    found = [(key, groups(text)) for key, text in rows]
    links = [collections.Counter((x, y) for g in gs or [] for x in g[0] for y in g[1]) for _, gs in found]
    counts = collections.Counter(pair for own in links for pair in own)
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (key, gs), own in zip(found, links):
        sha = "" if gs is None else hashlib.sha256(";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in gs).encode()).hexdigest()
        gs = gs or []
        out.append((
            key, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), sum(own.values()), sum(n for p, n in own.items() if counts[p] == top[p[0]]),
            sum(n * counts[p] for p, n in own.items()), sha,
        ))
    return sorted(out, key=str)


PARTS = [*"   \n\t.,()_-½éß×ñ—’…ªж", "  ", "    ", "\r\n", "\x00", "\xa0", "　", "▁", "a", "the", "don't", "'s", "1", "2345", "中文", "北京大学", "!!", "😀", "👍🏽", "<|endoftext|>", "</s>", "<unk>", "<0x41>", "word", "Straße", "ing"]


@pytest.mark.parametrize("kept", [100_000, 40])
def test_kept_pieces_give_the_ids_of_whole_texts(kept):
    r = random.Random(kept)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(1, r.choice([4, 12, 60])))) for _ in range(4000)] + [" ", "  ", "a ", "x" * 3000, " " * 50 + "y", "a " * 5000]
    own = align.PieceTokens("piece_bpe_32k.model", kept)
    assert own.by_piece
    for k in range(0, len(texts), 500):
        some = texts[k : k + 500]
        for text, ids in zip(some, own.encode([b" " + t.encode() for t in some])):
            if "▁" not in text:
                assert np.frombuffer(ids, np.uint16).tolist() == B.encode(text), repr(text)


@pytest.mark.parametrize(("batch", "wide", "piece"), [(1 << 20, 4096, 1_000_000), (300, 2, 3)])
def test_edge_cases_match_plain_loops(spark, monkeypatch, batch, wide, piece):
    for name, value in (("BATCH", batch), ("WIDE", wide), ("SLICE", piece)):
        monkeypatch.setattr(align, name, value)
    r = random.Random(batch)
    texts = ["".join(r.choice(PARTS) + r.choice(["", " "]) for _ in range(r.randrange(1, 40))) for _ in range(80)]
    texts += [None, "", " ", "same text here", "same text here", "a▁b", "▁", "\n", "é" * 400, "日本語" * 300, "q" * 5000, " " * 333, "the " * 3000]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (None, None), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(0) for c in ("batch", "place", "bucket", "a", "b", "count", "n_a")})
    assert sorted(map(tuple, align.alignment(df).collect()), key=str) == brute(rows)
    got = {(x.doc_id, tuple((tuple(g.a), tuple(g.b)) for g in x.groups)) for x in align.aligned_groups(df).collect()}
    assert got == {(k, tuple((tuple(g[0]), tuple(g[1])) for g in groups(t) or [])) for k, t in rows}
    assert align.alignment(df.limit(0)).count() == 0


def test_salted_buckets_give_the_same_sums(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(6)
    monkeypatch.setattr(align, "ENTRIES", 1000)
    monkeypatch.setattr(align, "BATCH", 20_000)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, align.alignment(docs).collect()), key=str) == want
    assert sorted(map(tuple, queries.op13_alignment(spark, DATA).collect()), key=str) == want


def test_a_wide_group_costs_its_different_pairs():
    """A group of 30,000 tokens on both sides is counted, not paired token by token."""
    r = np.random.default_rng(1)
    a, b = r.integers(0, 50, 30_000), r.integers(0, 40, 30_000)
    found = {"a": a, "b": b, "at_a": np.array([29_999]), "at_b": np.array([29_999]), "doc": np.array([0])}
    keys, links = align.linked(found, 1, 50, 40)
    assert len(keys) == 2000 and links.sum() == 30_000**2
