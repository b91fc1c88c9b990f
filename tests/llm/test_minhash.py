"""MinHash fingerprints against plain integers, and the order of documents against a sorted list."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lifespans.llm import minhash, queries

from ..conftest import DATA


def shingles(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    return {xxhash.xxh64_intdigest(" ".join(words[k : k + 5]).encode(), 42) for k in range(max(1, len(words) - 4))} if words else set()


def brute_print(text, count=128):
    factor, shift = (x.ravel().tolist() for x in minhash.family(count))
    found = shingles(text)
    return "".join(f"{min(((a * x + b) % 2**64 for x in found), default=2**64 - 1) % 65536:04x}" for a, b in zip(factor, shift))


def brute_rows(rows):
    """By (id, text): the row's own values in the order of ids, nulls on their own."""
    named = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    after = {k: named[(k + 1) % len(named)][1] or "" for k in range(len(named))}
    out = []
    for (key, text), follows in [*zip(named, after.values()), *((r, r[1] or "") for r in rows if r[0] is None)]:
        text = text or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + follows[:cut]
        p, e, f = brute_print(text), brute_print(edited), brute_print(follows)
        same = lambda x, y: sum(x[k : k + 4] == y[k : k + 4] for k in range(0, 512, 4)) / 128
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), p, e, same(p, e), same(p, f)))
    return sorted(out, key=str)


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa ÉTÉ straße 北京 😀 A b".split()


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_edge_cases_match_plain_integers(spark, monkeypatch, parts):
    r = random.Random(parts)
    text = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    rows = [(k * 7 - 30, text(r.randrange(40))) for k in range(30)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (2**63 - 1, "last id there is"), (-(2**63), "First id"), (None, text(20)), (None, None), (503, text(3000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({c: F.lit(0) for c in ("bucket", "after", "n_chars", "start", "p")})
    ordered = minhash.in_order
    monkeypatch.setattr(minhash, "in_order", lambda *a: ordered(*a, parts=parts))
    got = minhash.edited_fingerprints(df).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert sorted(map(tuple, got.collect()), key=str) == brute_rows(rows)
    assert minhash.edited_fingerprints(df.limit(0)).count() == 0
    assert {(x.doc_id, x.fingerprint) for x in minhash.fingerprints(df).collect()} == {(k, brute_print(t or "")) for k, t in rows}


def test_rows_of_one_id_all_stay(spark):
    rows = [(k % 4, f"text {k % 3} and some more words to tell") for k in range(60)]
    got = minhash.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == sorted(k for k, _ in rows)
    assert len({r.fingerprint for r in got}) == 3
    one = minhash.edited_fingerprints(spark.createDataFrame([(9, "only one document is here now")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.doc_id == 9


def test_likeness_estimates_the_similarity_of_the_sets(spark):
    """On the whole table: the estimate's error is that of 128 draws, and equal texts have equal fingerprints."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = queries.op12_fingerprints(spark, DATA).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    order = sorted(docs)
    for r in got:
        text, follows = docs[r.doc_id], docs[order[(order.index(r.doc_id) + 1) % len(order)]]
        cut = len(text) // 4
        a, e, f = shingles(text), shingles(text[: len(text) - cut] + follows[:cut]), shingles(follows)
        true = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert r.jaccard_edited == pytest.approx(true(a, e)) and r.jaccard_next == pytest.approx(true(a, f))
        assert abs(r.near_edited - true(a, e)) < 0.25 and abs(r.near_next - true(a, f)) < 0.25
        assert r.bands_edited <= 25 and (r.bands_edited == 25) >= (r.jaccard_edited == 1)
    assert abs(np.mean([r.near_edited - r.jaccard_edited for r in got])) < 0.01
