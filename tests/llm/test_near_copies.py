"""The pipeline's near-duplicate stage against brute force: five-word shingles, Jaccard similarity 0.8 or more."""

import random
from itertools import combinations

import corpus_pipeline


def _shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _texts():
    """Groups of copies with 0 to 6 words changed, at similarities on both sides of 0.8."""
    rng = random.Random(5)
    texts = []
    for group in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(100, 200))]
        for copy in range(4):
            changed = list(words)
            for _ in range(copy * rng.randrange(0, 3)):
                changed[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(changed))
    return [*texts, "", None, "two words", "Two  words"]


def test_stage_links_every_pair_of_jaccard_080(spark):
    texts = _texts()
    sets = [_shingles(t or "") for t in texts]
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = [0, 0]
    for a, b in combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        share = both / (len(sets[a]) + len(sets[b]) - both) if sets[a] or sets[b] else 1.0
        pairs[0] += 0.8 <= share < 0.95
        pairs[1] += 0.6 <= share < 0.8
        if share >= 0.8:
            root[max(top(a), top(b))] = min(top(a), top(b))
    assert min(pairs) > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {top(k) for k in range(len(texts))}


def test_chunked_buckets_give_the_same_groups(spark):
    from lifespans.llm import near_copies

    docs = spark.createDataFrame([(k, t) for k, t in enumerate(_texts())] + [(None, "two words")], "doc_id long, text string")
    whole = sorted(map(tuple, near_copies.near_copies(docs).collect()), key=str)
    assert whole == sorted(map(tuple, near_copies.near_copies(docs, chunk=200).collect()), key=str)


def test_wide_prints_are_majorities_of_bits_and_forests_join_what_is_near():
    import numpy as np
    from lifespans.llm import simhash

    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 255, 600):
        hashes = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        assert (np.unpackbits(simhash.set_fingerprint(hashes))[:64] == (2 * bits.sum(axis=0) > n)).all()
    sets = [rng.integers(0, 1 << 63, 400, np.uint64) for _ in range(2)]
    prints = [np.unpackbits(simhash.set_fingerprint(x)) for x in (sets[0], sets[1], np.r_[sets[0][:356], sets[1][:44]])]
    assert 96 < (prints[0] != prints[1]).sum() < 160 and (prints[0] != prints[2]).sum() < 64
    values = rng.integers(0, 1 << 63, (300, 4), np.uint64)
    values[100:200] = values[:100] ^ (np.uint64(1) << rng.integers(0, 63, (100, 4)).astype(np.uint64))
    values[200:250] = values[100:150]
    joined = sorted(tuple(sorted(x)) for x in simhash.near_forest(values, 4, 16).tolist())
    assert len(joined) == 150 and {k for x in joined for k in x} == set(range(250))
    assert all(np.bitwise_count(values[a] ^ values[b]).sum() <= 4 for a, b in joined)


def test_stage_finds_candidates_by_simhash(spark):
    """Without links of SimHash prints the stage links equal texts only; the keys' length and the buckets' size change nothing."""
    from lifespans.llm import near_copies

    docs = spark.createDataFrame(list(enumerate(_texts())), "doc_id long, text string")
    whole = sorted(map(tuple, near_copies.near_copies(docs).collect()))
    assert whole == sorted(map(tuple, near_copies.near_copies(docs, bucket=20, prints=30).collect()))
    none = near_copies.near_copies(docs, distance=-1).groupBy("component_id").count().count()
    assert none == len({t for t in _texts() if t}) + 1 > len({c for _, c in whole})
    assert [near_copies.distance_for(0.8), near_copies.bands_for(0), near_copies.bands_for(7)] == [64, 1, 25]


def test_large_groups_are_joined_whole(spark):
    """One large group of near copies with another one beside it, in buckets and components of many chunks."""
    from lifespans.llm import near_copies

    rng = random.Random(9)
    words = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(400):
        changed = list(words)
        if k % 4 == 0:  # a second group, of a similarity below 0.8 to the first
            changed[20:80:8] = [f"y{j}" for j in range(8)]
        changed[rng.randrange(20) if k % 2 else 100 + rng.randrange(20)] = f"x{k}"
        texts.append(" ".join(changed))
    sets = [_shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for options in ({}, {"prints": 50, "chunk": 5000}):
        assert dict(map(tuple, near_copies.near_copies(docs, **options).collect())) == dict(enumerate(root))
