"""Repetitive texts and shared openings in bounded memory, and longest matches against plain loops."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from lifespans.llm import decontaminate
from lifespans.llm.decontaminate import Block

HEAVY = """
import resource, sys
resource.setrlimit(resource.RLIMIT_AS, (int(sys.argv[2]) << 20, int(sys.argv[2]) << 20))
import numpy as np
from lifespans.llm.decontaminate import Block, _matches
if sys.argv[1] == "equal":
    block = Block.build([(1, [b"x"] * 2000)], 10)
    found = _matches([np.full(200_000, block.vocab[b"x"], np.int32)], block)
    assert (np.cumsum(found.cover)[:200_000] > 0).all() and found.matches == [(0, k, 2000, 0, 0) for k in range(198_001)]
else:
    opening = [b"o%d" % k for k in range(12)]
    block = Block.build([(k, opening + [b"own%d" % k]) for k in range(3000)], 10)
    words = (opening + [b"?"]) * 300
    found = _matches([np.array([block.vocab.get(w, 0) for w in words], np.int32)], block)
    assert len(found.matches) == 300 and len(found.window) == 3 and len(block.members) == 3 * 3000 + 3000
print("peak MB", resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""


@pytest.mark.parametrize("case", ["equal", "opening"])
def test_repetition_stays_below_500_mb(case):
    home = str(Path(decontaminate.__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", HEAVY, case, "6000"], capture_output=True, text=True, cwd=home, env={"PYTHONPATH": home, "OPENBLAS_NUM_THREADS": "1", "PATH": "/usr/bin:/bin"}, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-1]) < 500, done.stdout


def brute(texts, items, window):
    """Rows (text, start, words) of the longest matches that lie in no other one, and the words that windows cover."""
    out, hits = [], []
    for k, words in enumerate(texts):
        reach, hit = -1, set()
        for s in range(len(words)):
            best, occurs = 0, False
            for item in items:
                for b in range(len(item)):
                    n = 0
                    while s + n < len(words) and b + n < len(item) and words[s + n] == item[b + n]:
                        n += 1
                    w = min(window, len(item))
                    if n >= w and b + w <= len(item):
                        occurs = True
                        hit.update(range(s, s + w))
                    best = max(best, n)
            if occurs and s + best > reach:
                out.append((k, s, best))
                reach = s + best
        hits.append(hit)
    return out, hits


@pytest.mark.parametrize("seed", range(6))
def test_longest_matches_against_plain_loops(seed):
    r = random.Random(seed)
    word = lambda: b"abcde"[(k := r.randrange(2 + seed % 3)) : k + 1]
    items = [[word() for _ in range(r.choice([2, 3, 5, 30]))] for _ in range(5)]
    items[1] = items[0] + items[1]
    texts = [[word() if r.random() < 0.97 else b"?" for _ in range(r.randrange(40))] + items[r.randrange(5)] for _ in range(8)] + [[]]
    block = Block.build(list(enumerate(items)), 4)
    found = decontaminate._matches([np.array([block.vocab.get(w, 0) for w in t], np.int32) for t in texts], block)
    want, hits = brute(texts, items, 4)
    assert [m[:3] for m in found.matches] == want
    for text, start, n, item, at in found.matches:
        assert texts[text][start : start + n] == items[item][at : at + n]
    base = np.cumsum([0] + [len(t) + 1 for t in texts])
    cover = np.cumsum(found.cover) > 0
    assert [set(np.flatnonzero(cover[a : a + len(t)])) for a, t in zip(base, texts)] == hits


def test_items_of_one_opening_are_all_named(spark):
    opening = " ".join(f"o{k}" for k in range(12))
    bench = spark.createDataFrame([(k, f"{opening} own{k}") for k in range(500)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{opening} ? " * 50), (2, "x " * 4000), (3, f"a {opening} own7 z")], "doc_id long, text string")
    for options in ({}, {"block_words": 900, "shard_words": 100}):
        got = {r.doc_id: r for r in decontaminate.benchmark_matches(docs, bench, **options).collect()}
        assert len(got[1].item_ids) == 500 and len(got[1].matches) == 50 and not got[2].matches
        assert got[1].n_hit == 600 and len(got[3].item_ids) == 500
        assert [(m.start, m.words, m.item_id, m.item_start) for m in got[3].matches] == [(1, 13, 7, 0)]
