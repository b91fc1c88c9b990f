"""The ordinal trainer against a plain likelihood, and the pipeline's stage against plain scoring."""

import math
import random
import re
import zlib

import numpy as np

import corpus_pipeline
from lifespans.llm import queries, toxicity

from ..conftest import DATA


def plain_quantile(values, q):
    values = sorted(values)
    at = q * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])


def plain_training(rows, epochs, rate=0.3, decay=1e-4):
    """AdaGrad on the likelihood with gradients by central differences, coordinate by coordinate."""
    toxic, clean = [set(i.tolist()) for i, _, t in rows if t], [set(i.tolist()) for i, _, t in rows if not t]
    evidence = set()
    for b in set().union(*toxic, *clean):
        a, c = sum(b in r for r in toxic) + 0.5, sum(b in r for r in clean) + 0.5
        m, n = len(toxic) + 1 - a, len(clean) + 1 - c
        if math.log(a / m) - math.log(c / n) >= 3 * math.sqrt(1 / a + 1 / c + 1 / m + 1 / n):
            evidence.add(b)
    share = [len(set(i.tolist()) & evidence) / math.sqrt(n) for i, n, _ in rows]
    cuts = [plain_quantile([s for s, (*_, t) in zip(share, rows) if t], q) for q in (1 / 3, 2 / 3)]
    grades = [1 + sum(s >= c for c in cuts) if t else 0 for s, (*_, t) in zip(share, rows)]
    w, w2, gaps, gaps2 = {}, {}, [2.0, 0.0, 0.0], [1e-2] * 3

    def loss(total, g, grade):
        theta = [g[0], g[0] + math.exp(g[1]), g[0] + math.exp(g[1]) + math.exp(g[2])]
        below = [0.0, *(1 / (1 + math.exp(total - t)) for t in theta), 1.0]
        return -math.log(below[grade + 1] - below[grade])

    for _ in range(epochs):
        for (index, *_), grade in zip(rows, grades):
            kept = [b for b in index.tolist() if b in evidence]
            total, h = sum(w.get(b, 0.0) for b in kept), 1e-5
            slope = (loss(total + h, gaps, grade) - loss(total - h, gaps, grade)) / (2 * h)
            by_gap = []
            for k in range(3):
                up, down = ([x + s * h * (j == k) for j, x in enumerate(gaps)] for s in (1, -1))
                by_gap.append((loss(total, up, grade) - loss(total, down, grade)) / (2 * h))
            for b in kept:
                g = slope + decay * w.get(b, 0.0)
                w2[b] = w2.get(b, 1e-2) + g * g
                w[b] = w.get(b, 0.0) - rate * g / math.sqrt(w2[b])
            for k in range(3):
                gaps2[k] += by_gap[k] ** 2
                gaps[k] -= rate * by_gap[k] / math.sqrt(gaps2[k])
            gaps[1:] = [min(4.0, max(-4.0, x)) for x in gaps[1:]]
    return w, [gaps[0], gaps[0] + math.exp(gaps[1]), gaps[0] + math.exp(gaps[1]) + math.exp(gaps[2])]


def test_training_is_that_of_the_plain_likelihood():
    r, rows = random.Random(4), []
    for k in range(80):
        words = set(r.sample(range(100, 160), 8)) | (set(r.sample(range(6), 4)) if k % 4 == 0 else set())
        rows.append((np.array(sorted(words)), r.randrange(5, 40), int(k % 4 == 0)))
    weights, theta = toxicity.train_ordinal(rows, epochs=3)
    want, thresholds = plain_training(rows, 3)
    assert want and set(np.flatnonzero(weights)) == {b for b, x in want.items() if x}
    assert np.allclose([weights[b] for b in want], list(want.values()), atol=1e-4) and np.allclose(theta, thresholds, atol=1e-4)


def test_the_stage_drops_what_plain_scoring_rejects(spark):
    sf = DATA.replace("sf0.001", "sf0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    weights, theta = toxicity.fit(docs, labels)
    lower, kept, n = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), set(), 0
    for r in docs.select("doc_id", "text").toLocalIterator():
        words = {w.encode() for w in re.findall(r"[0-9a-z\x80-\U0010ffff]+", (r.text or "").translate(lower))}
        parts = words | {b"\x01" + w[:4] for w in words if len(w) > 4}
        total = sum(float(weights[b]) for b in {zlib.crc32(p) % toxicity.BUCKETS for p in parts})
        n += 1
        if sum(1 / (1 + math.exp(t - total)) for t in theta) < queries.TOXIC_FROM:
            kept.add(r.doc_id)
    got = {r.doc_id for r in corpus_pipeline.toxic(spark, docs, sf).select("doc_id").collect()}
    assert got == kept and 0 < len(kept) < n
