"""Whole n-grams of long texts, and the trainer against a plain loop."""

import random

import numpy as np

from lifespans.llm import quality, textual


def test_ngrams_cross_the_parts_of_a_long_text(monkeypatch):
    r = random.Random(6)
    for _ in range(30):
        text = " ".join(r.choice(["a", "bb", "Ccc", "d1", "d1", "longer-word,"]) for _ in range(r.randrange(1, 80))).encode()
        whole, n = quality.ngram_buckets(text)
        for size in (1, 7, 40):
            monkeypatch.setattr(quality, "runs_of_words", lambda data, size=size: textual.runs_of_words(data, size))
            parts, m = quality.ngram_buckets(text)
            assert m == n and np.array_equal(np.sort(np.concatenate(parts)), np.sort(np.concatenate(whole)))
            monkeypatch.undo()


def test_training_is_that_of_a_plain_loop():
    """Coordinate by coordinate, without numpy."""
    r = random.Random(8)
    rows = [(np.array(sorted(r.sample(range(40), 6))), np.array([r.random() for _ in range(6)]), r.randrange(2)) for _ in range(50)]
    alpha, beta, l1, l2 = 0.1, 1.0, 0.05, 1.0
    z, n = {}, {}

    def weight(i):
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - (l1 if v > 0 else -l1)) / ((beta + n.get(i, 0.0) ** 0.5) / alpha + l2)

    for _ in range(2):
        for index, value, label in rows:
            pairs = [*zip(index.tolist(), value.tolist()), ("bias", 1.0)]
            now = {i: weight(i) for i, _ in pairs}
            p = 1 / (1 + np.exp(-sum(now[i] * x for i, x in pairs)))
            for i, x in pairs:
                g, old = (p - label) * x, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / alpha * now[i]
                n[i] = old + g * g
    weights, bias = quality.train_ftrl(rows)
    assert np.allclose([weights[i] for i in range(40)], [weight(i) for i in range(40)], atol=1e-6) and abs(bias - weight("bias")) < 1e-6
