"""Against counts and probabilities in plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gleanwell.llm.lm_scoring import discounts, score_texts

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), None]


def expected(rows):
    """rows: (id, text, held). The same model, counted in dictionaries."""
    unigrams, pairs = Counter(), Counter()
    for _, text, held in rows:
        if not held:
            ts = tokens(text)
            unigrams.update(ts)
            pairs.update(zip(["<", *ts], ts))
    n, v = sum(unigrams.values()), len(unigrams)
    contexts, free = Counter(), defaultdict(lambda: [0, 0, 0])
    for (u, _), c in pairs.items():
        contexts[u] += c
        free[u][min(c, 3) - 1] += 1
    taken = discounts([sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])

    def root(w):
        return (unigrams[w] + 0.5) / (n + 0.5 * (v + 1))

    def step(u, w):
        if not contexts[u]:
            return root(w)
        c = pairs[u, w]
        kept = max(c - taken[min(c, 3) - 1], 0) / contexts[u] if c else 0
        return kept + sum(a * b for a, b in zip(taken, free[u])) / contexts[u] * root(w)

    out = []
    for i, text, held in rows:
        ts = tokens(text)
        base = sum(math.log10(root(w)) for w in ts)
        score = sum(math.log10(step(u, w)) for u, w in zip(["<", *ts], ts))
        out.append((i, held, len(ts), sum(unigrams[w] > 0 for w in ts), n, base, score))
    return out


@pytest.mark.parametrize("block_tokens", [50, 100_000])
def test_scores(texts, prose, block_tokens):
    rnd = random.Random(1)
    values = [prose(rnd, rnd.randrange(0, 30)) for _ in range(40)] + ["The the THE the", "the the", None, "", "É é"]
    frame = texts(values)
    rows = [(i, t, i % 5 == 1) for i, t in enumerate(values)]
    got = {r.doc_id: tuple(r) for r in score_texts(frame, F.col("doc_id") % 5 == 1, block_tokens).collect()}
    for want in expected(rows):
        assert got[want[0]][:5] == want[:5]
        assert got[want[0]][5:] == pytest.approx(want[5:], rel=1e-9)


def test_probabilities_of_all_continuations_add_up():
    many = Counter({1: 7, 2: 3, 3: 2, 4: 1})
    taken = discounts([many[k] for k in (1, 2, 3, 4)])
    assert all(0 < d <= k for k, d in enumerate(taken, 1))
    followers = {"a": 1, "b": 2, "c": 5}
    total = sum(followers.values())
    kept = sum(c - taken[min(c, 3) - 1] for c in followers.values()) / total
    freed = sum(taken[min(c, 3) - 1] for c in followers.values()) / total
    assert kept + freed == pytest.approx(1)


def test_odd_and_empty(odd, empty):
    rows = score_texts(odd, F.lit(False)).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    nothing = score_texts(odd, F.lit(True)).collect()
    assert {r.train_tokens for r in nothing} == {0} and all(r.score == r.base_score for r in nothing)
    assert score_texts(empty, F.lit(False)).count() == 0
