"""Against similarities of all pairs in plain Python."""

import random
import re

import numpy as np
import pytest

from gleanwell.llm import components, near_dups
from gleanwell.llm.components import smallest_reachable
from gleanwell.llm.near_dups import keep_one_of_each, near_duplicates, similarity, sketch


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def classes(values, percent):
    sets = [shingles(t) for t in values]
    root = list(range(len(values)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(len(values)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(find(k), len(sets[k])) for k in range(len(values))]


@pytest.fixture
def family(prose):
    """Copies of some texts with one to many words changed, exact copies, short and empty texts."""
    rnd = random.Random(8)
    values = []
    for _ in range(6):
        words = prose(rnd, 150).split()
        for _ in range(12):
            copy = list(words)
            for _ in range(rnd.randrange(0, 8)):
                copy[rnd.randrange(len(copy))] = prose(rnd, 1)
            values.append(" ".join(copy))
    values += [values[0].upper(), values[0] + "\n", "a b c", "A  b c", "a b c d", None, "", " "]
    values += [" ".join("abcdefghij"[: 5 + k]) for k in range(5)]
    rnd.shuffle(values)
    return values


@pytest.mark.parametrize("percent, block", [(85, 2_000_000), (80, 2_000_000), (85, 700)])
def test_classes(texts, family, monkeypatch, percent, block):
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", block)
    got = {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in near_duplicates(texts(family), percent).collect()}
    for k, (root, size) in enumerate(classes(family, percent)):
        assert got[k] == (root, size, root == k), family[k]


def test_keep_one_of_each(texts, family):
    frame = texts(family)
    kept = keep_one_of_each(frame, 85)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({root for root, _ in classes(family, 85)})


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(9)
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (700, 150, 150))
    sets = [np.concatenate((both, a)), np.concatenate((both, b)), np.concatenate((both, a, b))]
    one, two, union = (sketch(np.unique(x), np.array([0, len(x)])) for x in sets)
    assert (np.maximum(one, two) == union).all()
    close = similarity(one, two, np.array([850]), np.array([850]))[0]
    assert abs(close - 0.7) < 0.12


@pytest.mark.parametrize("per_task", [0, 250_000])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(components, "EDGES_PER_TASK", per_task)
    rnd = random.Random(10)
    links = [(k, k + 1) for k in range(200)] + [(1000 + rnd.randrange(60), 1000 + rnd.randrange(60)) for _ in range(50)] + [(5000, 5000 + k) for k in range(1, 50)]
    root = {x: x for e in links for x in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    frame = spark.createDataFrame([*links, (7, None), (9999, 9999)], "a bigint, b bigint")
    got = {r.id: r.root for r in smallest_reachable(frame).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in links)}
    assert smallest_reachable(frame.limit(0)).count() == 0


def test_odd_and_empty(odd, empty):
    rows = near_duplicates(odd, 85).collect()
    assert len(rows) == odd.count()
    assert all(r.kept for r in rows if not r.n_shingles) and all(r.kept for r in rows if r.doc_id is None)
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert near_duplicates(empty, 85).count() == 0


def test_rows_that_share_an_id_are_one_document(texts, prose):
    rnd = random.Random(21)
    a, b, c, d = (prose(rnd, 150) for _ in range(4))
    values = [a, b, a + " tail", b + " tail", c, d, d + " end", "", None, c, "alone here", a]
    ids = [5, 5, 7, 9, 3, 3, 1, 3, 5, 20, 30, None]
    rows = near_duplicates(texts(values, ids), 85).collect()
    got = sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id is not None)
    assert got == sorted(
        [(5, 5, True)] * 3 + [(7, 5, False), (9, 5, False)] + [(3, 1, False)] * 3 + [(1, 1, True), (20, 1, False), (30, 30, True)]
    )
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    kept = keep_one_of_each(texts(values, ids), 85).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 5, 5, 5, 30]
