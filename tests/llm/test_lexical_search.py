"""Against the same scores, document by document, in plain Python integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from gleanwell.llm import lexical_search
from gleanwell.llm.lexical_search import top_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, best=50):
    """``docs``, ``items``: (id, text)."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    many, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * many) // max(total, 1)
            score = 0
            for t in set(terms(text)):
                w = math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) if c[t] else 0
            if score > 0:
                scored.append((-score, doc is not None, doc, score))
        for rank, (_, _, doc, score) in enumerate(sorted(scored, key=lambda x: x[:3])[:best], 1):
            out.append((item, rank, doc, score))
    return out


def result(docs, items, **given):
    rows = [(r.item_id, r["rank"], r.doc_id, r.score) for r in top_documents(docs, items, **given).collect()]
    return sorted(rows, key=str)


def same(got, want):
    assert got == sorted(want, key=str)


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string, rank string, score string")


def rows(pairs):
    return [(i, t, "-", "-") for i, t in pairs]


@pytest.fixture
def corpus(prose):
    rnd = random.Random(9)
    docs = [(k, prose(rnd, rnd.randrange(1, 120))) for k in range(400)]
    items = [(k, prose(rnd, rnd.randrange(1, 30))) for k in range(25)]
    items += [(100 + k, docs[k][1]) for k in (3, 7)]
    docs += [(1000 + k, docs[3][1]) for k in range(70)]  # copies tie beyond the last rank
    docs += [(2000, items[4][1] + " " + docs[8][1]), (2001, items[4][1].upper() + "!"), (2001, "same id, other text")]
    return docs, items


@pytest.mark.parametrize("bucket, rest", [(16, 0.3), (16, 0.0), (100, 0.9), (4096, 0.3)])
def test_all_scores(texts, table, corpus, monkeypatch, bucket, rest):
    monkeypatch.setattr(lexical_search, "BUCKET", bucket)
    monkeypatch.setattr(lexical_search, "REST", rest)
    docs, items = corpus
    got = result(texts([t for _, t in docs], [i for i, _ in docs]).repartition(3), table(rows(items)), best=50)
    same(got, plain(docs, items))


def test_blocks_of_items(texts, table, corpus, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    docs, items = corpus
    docs, items = docs[:80], items[:5]
    same(result(texts([t for _, t in docs], [i for i, _ in docs]), table(rows(items)), best=3), plain(docs, items, 3))


def test_bounds_leave_out_only_what_is_too_low(corpus):
    """Candidates hold every row that reaches the least score, and far from all rows."""
    rnd = np.random.default_rng(4)
    counts = rnd.integers(1, 30, 500)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    number = np.concatenate([rnd.choice(200, c, replace=False) for c in counts])
    impacts = rnd.integers(1, 1_000_000, bounds[-1])
    length = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, bounds[:-1]))
    order = np.argsort(-length)
    parts = [slice(bounds[k], bounds[k + 1]) for k in order]
    cuts = np.concatenate(([0], np.cumsum(counts[order])))
    bucket = lexical_search._Bucket(length[order], cuts, np.concatenate([number[p] for p in parts]), np.concatenate([impacts[p] for p in parts]))
    weight_of = rnd.integers(1, 9000, 200)
    looked = []
    for _ in range(40):
        own = rnd.choice(200, 12, replace=False)
        own = own[np.argsort(-weight_of[own])]
        own = own[np.isin(own, bucket.held)]
        weights = weight_of[own].astype(float)
        assert len(own) > 7
        chosen = np.zeros(200, np.int64)
        chosen[own] = weight_of[own]
        scores = bucket.scores(np.arange(500), chosen)
        least = int(np.sort(scores)[-10])
        norm = float(np.linalg.norm(weights))
        for focus in (0, 3, 7, len(own)):
            rest = float(np.linalg.norm(weights[focus:]))
            rows_ = bucket.candidates(own, weights, norm, focus, rest, least)
            assert set(np.flatnonzero(scores >= least)) <= set(rows_)
            looked.append((focus, len(rows_)))
    mean = lambda focus: np.mean([n for f, n in looked if f == focus])
    assert mean(7) < mean(3) < mean(0) < 500


def test_odd_rows_and_no_rows(texts, odd, empty, table):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "one WORD Same c"), (2, None), (3, ""), (4, "日本語 é 🙂"), (None, "j id"), (1, "one WORD Same c"), (5, "| !")]
    same(result(odd, table(rows(items))), plain(docs, items))
    assert result(empty, table(rows(items))) == []
    assert result(odd, table([])) == []
    assert top_documents(odd, table([])).columns == ["item_id", "rank", "doc_id", "score"]


def test_a_text_longer_than_a_step(texts, table, prose, monkeypatch):
    monkeypatch.setattr(lexical_search, "STEP_BYTES", 1000)
    rnd = random.Random(2)
    docs = [(1, " ".join([prose(rnd, 300)] * 3)), (2, prose(rnd, 20)), (3, "x" * 5000 + " kanlor"), (4, "")]
    items = [(1, docs[0][1][:200]), (2, "kanlor " + docs[1][1]), (3, "X" * 5000)]
    same(result(texts([t for _, t in docs], [i for i, _ in docs]).coalesce(1), table(rows(items))), plain(docs, items))
