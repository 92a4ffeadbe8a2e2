"""Against raking in plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanwell.llm import mixing
from gleanwell.llm.mixing import DIMENSIONS, TEMPER, mix, sample


@pytest.fixture
def corpus(texts, prose):
    rnd = random.Random(13)
    n = 400
    sources = [rnd.choice(["a", "a", "a", "b", "c", None]) for _ in range(n)]
    langs = [rnd.choice(["en", "en", "de", None]) for _ in range(n)]
    return texts([prose(rnd, rnd.choice((20, 90, 400))) for _ in range(n)], langs=langs, sources=sources)


@pytest.mark.parametrize("per_task", [0, 250_000])
def test_expected_tokens_meet_the_targets(corpus, monkeypatch, per_task):
    monkeypatch.setattr(mixing, "CELLS_PER_TASK", per_task)
    rows = mix(corpus, budget=0.5).collect()
    total = sum(r.n_tokens for r in rows)
    for name in DIMENSIONS:
        there, drawn = defaultdict(int), defaultdict(float)
        for r in rows:
            there[r[name]] += r.n_tokens
            drawn[r[name]] += r.chance * r.n_tokens
        powers = {k: v ** TEMPER[name] for k, v in there.items()}
        for k, v in there.items():
            target = min(v, powers[k] / sum(powers.values()) * 0.5 * total)
            assert drawn[k] == pytest.approx(target, rel=0.02), (name, k)
    assert all(0 < r.chance <= 1 for r in rows)
    chosen = sum(r.n_tokens for r in rows if r.selected)
    assert 0.35 * total < chosen < 0.65 * total


def test_same_rounds_in_plain_python(corpus):
    rows = mix(corpus, budget=0.5).collect()
    cells = defaultdict(int)
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    total, chance = sum(cells.values()), dict.fromkeys(cells, 1.0)
    for _ in range(60):
        for d, name in enumerate(DIMENSIONS):
            there, now = defaultdict(float), defaultdict(float)
            for k, v in cells.items():
                there[k[d]] += v
                now[k[d]] += v * chance[k]
            powers = sum(v ** TEMPER[name] for v in there.values())
            for k in cells:
                target = min(there[k[d]], there[k[d]] ** TEMPER[name] / powers * 0.5 * total)
                chance[k] = min(1.0, chance[k] * target / now[k[d]])
    for r in rows:
        assert r.chance == pytest.approx(chance[r.source, r.lang, r.topic], rel=0.02)


def test_sample_takes_the_selected(corpus):
    chosen = {r.doc_id for r in mix(corpus).where("selected").collect()}
    drawn = sample(corpus)
    assert drawn.columns == corpus.columns and {r.doc_id for r in drawn.collect()} == chosen


def test_odd_and_empty(odd, empty):
    rows = mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.chance <= 1 for r in rows)
    assert mix(empty).count() == 0 and sample(empty).count() == 0
    blank = odd.where(F.coalesce(F.length(F.trim("text")), F.lit(0)) == 0)
    assert mix(blank).count() == blank.count()


def shares(there, power, budget):
    """Targets that add up to the budget and exceed nothing, by bisection of their scale."""
    low, high = 0.0, 1e12
    for _ in range(300):
        scale = (low + high) / 2
        low, high = (scale, high) if sum(min(v, scale * v**power) for v in there.values()) < budget else (low, scale)
    return {k: min(v, high * v**power) for k, v in there.items()}


def hot_corpus(texts, prose, single_language=False):
    """A source with a third of the texts and 40 small ones."""
    rnd = random.Random(23)
    values, langs, sources = [], [], []
    for source in ["hot"] * 20 + [f"s{k}" for k in range(40)]:
        for lang, words in (("en", 60), ("en", 200), ("de", 40), ("de", 140)):
            values.append(prose(rnd, words))
            langs.append("fr" if single_language and source == "hot" else lang)
            sources.append(source)
    return texts(values, langs=langs, sources=sources)


def expected(rows, name):
    there, drawn = defaultdict(int), defaultdict(float)
    for r in rows:
        there[r[name]] += r.n_tokens
        drawn[r[name]] += r.chance * r.n_tokens
    return there, drawn


@pytest.mark.parametrize("per_task", [0, 250_000])
def test_hot_source_and_small_ones_meet_the_budget(texts, prose, monkeypatch, per_task):
    monkeypatch.setattr(mixing, "CELLS_PER_TASK", per_task)
    rows = mix(hot_corpus(texts, prose), budget=0.8).collect()
    total = sum(r.n_tokens for r in rows)
    for name in DIMENSIONS:
        there, drawn = expected(rows, name)
        targets = shares(there, TEMPER[name], 0.8 * total)
        assert sum(targets.values()) == pytest.approx(0.8 * total)
        for k, target in targets.items():
            assert drawn[k] == pytest.approx(target, rel=0.003), (name, k)
    assert all(abs(r.miss) < 0.003 for r in rows)


def test_contradicting_targets_are_reported(texts, prose):
    # All of "hot" is the language "fr" and nothing else is, but their targets differ.
    rows = mix(hot_corpus(texts, prose, single_language=True), budget=0.8).collect()
    total, misses = sum(r.n_tokens for r in rows), {}
    for name in DIMENSIONS:
        there, drawn = expected(rows, name)
        misses |= {(name, k): drawn[k] / v - 1 for k, v in shares(there, TEMPER[name], 0.8 * total).items()}
    assert max(map(abs, misses.values())) > 0.05
    for r in rows:
        assert abs(r.miss) == pytest.approx(max(abs(misses[x, r[x]]) for x in DIMENSIONS), abs=1e-6)


@pytest.mark.parametrize("rounds", [1, 4])
def test_many_cells_are_raked_as_few_are(spark, texts, prose, monkeypatch, rounds):
    # The targets contradict each other, so that every round moves something; a tighter limit for tables must not count.
    monkeypatch.setattr(mixing, "TABLE_ROUNDS", 2, raising=False)
    docs = hot_corpus(texts, prose, single_language=True)
    counted = docs.select(*mixing.cell_columns(), mixing.tokens_of().alias("n")).groupBy(*DIMENSIONS).agg(F.sum("n").alias("tokens"))
    cells = mixing.write_scratch(counted, "cells")
    targets = {x: mixing.write_scratch(mixing.tempered(cells, x, TEMPER[x], 0.8), "targets") for x in DIMENSIONS}
    got = []
    for per_task in (0, 250_000):
        monkeypatch.setattr(mixing, "CELLS_PER_TASK", per_task)
        got.append({(r.source, r.lang, r.topic): (r.chance, r.miss) for r in mixing.rake(cells, targets, rounds, 0.0).collect()})
    assert len(got[0]) == cells.count() and got[0] == got[1]


def test_sums_of_a_group_do_not_depend_on_their_order():
    rnd = random.Random(3)
    values = mixing.np.array([rnd.random() * 10 ** rnd.randint(-12, 9) for _ in range(2000)])
    code = mixing.np.zeros(len(values), int)
    sums = {mixing._group_sums(code, values[order], 1)[0] for order in (slice(None), slice(None, None, -1), values.argsort())}
    assert len(sums) == 1 and sums.pop() == pytest.approx(values.sum(), rel=1e-12)
