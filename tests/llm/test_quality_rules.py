"""Measures against plain Python, and the fit against expectation-maximisation in plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanwell.llm.quality_rules import RULES, fit, judge, keep_good


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if counts[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = len(lines) - len(set(lines))
    n, symbols = len(words), len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), symbols, dup, len(covered), failed


def test_measures(texts, prose):
    rnd = random.Random(5)
    values = ["a b a b a b c", "a b c a b c", "x\nx\n \ny\nx", "#a $b | <c>", "é ü ß", "a b c d", None, "", " \n "]
    values += [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(0, 60))) for _ in range(40)]
    values += [prose(rnd, 80), "\n".join([prose(rnd, 30)] * 4)]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in judge(texts(values), into="q").select("doc_id", *[f"q.{x}" for x in names], "q.kept").collect():
        assert tuple(r)[1:7] == measured(values[r.doc_id]), values[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_fit(spark):
    rnd = random.Random(6)
    rows = []
    for _ in range(400):
        good = rnd.random() < 0.7
        rows.append([v if rnd.random() < a else -v for a in (0.9, 0.8, 0.7) for v in [1 if good else -1]])
        rows[-1][rnd.randrange(3)] *= rnd.random() < 0.8
    found = fit(spark.createDataFrame([(r,) for r in rows], "votes array<int>"), rules=3, rounds=40)
    patterns, k, n = Counter(map(tuple, rows)), 0.001 * len(rows) + 1, len(rows)
    good, right = 0.8, [0.9] * 3
    for _ in range(40):
        g = {v: c / (1 + math.exp(-(math.log(good / (1 - good)) + sum(x * math.log(a / (1 - a)) for x, a in zip(v, right))))) for v, c in patterns.items()}
        good = (sum(g.values()) + 0.8 * k) / (n + k)
        right = [
            max(0.5, min(0.99, (sum(g[v] if v[j] == 1 else c - g[v] if v[j] else 0 for v, c in patterns.items()) + 0.9 * k)
                         / (sum(abs(v[j]) * c for v, c in patterns.items()) + k)))
            for j in range(3)
        ]
    assert found.good == pytest.approx(good) and found.accuracies == pytest.approx(right)
    assert found.accuracies[0] > found.accuracies[2]


def test_clean_texts_stay_and_junk_goes(texts, prose):
    rnd = random.Random(7)
    nouns = "river house garden letter music window summer market engine picture".split()
    small = "the of a in and is to with for by".split()

    def sentence():
        return " ".join(w for _ in range(5) for w in (rnd.choice(small), prose(rnd, 1))).capitalize() + "."

    clean = ["\n".join(sentence() for _ in range(12)) for _ in range(60)]
    junk = [" ".join(f"{rnd.choice(nouns)}{x}$$$" for x in range(70)) for _ in range(8)]
    loud = [" ".join(f"{rnd.choice(nouns).upper()}!!" for x in range(70)) for _ in range(8)]
    frame = texts(clean + junk + loud)
    kept = {r.doc_id for r in keep_good(frame).collect()}
    assert kept == set(range(60))
    assert keep_good(frame).columns == frame.columns


def test_odd_and_empty(odd, empty):
    rows = judge(odd, into="q").select("q.*").collect()
    assert len(rows) == odd.count() and len(rows[0].votes) == len(RULES)
    assert all(set(r.votes) == {0} for r in rows if not r.n_words)
    assert keep_good(empty).count() == 0 and keep_good(empty).columns == empty.columns


def test_no_python_in_the_plan(odd):
    plan = judge(odd, into="q").where(F.col("q.kept"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
