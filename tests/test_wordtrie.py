import random
import re
import time

import pytest
from pyspark.sql import functions as F

from gleanwell.functions import wordtrie
from gleanwell.functions.predicates import MIN_PATTERN, any_of
from gleanwell.operators.filters import filter_ignored_words

LETTERS = "abcdeé.*+?[](){}|^$\\-/ß日🙂 _'\"&%#1"


def words(rnd, n, longest=6):
    return list({"".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(1, longest))) for _ in range(n)})


@pytest.mark.parametrize("test, same", [
    (F.contains, lambda t, w: w in t), (F.startswith, lambda t, w: t.startswith(w)), (F.endswith, lambda t, w: t.endswith(w))
])
def test_pattern_equals_words_one_by_one(spark, test, same):
    rnd = random.Random(1)
    listed = words(rnd, 300)
    assert len(listed) >= MIN_PATTERN
    texts = ["".join(rnd.choice(LETTERS + "xyzXYZ\n") for _ in range(rnd.randrange(0, 9))) for _ in range(3000)]
    rows = spark.createDataFrame([*enumerate(texts), (-1, None)], "i int, t string")
    got = {r.i: r.found for r in rows.select("i", any_of(F.col("t"), listed, test).alias("found")).collect()}
    assert got == {-1: None} | {k: any(same(t, w) for w in listed) for k, t in enumerate(texts)}


def test_the_empty_word_is_everywhere(column):
    assert column(any_of(F.col("x"), ["", *map(str, range(100))], F.contains), ["", "a", None]) == [True, True, None]


def test_pattern_is_read_alike_by_another_engine():
    rnd = random.Random(2)
    listed = words(rnd, 60, 4)
    found = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), wordtrie.pattern(listed)))
    for _ in range(2000):
        text = "".join(rnd.choice(LETTERS) for _ in range(5))
        assert bool(found.search(text)) == any(w in text for w in listed)


def test_time_does_not_grow_with_the_list(spark, tmp_path):
    rnd = random.Random(3)
    name = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    many = list({name(rnd.randrange(8, 14)) for _ in range(10_000)})
    urls = [f"https://www.{name(8)}.example/{name(20)}/{name(30)}?{rnd.choice(many) if k % 10 == 0 else name(5)}" for k in range(40_000)]
    spark.createDataFrame([(u,) for u in urls], "url string").write.parquet(str(tmp_path / "urls"))
    rows = spark.read.parquet(str(tmp_path / "urls"))

    def seconds(listed):
        filter_ignored_words(rows, listed).count()
        start = time.perf_counter()
        kept = filter_ignored_words(rows, listed).count()
        return time.perf_counter() - start, kept

    few, _ = seconds(many[:100])
    all_, kept = seconds(many)
    found = re.compile("|".join(map(re.escape, sorted(many, key=len))))
    assert kept == sum(1 for u in urls if not found.search(u))
    # A hundred times the words; one test per word would take about a hundred times as long.
    assert all_ < 8 * few + 1
