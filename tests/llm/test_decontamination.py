"""Against a search along every distance in plain Python."""

import itertools
import random
import re

import pytest

from gleanwell.llm.decontamination import AGREE, BY_SIZE, MASKS, STRETCH, overlaps, without_benchmark


def plain(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if c < "Ā" else c for c in text or ""))


def best(text, item):
    size = min(STRETCH, len(item))
    found = 0
    for shift in range(-len(item), len(text)):
        for at in range(len(item) - size + 1):
            if 0 <= at + shift <= len(text) - size:
                found = max(found, sum(text[at + shift + d] == item[at + d] for d in range(size)))
    return found, size


@pytest.fixture
def items(spark, prose):
    rnd = random.Random(11)
    values = [prose(rnd, n) for n in (40, 30, 25, 12)] + [None, "", "too short"]
    return values, spark.createDataFrame(list(enumerate(values)), "item_id bigint, text string")


def test_overlaps(texts, prose, items):
    rnd = random.Random(12)
    given, table = items

    def planted(item, changed):
        words = given[item].split()
        for k in rnd.sample(range(len(words)), changed):
            words[k] = prose(rnd, 1)
        return f"{prose(rnd, 30)}\n{' '.join(words).title()}, {prose(rnd, 20)}!"

    values = [planted(item, changed) for item in range(4) for changed in (0, 0, 1, 2)]
    values += [prose(rnd, 200) for _ in range(10)] + [None, "", given[0], " ".join(given[0].split()[:24]), given[3]]
    got = {(r.doc_id, r.item_id): (r.equal, r.tokens) for r in overlaps(texts(values), table).collect()}
    want = {}
    for d, text in enumerate(values):
        for i in range(4):
            equal, size = best(plain(text), plain(given[i]))
            if 100 * equal >= AGREE * size:
                want[d, i] = (equal, size)
    assert set(got) <= set(want) and all(got[x] == want[x] for x in got)
    # Up to one changed word in ten, seeds miss nothing.
    sure = {x for x, (equal, size) in want.items() if equal >= 0.9 * size}
    assert len(sure) >= 15 and sure <= set(got)


def test_masks_find_every_single_substitution():
    assert len({len(m) for m in MASKS}) == 1
    for at in range(STRETCH):
        assert any(
            all(start + d != at for d, x in enumerate(mask) if x == "1") for mask in MASKS for start in range(STRETCH - len(mask) + 1)
        )


def test_filter_odd_and_empty(texts, odd, empty, items):
    given, table = items
    frame = texts(["clean words only here", f"x {given[1]} y", None])
    assert [r.doc_id for r in without_benchmark(frame, table).orderBy("doc_id").collect()] == [0, 2]
    assert without_benchmark(frame, table).columns == frame.columns
    assert overlaps(odd, table).count() == 0 and without_benchmark(odd, table).count() == odd.count()
    assert overlaps(empty, table).count() == 0 and overlaps(odd, table.limit(0)).count() == 0


def padded_best(text, item):
    """As ``best``, with places beyond the text's edges that agree with nothing."""
    wide = [None] * len(item) + text + [None] * len(item)
    return best(wide, item)


def test_passages_cut_at_an_edge(texts, prose, items):
    rnd = random.Random(21)
    given, table = items
    long = given[0].split()
    values = []
    for n in range(13, 21):
        for part in (long[:n], long[-n:], long[9 : 9 + n]):
            quote, rest = " ".join(part), prose(rnd, 30)
            values += [f"{quote} {rest}", f"{rest} {quote}", f"{rest} {quote} {rest}", quote]
    got = {(r.doc_id, r.item_id): (r.start, r.equal, r.tokens) for r in overlaps(texts(values), table).collect()}
    want = {}
    for d, text in enumerate(values):
        for i in range(4):
            equal, size = padded_best(plain(text), plain(given[i]))
            if 100 * equal >= AGREE * size:
                want[d, i] = (equal, size)
    assert {x: y[1:] for x, y in got.items()} == want and all(y[0] >= 0 for y in got.values())
    # A quote of 16 of 20 tokens counts in every place.
    assert {d for d, i in want if i == 0} >= set(range(3 * 12, len(values)))


def test_every_placement_of_changes_has_a_seed():
    for size in range(1, STRETCH + 1):
        marked = [
            {start + d for d, x in enumerate(mask) if x == "1"} for mask in BY_SIZE[size] for start in range(size - len(mask) + 1)
        ]
        for changed in itertools.combinations(range(size), size * (100 - AGREE) // 100):
            assert any(m.isdisjoint(changed) for m in marked), (size, changed)


def test_all_overlaps_of_the_rule_and_no_others(spark, texts, prose):
    rnd = random.Random(22)
    given = [prose(rnd, n) for n in [*range(1, 21), 33]]
    table = spark.createDataFrame(list(enumerate(given)), "item_id bigint, text string")
    values = [prose(rnd, 60)]
    for text in given:
        words = text.split()[:STRETCH]
        most = len(words) * (100 - AGREE) // 100
        for extra in (0, 0, 0, 1):
            new = list(words)
            for k in rnd.sample(range(len(words)), min(len(words), most + extra)):
                new[k] = prose(rnd, 1)
            values += [" ".join([prose(rnd, a), *new, prose(rnd, b)]) for a, b in ((5, 5), (0, 5), (5, 0))]
    got = {(r.doc_id, r.item_id): (r.equal, r.tokens) for r in overlaps(texts(values), table).collect()}
    want = {}
    for d, text in enumerate(values):
        for i, item in enumerate(given):
            equal, size = padded_best(plain(text), plain(item))
            if equal and 100 * equal >= AGREE * size:
                want[d, i] = (equal, size)
    assert got == want and {i for _, i in want} == set(range(len(given)))


def test_memory_does_not_follow_the_batch(monkeypatch):
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pandas as pd
    import pyarrow as pa

    from gleanwell.llm import bytesets, decontamination

    # Tables that other tests have grown stay out of it.
    monkeypatch.setattr(bytesets, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    rnd = random.Random(41)
    # Words long enough that no two are alike: six million bytes, of which the filter lets no window pass.
    values = [" ".join(f"{rnd.getrandbits(20):05x}" for _ in range(330)) for _ in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3000)), pa.array(values)], names=["doc_id", "text"])
    nothing = SimpleNamespace(value=np.zeros(1024, np.uint8))
    pairs = pd.DataFrame({"doc_id": range(3000), "text": values, "item_id": 1, "item_text": values[7], "distances": [np.array([0])] * 3000})

    def peak(work):
        tracemalloc.start()
        made = work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return made, most

    made, most = peak(lambda: list(decontamination._candidates(iter([batch]), nothing, list(range(6)))))
    assert made == [] and most < 50_000_000
    made, most = peak(lambda: pd.concat(decontamination._verify(iter([pairs]))))
    assert made.doc_id.tolist() == [7] and most < 50_000_000
