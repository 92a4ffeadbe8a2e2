"""Against a set of all strings of LENGTH bytes in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest

from gleanwell.llm import repeats
from gleanwell.llm.repeats import LENGTH, least_in_windows, remove_repeats


def plain(values):
    data = [(t or "").encode() for t in values]
    counts = Counter(d[k : k + LENGTH] for d in data for k in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - LENGTH + 1):
            if counts[d[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(d)))
        out.append((len(d), sum(gone), spans, bytes(x for x, g in zip(d, gone) if not g)))
    return out


def check(frame, values):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(frame).collect()}
    for k, want in enumerate(plain(values)):
        assert got[k] == want, (k, got[k][:3], want[:3])


def test_passages_copies_and_near_copies(texts, prose):
    rnd = random.Random(16)
    passage, edge = prose(rnd, 90), (prose(rnd, 200))[:LENGTH]
    long = prose(rnd, 500)
    words = long.split()
    near = [" ".join(w if rnd.random() > p else "x" for w in words) for p in (0.002, 0.004, 0.01, 0.03, 0.2)]
    values = [
        f"{prose(rnd, 20)} {passage} {prose(rnd, 30)}", f"{passage}\n{prose(rnd, 5)}", f"{prose(rnd, 5)} {passage[3:]}",
        edge, f"é{edge}é", edge[:-1] + "!", edge[1:], long, long, *near, None, "", "short", "short",
        "ab" * 500, "ab" * 150, "z" * 2000, prose(rnd, 100) + " " + passage[10:420] + passage[5:430], "日本語テキスト" * 80,
    ]
    check(texts(values), values)


def test_random_texts_over_two_letters(texts):
    rnd = random.Random(17)
    pieces = ["".join(rnd.choice("ab") for _ in range(230)) for _ in range(5)]
    values = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 7))) for _ in range(25)]
    check(texts(values), values)


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_least_in_windows(size):
    values = np.random.default_rng(18).integers(0, 9, 40).astype(np.uint64)
    want = [k + int(np.argmin(values[k : k + size])) for k in range(len(values) - size + 1)]
    assert least_in_windows(values, size).tolist() == want


def test_odd_and_empty(odd, empty):
    rows = remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    assert {(r.n_removed, bytes(r.kept)) for r in rows if r.doc_id is None} == {(0, b"no id")}
    assert remove_repeats(empty).count() == 0
    assert repeats.HALF * 2 >= repeats.DISTANCES


@pytest.mark.parametrize("step", [500, 1100])
def test_long_texts_are_read_in_parts(texts, prose, monkeypatch, step):
    monkeypatch.setattr(repeats, "STEP_BYTES", step)
    rnd = random.Random(19)
    passage = prose(rnd, 150)
    values = [
        prose(rnd, 300) + passage + prose(rnd, 200), passage[7:], "ab" * 1500, "z" * 2500, prose(rnd, 900),
        prose(rnd, 40), "", prose(rnd, 100) + " " + passage[100:700] + passage[50:640], prose(rnd, 77)[:LENGTH],
    ]
    check(texts(values + values[4:5]), values + values[4:5])


def test_memory_does_not_follow_the_longest_text():
    import tracemalloc

    import pyarrow as pa

    data = np.random.default_rng(20).integers(97, 123, 6_000_000).astype(np.uint8).tobytes().decode()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([data])], names=["doc_id", "text"])
    tracemalloc.start()
    rows = sum(len(b) for b in repeats._runs(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Each start lies in a cell; a text's own bytes come from Arrow and are not counted.
    assert rows > 6_000_000 / repeats.HALF / 2
    assert peak < 60_000_000


def test_memory_does_not_follow_the_batch(monkeypatch):
    import tracemalloc

    import pandas as pd
    import pyarrow as pa

    from gleanwell.llm import bytesets

    # Tables that other tests have grown stay out of it.
    monkeypatch.setattr(bytesets, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    data = np.random.default_rng(21).integers(97, 123, 12_000_000).astype(np.uint8).tobytes()
    # Two neighbouring cells of the first pass for each text.
    pieces = [data[k : k + 600] for k in range(0, len(data), 1200)]
    frame = pd.DataFrame({"doc_id": range(len(pieces)), "at": repeats.pack_place(np.full(len(pieces), 50), np.zeros(1), np.full(1, 200)), "bytes": pieces})
    tracemalloc.start()
    rows = sum(map(len, repeats._cut(iter([frame]), repeats.CELL)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(pieces) * -(-201 // repeats.CELL)
    assert peak < 40_000_000

    whole = [data[k : k + 2000].decode() for k in range(0, len(data), 2000)]
    found = pa.array([[int(repeats.pack_place(np.array([3]), np.array([0]), np.array([5]))[0])] if k % 2 else None for k in range(len(whole))], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(whole))), pa.array(whole), found], names=["doc_id", "text", "found"])
    tracemalloc.start()
    made = [(r["doc_id"], r["n_removed"], r["n_spans"], len(r["kept"])) for b in repeats._remove(iter([batch])) for r in b.select(["doc_id", "n_removed", "n_spans", "kept"]).to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made == [(k, 405 * (k % 2), k % 2, 2000 - 405 * (k % 2)) for k in range(len(whole))]
    assert peak < 15_000_000
