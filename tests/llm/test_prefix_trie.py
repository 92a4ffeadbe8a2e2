"""Against a trie of tuples in plain Python."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from gleanwell.llm import prefix_trie as trie
from gleanwell.llm.prefix_trie import Slots, gather, prefix_trie

COLUMNS = "conv_id bigint, turn bigint, role string, text string, high string, shard string, depth string, conv string"


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, "-", "-", "-", "-") for r in rows], COLUMNS)


def plain(rows):
    """Turns that share a place must be equal, for their order is open here."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        gain = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += gain
    out = []
    for node, who in members.items():
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.append((min(who), len(node), parent, len(who), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def result(turns, **given):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    got = prefix_trie(turns, **given)
    assert got.columns == list(names)
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversations(rnd, many, most, words=3):
    rows = []
    for c in many:
        for turn in range(rnd.randrange(most + 1)):
            rows.append((c, turn, rnd.choice(["user", "bot", None]), rnd.choice(["hé", "ja", "nein 🙂", "", None][:words])))
    return rows


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_slots_are_minimal_and_checked(n):
    rnd = np.random.default_rng(n)
    high = rnd.integers(0, 3 if n < 10 else 50, n).astype(np.uint64)  # halves repeat, pairs do not
    low = np.arange(n, dtype=np.uint64)
    slots = Slots(high, low)
    assert sorted(slots.of(high, low)) == list(range(n))
    assert (slots.of(high, low + np.uint64(n)) == -1).all()


def test_gather_adds_up_through_parents():
    # 0 -> 1 -> 2, 0 -> 3
    high = np.array([10, 11, 12, 13, 10, 11], np.uint64)
    up = np.array([99, 10, 11, 10, 99, 10], np.uint64)
    zero, depth = np.zeros(6, np.uint64), np.array([4, 5, 6, 5, 4, 5])
    row, (sums,), least = gather(high, zero, up, zero, depth, [np.array([0, 1, 2, 4, 8, 16])], np.array([9, 8, 3, 7, 9, 9]))
    got = {int(high[r]): (int(s), int(m)) for r, s, m in zip(row, sums, least)}
    assert got == {10: (31, 3), 11: (19, 3), 12: (2, 3), 13: (4, 7)}


@pytest.mark.parametrize("band, shard, chunk", [(512, 1 << 16, 1 << 16), (3, 20, 4), (1, 5, 1)])
def test_all_nodes(table, monkeypatch, band, shard, chunk):
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rnd = random.Random(band)
    rows = conversations(rnd, [*range(0, 60), *range(100, 130), *range(205, 240), -3, -100, 10**12 + 7], 9, words=2)
    rows += [(c, t, "user", "same") for c in range(300, 420) for t in range(6)]  # copies
    rows += [(500, t, "user", str(t // 3)) for t in range(40)]  # longer than a band
    rows += [(501, t, "user", str(t // 3)) for t in range(40)]
    rnd.shuffle(rows)
    assert result(table(rows).repartition(3), rows_per_shard=shard) == plain(rows)


def test_odd_rows_and_no_rows(table):
    rows = [
        (7, None, "user", "first"), (7, -1, None, None), (7, 3, "user", "x" * 30_000), (7, 3, "user", "x" * 30_000),
        (None, 0, "user", "no id"), (0, 5, "bot", "head"), (0, 5, "bot", "head"), (0, 9, "bot", ""), (1, 0, "", "a"), (2, 0, "a", ""),
        (100, 0, "user", "only"), (101, 0, "u", "only turn"),
    ]
    assert result(table(rows)) == plain(rows)
    assert result(table([])) == []
    assert result(table([(None, 0, "user", "no id")])) == []


def test_turns_in_one_place_are_ordered_by_role_and_all_count(table):
    rows = [(4, 1, "b", "y"), (4, 1, "a", "x"), (4, 0, "c", "z")]
    ordered = [(4, 0, "c", "z"), (4, 1, "a", "x"), (4, 2, "b", "y")]
    assert result(table(rows)) == plain(ordered)
