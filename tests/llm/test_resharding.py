"""The flow against all small assignments, and rewritten files against the documents."""

import itertools
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanwell import storage
from gleanwell.llm import resharding
from gleanwell.llm.resharding import cheapest_moves, digests, plan_reshard, reshard, rewrite_affected, shard_sizes


def test_cheapest_moves_against_all_flows():
    rnd = random.Random(14)
    for _ in range(40):
        old, costs = [rnd.randrange(4) for _ in range(2)], [[rnd.randrange(5) for _ in range(3)] for _ in range(2)]
        room = [rnd.randrange(4) for _ in range(3)]
        if sum(room) < sum(old):
            continue
        ways = [[w for w in itertools.product(range(s + 1), repeat=3) if sum(w) == s] for s in old]
        best = min(
            sum(costs[i][j] * w[i][j] for i in range(2) for j in range(3))
            for w in itertools.product(*ways)
            if all(w[0][j] + w[1][j] <= room[j] for j in range(3))
        )
        flow = cheapest_moves(old, room, costs)
        assert [sum(x) for x in flow] == old and all(sum(x[j] for x in flow) <= room[j] for j in range(3))
        assert sum(costs[i][j] * flow[i][j] for i in range(2) for j in range(3)) == best
    assert shard_sizes([5, 6], 3) == [4, 4, 3]
    with pytest.raises(ValueError):
        cheapest_moves([5], [4])


def test_kept_bytes_are_the_most_possible():
    old = [100, 50, 0, 70]
    room = shard_sizes(old, 6)
    flow = cheapest_moves(old, room)
    assert sum(flow[k][k] for k in range(4)) == sum(min(a, b) for a, b in zip(old, room))


@pytest.fixture
def corpus(texts, prose):
    rnd = random.Random(15)
    values = [prose(rnd, rnd.randrange(1, 60)) for _ in range(900)]
    return texts(values + ["hot copy " * 20] * 300 + ["cool copy"] * 4 + [None, ""])


def test_shards(corpus):
    rows = reshard(corpus, old_shards=4, shards=6, kept=("lang", "size")).toDF("doc_id", "lang", "kept", "size", "crc", "old", "shard", "slot").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in corpus.collect())
    texts = {r.doc_id: r.text or "" for r in corpus.collect()}
    sizes, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        assert (r.size, r.crc) == (len(texts[r.doc_id].encode()) + 8, zlib.crc32(texts[r.doc_id].encode()))
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        places[texts[r.doc_id]].add(r.shard)
    assert len(sizes) == 6 and max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(places["hot copy " * 20]) > 1 and len(places["cool copy"]) == 1


def test_rewrite_touches_only_what_changes(spark, corpus, tmp_path):
    path = str(tmp_path / "shards")
    plain = corpus.select("doc_id", "text", "lang")
    spread = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(3)).cast("int")
    plain.withColumn("shard", spread).repartition("shard").write.partitionBy("shard").parquet(path)
    plan, _ = plan_reshard(digests(plain, 3, 4), 3, 4)
    before = {x.name: {f.name for f in x.iterdir()} for x in (tmp_path / "shards").glob("shard=*")}
    changed = rewrite_affected(spark.read.parquet(path), path, 3, 4)
    assert set(changed) == plan.changed()
    after = spark.read.parquet(path)
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in plain.collect())
    for name, files in before.items():
        if int(name.split("=")[1]) not in changed:
            assert {f.name for f in (tmp_path / "shards" / name).iterdir()} == files


def test_odd_and_empty(odd, empty):
    assert reshard(odd).count() == odd.count() and reshard(empty).count() == 0


def test_two_reshards_in_a_row_and_fewer_shards(spark, corpus, tmp_path):
    path = str(tmp_path / "shards")
    plain = corpus.select("doc_id", "text", "lang")
    spread = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(3)).cast("int")
    plain.withColumn("shard", spread).repartition("shard").write.partitionBy("shard").parquet(path)
    want, now = sorted(map(str, plain.collect())), 3
    for shards in (5, 2, 4):
        before = {(r.doc_id, r.text): r.shard for r in spark.read.parquet(path).collect()}
        files = {x.name: {f.name for f in x.iterdir()} for x in (tmp_path / "shards").glob("shard=*")}
        changed = rewrite_affected(spark.read.parquet(path), path, now, shards)
        after = spark.read.parquet(path)
        assert sorted(map(str, after.select(*plain.columns).collect())) == want
        sizes = defaultdict(int)
        for r in after.collect():
            sizes[r.shard] += len((r.text or "").encode()) + 8
            assert before[r.doc_id, r.text] == r.shard or {before[r.doc_id, r.text], r.shard} <= set(changed)
        assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) < 0.1 * sum(sizes.values())
        assert {x.name for x in (tmp_path / "shards").glob("shard=*")} == {f"shard={k}" for k in range(shards)}
        for name, those in files.items():
            if int(name.split("=")[1]) not in changed:
                assert {f.name for f in (tmp_path / "shards" / name).iterdir()} == those
        now = shards
    with pytest.raises(ValueError):
        rewrite_affected(spark.read.parquet(path), path, 2, 4)


@pytest.mark.parametrize("done", range(4))
def test_a_rewrite_cut_off_loses_and_doubles_nothing(spark, corpus, tmp_path, monkeypatch, done):
    """A driver lost at any of the renames, and at the write."""
    path = str(tmp_path / "shards")
    plain = corpus.select("doc_id", "text", "lang")
    spread = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(5)).cast("int")
    plain.withColumn("shard", spread).repartition("shard").write.partitionBy("shard").parquet(path)
    want, left, move = sorted(map(str, plain.collect())), [done - 1], storage.move

    def stop(*args):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        move(*args)

    if done:
        monkeypatch.setattr(storage, "move", stop)
    else:
        monkeypatch.setattr(resharding, "_write_shards", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        rewrite_affected(spark.read.parquet(path), path, 5, 3)
    monkeypatch.undo()
    docs = spark.read.parquet(path) if not done else spark.createDataFrame([], "doc_id bigint, text string, lang string, shard int")
    changed = rewrite_affected(docs, path, 5, 3)
    after = spark.read.parquet(path)
    assert sorted(map(str, after.select(*plain.columns).collect())) == want
    assert {r.shard for r in after.select("shard").distinct().collect()} == {0, 1, 2} <= set(changed) | {0, 1, 2}
    assert {x.name for x in (tmp_path / "shards").glob("shard=*")} == {"shard=0", "shard=1", "shard=2"}


def test_reshard_writes_the_texts(spark, corpus):
    before = set(storage._scratch.get(spark.sparkContext.applicationId, []))
    rows = {r.doc_id: r for r in reshard(corpus, old_shards=6, shards=4).collect()}
    path = next(x for x in storage._scratch[spark.sparkContext.applicationId] if x not in before and "/shards-" in x)
    found = spark.read.parquet(path).collect()
    assert {r.doc_id: (r.text, r.shard) for r in found} == {r.doc_id: (r.text, rows[r.doc_id].shard) for r in corpus.collect()}
    assert len(found) == len(rows) and {r.shard for r in found} == set(range(4))
