"""Archives appended to once per run, lists replaced as one, archives joined in place."""

import re

import pytest
from pyspark.sql import functions as F

from gleanwell import storage
from gleanwell.operators.bucketed import append_bucketed, not_in_bucketed, write_bucketed
from gleanwell.plans.channel_lists import build_channel_lists
from gleanwell.sinks.writers import append_archive
from gleanwell.sources.files import read_archive, read_channel_videos
from gleanwell.storage import commit_run, names


def keys(spark, *pairs):
    return spark.createDataFrame(list(pairs), "source string, key string")


def held(spark, path):
    return sorted((r.source, r.key) for r in read_archive(spark, path, partitioned=True).collect())


def test_the_same_run_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "archive")
    first, second = [("a", "1"), ("b", "2")], [("a", "3")]
    for rows, run in ((first, "r1"), (first, "r1"), (second, "r2"), (first, "r1"), (second, "r2")):
        append_archive(keys(spark, *rows), path, run=run)
    assert held(spark, path) == sorted(first + second)
    append_archive(keys(spark, *first, ("c", "9")), path, archive=read_archive(spark, path, partitioned=True), run="r3")
    append_archive(keys(spark, *first, ("c", "9")), path, archive=read_archive(spark, path, partitioned=True), run="r3")
    assert held(spark, path) == sorted(first + second + [("c", "9")])


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_run_cut_off_while_it_is_put_in_place_is_finished(spark, tmp_path, monkeypatch, moves):
    path = str(tmp_path / "archive")
    rows = [("a", "1"), ("b", "2"), ("c", "3")]
    left, move = [moves], storage.move

    def stop(*args):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        move(*args)

    monkeypatch.setattr(storage, "move", stop)
    with pytest.raises(OSError):
        append_archive(keys(spark, *rows), path, run="r")
    monkeypatch.setattr(storage, "move", move)
    append_archive(keys(spark, *rows), path, run="r")
    assert held(spark, path) == rows


def test_a_run_cut_off_before_its_commit_is_begun_anew(spark, tmp_path):
    path = str(tmp_path / "archive")

    def cut_off(to):
        keys(spark, ("a", "1")).withColumnRenamed("key", "value").write.partitionBy("source").text(to)
        storage.delete(spark, f"{to}/_SUCCESS")
        raise OSError("lost")

    with pytest.raises(OSError):
        commit_run(cut_off, spark, path, "r")
    assert held(spark, path) == []
    append_archive(keys(spark, ("a", "1"), ("a", "2")), path, run="r")
    assert held(spark, path) == [("a", "1"), ("a", "2")]
    with pytest.raises(ValueError):
        append_archive(keys(spark, ("a", "1")), path, run="a/b")


@pytest.fixture
def bucketed(spark, tmp_path):
    rows = [(f"s{k % 7}", str(k)) for k in range(400)]
    yield write_bucketed(keys(spark, *rows), "archive_in_buckets", str(tmp_path / "archive"), buckets=8)
    spark.sql("DROP TABLE archive_in_buckets")


def test_join_in_place_moves_new_rows_only(spark, bucketed):
    new = spark.range(1000).select(F.concat(F.lit("s"), F.col("id") % 7).alias("site"), F.col("id").cast("string").alias("video"), F.lit("x").alias("more"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fresh = not_in_bucketed(new, bucketed, "site", "video")
        got = sorted(int(r.video) for r in fresh.collect())
        text = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == list(range(400, 1000))
    above = ancestors(text.split("== Initial Plan ==")[0], "archive_in_buckets")
    join = next(k for k, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line or "ShuffleRead" in line for line in above[:join])


def ancestors(plan, name):
    """The operators above the one that names a table, from the bottom up."""
    lines = [line for line in plan.splitlines() if re.search(r"\w", line)]
    depth = [re.search(r"[\w*]", line).start() for line in lines]
    at = next(k for k, line in enumerate(lines) if name in line)
    found, level = [], depth[at]
    for k in range(at, -1, -1):
        if depth[k] < level:
            found.append(lines[k])
            level = depth[k]
    return found


def test_null_keys_are_new_and_appending_adds_once(spark, bucketed):
    rows = keys(spark, ("s0", None), (None, "0"), ("s0", "0"), ("s0", "777"), ("s0", "777"))
    got = not_in_bucketed(rows, bucketed).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("s0", None), (None, "0"), ("s0", "777"), ("s0", "777")]))
    for _ in range(2):
        append_bucketed(keys(spark, ("s0", "777"), ("s0", "777"), ("s0", "0")), "archive_in_buckets", buckets=8)
    assert spark.table("archive_in_buckets").count() == 401


# --- channel lists ---------------------------------------------------------------------------------


CHANNELS = [("https://www.youtube.com/channel/UC1", "One two"), ("https://www.youtube.com/channel/UC2", "Two"), ("https://www.youtube.com/channel/UC3", "Three")]
FOUND = [("UC1", 0, "a"), ("UC1", 1, "b"), ("UC1", 2, "a"), ("UC2", 0, "c"), ("UC3", 0, "d"), ("UC3", 1, "e"), ("UC9", 0, "z")]


@pytest.fixture
def lists(spark, tmp_path):
    path = str(tmp_path / "lists")

    def build(channels=CHANNELS, found=FOUND, licences=None):
        codes = None if licences is None else spark.createDataFrame(licences, "video_id string, license string")
        return build_channel_lists(
            spark.createDataFrame(channels, "channel_url string, channel_name string"),
            spark.createDataFrame(found, "channel_id string, pos bigint, video_id string"), path, codes,
        )

    def read():
        rows = read_channel_videos(spark, path, partitioned=True).orderBy("channel_id", "pos").collect()
        out = {}
        for r in rows:
            out.setdefault((r.channel_id, r.channel_name), []).append(r.video_id)
        return out

    def files():
        return {p: names(spark, f"{path}/{p}") for p in names(spark, path) if "=" in p}

    build.read, build.files, build.path = read, files, path
    return build


def cc(*ids):
    return [(i, "creativeCommon") for i in ids]


def test_lists_are_built_once_in_first_seen_order(lists):
    assert lists(CHANNELS[:2]) == 2
    assert lists.read() == {("UC1", "One_two"): ["a", "b"], ("UC2", "Two"): ["c"]}
    before = lists.files()
    assert lists(found=[("UC1", 0, "new"), *FOUND[4:]]) == 1
    assert lists.read() == {("UC1", "One_two"): ["a", "b"], ("UC2", "Two"): ["c"], ("UC3", "Three"): ["d", "e"]}
    assert before.items() <= lists.files().items()
    assert lists() == 0


def test_only_lists_that_change_are_rewritten(lists):
    lists()
    before = lists.files()
    assert lists(CHANNELS[:2], licences=cc("b", "c", "e")) == 1
    assert lists.read() == {("UC1", "One_two"): ["b"], ("UC2", "Two"): ["c"], ("UC3", "Three"): ["d", "e"]}
    after = lists.files()
    assert [p for p in before if before[p] != after[p]] == ["channel=UC1__One_two"]
    assert lists(licences=[*cc("b", "e"), ("d", "youtube"), ("c", None)]) == 2
    assert lists.read() == {("UC1", "One_two"): ["b"], ("UC3", "Three"): ["e"]}
    # The emptied list is there, so the channel is not listed anew, and nothing is left to change.
    assert lists(licences=cc("b", "e")) == 0


def test_new_lists_hold_creative_commons_only(lists):
    lists(licences=cc("a", "d"))
    assert lists.read() == {("UC1", "One_two"): ["a"], ("UC3", "Three"): ["d"]}


def test_a_driver_lost_between_renames_leaves_whole_lists(lists, monkeypatch, spark):
    lists()
    left, move = [1], storage.move

    def stop(*args):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        move(*args)

    monkeypatch.setattr(storage, "move", stop)
    with pytest.raises(OSError):
        lists(licences=cc("b", "e"))
    monkeypatch.setattr(storage, "move", move)
    assert len(storage.finish_replacements(spark, lists.path)) == 2
    assert lists.read() == {("UC1", "One_two"): ["b"], ("UC3", "Three"): ["e"]}
    assert storage.finish_replacements(spark, lists.path) == []
