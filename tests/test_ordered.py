import random

from gleanwell.functions.media import media_name_seconds
from gleanwell.operators import counts, ordered


def test_batches_and_positions_equal_the_plain_rule(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", None]), p) for p in rnd.sample(range(5000), 700)]
    frame = spark.createDataFrame(rows, "channel_name string, pos bigint")
    got = {(r.channel_name, r.pos): r.batch for r in ordered.batch_plan(frame, 7).collect()}
    for channel in {r[0] for r in rows}:
        for n, pos in enumerate(sorted(p for c, p in rows if c == channel)):
            assert got[channel, pos] == n // 7 + 1
    assert len(got) == len(rows)


def test_hours_budget_keeps_the_crossing_item(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice("ab"), round(rnd.random() * 60, 3)) for i in range(600)]
    frame = spark.createDataFrame(rows, "pos bigint, source string, duration double")
    limit = 2.0
    kept, total = set(), 0.0
    for pos, _, seconds in rows:
        if total < limit * 3600:
            kept.add(pos)
        total += seconds
    assert {r.pos for r in ordered.hours_budget(frame, limit).collect()} == kept
    by_source = ordered.hours_budget(frame, 1.0, keys=("source",)).collect()
    expected = set()
    for source in "ab":
        total = 0.0
        for pos, s, seconds in rows:
            if s == source:
                if total < 3600:
                    expected.add(pos)
                total += seconds
    assert {r.pos for r in by_source} == expected
    assert ordered.hours_budget(frame, 0.1, enabled=False).count() == 600


def test_uploaded_counts(spark):
    rows = spark.createDataFrame([("c", 1)] * 3 + [("c", 2)] * 2 + [("d", 1)], "channel_name string, batch bigint")
    got = {(r.channel_name, r.batch): (r.files, r.files_so_far) for r in ordered.uploaded_counts(rows).collect()}
    assert got == {("c", 1): (3, 3), ("c", 2): (2, 5), ("d", 1): (1, 1)}


def test_hours(spark):
    rows = spark.createDataFrame([(1800.0, 1800), (5400.5, 5400), (None, None)], "duration double, seconds bigint")
    assert counts.total_hours(rows).first().hours == 7200.5 / 3600
    assert counts.total_hours_floor(rows).first().hours == 2


def test_whole_hours_of_files_whose_minutes_do_not_come_out_even(spark):
    for seconds, files in ((80, 45), (20, 180)):
        names = spark.createDataFrame([(f"{seconds}file-id{k}.mp4",) for k in range(files)], "name string")
        rows = names.select(media_name_seconds("name").alias("seconds"))
        assert counts.total_hours_floor(rows).first().hours == 1
        assert counts.total_hours_floor(rows.limit(files - 1)).first().hours == 0
