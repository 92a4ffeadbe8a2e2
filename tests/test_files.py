import os
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gleanwell import sinks, sources
from gleanwell.config import CrawlConfig
from gleanwell.operators.ordered import dense_position


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")
    return str(folder)


def test_playlists_and_channels_from_plain_files(spark, tmp_path):
    write(tmp_path, "My List.txt", "b\na\nc\n")
    folder = write(tmp_path, "Empty.txt", "")
    rows = sources.read_playlists(spark, folder).orderBy("pos").collect()
    assert [(r.playlist, r.video_id) for r in rows] == [("My List", "b"), ("My List", "a"), ("My List", "c")]
    assert sources.read_playlists(spark, str(tmp_path / "absent")).count() == 0
    channels = write(tmp_path / "ch", "UC1__Some_Name.txt", "x\n")
    row = sources.read_channel_videos(spark, channels).first()
    assert (row.channel_id, row.channel_name, row.video_id) == ("UC1", "Some_Name", "x")
    assert sources.read_channel_videos(spark, channels, file_mode=True).first().channel_id is None


def test_line_order_survives_file_splits(spark, tmp_path):
    ids = [f"id{i * 7919 % 10007}" for i in range(10007)]
    folder = write(tmp_path, "UC1__Big.txt", "\n".join(ids) + "\n")
    write(tmp_path, "UC2__Small.txt", "q\np\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        read = sources.read_channel_videos(spark, folder)
        assert read.rdd.getNumPartitions() > 5
        ranked = dense_position(read, ["channel_id"])
        got = [r.video_id for r in ranked.where("channel_id = 'UC1'").orderBy("seq").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == ids


def test_archives(spark, tmp_path):
    write(tmp_path, "My Source+1/archive.txt", "https://a/b c\nhttps://d\n")
    folder = write(tmp_path, "other/archive.txt", "")
    rows = sources.read_archive(spark, folder).collect()
    assert sorted(tuple(r) for r in rows) == [("My Source+1", "https://a/b c"), ("My Source+1", "https://d")]
    videos = write(tmp_path / "v", "s/archive.txt", "youtube abc\nyoutube def\n")
    assert sorted(r.key for r in sources.read_archive(spark, videos, kind="video").collect()) == ["abc", "def"]
    assert sources.read_archive(spark, str(tmp_path / "absent")).count() == 0
    assert sources.read_archive(spark, str(tmp_path / "absent"), partitioned=True).columns == ["source", "key"]


def test_append_archive_adds_only_new_keys(spark, tmp_path):
    path = str(tmp_path / "archive")
    first = spark.createDataFrame([("s", "a"), ("s", "b")], "source string, key string")
    sinks.append_archive(first, path, video=True)
    more = spark.createDataFrame([("s", "b"), ("t", "b"), ("t", "b")], "source string, key string")
    have = sources.read_archive(spark, path, kind="video", partitioned=True)
    sinks.append_archive(more, path, archive=have, video=True)
    rows = sources.read_archive(spark, path, kind="video", partitioned=True).collect()
    assert sorted(tuple(r) for r in rows) == [("s", "a"), ("s", "b"), ("t", "b")]


@pytest.mark.parametrize("missing", ["video_url", "speaker_name", "speaker_gender"])
def test_curated_columns_are_checked(spark, tmp_path, missing):
    columns = [c for c in ("video_url", "speaker_name", "speaker_gender") if c != missing]
    write(tmp_path, "list.csv", ",".join(columns) + "\n1,2\n")
    with pytest.raises(KeyError, match=missing):
        sources.read_curated_videos(spark, str(tmp_path / "list.csv"))


def test_curated_rows_keep_their_order(spark, tmp_path):
    write(tmp_path, "list.csv", "video_url,speaker_name,speaker_gender\nb,N,M\na,,F\n")
    rows = sources.read_curated_videos(spark, str(tmp_path / "list.csv")).orderBy("pos").collect()
    assert [(r.video_url, r.speaker_name) for r in rows] == [("b", "N"), ("a", None)]


def test_json_sources(spark, tmp_path):
    page = '{"keyword":"k","page_no":1,"items":[{"id":{"videoId":"v"},"snippet":{"channelId":"C","channelTitle":"T"}}]}\n'
    write(tmp_path, "results/r.json", page)
    row = sources.read_search_results_json(spark, str(tmp_path / "results")).first()
    assert row.nextPageToken is None and row["items"][0].id.videoId == "v"
    dump = '{"url":"u","entries":[{"entries":[{"id":"a","license":"Creative Commons"},{"id":"b"}]},{"entries":[{"id":"x"}]}]}\n'
    write(tmp_path, "dump/d.json", dump)
    rows = sources.read_channel_dump_json(spark, str(tmp_path / "dump")).collect()
    assert [(r.pos, r.video_id, r.license) for r in rows] == [(0, "a", "Creative Commons"), (1, "b", None)]
    write(tmp_path, "log/l.json", '{"video_id":"v","attempt":1,"stdout":"x"}\n')
    assert sources.read_download_log(spark, str(tmp_path / "log")).first().stderr is None


def test_scraped_files_and_media_listing(spark, tmp_path):
    write(tmp_path, "s/one.txt", "a,b\nx,y\n/1,/2")
    folder = write(tmp_path, "s/two.txt", "a\nx") + "/s"
    rows = sources.read_scraped_triplets(spark, folder, prefix="p").orderBy("pos").collect()
    assert [(r.title, r.download_link) for r in rows] == [("a", "p/1"), ("b", "p/2")]
    write(tmp_path, "m/60file-idx.mp4", "1234")
    write(tmp_path, "m/other.mp3", "1")
    row = sources.read_media_listing(spark, str(tmp_path / "m")).collect()
    assert [(r.raw_file_name, r.length) for r in row] == [("60file-idx.mp4", 4)]


def test_scraped_files_written_one_per_page(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [("f1", "a,b\nx,y\n/1,/2"), ("f1", "second"), ("f/2", "é\nx\n/3"), (None, "c\nx\n/4"), ("f5", None), ("f6", ""), ("_g.", "d\nx\n/6")]
    assert sinks.write_scraped_files(spark.createDataFrame(rows, "file string, value string").repartition(3), path) == 6
    # No folder per page, and nothing that is half written.
    assert all(len(p.relative_to(path).parts) == 2 and p.name.endswith(".txt") for p in (tmp_path / "pages").rglob("*") if p.is_file())
    read = sources.read_scraped_files(spark, path, nested=True)
    got = {r.name: r.value for r in read.select(F.regexp_extract("file", r"file=([^/]*)\.txt$", 1).alias("name"), "value").collect()}
    assert got["f1"] == "a,b\nx,y\n/1,/2\nsecond\n" and got["__HIVE_DEFAULT_PARTITION__"] == "c\nx\n/4\n"
    assert got["f5"] == got["f6"] == "\n" and got["_g."] == "d\nx\n/6\n" and "é\nx\n/3\n" in got.values()
    assert [r.title for r in sources.read_scraped_triplets(spark, path, nested=True).orderBy("title").collect()] == ["c", "d", "é"]
    empty = str(tmp_path / "none")
    assert sinks.write_scraped_files(spark.createDataFrame([], "file string, value string"), empty) == 0
    assert sources.read_scraped_triplets(spark, empty, nested=True).count() == 0


ODD_NAMES = [
    "a b.txt", "p%41+c.txt", "é \u00a0\u3000.txt", "_x.txt", "_x=1.txt", ".h.txt", "_metadata.txt", "q#?[]{}|^`<>\"'~!@$&*();,=\\.txt",
    "n.TXT", "x.txt.bak", "tab\there.txt", "\U0001f600.txt", "z._COPYING_", "\x85c\x7f.txt",
]


def test_scraped_files_are_those_that_sparks_reader_gives(spark, tmp_path):
    root = tmp_path / "a+b %20"
    for folder in ("sub dir", "_hid", "k=v", "sub dir/.deep", "sub dir/e+%", "_metadata", "none"):
        (root / folder).mkdir(parents=True, exist_ok=True)
    for folder in (root, *(p for p in root.rglob("*") if p.is_dir() and p.name != "none")):
        for name in ODD_NAMES:
            (folder / name).write_bytes(f"{folder.name}/{name}\n\xe9".encode("latin-1", "replace"))
    (root / "empty.txt").write_text("")
    os.symlink(root / "sub dir" / "a b.txt", root / "link.txt")
    os.symlink(root / "nowhere", root / "broken.txt")

    def by_spark(path, nested):
        files = spark.read.format("binaryFile").options(pathGlobFilter="*.txt", recursiveFileLookup=nested).load(path)
        return sorted((r.f, bytes(r.content)) for r in files.select(F.col("_metadata.file_path").alias("f"), "content").collect())

    def ours(path, nested):
        files = sources.read_scraped_files(spark, path, nested)
        return sorted((r.file, bytes(r.value)) for r in files.select("file", F.col("value").cast("binary").alias("value")).collect())

    for path, nested in ((root, True), (f"file://{root}/", True), (root / "k=v", False), (root / "sub dir", False), (root / "a b.txt", False), (tmp_path / "a*" / "k=*", False)):
        assert ours(str(path), nested) == by_spark(str(path), nested) != []
    for nested in (True, False):
        assert ours(str(root / "none"), nested) == []
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            sources.read_scraped_files(spark, str(tmp_path / "absent"), nested)


@pytest.mark.parametrize("nested", [True, False])
def test_scraped_files_leave_nothing_of_a_file_on_the_driver(spark, tmp_path, nested):
    for k in range(600):
        write(tmp_path / "s" / str(k % 20 if nested else ""), f"{k}.txt", f"t{k}\nx\n/{k}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        rows = sources.read_scraped_triplets(spark, str(tmp_path / "s"), nested)
        # No index of files, and no task or split for a few of them.
        assert rows.inputFiles() == [] and rows.rdd.getNumPartitions() <= 4
        assert sorted(r.title for r in rows.collect()) == sorted(f"t{k}" for k in range(600))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_crawl_state_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    pages = spark.createDataFrame([("k", 1, "t1"), ("k", 2, "t2"), ("done", 1, "t"), ("done", 2, None)],
                                  "keyword string, page_no int, nextPageToken string")
    sinks.save_crawl_state(pages, path)
    keywords = spark.createDataFrame([("k",), ("done",), ("new",)], "keyword string")
    got = {r.keyword: r.token for r in sources.read_crawl_state(spark, path, keywords).collect()}
    assert got == {"k": "t2", "done": "", "new": ""}
    assert sinks.next_result_offset(CrawlConfig(pages=10)) == 100
    assert sinks.next_result_offset(CrawlConfig(pages=10, continue_page="YES", last_visited=100)) == 200


def test_license_docs_last_write_wins(spark, tmp_path):
    items = spark.createDataFrame([("s", "old", "text", 1), ("s", "new\nline", "text", 2), ("s", None, "fetch", 3)],
                                  "source string, text string, target string, pos int")
    sinks.write_license_docs(items, str(tmp_path / "l"))
    row = spark.read.text(str(tmp_path / "l"), wholetext=True).select("value", "source").collect()
    assert [tuple(r) for r in row] == [("new\nline\n", "s")]


def test_hot_channel_order_over_many_files(spark, tmp_path):
    rows = spark.range(3000).select(F.lit("hot").alias("channel"), (2999 - F.col("id")).alias("pos"), F.concat(F.lit("v"), "id").alias("video_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_channel_videos(rows, str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = list((tmp_path / "c" / "channel=hot").glob("part-*"))
    assert len(files) > 1
    read = sources.read_lines(spark, str(tmp_path / "c"), "channel").orderBy("pos").collect()
    assert [r.value for r in read] == [f"v{i}" for i in range(2999, -1, -1)]


def test_curated_cells_with_quotes_and_line_breaks(spark, tmp_path):
    text = (
        "video_url,speaker_name,speaker_gender\n"
        'u1,"The ""Great"" X, Jr",male\n'
        'u2,"first\nsecond",female\n'
        "u3,plain,male\n"
    )
    path = write(tmp_path / "lists", "curated.csv", text)
    rows = sources.read_curated_videos(spark, path).orderBy("pos").collect()
    assert [(r.video_url, r.speaker_name, r.speaker_gender) for r in rows] == [
        ("u1", 'The "Great" X, Jr', "male"), ("u2", "first\nsecond", "female"), ("u3", "plain", "male"),
    ]
    one_line = write(tmp_path / "short", "curated.csv", "video_url,speaker_name,speaker_gender\nu1,a,b\n")
    assert sources.read_curated_videos(spark, one_line, multi_line=False).count() == 1


def test_order_over_appends_and_several_plain_files(spark, tmp_path):
    path = str(tmp_path / "lists")
    for part in (["a", "b"], ["c", "d"], ["e"]):
        rows = spark.createDataFrame([("L", k, v) for k, v in enumerate(part)], "playlist string, pos int, video_id string")
        sinks.write_channel_videos(rows, path, channel="playlist", mode="append")
        time.sleep(1.1)
    read = sources.read_playlists(spark, path, partitioned=True)
    assert read.select("pos").distinct().count() == 5
    assert [r.video_id for r in dense_position(read, ["playlist"]).orderBy("seq").collect()] == list("abcde")
    for k, name in enumerate(("z.txt", "a.txt")):
        write(tmp_path / "plain" / "playlist=P", name, f"{name}1\n{name}2\n")
        os.utime(tmp_path / "plain" / "playlist=P" / name, (1_700_000_000 + k, 1_700_000_000 + k))
    plain = sources.read_playlists(spark, str(tmp_path / "plain"), partitioned=True)
    assert [r.video_id for r in plain.orderBy("pos").collect()] == ["z.txt1", "z.txt2", "a.txt1", "a.txt2"]


def test_metadata_of_a_source_lies_in_files_of_limited_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks.writers, "ROWS_PER_FILE", 100, raising=False)
    rows = spark.range(1000).select(F.lit("s").alias("source"), F.concat(F.lit("two\nlines "), "id").alias("title"))
    path = str(tmp_path / "metadata")
    sinks.write_media_metadata(rows, path)
    assert len(list((tmp_path / "metadata" / "crawl_source=s").glob("*.csv"))) >= 10
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    assert sorted(r.title for r in back.collect()) == sorted(r.title for r in rows.collect())
