from gleanwell.config import METADATA_COLUMNS, ChannelPipelineConfig, MetadataConfig
from gleanwell.functions import media
from gleanwell.operators import metadata as ops
from gleanwell.plans.channel import channel_metadata
from gleanwell.plans.playlist import playlist_files
from pyspark.sql import functions as F


def info(spark, **changes):
    row = dict(raw_file_name="f.mp3", duration=2.0, name=None, gender=None, language="kn", source="src",
               source_url="u", source_website="w", license="CC")
    row.update(changes)
    kinds = {"duration": "double"}
    schema = ", ".join(f"{k} {kinds.get(k, 'string')}" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_row_wins_for_language_source_and_website(spark):
    row = ops.metadata_defaults(info(spark), MetadataConfig(num_of_speakers=1)).first()
    assert tuple(row.asDict()) == METADATA_COLUMNS
    assert (row.language, row.source, row.source_website, row.license, row.duration) == ("kn", "src", "w", "CC", "2.0")
    assert (row.title, row.num_of_speakers, row.type, row.speaker_name) == ("f.mp3", "1", "audio", None)


def test_config_wins_for_the_speaker(spark):
    row = ops.metadata_defaults(info(spark, name="row", gender="row"), MetadataConfig(speaker_name="A", speaker_gender="FEMALE")).first()
    assert (row.speaker_name, row.speaker_gender) == ("A", "female")
    row = ops.metadata_defaults(info(spark, name="row", gender="Row"), MetadataConfig(speaker_name="")).first()
    assert (row.speaker_name, row.speaker_gender) == ("row", "Row")


def test_missing_row_fields_fall_back(spark):
    frame = info(spark).drop("language", "source", "source_website", "license")
    row = ops.metadata_defaults(frame, MetadataConfig(source_website="site")).first()
    assert (row.language, row.source, row.source_website, row.license) == ("Bodo", "DEMO", "site", "")


def curated(spark):
    return spark.createDataFrame(
        [("v1", "First Name", "Male", None, 2), ("v1", "EARLIER", "Female", "lic", 1), ("v2", None, "Male", "l2", 3)],
        "video_id string, speaker_name string, speaker_gender string, license string, pos int",
    )


def test_enrich_from_curated(spark):
    files = spark.createDataFrame([("v1",), ("v2",), ("v3",)], "video_id string")
    rows = {r.video_id: r[1:] for r in ops.enrich_from_curated(files, curated(spark)).collect()}
    assert rows == {"v1": ("earlier", "female", "lic"), "v2": (None, "male", "l2"), "v3": ("", "", "")}
    rows = ops.enrich_from_curated(files, curated(spark).drop("license")).collect()
    assert {r.curated_license for r in rows} == {""}


def test_channel_metadata_by_mode(spark):
    files = spark.createDataFrame([("60file-idv1.mp4", "Chan", "UC1"), ("90file-idv3.mp4", "Chan", "UC1")],
                                  "raw_file_name string, channel_name string, channel_id string")
    codes = spark.createDataFrame([("v3", "creativeCommon")], "video_id string, license string")
    by_file = channel_metadata(files, codes, ChannelPipelineConfig(mode="file"), MetadataConfig(), curated(spark))
    rows = {r.raw_file_name: r for r in by_file.collect()}
    assert (rows["60file-idv1.mp4"].license, rows["60file-idv1.mp4"].speaker_name, rows["60file-idv1.mp4"].duration) == ("lic", "earlier", "1.0")
    assert (rows["90file-idv3.mp4"].license, rows["90file-idv3.mp4"].duration) == ("Creative Commons", "1.5")
    assert rows["90file-idv3.mp4"].source_website == "" and rows["90file-idv3.mp4"].source == "Chan"
    looked_up = channel_metadata(files, codes, ChannelPipelineConfig(only_creative_commons=False), MetadataConfig())
    rows = {r.raw_file_name: r for r in looked_up.collect()}
    assert rows["60file-idv1.mp4"].license == "Standard Youtube"
    assert rows["60file-idv1.mp4"].source_website == "https://www.youtube.com/channel/UC1"
    constant = channel_metadata(files, codes, ChannelPipelineConfig(), MetadataConfig())
    assert {r.license for r in constant.collect()} == {"Creative Commons"}


def test_playlist_files(spark):
    files = spark.createDataFrame([("p", "v1", 61.9, "creativeCommon")], "playlist string, video_id string, seconds double, license_code string")
    row = playlist_files(files, "Tamil").first()
    assert (row.raw_file_name, row.title, row.language, row.license) == ("61file-idv1.mp4", "61file-idv1.mp4", "tamil", "Creative Commons")
    assert (row.duration, row.source, row.source_website) == (str(61 / 60), "p", "https://www.youtube.com")


def test_variant_has_no_length_for_other_formats(spark):
    rows = spark.createDataFrame([("a.mp3", 60.0, None, None, "u", "s")],
                                 "raw_file_name string, seconds double, name string, gender string, source_url string, source string")
    row = ops.playlist_metadata(rows).first()
    assert row.duration == "0" and "license" not in row.asDict() and row.language == "Tamil"


def test_durations(column):
    seconds = media.duration_seconds(F.lit("a.mp4"), "x")
    assert column(media.duration_minutes(seconds), [120.9, 0.0], "double") == [2.0, 0.0]
    other = media.duration_seconds(F.lit("a.wav"), "x")
    assert column(media.duration_minutes(other), [2.0, 60.03], "double") == [round(2 / 60, 3), round(60.03 / 60, 3)]


def test_parse_media_name(column):
    video_id, minutes = media.media_name_parts("x")
    assert column(video_id, ["60file-idsfgsft.mp4"]) == ["sfgsft"]
    assert column(minutes, ["60file-idsfgsft.mp4"]) == [1.0]


def test_a_blank_curated_licence_is_looked_up(spark):
    files = spark.createDataFrame([("a", None), ("b", ""), ("c", "own")], "video_id string, curated_license string")
    codes = spark.createDataFrame([("a", "creativeCommon"), ("c", "creativeCommon")], "video_id string, license string")
    rows = ops.resolve_video_license(files, codes, mode="file").collect()
    assert {r.video_id: r.license for r in rows} == {"a": "Creative Commons", "b": "Standard Youtube", "c": "own"}
