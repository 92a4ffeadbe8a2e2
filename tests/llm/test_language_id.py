"""Against profiles and distances in plain Python, and by held-out accuracy."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanwell.llm import language_id
from gleanwell.llm.frames import remainder
from gleanwell.llm.language_id import PROFILE, TEXT_PROFILE, UNKNOWN, identify

FOLDER = "/root/testdata/sf0.01"


def ranked(text, most):
    counts = Counter()
    words = "".join(c.lower() if c.isalpha() else " " for c in text or "").split()
    for w in words:
        padded = f" {w} "
        for n in (1, 2, 3):
            counts.update(g for k in range(len(padded) - n + 1) if (g := padded[k : k + n]) != " ")
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:most]


def test_profiles_and_distances(texts):
    values = {
        "en": ["the cat and the dog", "The weather is fine, and the sun shines!"],
        "de": ["die Katze und der Hund", "Über den Wolken ist das Wetter schön"],
        "ru": ["кот и собака", "погода хорошая"],
    }
    rows = [(lang, t) for lang, ts in values.items() for t in ts]
    frame = texts([t for _, t in rows] + ["der cat", "собака", "123 !!", None, ""], langs=[lang for lang, _ in rows] + [None] * 5)
    profiles = {lang: ranked(" \n ".join(ts), PROFILE) for lang, ts in values.items()}
    for r in identify(frame, F.lit(False)).collect():
        text = (frame.where(F.col("doc_id") == r.doc_id).first()).text
        mine = ranked(text, TEXT_PROFILE)
        if not mine:
            assert (r.lang_pred, r.score) == (UNKNOWN, 0.0)
            continue
        away = {x: sum(abs(p.index(g) - k) if g in p else PROFILE for k, g in enumerate(mine)) for x, p in profiles.items()}
        best, other = sorted(sorted(away), key=away.get)[:2]
        assert r.lang_pred == best and r.score == pytest.approx(away[other] / max(1, away[best] + away[other]))


@pytest.mark.parametrize("group, per_pass", [(1, 4), (2, 1)])
def test_groups_of_languages_give_the_same(texts, monkeypatch, group, per_pass):
    values = ["the cat and the dog", "die Katze und der Hund", "le chat et le chien", "кот и собака", "el gato y el perro"] * 2
    frame = texts([*values, "der chat", "123", None], langs=["en", "de", "fr", "ru", "es"] * 2 + [None] * 3)
    want = sorted(map(tuple, identify(frame, F.lit(False)).collect()))
    monkeypatch.setattr(language_id, "GROUP", group)
    monkeypatch.setattr(language_id, "GROUPS_PER_PASS", per_pass)
    assert sorted(map(tuple, identify(frame, F.lit(False)).collect())) == want


def test_more_languages_than_one_group(texts):
    names = [f"l{k:04d}" for k in range(2600)]
    values = [f"{chr(0x4E00 + k)}{chr(0x4E00 + k + 1)} {chr(0x4E00 + k)}" for k in range(2600)]
    rows = identify(texts(values, langs=names), F.lit(False)).collect()
    assert all(r.lang_pred == names[r.doc_id] for r in rows) and len(rows) == 2600


def test_bytes_that_are_not_utf_8(spark):
    odd = [b"abc\x80\x80", b"\xed\xa0\x80 the cat", b"the dog \xe3\x81", b"\x82\x80", b"\xff\xfe", b"the cat and dog"]
    rows = spark.createDataFrame([(k, bytearray(b), "en") for k, b in enumerate(odd)], "doc_id bigint, raw binary, lang string")
    frame = rows.select("doc_id", F.col("raw").cast("string").alias("text"), "lang")
    got = {r.doc_id: r.lang_pred for r in identify(frame, F.lit(False)).collect()}
    assert got == {0: "en", 1: "en", 2: "en", 3: UNKNOWN, 4: UNKNOWN, 5: "en"}


def test_odd_and_empty(odd, empty):
    rows = identify(odd, F.lit(False)).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows} == {"en", UNKNOWN}
    assert {r.lang_pred for r in identify(odd, F.lit(True)).collect()} == {UNKNOWN}
    assert identify(empty, F.lit(False)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="captured tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = identify(docs, remainder("doc_id", 4) == 2).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count()
