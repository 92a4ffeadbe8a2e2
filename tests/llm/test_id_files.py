"""Exact round trips, and every text against the tokenizer on the whole text."""

import random
import zlib

import numpy as np
import pytest

from gleanwell.llm import id_files
from gleanwell.llm.id_files import BLOCK, id_index, pack_ids, read_ids, segment, segments, unpack_ids, write_ids

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def want(model, text):
    return model.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("n", [0, 1, 59, BLOCK - 1, BLOCK, BLOCK + 1, 5 * BLOCK + 17])
@pytest.mark.parametrize("most", [1, 2, 300, 50_000, 2**33, 2**60, 2**64 - 1])
def test_words_give_the_ids_back(n, most):
    rnd = np.random.default_rng(n + most % 97)
    ids = (rnd.random(n) ** 4 * most).astype(np.uint64)
    if n > 100:
        ids[40:90] = 7  # a run, and ids of more than 60 bits inside and at the end of one
        ids[3], ids[90] = 2**64 - 1, 2**60
    places, words, literals = pack_ids(ids)
    assert np.array_equal(unpack_ids(n, places, words, literals), ids)
    for block in range(-(-n // BLOCK)):
        alone = unpack_ids(n, places, words, literals, block, block + 1)
        assert np.array_equal(alone, ids[block * BLOCK : (block + 1) * BLOCK])


def test_small_ids_share_words():
    ids = np.arange(60 * 1024, dtype=np.uint64) % 2
    assert len(pack_ids(ids)[1]) < 1100
    assert len(pack_ids(np.full(60 * 1024, 9, np.uint64))[1]) == 60  # one run a block


def test_segments_of_a_file():
    first = segment(np.array([5, 0]), np.array([True, False]), np.array([2, 3]), np.arange(5, dtype=np.uint64))
    second = segment(np.array([6]), np.array([True]), np.array([1]), np.array([1], np.uint64))
    end = id_files.END.encode()
    got = [[list(x) for x in s] for s in segments(first + end + second + end)]
    assert got == [[[5, 0], [True, False], [2, 3], [0, 1, 2, 3, 4]], [[6], [True], [1], [1]]]
    with pytest.raises(ValueError):
        list(segments(first + end + second[8:] + end))
    assert list(segments(b"")) == []


def index(spark, docs, folder, **given):
    write_ids(docs, folder, TOKENIZER, **given)
    rows = id_index(spark, folder).collect()
    return sorted((r.start, -1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows)


def expected(model, rows):
    """``rows``: (doc_id, text) in order."""
    out, start = [], 0
    for doc, text in rows:
        ids = want(model, text)
        out.append((start, doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_whole_texts(spark, texts, prose, model, tmp_path, monkeypatch):
    rnd = random.Random(5)
    values = [prose(rnd, rnd.randrange(400)) + rnd.choice(["", " don't 12", "\n\t", "Éa 日本", " x'S"]) for _ in range(120)]
    ids = rnd.sample(range(10_000), len(values))
    got = index(spark, texts(values, ids).repartition(5), str(tmp_path / "ids"))
    assert got == expected(model, sorted(zip(ids, values)))
    whole = {r.doc_id: r.ids for r in read_ids(spark, str(tmp_path / "ids")).collect()}
    assert whole == {i: want(model, t) for i, t in zip(ids, values)}


def test_odd_rows_and_no_rows(spark, odd, empty, model, tmp_path):
    got = index(spark, odd, str(tmp_path / "odd"))
    rows = [(-1 if r.doc_id is None else r.doc_id, r.text) for r in odd.collect()]
    assert got == expected(model, sorted(rows, key=lambda r: r[0]))
    assert index(spark, empty, str(tmp_path / "none")) == []


def test_long_texts_are_read_in_steps_and_files_split(spark, texts, prose, model, tmp_path):
    rnd = random.Random(6)
    # Longer than a step, with and without white space to cut at, and more ids than a segment holds.
    values = [prose(rnd, 60), " ".join([prose(rnd, 5000)] * 130), "", "ab" * 3_200_000 + " end", prose(rnd, 300)]
    docs = texts(values).coalesce(1)
    assert max(map(len, values)) > id_files.STEP_BYTES
    got = index(spark, docs, str(tmp_path / "long"), segments_per_file=1)
    assert got == expected(model, list(enumerate(values)))


def test_words_are_forgotten_and_learnt_again(model, monkeypatch):
    monkeypatch.setattr(id_files, "REMEMBERED", 3)
    with open(TOKENIZER, encoding="utf-8") as file:
        words = id_files.WordIds(file.read())
    for text in (b"one two three four", b"four five one", b"six", b""):
        data = np.frombuffer(text, np.uint8)
        starts, ends, _ = id_files.word_spans(data, np.array([0, len(data)]))
        assert list(words.of(data, starts, ends)[1]) == model.encode(text.decode(), add_special_tokens=False).ids
