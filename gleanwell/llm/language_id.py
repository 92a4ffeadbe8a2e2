"""Language identification by rank-order profiles.

A language's profile lists its most frequent character n-grams by rank. A text's own list, ranked in the same way, is
held against each: every n-gram counts the distance of its two ranks, or the longest possible distance where the
profile lacks it, and the language with the least sum wins.

N-grams are the one to three letters long parts of words padded with a blank on both sides; other characters part
words. Letters are lower-cased. An n-gram is a number: its code points side by side, 21 bits each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from gleanwell.llm.bytesets import steps, text_bytes
from gleanwell.storage import write_scratch

#: Length of a profile.
PROFILE = 400
#: Ranks in a text's list; a shorter list is taken whole.
TEXT_PROFILE = 300
UNKNOWN = "und"

#: Languages whose profiles are sent to every task at once; more are compared group after group.
GROUP = 2000
#: Groups that one pass over the texts goes through; between passes the texts and their nearest so far are written.
GROUPS_PER_PASS = 4

_BLANK = 32
_COMMON = 0x3000


def _letter(point: int) -> int:
    """The lower-cased letter, or 0 for what is none."""
    c = chr(point)
    low = c.lower()
    return 0 if not c.isalpha() else ord(low) if len(low) == 1 else point


_TABLE = np.array([_letter(p) for p in range(_COMMON)], np.int64)


def letters_of(points: np.ndarray) -> np.ndarray:
    out = _TABLE[np.minimum(points, _COMMON - 1)]
    rare = points >= _COMMON
    if rare.any():
        kinds, number = np.unique(points[rare], return_inverse=True)
        out[rare] = np.array([_letter(p) for p in kinds.tolist()], np.int64)[number.reshape(-1)]
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text, and the bounds of the texts. One of n letters belongs to the text of its letters."""
    whole, texts = data.tobytes(), len(offsets) - 1
    points = np.frombuffer(whole.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    if len(points) != starts[-1]:
        # Bytes that are not UTF-8 are replaced by as many points as the decoder likes.
        each = [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        points = np.frombuffer("".join(each).encode("utf-32-le"), np.uint32)
        starts = np.concatenate(([0], np.cumsum([len(x) for x in each])))
    # A gap before each text and behind the last one ends the words there.
    owner = np.append(np.repeat(np.arange(texts), np.diff(starts) + 1), texts)
    letters = np.zeros(len(points) + texts + 1, np.int64)
    letters[np.arange(len(points)) + np.repeat(np.arange(texts), np.diff(starts)) + 1] = letters_of(points)
    word = letters > 0
    padded = np.where(word, letters, _BLANK)
    one = np.flatnonzero(word)
    two = np.flatnonzero(word[:-1] | word[1:])
    three = np.flatnonzero(word[1:-1])
    codes = np.concatenate(
        (
            padded[one],
            padded[two] << 21 | padded[two + 1],
            padded[three] << 42 | padded[three + 1] << 21 | padded[three + 2],
        )
    )
    owners = np.concatenate((owner[one], owner[np.where(word[two], two, two + 1)], owner[three + 1]))
    order = np.argsort(owners, kind="stable")
    return codes[order], np.searchsorted(owners[order], np.arange(texts + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each n-gram stands in the texts of each language, summed within a batch."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        langs = np.array(batch.column(batch.schema.get_field_index("lang")).to_pylist(), object)
        for a, b in steps(offsets):
            codes, bounds = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            names, number = np.unique(langs[a:b].astype(str), return_inverse=True)
            of = np.repeat(number.reshape(-1), np.diff(bounds))
            for k, name in enumerate(names):
                kinds, counts = np.unique(codes[of == k], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": [name] * len(kinds), "gram": kinds, "n": counts})


def learn_profiles(texts: DataFrame) -> DataFrame:
    """Each language's most frequent n-grams by falling frequency, from ``texts`` (text, lang), rows without lang left out:
    a written table of lang, gram and rank (from 0).

    Of equally frequent ones the smaller number comes first.
    """
    known = texts.where("lang IS NOT NULL AND text IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    counts = known.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank - 1).where(F.col("rank") < PROFILE)
    return write_scratch(top.select("lang", "gram", "rank"), "language-profiles")


@dataclass(frozen=True)
class Profiles:
    """Profiles of some languages by n-gram: which of ``names`` hold it (between two ``bounds``), and at which rank."""

    names: list[str]
    kinds: np.ndarray
    bounds: np.ndarray
    holders: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, names: list[str], langs: np.ndarray, grams: np.ndarray, ranks: np.ndarray) -> Profiles:
        """``langs`` are places in the sorted ``names``."""
        order = np.lexsort((langs, grams))
        kinds, first = np.unique(grams[order], return_index=True)
        return cls(names, kinds, np.append(first, len(grams)), langs[order].astype(np.int32), ranks[order].astype(np.int32))


def _groups(profiles: DataFrame) -> Iterator[Profiles]:
    """The profiles in groups of ``GROUP`` languages, in their order. One group at a time is on the driver."""
    names: list[str] = []
    langs = profiles.select("lang").distinct().orderBy("lang").toLocalIterator()
    for row in chain(langs, [None]):
        if names and (row is None or len(names) == GROUP):
            own = profiles.where(F.col("lang").between(names[0], names[-1])).toPandas()
            place = {x: k for k, x in enumerate(names)}
            yield Profiles.of(names, own["lang"].map(place).to_numpy(np.int64), own["gram"].to_numpy(), own["rank"].to_numpy())
            names = []
        if row is not None:
            names.append(row.lang)


def text_profile(codes: np.ndarray) -> np.ndarray:
    """The most frequent n-grams of one text, by falling frequency and then by number."""
    kinds, counts = np.unique(codes, return_counts=True)
    return kinds[np.argsort(-counts, kind="stable")[:TEXT_PROFILE]]


def distances(mine: np.ndarray, profiles: Profiles) -> np.ndarray:
    """Out-of-place distance of a text's list to every profile."""
    at = np.searchsorted(profiles.kinds, mine)
    known = at < len(profiles.kinds)
    known[known] = profiles.kinds[at[known]] == mine[known]
    place, at = np.flatnonzero(known), at[known]
    many = profiles.bounds[at + 1] - profiles.bounds[at]
    entry = np.repeat(profiles.bounds[at] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    nearer = PROFILE - np.abs(profiles.ranks[entry] - np.repeat(place, many))
    found = np.bincount(profiles.holders[entry], weights=nearer, minlength=len(profiles.names))
    return PROFILE * len(mine) - found.astype(np.int64)


_NONE = np.iinfo(np.int64).max


def _nearest(batches: Iterator[pa.RecordBatch], schema: pa.Schema, shared) -> Iterator[pa.RecordBatch]:
    """The nearest language and the two least distances of each text, among these profiles and what came before."""
    profiles = shared.value
    for batch in batches:
        column = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
        data, offsets = text_bytes(column["text"])
        best = column["best"].to_pylist()
        first, second = (np.array(column[c]) for c in ("first", "second"))
        for a, b in steps(offsets):
            codes, bounds = grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for k in np.flatnonzero(np.diff(bounds)):
                away = distances(text_profile(codes[bounds[k] : bounds[k + 1]]), profiles)
                own = int(away.argmin())
                least = away[own]
                away[own] = _NONE
                other = away.min()
                k += a
                # Groups come in the order of their names, so an equal distance is no nearer.
                if least < first[k]:
                    best[k], second[k], first[k] = profiles.names[own], min(first[k], other), least
                else:
                    second[k] = min(second[k], least)
        state = {"best": pa.array(best, pa.string()), "first": pa.array(first), "second": pa.array(second)}
        yield pa.RecordBatch.from_arrays([state.get(x, column.get(x)) for x in schema.names], schema=schema)


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """The language of every text of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Profiles come from the rows with a lang where ``held_out`` is not true; there may be any number of languages. A text
    without a letter, NULL or empty, is ``und`` with score 0, and so is every text if nothing can be learnt. Bytes that are
    not UTF-8 are no letters. ``score`` is the runner-up's share of the sum
    of the two least distances: 0.5 for a tie, which the alphabetically first language wins, up to 1. Repeated rows
    count as often as they stand; other columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    marked = docs.withColumn("_held", F.coalesce(held_out, F.lit(False)))
    profiles = learn_profiles(marked.where("NOT _held").select("text", "lang"))
    none = F.lit(int(_NONE)).cast("bigint")
    found = marked.select(
        "doc_id", F.col("_held").alias("held_out"), "text", F.lit(None).cast("string").alias("best"), none.alias("first"), none.alias("second")
    )
    groups, number = _groups(profiles), 0
    group = next(groups, None)
    while group is not None:
        following = next(groups, None)
        if number and number % GROUPS_PER_PASS == 0:
            found = write_scratch(found, "language-nearest")
        # The texts are handed on only where another group will want them.
        result = found.schema if following is not None else found.drop("text").schema
        shared, shape = spark.sparkContext.broadcast(group), to_arrow_schema(result)
        found = found.mapInArrow(lambda it, shared=shared, shape=shape: _nearest(it, shape, shared), result)
        group, number = following, number + 1
    # With one language alone there is no runner-up.
    other = F.when(F.col("second") == none, F.lit(1)).otherwise(F.col("second")).cast("double")
    score = F.when(F.col("best").isNull(), 0.0).otherwise(other / F.greatest(F.lit(1.0), F.col("first") + other))
    return found.select("doc_id", "held_out", F.coalesce("best", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))
