"""Exact removal of long repeated strings by a depth-limited radix sort of suffixes.

Two suffixes count as equal when their first ``LENGTH`` bytes are, so sorting stops at that depth and only the groups
matter: a group of two or more starts is a repeated string. The sort goes from the most significant digit down and
drops whatever is alone in its group:

1. A start is placed by the ``GRAM``-byte string with the least hash within its ``LENGTH`` bytes and by its distance
   to that. Starts that share the string follow one another in runs, and a run is cut into cells of neighbouring
   distances. The bytes that all starts of a cell have in common are its first digit: some 230 of them.
2. Cells whose digit stands twice or more are compared by the whole string that their suffixes cover. Equal ones are
   repeats from end to end.
3. What differs is cut into cells of ``CELL`` starts with a digit of their own, nearly as long as the depth,
4. and what differs then into single starts.

A group is only ever counted, never gathered, so it may hold any share of the corpus. One member stands for those
that are equal when the others go on to the next digit. Strings are compared by 64-bit hash within their digit, which
is a 64-bit hash too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.bloom import bloom_filter, part, split
from gleanwell.llm.bytesets import mixed, prefix_sums, span_hashes, steps, text_bytes
from gleanwell.storage import write_scratch

LENGTH = 400
GRAM = 64
#: Most distances between a start and its string, and sizes of the cells they are cut into, pass by pass.
DISTANCES = LENGTH - GRAM + 1
HALF = (DISTANCES + 1) // 2
CELL = 16
#: Bytes of text that are hashed at once.
STEP_BYTES = 256_000

#: ``at`` packs the place of the first start in its text and the cell's first and last distance.
_PLACES = "digit bigint, hash bigint, doc_id bigint, at bigint"

_U = np.uint64


def pack_place(first: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 20 | low.astype(np.int64) << 10 | high.astype(np.int64)


def unpack_place(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 20, at >> 10 & 1023, at & 1023


def least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` values the place of its least, the leftmost of equals."""
    n = len(values)
    if n < size:
        return np.zeros(0, np.int64)
    rows = -(-n // size)
    padded = np.full(rows * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(rows, size)
    place = np.arange(rows * size).reshape(rows, size)
    head = np.minimum.accumulate(blocks, axis=1)
    fresh = np.ones_like(blocks, bool)
    fresh[:, 1:] = blocks[:, 1:] < head[:, :-1]
    head_at = np.maximum.accumulate(np.where(fresh, place, -1), axis=1).reshape(-1)
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]
    fresh[:, -1] = True
    fresh[:, :-1] = blocks[:, :-1] <= tail[:, 1:]
    tail_at = np.minimum.accumulate(np.where(fresh, place, rows * size)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = np.arange(n - size + 1)
    left, right = tail_at[starts], head_at[starts + size - 1]
    return np.where(padded[left] <= padded[right], left, right)


def cells(sums: np.ndarray, zero: np.ndarray, low: np.ndarray, high: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Runs of distances cut at multiples of ``size``; ``zero`` is where distance 0 lies in the hashed bytes.

    Returns the number of the run, the first and last distance, the digit and the hash of each cell.
    """
    first = low // size
    many = high // size - first + 1
    run = np.repeat(np.arange(len(low)), many)
    cell = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(many) - many, many)
    a, b = np.maximum(cell * size, low[run]), np.minimum(cell * size + size - 1, high[run])
    core = zero[run] + cell * size
    digit = mixed(span_hashes(sums, core + size - 1, core + LENGTH) + cell.astype(_U))
    whole = span_hashes(sums, zero[run] + a, zero[run] + b + LENGTH)
    return {"run": run, "low": a, "high": b, "digit": digit.view(np.int64), "hash": whole.view(np.int64)}


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Cells of the starts of all texts, and for each cell its text and the place of its first start there."""
    sums = prefix_sums(data)
    grams = np.arange(max(0, len(data) - GRAM + 1))
    grams = span_hashes(sums, grams, grams + GRAM)
    place = least_in_windows(grams, DISTANCES)
    starts = np.arange(len(place))
    row = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + LENGTH <= offsets[row + 1] if len(starts) else np.zeros(0, bool)
    starts, place, row = starts[inside], place[inside], row[inside]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(starts)) - 1 if len(begin) else begin
    # Distance 0 is the earliest start whose bytes hold the string.
    zero = place[begin] - DISTANCES + 1
    found = cells(sums, zero, starts[begin] - zero, starts[last] - zero, HALF)
    row = row[begin][found["run"]]
    return found, row, zero[found["run"]] + found["low"] - offsets[row]


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """First and last row, and bounds in bytes, of what is hashed at once: some short texts or a part of a long one.

    Parts of a text overlap by all but one byte of a string, so that each start has its whole string in one of them.
    """
    for a, b in steps(offsets, STEP_BYTES):
        first, last = int(offsets[a]), int(offsets[b])
        if b - a > 1 or last - first <= STEP_BYTES + LENGTH:
            yield a, b, first, last
            continue
        for at in range(first, last - LENGTH + 1, STEP_BYTES):
            yield a, b, at, min(at + STEP_BYTES + LENGTH - 1, last)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for a, b, first_byte, last_byte in _parts(offsets):
            bounds = np.clip(offsets[a : b + 1], first_byte, last_byte) - first_byte
            found, row, first = runs(data[first_byte:last_byte], bounds)
            # Only the first part of a text begins where the text does.
            at = pa.array(pack_place(first + max(0, first_byte - int(offsets[a])), found["low"], found["high"]))
            columns = [pa.array(found["digit"]), pa.array(found["hash"]), ids.take(pa.array(row + a)), at]
            yield pa.RecordBatch.from_arrays(columns, names=["digit", "hash", "doc_id", "at"])


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` of the given sizes as an array of binaries, without an object for each."""
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that the places of each text cover."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        places = batch.column(batch.schema.get_field_index("places"))
        many = np.diff(np.asarray(places.offsets)).astype(np.int64)
        at = places.flatten().to_numpy()
        row = np.repeat(np.arange(len(many)), many)
        first, low, high = unpack_place(at)
        begin, size = offsets[:-1][row] + first, high - low + LENGTH
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for a, b in steps(np.concatenate(([0], np.cumsum(size))), STEP_BYTES):
            own = size[a:b]
            before = np.cumsum(own) - own
            covered = data[np.repeat(begin[a:b] - before, own) + np.arange(own.sum())]
            pieces = _binaries(covered, own).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[a:b])), pa.array(at[a:b]), pieces], names=["doc_id", "at", "bytes"])


def _cut(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Places with their bytes cut into cells of ``size``."""
    for frame in frames:
        if not len(frame):
            continue
        length = frame.bytes.map(len).to_numpy()
        for a, b in steps(np.concatenate(([0], np.cumsum(length))), STEP_BYTES):
            some, own = frame.iloc[a:b], length[a:b]
            first, low, high = unpack_place(some["at"].to_numpy())
            data = np.frombuffer(b"".join(map(bytes, some.bytes)), np.uint8)
            found = cells(prefix_sums(data), np.cumsum(own) - own - low, low, high, size)
            run = found["run"]
            at = pack_place(first[run] + found["low"] - low[run], found["low"], found["high"])
            yield pd.DataFrame({"digit": found["digit"], "hash": found["hash"], "doc_id": some.doc_id.to_numpy()[run], "at": at})


def _twice_or_more(places: DataFrame) -> DataFrame:
    counts = places.groupBy("digit").agg(F.count("*").alias("n"))
    return counts.where("n > 1").select(F.col("digit").alias("_digit"))


def _split(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stands twice or more, and what must go on to the next digit: one of each group of equals.

    Lists of digits are written before they are joined, so that the join can split a digit that stands very often.
    """
    often = write_scratch(_twice_or_more(places), "repeat-digits")
    places = write_scratch(places.join(often, F.col("digit") == F.col("_digit"), "left_semi"), "repeat-places")
    key = ["digit", "hash", "range"]
    ranged = places.withColumn("range", F.col("at").bitwiseAND(2**20 - 1))
    groups = ranged.groupBy(*key).agg(F.count("*").alias("many"), F.min(F.struct("doc_id", "at")).alias("one"))
    groups = write_scratch(groups, "repeat-groups")
    twice = groups.where("many > 1").select(*[F.col(k).alias(f"_{k}") for k in key])
    found = ranged.join(twice, [F.col(k) == F.col(f"_{k}") for k in key], "left_semi").select("doc_id", "at")
    differ = write_scratch(_twice_or_more(groups), "repeat-digits")
    going = groups.join(differ, F.col("digit") == F.col("_digit"), "left_semi").select("one.doc_id", "one.at")
    return found, going


def repeated_places(docs: DataFrame) -> DataFrame:
    """Runs of starts of strings of LENGTH bytes that start anywhere else too: doc_id and the packed place.

    ``docs`` has an integer doc_id and text.
    """
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    first_pass = write_scratch(docs.mapInArrow(_runs, _PLACES), "repeat-runs")
    found, going = _split(first_pass)

    places = going.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list("at").alias("places"))
    places = write_scratch(places, "repeat-open")
    # Texts without an open place stay where they are.
    filtered = docs.sparkSession.sparkContext.broadcast(bloom_filter(places.select(F.xxhash64("_doc").alias("seed"))))
    texts, _ = split(docs.withColumn("seed", F.xxhash64("doc_id")), filtered)
    texts = texts.join(places, F.col("doc_id") == F.col("_doc")).select("doc_id", "places", "text")
    contexts = write_scratch(texts.mapInArrow(_contexts, "doc_id bigint, at bigint, bytes binary"), "repeat-contexts")
    second_pass = write_scratch(contexts.mapInPandas(lambda it: _cut(it, CELL), _PLACES), "repeat-cells")
    found_cells, going = _split(second_pass)

    on = going.select(F.col("doc_id").alias("_doc"), F.col("at").alias("_at"))
    # The zero distance of a place tells which of a text's runs it belongs to.
    zero = F.shiftright("at", 20) - F.shiftright("at", 10).bitwiseAND(1023)
    on = on.withColumn("_zero", F.shiftright("_at", 20) - F.shiftright("_at", 10).bitwiseAND(1023))
    inner = F.shiftright("_at", 20) - F.shiftright("at", 20)
    within = contexts.withColumn("_own", zero).join(on, (F.col("doc_id") == F.col("_doc")) & (F.col("_own") == F.col("_zero")))
    within = within.where((inner >= 0) & (F.shiftright("_at", 10).bitwiseAND(1023) <= F.col("at").bitwiseAND(1023)))
    size = F.col("_at").bitwiseAND(1023) - F.shiftright("_at", 10).bitwiseAND(1023) + LENGTH
    single = within.select("doc_id", F.col("_at").alias("at"), F.substr("bytes", (inner + 1).cast("int"), size.cast("int")).alias("bytes"))
    third_pass = write_scratch(single.mapInPandas(lambda it: _cut(it, 1), _PLACES), "repeat-starts")
    found_starts, _ = _split(third_pass)
    return found.union(found_cells).union(found_starts)


_REPORT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        whole, bounds = text_bytes(batch.column(batch.schema.get_field_index("text")))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        found = batch.column(batch.schema.get_field_index("found"))
        counts = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        places, before = found.flatten(), np.concatenate(([0], np.cumsum(counts)))
        for a, b in steps(bounds, STEP_BYTES):
            data, offsets, many = whole[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], counts[a:b]
            row = np.repeat(np.arange(len(many)), many)
            own = places.slice(before[a], before[b] - before[a])
            first, low, high = unpack_place(own.to_numpy(zero_copy_only=False).astype(np.int64))
            begin = first + offsets[:-1][row]
            end = begin + high - low + LENGTH
            # Places that overlap or touch become one span; rows lie one after the other and none reaches into the next.
            order = np.argsort(begin, kind="stable")
            begin, end, row = begin[order], np.maximum.accumulate(end[order]), row[order]
            new = np.ones(len(begin), bool)
            new[1:] = (begin[1:] > end[:-1]) | (row[1:] != row[:-1])
            opens = np.flatnonzero(new)
            starts, stops, of = begin[opens], end[np.append(opens[1:], len(end)) - 1] if len(opens) else end, row[opens]
            spans = np.bincount(of, minlength=len(many))
            removed = np.zeros(len(many), np.int64)
            np.add.at(removed, of, stops - starts)
            # A span may begin where that of the row before it ends, so both edges are counted.
            marks = np.zeros(len(data) + 1, np.int8)
            np.add.at(marks, starts, 1)
            np.add.at(marks, stops, -1)
            kept = data[np.cumsum(marks[:-1], dtype=np.int8) == 0]
            sizes = np.diff(offsets)
            left = _binaries(kept, sizes - removed).cast(pa.binary())
            columns = [ids.slice(a, b - a), pa.array(sizes), pa.array(removed), pa.array(spans.astype(np.int64)), left]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every text of ``docs`` (doc_id, text) without the bytes that a repeated string of LENGTH bytes covers.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and ``kept``, the remaining bytes, which need
    not be valid UTF-8. Strings are judged on the input, within and across texts; none crosses a text's end. A NULL
    text counts as empty. doc_id is an integer that tells texts apart: rows that share one must be copies, which repeat
    each other. A row without doc_id keeps its bytes and is no place where others repeat. Other
    columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = repeated_places(docs).groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_list("at").alias("found"))
    found = write_scratch(found, "repeat-found")
    filtered = docs.sparkSession.sparkContext.broadcast(bloom_filter(found.select(F.xxhash64("_doc").alias("seed"))))
    seeded = docs.withColumn("seed", F.xxhash64("doc_id"))
    marked, _ = split(seeded, filtered)
    marked = marked.join(found, F.col("doc_id") == F.col("_doc"), "left").select("doc_id", "text", "found")
    # One Python step for the others, so that a task has one worker.
    others = seeded.withColumn("found", F.lit(None).cast("array<bigint>")).mapInArrow(lambda it: _remove(part(it, filtered, False)), _REPORT)
    return marked.mapInArrow(_remove, _REPORT).union(others)
