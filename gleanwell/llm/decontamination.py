"""Benchmark decontamination with spaced seeds.

A mask is a fixed pattern over a window of tokens; only the tokens it marks are hashed, so a window matches even if the
ignored tokens differ. Hashes of all windows of the benchmark and of the training texts are joined; each hit names a
document, an item and the distance of their places, and the two texts are then compared along that distance. The masks
depend on the size of the item and miss no overlap, however the tokens that differ lie. An
overlap counts where a stretch of ``STRETCH`` tokens (or the whole of a shorter item) agrees in ``AGREE`` percent,
whether it lies inside the text or reaches over its edge.

Before the join a Bloom filter of the benchmark's hashes, of a size with a fixed limit, keeps all but few of the
other windows on their executors. A larger benchmark only lets more of them pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.bloom import bloom_filter, passing
from gleanwell.llm.bytesets import mixed, prefix_sums, span_hashes, steps, text_bytes
from gleanwell.llm.frames import without
from gleanwell.storage import write_scratch

#: A 1 marks a token that must agree.
MASKS = ("1110100111", "1101101011", "1011110101")
#: Lighter masks that find what those miss: together, every way in which a stretch of 12 to 20 tokens may agree in
#: ``AGREE`` percent leaves the marked tokens of a mask alone.
LIGHT = ("1110111", "11100010011", "1111101")
STRETCH, AGREE = 20, 80
#: The masks of items by their tokens; longer ones have those of ``STRETCH``. Up to 4 tokens all must agree.
BY_SIZE = {
    **{n: ("1" * n,) for n in range(1, 5)},
    5: ("111", "1101"),
    **dict.fromkeys((6, 7, 8), ("1111", "110011")),
    9: ("111111", "111000111"),
    **dict.fromkeys((10, 11), ("111011", "11000111", "1001001011")),
    **dict.fromkeys(range(12, STRETCH + 1), MASKS + LIGHT),
}
#: Bytes of text whose windows are hashed at once, under all masks.
STEP_BYTES = 256_000
ALL_MASKS = tuple(dict.fromkeys(m for masks in BY_SIZE.values() for m in masks))

_U = np.uint64


def plain_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of each text, and their bounds.

    Tokens are runs of ASCII letters and digits and of other scripts' bytes. ASCII and Latin-1 letters count alike in
    both cases.
    """
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    before = np.concatenate(([0], data[:-1])) if len(data) else data
    data = np.where((before == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 32, data).astype(np.uint8)
    inside = (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | cut[:-1])) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | cut[1:])) + 1 if len(data) else starts
    return span_hashes(prefix_sums(data), starts, ends), np.searchsorted(starts, offsets)


def seeds(tokens: np.ndarray, bounds: np.ndarray, masks: Iterable[int], own: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, place and mask of every window under ``masks`` (numbers in ALL_MASKS).

    With ``own``, a text has only the windows of the masks for an item of its size.
    """
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(tokens)) - bounds[row]
    left = bounds[row + 1] - np.arange(len(tokens))
    size = np.minimum(np.diff(bounds), STRETCH)[row]
    out = []
    for k in masks:
        mask = ALL_MASKS[k]
        fits = left >= len(mask)
        if own:
            fits &= np.isin(size, [n for n, those in BY_SIZE.items() if mask in those])
        full = np.flatnonzero(fits)
        hashes = np.full(len(full), k + 1, _U)
        for d in (i for i, x in enumerate(mask) if x == "1"):
            hashes = (hashes ^ tokens[full + d]) * _U(0x9E3779B97F4A7C15)
            hashes ^= hashes >> _U(29)
        out.append((mixed(hashes), row[full], place[full], np.full(len(full), k, np.int16)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _item_seeds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        data, offsets = text_bytes(pa.array(frame.text, pa.string()))
        ids = frame.item_id.to_numpy()
        for a, b in steps(offsets, STEP_BYTES):
            tokens, bounds = plain_tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            hashes, row, place, mask = seeds(tokens, bounds, range(len(ALL_MASKS)), own=True)
            yield pd.DataFrame({"seed": hashes.view(np.int64), "item_id": ids[row + a], "item_place": place.astype(np.int32), "mask": mask})


def _candidates(batches: Iterator[pa.RecordBatch], shared, masks: list[int]) -> Iterator[pa.RecordBatch]:
    """Texts with windows that pass the filter, and these windows."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        data, offsets = text_bytes(column)
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for a, b in steps(offsets, STEP_BYTES):
            tokens, bounds = plain_tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            hashes, row, place, _ = seeds(tokens, bounds, masks)
            passed = passing(shared.value, hashes)
            if not len(passed):
                continue
            passed = passed[np.argsort(row[passed], kind="stable")]
            rows, first = np.unique(row[passed], return_index=True)
            ends = pa.array(np.append(first, len(passed)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(rows + a)),
                    column.take(pa.array(rows + a)),
                    pa.ListArray.from_arrays(ends, pa.array(hashes[passed].view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(place[passed].astype(np.int32))),
                ],
                names=["doc_id", "text", "seeds", "places"],
            )


def best_stretch(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Along one distance: the stretch of the item that agrees most, as (start in the text, tokens, equal tokens).

    ``shift`` is the place in the text minus the place in the item. Tokens of the item beyond an edge of the text agree
    with nothing; a stretch that begins before the text starts at 0.
    """
    size = min(STRETCH, len(item))
    first, last = max(0, -shift), min(len(item), len(text) - shift)
    if last <= first:
        return 0, size, 0
    same = np.zeros(len(item), np.int64)
    same[first:last] = text[first + shift : last + shift] == item[first:last]
    equal = np.concatenate(([0], np.cumsum(same)))
    sums = equal[size:] - equal[:-size]
    at = int(sums.argmax())
    return max(0, at + shift), size, int(sums[at])


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        both = [text_bytes(pa.array(frame[c], pa.large_string())) for c in ("text", "item_text")]
        found, pair = [], []
        for a, b in steps(both[0][1] + both[1][1], STEP_BYTES):
            (texts, bounds), (items, item_bounds) = (plain_tokens(x[at[a] : at[b]], at[a : b + 1] - at[a]) for x, at in both)
            for k, distances in enumerate(frame.distances.iloc[a:b]):
                text, item = texts[bounds[k] : bounds[k + 1]], items[item_bounds[k] : item_bounds[k + 1]]
                found += [best_stretch(text, item, shift) for shift in distances]
                pair += [a + k] * len(distances)
        out = frame[["doc_id", "item_id"]].iloc[pair].reset_index(drop=True)
        out["start"], out["tokens"], out["equal"] = (pd.Series(x, index=out.index, dtype="int64") for x in (zip(*found, strict=True) if found else [[], [], []]))
        yield out[(out.equal > 0) & (100 * out.equal >= AGREE * out.tokens)]


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that overlap benchmark items: doc_id, item_id, start, tokens, equal, distances.

    ``start`` is the token of the text where the best stretch begins (0 if before the text), ``equal`` how many of its
    ``tokens`` agree, and ``distances`` at how many distances the two texts overlap. ``docs`` has doc_id and text, ``benchmark`` item_id and
    text. NULL and empty texts and items overlap nothing. Rows that share an id
    count as one document or item; rows without id are left out. Empty tables give an empty table.
    """
    items = benchmark.where("item_id IS NOT NULL").select("item_id", F.col("text").alias("item_text"))
    item_seeds = items.select("item_id", F.col("item_text").alias("text")).mapInPandas(_item_seeds, "seed bigint, item_id bigint, item_place int, mask smallint")
    item_seeds = write_scratch(item_seeds.distinct(), "benchmark-seeds")
    masks = sorted(r["mask"] for r in item_seeds.select("mask").distinct().collect()) or [0]
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(item_seeds))
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.mapInArrow(lambda it: _candidates(it, shared, masks), "doc_id bigint, text string, seeds array<bigint>, places array<int>")
    found = write_scratch(found, "benchmark-candidates")

    windows = found.select("doc_id", F.explode(F.arrays_zip("seeds", "places")).alias("x")).select("doc_id", "x.seeds", "x.places")
    hits = windows.join(item_seeds, F.col("seeds") == F.col("seed"))
    hits = hits.select("doc_id", "item_id", (F.col("places") - F.col("item_place")).alias("distance"))
    hits = hits.groupBy("doc_id", "item_id").agg(F.collect_set("distance").alias("distances"))
    pairs = hits.withColumnRenamed("doc_id", "_doc").join(found.select("doc_id", "text"), F.col("_doc") == F.col("doc_id"))
    pairs = pairs.join(items.withColumnRenamed("item_id", "_item"), F.col("item_id") == F.col("_item"))
    checked = pairs.select("doc_id", "text", "item_id", "item_text", "distances").mapInPandas(
        _verify, "doc_id bigint, item_id bigint, start bigint, tokens bigint, equal bigint"
    )
    best = F.min(F.struct((-F.col("equal")).alias("e"), "start", "tokens", "equal")).alias("best")
    return checked.groupBy("doc_id", "item_id").agg(best, F.count("*").alias("distances")).select(
        "doc_id", "item_id", "best.start", "best.tokens", "best.equal", "distances"
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no item, with their columns."""
    return without(docs, overlaps(docs, benchmark))
