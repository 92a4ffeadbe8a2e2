"""Near-duplicate texts by SetSketch registers.

A text's set holds its distinct shingles of five words. Its sketch holds, per register, the smallest of exponentially
distributed numbers drawn from the shingles, cut down to the integer exponent of a base slightly above one. Sketches
of parts merge by the larger register, and two sketches agree in a register about as often as the sets agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanwell.llm.bytesets import lower_ascii, mixed, prefix_sums, span_hashes, steps, text_bytes, word_spans
from gleanwell.llm.components import smallest_reachable
from gleanwell.llm.frames import without
from gleanwell.storage import write_scratch

#: Bytes of text whose shingles are hashed at once.
STEP_BYTES = 500_000
SHINGLE = 5
#: Sets of fewer shingles are as similar as 0.8 only if they are equal.
SMALLEST = 4
#: Registers of a sketch; bands of registers that must agree for two texts to be compared. At a similarity of 0.85
#: no band agrees once in four million pairs; at 0.80, once in sixteen thousand.
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: Base, and scale of the largest number that has a register value of its own.
BASE, LARGEST, TOP = 1.1, 20.0, 254

_U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and the bounds of the texts.

    A text of fewer than five words has them all as its one shingle; one without words has none.
    """
    starts, ends, words = word_spans(data, offsets)
    tokens = span_hashes(prefix_sums(data), starts, ends)
    size = np.where(words >= SHINGLE, words - SHINGLE + 1, (words > 0).astype(np.int64))
    row = np.repeat(np.arange(len(words)), size)
    first = np.cumsum(words) - words
    place = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    hashes = np.zeros(len(row), _U)
    length = np.minimum(words, SHINGLE)[row]
    for k in range(SHINGLE):
        inside = k < length
        hashes[inside] = mixed(hashes[inside] * _U(0xD1342543DE82EF95) + tokens[place[inside] + k])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[fresh], row[fresh]
    return hashes, np.searchsorted(row, np.arange(len(words) + 1))


def sketch(hashes: np.ndarray, bounds: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Register values of each set, a byte each.

    A shingle draws a rising sequence of numbers, each for a register of its own choice; it stops when its numbers
    exceed what every register of its set already holds, so a large set costs little more than one draw per shingle.
    """
    sets = len(bounds) - 1
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    least = np.full(sets * registers, np.inf)
    seed, at = hashes, np.zeros(len(hashes))
    limit = np.full(sets, np.inf)
    for k in range(1, 1 << 20):
        if not len(seed):
            break
        draw = mixed(seed + _U(k * 0x9E3779B97F4A7C15 % 2**64))
        at = at - np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / registers
        register = ((mixed(draw) >> _U(32)) * _U(registers) >> _U(32)).astype(np.int64)
        np.minimum.at(least, owner * registers + register, at)
        if k < 8 or k % 8 == 0:
            limit = least.reshape(sets, registers).max(axis=1)
        going = at < limit[owner]
        seed, at, owner = seed[going], at[going], owner[going]
    with np.errstate(divide="ignore"):
        values = np.floor(1 - np.log(least / LARGEST) / np.log(BASE))
    values[~np.isfinite(least)] = 0
    return np.clip(values, 0, TOP + 1).astype(np.uint8).reshape(sets, registers)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A hash of each band's registers."""
    grouped = sketches.reshape(len(sketches), BANDS, ROWS).astype(_U)
    keys = np.zeros((len(sketches), BANDS), _U)
    for k in range(ROWS):
        keys = keys << _U(8) | grouped[:, :, k]
    return mixed(keys + (np.arange(BANDS, dtype=_U) << _U(48))).view(np.int64)


def _log_likelihood(similarity, above, below, equal, u, v):
    """How likely registers are that differ upwards, downwards and not at all so many times."""

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    plus, minus = chance(u - v * similarity), chance(v - u * similarity)
    terms = ((above, plus), (below, minus), (equal, 1 - plus - minus))
    return sum(n * np.log(np.maximum(x, 1e-12)) for n, x in terms)


def similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of sketched sets with known sizes: the value that makes their registers likeliest."""
    above, below = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    u = size_a / (size_a + size_b)
    v = 1 - u
    grid = np.linspace(0, 1, 201)[:, None] * np.minimum(u / v, v / u)
    likely = _log_likelihood(grid, above, below, b.shape[-1] - above - below, u, v)
    return np.take_along_axis(grid, likely.argmax(axis=0)[None, :], axis=0)[0]


def likely_above(a: np.ndarray, b: np.ndarray, size_a: int, size_b: np.ndarray, least: float) -> np.ndarray:
    """Whether the likeliest similarity is ``least`` or more: whether the likelihood still rises there."""
    above, below = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    u = size_a / (size_a + size_b)
    v = 1 - u
    here, there = (
        _log_likelihood(x, above, below, b.shape[-1] - above - below, u, v) for x in (least - 5e-4, least + 5e-4)
    )
    return there >= here


#: Shingles of a block of candidates that one task holds, unless a single text has more.
BLOCK_SHINGLES = 2_000_000
#: Pairs whose likeliest similarity is this far below the threshold are not verified: over four standard deviations.
MARGIN = 0.13


def _sketches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        ids, marks = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "mark"))
        for a, b in steps(offsets, STEP_BYTES):
            hashes, bounds = shingle_sets(lower_ascii(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a])
            size = np.diff(bounds)
            keys = [np.concatenate((np.zeros(1, _U), np.cumsum(mixed(hashes + _U(k)), dtype=_U))) for k in (1, 2)]
            keys = [(k[bounds[1:]] - k[bounds[:-1]]).view(np.int64) for k in keys]
            large = np.repeat(size >= SMALLEST, size)
            made = sketch(hashes[large], np.concatenate(([0], np.cumsum(np.where(size >= SMALLEST, size, 0)))))
            columns = [ids.slice(a, b - a), marks.slice(a, b - a), pa.array(size), *map(pa.array, keys), pa.array([x.tobytes() for x in made], pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _bands(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if len(frame):
            keys = band_keys(np.frombuffer(b"".join(map(bytes, frame.sketch)), np.uint8).reshape(len(frame), -1))
            yield pd.DataFrame({"band": keys.reshape(-1), "class": np.repeat(frame["class"].to_numpy(), BANDS)})


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each candidate's set, once for every pair of blocks that its block is in."""
    for frame in frames:
        data, offsets = text_bytes(pa.array(frame.pop("text"), pa.large_string()))
        for a, b in steps(offsets, STEP_BYTES):
            hashes, bounds = shingle_sets(lower_ascii(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a])
            part = frame.iloc[a:b].copy()
            part["shingles"] = [hashes[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            block = part["class"].map(lambda x: int(mixed(np.array([x], np.int64).view(_U))[0] >> _U(40))) % part.blocks
            part["pair"] = [[f"{min(x, y)}-{max(x, y)}" for y in range(n)] for x, n in zip(block, part.blocks, strict=True)]
            part["block"] = block
            yield part.explode("pair")[["root", "pair", "block", "class", "sketch", "shingles"]]


def linked(members: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that connect those members of one or two blocks that are similar enough, directly or over others.

    Pairs that already hang together are not compared. With two blocks only pairs across them are.
    """
    members = members.drop_duplicates("class").sort_values("class", ignore_index=True)
    ids, block = members["class"].to_numpy(), members.block.to_numpy()
    across = block.min() != block.max()
    size = members.shingles.map(len).to_numpy() // 8
    first = np.cumsum(size) - size
    shingles = np.unique(np.frombuffer(b"".join(map(bytes, members.shingles)), _U), return_inverse=True)[1].reshape(-1)
    sketches = np.frombuffer(b"".join(map(bytes, members.sketch)), np.uint8).reshape(len(ids), -1)
    keys = band_keys(sketches)
    order = np.argsort(keys.reshape(-1), kind="stable")
    owner, ordered = order // BANDS, keys.reshape(-1)[order]
    begin, end = np.searchsorted(ordered, keys), np.searchsorted(ordered, keys, "right")
    root, out = np.arange(len(ids)), []
    in_x = np.zeros(int(shingles.max()) + 1 if len(shingles) else 1, bool)
    for x in range(len(ids)):
        near = np.zeros(len(ids), bool)
        for a, b in zip(begin[x], end[x], strict=True):
            near[owner[a:b]] = True
        near[: x + 1] = False
        near &= (root != root[x]) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
        if across:
            near &= block != block[x]
        near = np.flatnonzero(near)
        if len(near):
            near = near[likely_above(sketches[x], sketches[near], size[x], size[near], percent / 100 - MARGIN)]
        if not len(near):
            continue
        mine = shingles[first[x] : first[x] + size[x]]
        in_x[mine] = True
        places = np.repeat(first[near], size[near]) + np.arange(size[near].sum()) - np.repeat(np.cumsum(size[near]) - size[near], size[near])
        shared = np.add.reduceat(in_x[shingles[places]].astype(np.int64), np.cumsum(size[near]) - size[near])
        in_x[mine] = False
        found = near[100 * shared >= percent * (size[x] + size[near] - shared)]
        if len(found):
            roots, one = np.unique(root[found], return_index=True)
            out += [(ids[x], ids[found[k]]) for k in one]
            joined = np.append(roots, root[x])
            root[np.isin(root, joined)] = joined.min()
    return pd.DataFrame(out, columns=["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The class of every text of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two texts are linked when their shared shingles are at least ``percent`` (80 or more) of all their shingles;
    ``component_id`` is the smallest doc_id that links lead to, ``kept`` tells whether it is the text's own. Texts
    with equal sets are one class from the start. Classes that agree in a band of registers form candidate groups;
    the pairs of a group are estimated by likelihood and confirmed on full sets, block by block, so a group of any
    size fits the tasks; what a large group costs more is that its sets go to a task for each pair of blocks.

    NULL, empty and blank texts have no shingle, are linked with nothing and kept. doc_id is an integer; rows that
    share one are one document in the graph, which joins what their texts are linked with, and each is returned. Rows without doc_id come back with a NULL class
    and kept. Other columns are ignored; an empty table gives an empty table.
    """
    schema = T.StructType(
        [
            *[T.StructField(x, T.LongType()) for x in ("doc_id", "mark", "n", "key_a", "key_b")],
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    shape = to_arrow_schema(schema)
    # The mark tells the texts of a doc_id apart.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    made = write_scratch(texts.mapInArrow(lambda it: _sketches(it, shape), schema), "sketches")
    key = ["key_a", "key_b", "n"]
    one = F.min(F.struct("doc_id", "mark"))
    classes = made.where("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(one.alias("_one"), F.first("sketch").alias("sketch"))
    classes = classes.select(*key, F.col("_one.doc_id").alias("least"), F.col("_one.mark").alias("mark"), F.xxhash64(*key).alias("class"), "sketch")
    classes = write_scratch(classes, "classes")

    large = classes.where(f"n >= {SMALLEST}").select("class", "least", "mark", "n", "sketch")
    bands = write_scratch(large.select("class", "sketch").mapInPandas(_bands, "band bigint, class bigint"), "bands")
    shared = bands.groupBy("band").agg(F.min("class").alias("hub"), F.count("*").alias("many")).where("many > 1")
    spokes = bands.join(shared.select("band", "hub"), "band").where("hub <> class").select(F.col("hub").alias("a"), F.col("class").alias("b"))
    groups = smallest_reachable(spokes.distinct())

    members = write_scratch(groups.join(large, F.col("id") == F.col("class")).drop("id"), "candidates")
    volume = members.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    members = members.join(volume.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"))
    members = members.select(F.col("least").alias("_id"), F.col("mark").alias("_mark"), "class", "root", "blocks", "sketch")
    # Copies of a class's text come along; ``linked`` takes one.
    candidates = texts.join(members, (F.col("doc_id") == F.col("_id")) & (F.col("mark") == F.col("_mark")))
    sets = candidates.select("class", "root", "blocks", "sketch", "text").mapInPandas(
        _sets, "root bigint, pair string, block int, class bigint, sketch binary, shingles binary"
    )
    links = sets.groupBy("root", "pair").applyInPandas(lambda x: linked(x, percent), "a bigint, b bigint")

    # From classes to documents. A doc_id with several texts connects their classes.
    ids = classes.select(F.col("class").alias("_class"), "least")
    ends = links.join(ids.withColumnRenamed("least", "x"), F.col("a") == F.col("_class")).select("x", "b")
    ends = ends.join(ids, F.col("b") == F.col("_class")).select(F.col("x").alias("a"), F.col("least").alias("b"))
    lookup = classes.select(*[F.col(k).alias(f"_{k}") for k in key], "least")
    same = [F.col(k) == F.col(f"_{k}") for k in key]
    often = made.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id"))
    several = made.join(often, F.col("doc_id") == F.col("_id"), "left_semi").join(lookup, same)
    edges = ends.unionByName(several.select(F.col("least").alias("a"), F.col("doc_id").alias("b"))).where("a <> b").distinct()
    components = smallest_reachable(edges)

    classed = made.join(lookup, same, "left")
    found = classed.join(components, F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("least")), F.col("doc_id")) == F.col("id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "least", "doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document stays: one of each class of near-duplicates, with its columns.

    Every row of that document stays, repeated or not, and so do rows without id and those without a word, unless their
    document goes for another text. An empty table gives an empty table.
    """
    return without(docs, near_duplicates(docs, percent).where("NOT kept"))
