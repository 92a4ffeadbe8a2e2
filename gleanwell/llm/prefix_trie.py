"""The trie of conversation prefixes: how many conversations share each prefix, and what sharing it saves.

A conversation's prefixes have digests that can be added up: a turn's hash is mixed with its place, and the digest of
the first d turns is the sum of d mixed hashes, four sums of 32 bits each. So digests come from running totals, which
deal a long conversation out over many tasks, and a prefix's parent is known from the same row. Texts are hashed where
they lie and never shuffled.

The rows (conversation, depth, digest, parent's digest) are cut into shards: conversations that share their opening stand
together, and long conversations are cut into bands of depths, so a shard has a bounded number of rows whatever is
common. A shard enumerates its distinct digests and gives each a slot by a minimal perfect hash: level by level a
digest takes the slot it hashes to if it is alone there, and the others go on to the next, smaller level. Whoever looks a
digest up compares it with the one at its slot. Values are scattered into flat arrays by slot and added up through the
array of parent slots, deepest level first; what lies in deeper bands of a conversation arrives at the last row of the
band. The shards' arrays are then added up by digest, so a prefix that a third of all conversations share comes as
one row per shard.

This is done twice: ends of conversations give the members of each node; then each node's own figures, held by its
smallest member's row, give the leaves and savings of the subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.llm.bytesets import mixed
from gleanwell.llm.frames import partitions
from gleanwell.operators.ordered import running
from gleanwell.storage import write_scratch

#: Depths in a band, and rows in a shard; conversations of a hundred ids in a row are not parted.
BAND = 512
SHARD_ROWS = 1 << 16
#: Places per digest at a level of the perfect hash.
SPARE = 2
#: Bytes of ids joined ahead of their hash.
CHUNK = 1 << 16

_U = np.uint64
_LANES = ("a", "b", "c", "d")


class Slots:
    """A minimal perfect hash of distinct digests (two 64-bit halves each)."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        n = len(high)
        self.taken: list[np.ndarray] = []  # per level: which slots hold a digest
        self.before: list[np.ndarray] = []  # slots taken before each of them, over all levels
        rest, done = np.arange(n), 0
        self.high, self.low = np.zeros(n, _U), np.zeros(n, _U)
        while len(rest):
            level, size = len(self.taken), SPARE * len(rest) + 1
            slot = self._slot(high[rest], low[rest], level, size)
            alone = np.bincount(slot, minlength=size) == 1
            self.taken.append(alone)
            self.before.append(done + np.cumsum(alone) - alone)
            mine = alone[slot]
            place = self.before[-1][slot[mine]]
            self.high[place], self.low[place] = high[rest[mine]], low[rest[mine]]
            done += int(mine.sum())
            rest = rest[~mine]
            if level > 200:
                raise ValueError("digests are not distinct")

    @staticmethod
    def _slot(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(high ^ mixed(low + _U(0x9E3779B97F4A7C15 * (level + 1) % 2**64))) % _U(size)).astype(np.int64)

    def of(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for those that are not in the table."""
        out = np.full(len(high), -1, np.int64)
        rest = np.arange(len(high))
        for level, taken in enumerate(self.taken):
            slot = self._slot(high[rest], low[rest], level, len(taken))
            here = taken[slot]
            place, at = self.before[level][slot[here]], rest[here]
            same = (self.high[place] == high[at]) & (self.low[place] == low[at])
            out[at[same]] = place[same]
            rest = rest[~here]
        return out


def gather(high, low, up_high, up_low, depth, adds: list[np.ndarray], least: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Per distinct digest of a shard: a row of it, the sum of each of ``adds`` over the rows of its subtree, and the
    least of ``least`` there. All but the highest level have their parents in the shard."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    first = order[new]
    slots = Slots(high[first], low[first])
    row = np.empty(len(first), np.int64)
    row[slots.of(high[first], low[first])] = first
    own, level = slots.of(high, low), depth[row]
    parent = np.where(level > level.min(), slots.of(up_high[row], up_low[row]), -1)
    sums = [np.zeros(len(first), np.int64) for _ in adds]
    for total, values in zip(sums, adds):
        np.add.at(total, own, values)
    smallest = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(smallest, own, least)
    deepest_first = np.argsort(-level, kind="stable")
    for nodes in np.split(deepest_first, np.flatnonzero(np.diff(level[deepest_first])) + 1):
        nodes = nodes[parent[nodes] >= 0]
        for total in sums:
            np.add.at(total, parent[nodes], total[nodes])
        np.minimum.at(smallest, parent[nodes], smallest[nodes])
    return row, sums, smallest


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _digests(rows: pa.Table) -> list[np.ndarray]:
    return [_column(rows, c).view(_U) for c in ("high", "low", "up_high", "up_low")]


def _last_rows(conv: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The deepest row of each conversation of a shard."""
    order = np.lexsort((depth, conv))
    return order[np.append(conv[order][1:] != conv[order][:-1], True)]


def _members(rows: pa.Table) -> pa.Table:
    conv, depth = _column(rows, "conv"), _column(rows, "depth")
    last = _last_rows(conv, depth)
    ends = np.zeros(len(conv), np.int64)
    ends[last] = 1
    least = np.full(len(conv), np.iinfo(np.int64).max)
    least[last] = conv[last]
    row, (members,), smallest = gather(*_digests(rows), depth, [ends], least)
    kept = rows.select(["depth", "high", "low", "up_high", "up_low", "chars"]).take(pa.array(row))
    return kept.append_column("n_convs", pa.array(members)).append_column("conv", pa.array(smallest))


_MEMBERS = "depth bigint, high bigint, low bigint, up_high bigint, up_low bigint, chars bigint, n_convs bigint, conv bigint"


def _subtrees(rows: pa.Table) -> pa.Table:
    conv, depth = _column(rows, "conv"), _column(rows, "depth")
    last = _last_rows(conv, depth)
    adds = []
    for name in ("saved", "leaves"):
        values = _column(rows, name).copy()
        values[last] += _column(rows, f"{name}_below")[last]
        adds.append(values)
    row, sums, _ = gather(*_digests(rows), depth, adds, conv)
    kept = rows.select(["depth", "high", "low"]).take(pa.array(row))
    return kept.append_column("saved_tokens", pa.array(sums[0])).append_column("n_leaves", pa.array(sums[1]))


_SUBTREES = "depth bigint, high bigint, low bigint, saved_tokens bigint, n_leaves bigint"


def openings(turns: DataFrame) -> DataFrame:
    """The rebuilt conversations as rows (conv, depth, h1, h2, chars), and one row of depth 0 for each conversation.

    A conversation c takes the first h turns of conversation c - c % 100 in place of its own first h,
    h = crc32(c as text) % 6. Remainders have the sign of c, as in SQL.
    """
    clean = {c: F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")}
    hashed = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        clean["role"].alias("role"),
        F.xxhash64(F.lit(1), clean["role"], clean["text"]).alias("h1"),
        F.xxhash64(F.lit(2), clean["role"], clean["text"]).alias("h2"),
        F.char_length(clean["text"]).cast("bigint").alias("chars"),
    )
    placed = write_scratch(running(hashed, ["conv"], ["turn", "role", "h1"], {"pos": F.lit(1).cast("bigint")}).drop("turn", "role"), "trie_turns")
    turn = F.struct("pos", "h1", "h2", "chars")
    first = placed.where((F.col("conv") % 100 == 0) & (F.col("pos") < 5))
    heads = write_scratch(first.groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("head")), "trie_heads")

    taken = F.crc32(F.col("conv").cast("string")) % 6
    known = placed.withColumn("_base", F.col("conv") - F.col("conv") % 100).join(heads, F.col("_base") == F.col("base"), "left")
    known = known.withColumn("_taken", taken).withColumn("_head", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("_taken").cast("int")))
    own = known.where(F.col("pos") >= F.col("_taken")).select(
        "conv", (F.size("_head") + F.col("pos") - F.col("_taken") + 1).alias("depth"), "h1", "h2", "chars"
    )
    each = known.where(F.col("pos") == 0)
    opened = each.select("conv", F.posexplode("_head").alias("k", "t")).select("conv", (F.col("k") + 1).cast("bigint").alias("depth"), "t.h1", "t.h2", "t.chars")
    zero = F.lit(0).cast("bigint")
    roots = each.select("conv", zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), zero.alias("chars"))
    return own.unionByName(opened).unionByName(roots)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, chars, high, low, up_high, up_low) of rows (conv, depth, h1, h2, chars): digests of each prefix and of the
    one before it. The empty prefix has the digest 0, 0."""
    part = (1 << 32) - 1
    for name, order in (("x", ("h1", "h2")), ("y", ("h2", "h1"))):
        rows = rows.withColumn(name, F.when(F.col("depth") > 0, F.xxhash64("depth", *order)).otherwise(F.lit(0).cast("bigint")))
    halves = {"a": F.shiftrightunsigned("x", 32), "b": F.col("x").bitwiseAND(part), "c": F.shiftrightunsigned("y", 32), "d": F.col("y").bitwiseAND(part)}
    totals = running(rows, ["conv"], ["depth"], halves)

    def joined(upper: Column, lower: Column) -> Column:
        return F.shiftleft(upper.bitwiseAND(part), 32).bitwiseOR(lower.bitwiseAND(part))

    now = {n: F.col(n) + halves[n] for n in _LANES}
    return totals.select(
        "conv",
        "depth",
        "chars",
        joined(now["a"], now["b"]).alias("high"),
        joined(now["c"], now["d"]).alias("low"),
        joined(F.col("a"), F.col("b")).alias("up_high"),
        joined(F.col("c"), F.col("d")).alias("up_low"),
    )


def _ends_hashes(paths: DataFrame) -> DataFrame:
    """Per prefix at which conversations end: SHA-256 of their ids, ascending and joined by commas.

    The ids are joined in ranges of (prefix, id), so a prefix at which very many end is joined in many tasks; its few
    long pieces are hashed one after the other, as the hash demands.
    """
    last = paths.groupBy("conv").agg(F.max_by(F.struct("high", "low"), "depth").alias("_end")).select("_end.high", "_end.low", "conv")
    ranged = last.repartitionByRange("high", "low", "conv").sortWithinPartitions("high", "low", "conv")
    pieces = ranged.mapInArrow(_joined_ids, "high bigint, low bigint, conv bigint, ids string")
    streams = pieces.repartition("high", "low").sortWithinPartitions("high", "low", "conv")
    return streams.mapInArrow(_hashed_ids, "high bigint, low bigint, ends_sha256 string")


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, first, ids, size = None, 0, [], 0
    names = ["high", "low", "conv", "ids"]
    for batch in batches:
        out: list[tuple] = []
        for high, low, conv in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (high, low) != key or size > CHUNK:
                if ids:
                    out.append((*key, first, ",".join(ids)))
                key, first, ids, size = (high, low), conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, first, ",".join(ids))], names)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    names = ["high", "low", "ends_sha256"]
    for batch in batches:
        out: list[tuple] = []
        for high, low, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
            if (high, low) == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (high, low), hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names)


def _sharded(paths: DataFrame, shards: int) -> DataFrame:
    """Conversations with neighbouring ids, whose openings may be the same, come into one shard."""
    return paths.withColumn("shard", F.pmod(F.xxhash64(F.floor(F.col("conv") / 100)), F.lit(shards)))


def prefix_trie(turns: DataFrame, rows_per_shard: int = SHARD_ROWS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (see ``openings``) of ``turns`` (conv_id, turn, role, text).

    conv_id (smallest member), depth, parent_conv_id (NULL at the root), n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256. Turns are ordered by turn, NULL first; equal turns of a conversation by role, then by a hash of role
    and text, and each counts. NULL roles and texts are empty. Rows without conv_id belong to no conversation. Other
    columns are ignored. An empty table has no node.
    """
    spark = turns.sparkSession
    key = ["depth", "high", "low"]
    paths = prefixes(openings(turns)).withColumn("band", F.floor(F.col("depth") / BAND))
    paths = write_scratch(paths, "trie_paths")
    rows, deepest = paths.agg(F.count(F.lit(1)), F.max("band")).first()
    shards = max(2 * partitions(spark), -(-rows // rows_per_shard))
    members = _sharded(paths, shards).groupBy("band", "shard").applyInArrow(_members, _MEMBERS)
    nodes = members.groupBy(*key).agg(
        F.sum("n_convs").alias("n_convs"),
        F.min("conv").alias("conv"),
        *[F.max(c).alias(c) for c in ("up_high", "up_low", "chars")],
    )
    nodes = write_scratch(nodes, "trie_nodes")

    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_high").alias("high"), F.col("up_low").alias("low"))
    nodes = nodes.join(below.agg(F.count(F.lit(1)).alias("n_children")), key, "left").fillna(0, ["n_children"])
    nodes = write_scratch(nodes, "trie_nodes")

    # A node's own figures lie at the row of its smallest member.
    own = nodes.select(
        "conv", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), (F.col("n_children") == 0).cast("bigint").alias("leaves")
    )
    valued = paths.join(own, ["conv", "depth"], "left").fillna(0, ["saved", "leaves"])
    names = ("saved", "leaves")
    if deepest:
        totals = valued.groupBy("conv", "band").agg(*[F.sum(n).alias(n) for n in names]).withColumn("_up", -F.col("band"))
        deeper = running(totals, ["conv"], ["_up"], {f"{n}_below": F.col(n) for n in names}).drop("_up", *names)
        valued = valued.join(deeper, ["conv", "band"])
    else:
        valued = valued.select("*", *[F.lit(0).cast("bigint").alias(f"{n}_below") for n in names])
    parts = _sharded(valued, shards).groupBy("band", "shard").applyInArrow(_subtrees, _SUBTREES)
    sums = parts.groupBy(*key).agg(F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("high").alias("up_high"), F.col("low").alias("up_low"), F.col("conv").alias("parent_conv_id"))
    found = nodes.join(parents, ["depth", "up_high", "up_low"], "left").join(sums, key).join(_ends_hashes(paths), ["high", "low"], "left")
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
