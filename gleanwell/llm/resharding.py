"""Resharding by minimum-cost flow: new shards of given capacities with the fewest bytes moved.

Documents lie in old shards, at first by a hash of their text. Each old shard is cut into blocks by further bits of the hash,
so that equal texts share a block; only copies that would fill a large part of a shard are split by document.
The flow decides how many bytes go from each old shard to each new one: bytes that stay in the shard of the same
number cost nothing, every other byte costs one. Blocks are then dealt out to meet the flow, and the
texts are written to the files of their new shards. Only sizes of shards, blocks and files reach the driver, and
their number depends on the shards alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.storage import finish_replacements, replace_partitions, scratch_path, write_scratch

#: Blocks of an old shard, a power of two, and the bytes of other columns in a row.
BLOCKS = 512
ROW_BYTES = 8
#: Copies of one text stay together up to this share of a new shard; beyond it they are split by document.
GROUP_SHARE, PIECES = 1 / 8, 64
#: Files of a shard.
PARTS = 8


def shard_sizes(old: list[int], shards: int) -> list[int]:
    """Near equal capacities for ``shards`` shards that hold what the old ones held."""
    total = sum(old)
    return [total // shards + (k < total % shards) for k in range(shards)]


def cheapest_moves(old: list[int], capacity: list[int], costs: list[list[int]] | None = None) -> list[list[int]]:
    """Bytes to send from each old shard to each new one at the least total cost.

    ``costs`` are per byte; by default a byte that changes its shard number costs 1. Minimum-cost flow by successive
    shortest paths: source, old shards, new shards, sink; a path may take back bytes sent before.
    """
    if sum(capacity) < sum(old):
        raise ValueError("the new shards are too small")
    m, n = len(old), len(capacity)
    costs = costs or [[int(i != j) for j in range(n)] for i in range(m)]
    flow = [[0] * n for _ in range(m)]
    supply, room = list(old), list(capacity)
    far = float("inf")
    while any(supply):
        reach = [0 if s else far for s in supply] + [far] * n
        back: list[int | None] = [None] * (m + n)
        changed = True
        while changed:
            changed = False
            for i in range(m):
                for j in range(n):
                    if reach[i] + costs[i][j] < reach[m + j]:
                        reach[m + j], back[m + j], changed = reach[i] + costs[i][j], i, True
                    if flow[i][j] and reach[m + j] - costs[i][j] < reach[i]:
                        reach[i], back[i], changed = reach[m + j] - costs[i][j], m + j, True
        end = min((k for k in range(m, m + n) if room[k - m]), key=lambda k: (reach[k], k))
        path, at = [], end
        while back[at] is not None:
            path.append((back[at], at))
            at = back[at]
        sent = min([supply[at], room[end - m], *(flow[b][a - m] for a, b in path if a >= m)])
        for a, b in path:
            if a < m:
                flow[a][b - m] += sent
            else:
                flow[b][a - m] -= sent
        supply[at] -= sent
        room[end - m] -= sent
    return flow


def deal_blocks(blocks: dict[int, dict[int, int]], flow: list[list[int]]) -> dict[int, dict[int, int]]:
    """The new shard of each block of each old shard, so that the bytes sent are as near to ``flow`` as whole blocks are.

    Largest blocks first, each to where most bytes are still due; on a tie it stays or goes to the lower number.
    """
    due = [list(row) for row in flow]
    out: dict[int, dict[int, int]] = {}
    for old, sizes in sorted(blocks.items()):
        mine = due[old]
        out[old] = {}
        for block, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
            to = max(range(len(mine)), key=lambda j: (mine[j], j == old, -j))
            out[old][block] = to
            mine[to] -= size
    return out


@dataclass(frozen=True)
class Plan:
    """Bytes from each old shard to each new one, and where each block goes."""

    flow: list[list[int]]
    target: dict[int, dict[int, int]]

    def changed(self) -> set[int]:
        """New shards whose files differ from the old shard of the same number."""
        taken = {i for i, blocks in self.target.items() if any(j != i for j in blocks.values())}
        given = {j for i, blocks in self.target.items() for j in blocks.values() if j != i}
        return taken | given


def blocked(docs: DataFrame, old_shards: int, shards: int, layout: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A table of sizes, and ``docs`` itself, both with the old shard ``_old`` and the block ``_block`` of every row.

    The old shard is column ``layout``; without one, in a first layout, it is a hash of the text. The table of sizes has
    doc_id, size and text_crc32 and is written; ``docs`` keeps its columns and is not.
    """
    text = F.coalesce("text", F.lit(""))
    spread = F.xxhash64(text)
    old = F.col(f"`{layout}`") if layout else F.pmod(spread, F.lit(old_shards))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    rows = docs.select("doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), spread.alias("_spread"), old.cast("int").alias("_old"))
    rows = write_scratch(rows, "shard-digests")
    total = rows.agg(F.sum("size")).first()[0] or 0
    # So many groups at most as the share allows: shards / GROUP_SHARE.
    large = rows.groupBy("_spread").agg(F.sum("size").alias("_all")).where(F.col("_all") > F.lit(GROUP_SHARE * total / shards))
    large = [r["_spread"] for r in large.collect()]

    def block(spread: Column) -> Column:
        piece = F.lit(BLOCKS) + F.pmod(F.xxhash64("doc_id"), F.lit(PIECES))
        own = F.pmod(F.shiftright(spread, 32), F.lit(BLOCKS))
        return (F.when(spread.isin(large), piece).otherwise(own) if large else own).cast("int")

    cut = rows.withColumn("_block", block(F.col("_spread"))).drop("_spread")
    return cut, docs.withColumns({"_old": old.cast("int"), "_block": block(spread)})


def digests(docs: DataFrame, old_shards: int, shards: int, layout: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, the old shard and the block of every row."""
    return blocked(docs, old_shards, shards, layout)[0]


def plan_reshard(rows: DataFrame, old_shards: int, shards: int) -> tuple[Plan, DataFrame]:
    """The plan for ``rows`` (of ``digests``), and the number of rows of each block before those in its new shard."""
    sums = rows.groupBy("_old", "_block").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect()
    blocks: dict[int, dict[int, int]] = {i: {} for i in range(old_shards)}
    for r in sums:
        if r["_old"] not in blocks:
            raise ValueError(f"rows lie in shard {r['_old']}, which is none of the {old_shards} old ones")
        blocks[r["_old"]][r["_block"]] = r["size"]
    old = [sum(blocks[i].values()) for i in range(old_shards)]
    flow = cheapest_moves(old, shard_sizes(old, shards))
    plan = Plan(flow, deal_blocks(blocks, flow))
    before, starts = [0] * shards, []
    for r in sorted(sums, key=lambda r: (r["_old"], r["_block"])):
        to = plan.target[r["_old"]][r["_block"]]
        starts.append((r["_old"], r["_block"], to, before[to]))
        before[to] += r["rows"]
    return plan, rows.sparkSession.createDataFrame(starts, "_o int, _b int, shard int, _start long")


def _new_shard(plan: Plan) -> Column:
    """The new shard of ``_old`` and ``_block``, looked up in a constant that has one number per block."""
    wide = BLOCKS + PIECES
    numbers = ",".join(str(plan.target[i].get(b, -1)) for i in sorted(plan.target) for b in range(wide))
    return F.split(F.lit(numbers), ",").cast("array<int>")[F.col("_old") * wide + F.col("_block")]


def _write_shards(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows to one directory per shard, each in up to PARTS files."""
    dealt = rows.repartition(F.col("shard"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS)))
    dealt.write.partitionBy("shard").mode(mode).option("partitionOverwriteMode", "dynamic").parquet(path)


def reshard(docs: DataFrame, old_shards: int = 16, shards: int = 24, kept: tuple[str, ...] = ()) -> DataFrame:
    """Move every document to its new shard: doc_id, ``kept``, size, text_crc32, old_shard, shard, slot.

    ``docs`` has no layout yet; its old shards are those of the hash. The texts are written to new files, one directory
    per shard below the shared folder, and what is returned is read from these. Slots count the rows of a shard from 0
    without gaps, in the order of its files and of the rows in them. NULL and empty texts have ROW_BYTES bytes.
    Repeated rows are kept, each in a slot of its own. Columns that are not named are ignored; an empty table gives an
    empty table.
    """
    spark = docs.sparkSession
    carried = docs.select("doc_id", "text", F.struct(F.lit(0), *[F.col(f"`{c}`") for c in kept]).alias("_kept"))
    sizes, rows = blocked(carried, old_shards, shards)
    plan, _ = plan_reshard(sizes, old_shards, shards)
    moved = rows.withColumn("shard", _new_shard(plan)).select("doc_id", "text", "_kept", "_old", "shard")
    path = scratch_path(spark, "shards")
    _write_shards(moved, path)
    written = spark.read.schema(moved.schema).parquet(path).withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})

    # Names and rows of files: shards times PARTS at most.
    before, starts = [0] * shards, []
    for r in sorted(written.groupBy("shard", "_file").count().collect()):
        starts.append((r["shard"], r["_file"], before[r["shard"]]))
        before[r["shard"]] += r["count"]
    starts = spark.createDataFrame(starts, "_s int, _f string, _start long")
    placed = written.join(starts, (F.col("shard") == F.col("_s")) & (F.col("_file") == F.col("_f")))
    text = F.coalesce("text", F.lit(""))
    return placed.select(
        "doc_id",
        *[F.col(f"_kept.`{c}`") for c in kept],
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("_old").alias("old_shard"),
        "shard",
        (F.col("_start") + F.col("_row")).cast("long").alias("slot"),
    )


def rewrite_affected(docs: DataFrame, path: str, old_shards: int, shards: int) -> list[int]:
    """Bring the files under ``path`` (one directory ``shard=K`` each) from the old layout to the new one.

    ``docs`` are the rows that lie there, with their column shard. Only shards that lose or gain a block are written. They
    are staged beside the old ones, all of them, and committed by one marker; then each takes its place by a rename, and
    directories of shards that lose all rows are deleted (see ``storage.replace_partitions``). A run that was cut off
    before the marker has changed nothing; one cut off after it is finished by the next call, which does nothing else.
    Returns the numbers of all shards that were changed.
    """
    spark = docs.sparkSession
    if finished := finish_replacements(spark, path):
        return sorted(int(name.partition("=")[2]) for name in finished)
    sizes, rows = blocked(docs, old_shards, shards, "shard")
    plan, _ = plan_reshard(sizes, old_shards, shards)
    changed = sorted(plan.changed())
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "shard"]
    moved = rows.select(*columns, _new_shard(plan).alias("shard")).where(F.col("shard").isin(changed))
    held = {to for blocks in plan.target.values() for to in blocks.values()}
    replace_partitions(lambda to: _write_shards(moved, to, "append"), spark, path, [f"shard={k}" for k in changed if k not in held])
    return changed
