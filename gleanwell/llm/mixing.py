"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. Raking scales the cells' sampling chances until the expected
tokens of every source, every language and every topic meet their targets; documents are then drawn by the chance of
their cell. Few cells are raked by one task; many stay in a table, since there may be as many sources as sites, and a
round is a few small shuffles. Both ways give the same bits: they share rounds and stopping rule, and add in whole
numbers (``_LIMBS``), so that no sum depends on its order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwell.llm.frames import unused
from gleanwell.storage import delete, scratch_path, write_scratch

DIMENSIONS = ("source", "lang", "topic")
#: Share of all tokens to draw, and the power that tempers each dimension's shares; 1 leaves them as they are.
BUDGET = 0.5
TEMPER = {"source": 0.5, "lang": 0.6, "topic": 0.8}
ROUNDS, CLOSE = 2000, 1e-3
#: So few cells are raked by one task; more are raked in a table, by the same rounds.
CELLS_PER_TASK = 250_000
#: A round that moves no chance by more is the last. Bounds of the weights, which grow or shrink on where targets contradict.
STILL, WEIGHTS = 1e-7, (1e-60, 1e60)
#: Expected tokens are added as two whole numbers, of 1/2**16 and 1/2**48 of a token. Room for 10**14 tokens in 2**31 cells.
_LIMBS = 2.0**16, 2.0**32


def topic_of(text: str = "text") -> Column:
    """A coarse kind of text: table, list, note, essay or article."""
    body = F.coalesce(F.col(text), F.lit(""))
    size, lines = F.length(body), F.size(F.split(body, "\n"))
    return (
        F.when(40 * F.regexp_count(body, F.lit(r"\|")) > size, "table")
        .when((lines > 3) & (size < 60 * lines), "list")
        .when(size < 800, "note")
        .when(size > 4000, "essay")
        .otherwise("article")
    )


def tokens_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cell_columns() -> list[Column]:
    """source, lang and topic of a document. NULL is a value of its own, written as the empty string."""
    return [c.alias(x) for c, x in zip(_cell(), DIMENSIONS, strict=True)]


def _cell() -> list[Column]:
    return [F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), topic_of()]


def tempered(cells: DataFrame, dimension: str, power: float, budget: float) -> DataFrame:
    """Target tokens of each value of a dimension: its share to a power, scaled so that the targets add up to the budget.

    No target exceeds what is there; what a value cannot give goes to the others in proportion to their powers.
    """
    sums = cells.groupBy(F.col(dimension).alias("_value")).agg(F.sum("tokens").cast("double").alias("there"))
    sums = write_scratch(sums, "mix-sums")
    whole = sums.agg(F.sum("there")).first()[0]
    if not whole:
        return sums.select("_value", F.lit(0.0).alias("target"))
    powers, scale, full = F.pow("there", F.lit(power)), 0.0, -1
    # A larger scale fills more values, which leaves more to the others; each pass fills one at least, or is the last.
    while True:
        filled = F.lit(scale) * powers >= F.col("there")
        r = sums.agg(F.count_if(filled).alias("full"), F.sum(F.when(filled, F.col("there")).otherwise(0.0)).alias("given"), F.sum(F.when(filled, 0.0).otherwise(powers)).alias("rest")).first()
        if r["full"] == full or not r["rest"]:
            break
        full, scale = r["full"], max(scale, (budget * whole - r["given"]) / r["rest"])
    return sums.select("_value", F.least(F.lit(scale) * powers, F.col("there")).alias("target"))


def _group_sums(code: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """Sums of the values of each group, the same in any order; see ``_LIMBS``."""
    scaled = values * _LIMBS[0]
    high = np.floor(scaled)
    sums = np.zeros((2, groups), np.int64)
    for total, limb in zip(sums, (high, np.floor((scaled - high) * _LIMBS[1])), strict=True):
        np.add.at(total, code, limb.astype(np.int64))
    return sums[0] / _LIMBS[0] + sums[1] / (_LIMBS[0] * _LIMBS[1])


def _limb_sums(value: Column, name: str) -> list[Column]:
    """The two sums behind ``_group_sums``, in a table; ``_joined`` makes one number of them."""
    scaled = value * F.lit(_LIMBS[0])
    high = F.floor(scaled)
    low = F.floor((scaled - high.cast("double")) * F.lit(_LIMBS[1]))
    return [F.sum(high).alias(f"{name}_high"), F.sum(low).alias(f"{name}_low")]


def _joined(name: str) -> Column:
    high, low = F.col(f"{name}_high").cast("double"), F.col(f"{name}_low").cast("double")
    return high / F.lit(_LIMBS[0]) + low / F.lit(_LIMBS[0] * _LIMBS[1])


def rake_cells(tokens: np.ndarray, values: list[np.ndarray], targets: list[np.ndarray], rounds: int, close: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Chances of cells, and by which share each value of each dimension then misses its target.

    ``values`` has, for each dimension, the number of each cell's value, ``targets`` the target of each number.
    """
    weight = np.ones(len(tokens))

    def sums(code: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        now = _group_sums(code, np.minimum(weight, 1) * tokens, len(target))
        free = _group_sums(code, np.where(weight < 1, weight * tokens, 0), len(target))
        return now, free, np.where(target > 0, now / np.where(target > 0, target, 1) - 1, 0)

    for _ in range(rounds):
        before, worst = np.minimum(weight, 1), 0.0
        for code, target in zip(values, targets, strict=True):
            now, free, miss = sums(code, target)
            worst = max(worst, np.abs(miss).max(initial=0))
            up = (now < target) & (free > 0)
            factor = np.where(up, 1 + (target - now) / np.where(up, free, 1), np.where((now > target) & (target > 0), target / np.where(now > 0, now, 1), 1))
            weight = np.clip(weight * factor[code], *WEIGHTS)
        if worst < close or np.abs(np.minimum(weight, 1) - before).max(initial=0) < STILL:
            break
    return np.minimum(weight, 1), [sums(c, t)[2] for c, t in zip(values, targets, strict=True)]


def _furthest(misses: np.ndarray) -> np.ndarray:
    """The largest miss of each cell; of two as large the one above zero."""
    size = np.abs(misses)
    return np.where(size == size.max(axis=0), misses, -np.inf).max(axis=0)


def _rake_in_task(frames: Iterator[pd.DataFrame], names: tuple[str, ...], rounds: int, close: float) -> Iterator[pd.DataFrame]:
    frames = [f for f in frames if len(f)]
    if not frames:
        return
    frame = pd.concat(frames, ignore_index=True)
    values, targets = [], []
    for name in names:
        code, distinct = pd.factorize(frame[name])
        target = np.zeros(len(distinct))
        target[code] = frame[f"_target_{name}"]
        values.append(code)
        targets.append(target)
    chance, misses = rake_cells(frame.tokens.to_numpy(np.float64), values, targets, rounds, close)
    frame["chance"] = chance
    frame["miss"] = _furthest(np.stack([m[c] for m, c in zip(misses, values, strict=True)]))
    yield frame.drop(columns=[f"_target_{x}" for x in names])


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, close: float = CLOSE) -> DataFrame:
    """Columns ``chance`` and ``miss`` for each cell, so that chance times tokens adds up to every target.

    ``cells`` has the dimensions and tokens; a target table has ``_value`` and ``target``. A chance is a weight, a product
    of one factor per dimension, cut at 1. Each step moves the factors of a dimension towards its targets; cells that
    are cut no longer count as room. Stops when every sum is within a share of ``close`` of its target, when a round
    moves no chance any more, since targets can contradict each other, or after ``rounds``, however many cells there are. ``miss`` is the largest share
    by which the cell's source, language or topic then misses its target, below zero where it has too little.
    """
    state = cells
    for name, target in targets.items():
        wanted = target.select("_value", F.col("target").alias(f"_target_{name}"))
        state = state.join(wanted, F.col(name) == F.col("_value")).drop("_value")
    names = tuple(targets)
    if cells.count() <= CELLS_PER_TASK:
        schema = T.StructType([*cells.schema.fields, T.StructField("chance", T.DoubleType()), T.StructField("miss", T.DoubleType())])
        state = write_scratch(state.select(*cells.columns, *[f"_target_{x}" for x in names]), "cells").coalesce(1)
        return write_scratch(state.mapInPandas(lambda it: _rake_in_task(it, names, rounds, close), schema), "cells")

    def with_sums(state: DataFrame, name: str) -> DataFrame:
        now = _limb_sums(F.least(F.lit(1.0), F.col("weight")) * F.col("tokens"), "_now")
        free = _limb_sums(F.when(F.col("weight") < 1, F.col("weight") * F.col("tokens")).otherwise(0.0), "_free")
        sums = state.groupBy(F.col(name).alias("_value")).agg(*now, *free)
        sums = sums.select("_value", _joined("_now").alias("_now"), _joined("_free").alias("_free"))
        state = state.join(sums, F.col(name) == F.col("_value")).drop("_value")
        wanted = F.col(f"_target_{name}")
        return state.withColumn(f"_miss_{name}", F.when(wanted > 0, F.col("_now") / wanted - 1).otherwise(0.0))

    def written(state: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(state.sparkSession, "cells")
        state.write.parquet(path)
        return state.sparkSession.read.schema(state.schema).parquet(path), path

    state, path = written(state.withColumn("weight", F.lit(1.0)))
    misses = [F.col(f"_miss_{x}") for x in names]
    for _ in range(rounds):
        state = state.withColumn("_before", F.least(F.lit(1.0), F.col("weight")))
        for name in names:
            state, wanted, now, free = with_sums(state, name), F.col(f"_target_{name}"), F.col("_now"), F.col("_free")
            factor = F.when((now < wanted) & (free > 0), 1 + (wanted - now) / free).when((now > wanted) & (wanted > 0), wanted / now).otherwise(1.0)
            state = state.withColumn("weight", F.least(F.greatest(F.col("weight") * factor, F.lit(WEIGHTS[0])), F.lit(WEIGHTS[1]))).drop("_now", "_free")
        last, (state, path) = path, written(state)
        # Rounds may be many; only the last one is kept.
        delete(state.sparkSession, last)
        moved = F.abs(F.least(F.lit(1.0), F.col("weight")) - F.col("_before"))
        worst, moving = state.agg(F.max(F.greatest(*map(F.abs, misses))), F.max(moved)).first()
        state = state.drop("_before", *[f"_miss_{x}" for x in names])
        if worst is None or worst < close or moving < STILL:
            break
    for name in names:
        state = with_sums(state, name).drop("_now", "_free")
    furthest = F.array_max(F.array(*[F.struct(F.abs(m).alias("size"), m.alias("miss")) for m in misses]))["miss"]
    return write_scratch(state.select(*cells.columns, F.least(F.lit(1.0), F.col("weight")).alias("chance"), furthest.alias("miss")), "cells")


def draw(seed: int = 0) -> Column:
    """A number from 0 to 1 that depends on the document alone."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) * F.lit(2.0**-53)


def calibrated(docs: DataFrame, budget: float = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Cells and tokens of every document, and the raked cells."""
    measured = write_scratch(docs.select("doc_id", *cell_columns(), tokens_of().alias("n_tokens")), "mix-documents")
    cells = write_scratch(measured.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    targets = {x: write_scratch(tempered(cells, x, TEMPER[x], budget), "mix-targets") for x in DIMENSIONS}
    return measured, rake(cells, targets).select(*[F.col(x).alias(f"_{x}") for x in DIMENSIONS], "chance", "miss")


def _same_cell() -> list[Column]:
    return [F.col(x) == F.col(f"_{x}") for x in DIMENSIONS]


def mix(docs: DataFrame, budget: float = BUDGET, seed: int = 0) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, chance, miss and selected of every document.

    Expected tokens of the selected meet the targets as far as these do not contradict each other; ``miss`` is the
    largest share by which the document's source, language or topic misses its own (as in ``rake``). Texts without words weigh nothing in the sums and are drawn by
    the chance of their cell. Repeated rows share the draw of their doc_id. An empty table gives an empty table.
    """
    measured, cells = calibrated(docs, budget)
    chosen = measured.join(cells, _same_cell()).drop(*[f"_{x}" for x in DIMENSIONS])
    return chosen.withColumn("selected", draw(seed) < F.col("chance"))


def sample(docs: DataFrame, budget: float = BUDGET, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` that ``mix`` selects, with their columns."""
    _, cells = calibrated(docs, budget)
    names = {f"_{x}": unused(docs, f"_{x}") for x in DIMENSIONS} | {"chance": unused(docs, "_chance")}
    cells = cells.select(*[F.col(x).alias(y) for x, y in names.items()])
    same = [c == F.col(names[f"_{x}"]) for c, x in zip(_cell(), DIMENSIONS, strict=True)]
    drawn = docs.join(cells, same).where(draw(seed) < F.col(names["chance"]))
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])
