"""The highest-scoring documents for each of a set of texts, by exact whole-number scores.

A document's vector has one impact per term, an item's vector one weight per term, and a score is their product. The
documents' vectors are put in order by their length (Euclidean norm) and cut into buckets. With the least score that
can still be among the best of an item, the threshold:

* the Cauchy-Schwarz inequality leaves out whole buckets, and the tail of a bucket, whose vectors are too short;
* inside a bucket the item's heaviest terms, its focus, are read term by term. What the other terms can add is at most
  the product of what is left of both vectors' lengths, so most documents fall to that bound;
* the survivors' scores are computed in 64-bit integers.

The bounds are taken in doubles with a margin, so they never cost a document. The longest vectors are searched first, in
waves; each wave's results raise the thresholds of the next, and so do a task's own results as it goes on. A task
returns at most as many documents per item as are asked for.

Terms are runs of ASCII letters and digits and of all bytes above 127, A-Z lower-cased; they are told apart by 64-bit
hashes. Of a document only the terms of items are kept. Items are taken in blocks of a bounded number of terms, so
that what is broadcast does not grow with them; each block is one pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanwell.llm.bytesets import STEP_BYTES, lower_ascii, pieces, prefix_sums, runs, span_hashes, steps, text_bytes
from gleanwell.storage import write_scratch

#: Terms and items of a block; one item with more terms is a block of its own.
BLOCK_TERMS, BLOCK_ITEMS = 200_000, 4_000
#: Vectors in a bucket.
BUCKET = 4096
#: Shares of the documents, longest first, after which a wave ends.
WAVES = (0.01, 0.1)
#: The focus of an item holds terms until this share of its length is left.
REST = 0.3
#: Factor on bounds in doubles.
MARGIN = 1 + 1e-9


def term_bytes() -> np.ndarray:
    """Which of the 256 bytes are part of a term."""
    byte = np.arange(256)
    digits, upper, lower = ((byte >= ord(a)) & (byte <= ord(b)) for a, b in ("09", "AZ", "az"))
    return digits | upper | lower | (byte > 127)


def _term_hashes(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms in ``data``, and terms per row."""
    starts, ends, per_row = runs(inside[data], bounds)
    return span_hashes(prefix_sums(lower_ascii(data)), starts, ends), per_row


@dataclass(frozen=True)
class Items:
    """Items of one block: their ids, the hashes of all their terms, and the numbers of each item's terms."""

    ids: list
    hashes: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray

    @classmethod
    def of(cls, ids: list, found: list[np.ndarray]) -> Items:
        hashes, number = np.unique(np.concatenate(found), return_inverse=True)
        return cls(ids, hashes, np.concatenate(([0], np.cumsum([len(x) for x in found]))), number.reshape(-1))


def _blocks(items: DataFrame) -> Iterator[Items]:
    inside = term_bytes()
    ids, found, total = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        data = np.frombuffer((row.text or "").encode(), np.uint8)
        terms = np.unique(_term_hashes(data, np.array([0, len(data)]), inside)[0])
        if ids and (total + len(terms) > BLOCK_TERMS or len(ids) == BLOCK_ITEMS):
            yield Items.of(ids, found)
            ids, found, total = [], [], 0
        ids, found, total = [*ids, row.item_id], [*found, terms], total + len(terms)
    if ids:
        yield Items.of(ids, found)


def _lists(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _counted(batches: Iterator[pa.RecordBatch], shared, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Number of terms, and numbers and counts of the items' terms, of each text."""
    hashes, inside = shared.value, term_bytes()
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        rows, size = len(ids), max(len(hashes), 1)
        n = np.zeros(rows, np.int64)
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        bounds, row_of = pieces(data, offsets, ~inside, STEP_BYTES)
        for a, b in steps(bounds, STEP_BYTES):
            found, per_piece = _term_hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], inside)
            np.add.at(n, row_of[a:b], per_piece)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == found)
                key, count = np.unique(np.repeat(row_of[a:b], per_piece)[hit] * size + at[hit], return_counts=True)
                keys.append(key)
                counts.append(count)
        # A long text may have come in several pieces.
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.zeros(len(key), np.int64)
        np.add.at(tf, place.reshape(-1), np.concatenate(counts))
        ends = np.searchsorted(key, np.arange(rows + 1) * size)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n), _lists(ends, key % size, pa.int32()), _lists(ends, tf, pa.int32())], schema=schema
        )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and values of a list column."""
    bounds = np.asarray(column.offsets).astype(np.int64)
    return bounds - bounds[0], np.asarray(column.flatten())


def _weighed(batches: Iterator[pa.RecordBatch], texts: int, terms: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Vectors of impacts and their lengths; ``texts`` have a term, ``terms`` are all their terms."""
    for batch in batches:
        ids, n = batch.column(0), np.asarray(batch.column(1))
        (bounds, number), (_, tf) = _flat(batch.column(2)), _flat(batch.column(3))
        row = np.repeat(np.arange(len(n)), np.diff(bounds))
        tf = tf.astype(np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * (50 + (50 * n * texts) // terms)[row])
        length = np.sqrt(np.bincount(row, weights=impact.astype(np.float64) ** 2, minlength=len(n)))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(length), _lists(bounds, number, pa.int32()), _lists(bounds, impact, pa.int32())], schema=schema
        )


class _Bucket:
    """Vectors by falling length: row by row, and their impacts term by term."""

    def __init__(self, length: np.ndarray, bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.length, self.bounds, self.terms, self.impacts = length, bounds, terms, impacts.astype(np.int64)
        order = np.argsort(terms, kind="stable")
        self.held, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(terms))
        self.by_term = self.impacts[order]
        self.row = np.repeat(np.arange(len(length)), np.diff(bounds))[order]

    def candidates(self, terms: np.ndarray, weights: np.ndarray, norm: float, focus: int, rest: float, least: int) -> np.ndarray:
        """Rows whose score may reach ``least`` (and is above 0). The first ``focus`` of ``terms`` are read."""
        # Vectors are ordered: those whose length times the item's falls short are a tail.
        enough = int(np.searchsorted(-self.length, -(least / (norm * MARGIN)), "right"))
        part, squares = np.zeros(enough), np.zeros(enough)
        at = np.searchsorted(self.held, terms[:focus])
        for k, weight in zip(at, weights[:focus]):
            rows = self.row[self.first[k] : self.first[k + 1]]
            rows = rows[: np.searchsorted(rows, enough)]
            own = self.by_term[self.first[k] : self.first[k] + len(rows)].astype(np.float64)
            part[rows] += weight * own
            squares[rows] += own * own
        left = np.sqrt(np.maximum(self.length[:enough] ** 2 * MARGIN - squares, 0.0))
        bound = (part + rest * left) * MARGIN
        return np.flatnonzero((bound >= least) & (bound > 0))

    def scores(self, rows: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of rows."""
        size = self.bounds[rows + 1] - self.bounds[rows]
        before = np.cumsum(size) - size
        at = np.repeat(self.bounds[rows] - before, size) + np.arange(size.sum())
        products = np.concatenate(([0], np.cumsum(weight_of[self.terms[at]] * self.impacts[at])))
        return products[before + size] - products[before]


class _Queries:
    """The items of a block with their weights, least scores of interest, and the best documents found so far."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, weight_of: np.ndarray, least: np.ndarray, best: int):
        self.best, self.least, self.weight_of = best, least.copy(), weight_of
        self.items = []
        for number in range(len(bounds) - 1):
            own = terms[bounds[number] : bounds[number + 1]]
            own = own[weight_of[own] > 0]
            own = own[np.argsort(-weight_of[own], kind="stable")]
            if len(own):
                self.items.append((number, own, weight_of[own].astype(np.float64)))
        self.found: dict[int, tuple[np.ndarray, list]] = {}
        self.chosen = np.zeros(len(weight_of), np.int64)

    def search(self, bucket: _Bucket, ids: list) -> None:
        longest = bucket.length[0]
        for number, terms, weights in self.items:
            least = int(self.least[number])
            norm = float(np.sqrt(np.dot(weights, weights)))
            if norm * longest * MARGIN < least:
                continue
            here = np.isin(terms, bucket.held, assume_unique=True)
            terms, weights = terms[here], weights[here]
            if not len(terms):
                continue
            norm = float(np.sqrt(np.dot(weights, weights)))
            rests = np.sqrt(np.maximum(np.append(np.cumsum((weights * weights)[::-1])[::-1], 0.0), 0.0))
            focus = int(np.searchsorted(-rests, -REST * norm))
            rows = bucket.candidates(terms, weights, norm, focus, rests[focus], least)
            if not len(rows):
                continue
            exact = terms.astype(np.int64)
            self.chosen[exact] = self.weight_of[exact]
            scores = bucket.scores(rows, self.chosen)
            self.chosen[exact] = 0
            good = np.flatnonzero((scores >= max(least, 1)))
            self._keep(number, scores[good], [ids[k] for k in rows[good]])

    def _keep(self, number: int, scores: np.ndarray, ids: list) -> None:
        if number in self.found:
            old, names = self.found[number]
            scores, ids = np.concatenate((old, scores)), names + ids
        if len(scores) > self.best:
            # By falling score and rising id, NULL first.
            order = sorted(range(len(scores)), key=lambda k: (-scores[k], ids[k] is not None, ids[k]))[: self.best]
            scores, ids = scores[order], [ids[k] for k in order]
        self.found[number] = scores, ids
        if len(scores) == self.best:
            self.least[number] = max(self.least[number], scores.min())


def _search(batches: Iterator[pa.RecordBatch], shared, best: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    queries = _Queries(*shared.value, best)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        length = np.asarray(batch.column(1))
        (bounds, terms), (_, impacts) = _flat(batch.column(2)), _flat(batch.column(3))
        order = np.argsort(-length, kind="stable")
        for first in range(0, len(order), BUCKET):
            rows = order[first : first + BUCKET]
            size = bounds[rows + 1] - bounds[rows]
            cuts = np.concatenate(([0], np.cumsum(size)))
            at = np.repeat(bounds[rows] - cuts[:-1], size) + np.arange(cuts[-1])
            if cuts[-1]:
                queries.search(_Bucket(length[rows], cuts, terms[at], impacts[at]), [ids[k] for k in rows])
    for number, (scores, ids) in queries.found.items():
        columns = [pa.array([number] * len(ids), pa.int32()), pa.array(ids, schema.field("doc_id").type), pa.array(scores)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _block(docs: DataFrame, items: Items, best: int) -> DataFrame:
    spark = docs.sparkSession
    doc_id = docs.schema["doc_id"]
    ints = T.ArrayType(T.IntegerType())
    fields = lambda *pairs: T.StructType([T.StructField(n, t) for n, t in pairs])

    counted = fields(("doc_id", doc_id.dataType), ("n", T.LongType()), ("terms", ints), ("tfs", ints))
    hashes, shape = spark.sparkContext.broadcast(items.hashes), to_arrow_schema(counted)
    vectors = write_scratch(docs.select("doc_id", "text").mapInArrow(lambda it: _counted(it, hashes, shape), counted), "search_terms")
    texts, terms = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    found = fields(("item", T.IntegerType()), ("doc_id", doc_id.dataType), ("score", T.LongType()))
    if not texts or not len(items.hashes):
        return spark.createDataFrame([], found)
    df = np.zeros(len(items.hashes), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[row.term] = row["count"]
    weight_of = np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * int(x) + 1))) for x in df], np.int64)

    weighed = fields(("doc_id", doc_id.dataType), ("length", T.DoubleType()), ("terms", ints), ("impacts", ints))
    shape = to_arrow_schema(weighed)
    holding = vectors.where(F.size("terms") > 0)
    ordered = holding.mapInArrow(lambda it: _weighed(it, texts, terms, shape), weighed)
    ordered = write_scratch(ordered.repartitionByRange(F.desc("length"), "doc_id").sortWithinPartitions(F.desc("length")), "search_vectors")
    marks = ordered.agg(F.percentile_approx("length", [1 - x for x in WAVES], 10_000)).first()[0]
    limits = [math.inf, *(marks or []), -1.0]

    least = np.zeros(len(items.ids), np.int64)
    shape = to_arrow_schema(found)
    tops: list[DataFrame] = []
    for above, below in zip(limits, limits[1:]):
        shared = spark.sparkContext.broadcast((items.bounds, items.terms, weight_of, least))
        wave = ordered.where((F.col("length") < above) & (F.col("length") >= below))
        hits = wave.mapInArrow(lambda it, shared=shared: _search(it, shared, best, shape), found)
        tops.append(write_scratch(_best(reduce(DataFrame.unionByName, [*tops[-1:], hits]), best), "search_best"))
        for row in tops[-1].groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).toLocalIterator():
            if row.n == best:
                least[row.item] = row.least
    return tops[-1]


def _best(found: DataFrame, best: int) -> DataFrame:
    """The ``best`` rows of each item, with their rank. The limit is applied in each task before the shuffle."""
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.select("item", "doc_id", "score", F.row_number().over(place).alias("rank")).where(F.col("rank") <= best).select("item", "doc_id", "score")


def top_documents(docs: DataFrame, items: DataFrame, best: int = 50) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the ``best`` documents of each item with a score above 0.

    ``docs`` (doc_id, text), ``items`` (item_id, text); other columns are ignored. Equal scores are ranked by ascending
    doc_id, NULL first. NULL and empty texts have no term: such documents are nowhere found and are not among those that
    weights count, such items find nothing. Every row is a document, and every row an item, whether it repeats another or
    not. Without documents or items the result is empty.
    """
    spark = docs.sparkSession
    results = []
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema["item_id"].dataType)])
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    for block in _blocks(items):
        names = spark.createDataFrame(list(enumerate(block.ids)), schema)
        found = _block(docs, block, best).join(names, "item")
        results.append(found.select("item_id", F.row_number().over(place).alias("rank"), "doc_id", "score"))
    if not results:
        empty = T.StructType([schema["item_id"]]).add("rank", T.IntegerType()).add(docs.schema["doc_id"]).add("score", T.LongType())
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, results)
