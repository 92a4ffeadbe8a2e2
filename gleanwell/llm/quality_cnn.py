"""A byte-level convolutional network for text quality, in numpy.

A text is cut into overlapping chunks of bytes that cover all of it. Each byte is looked up as a short vector, learned
filters slide over the vectors of a chunk, and each filter's largest answer stands for the chunk. A text's
probability is a logistic function of the mean, least and largest answers over its chunks, so every chunk counts.

The network is small and is fitted on the driver with a bounded sample of labelled texts; scoring runs in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanwell.llm.bytesets import steps, text_bytes

CHUNK, STEP = 512, 448
#: A filter spans two strides.
STRIDE, WIDTH, VECTOR, FILTERS = 4, 8, 8, 24
#: The sample: at most so many labelled texts, none longer than so many bytes.
SAMPLE_TEXTS, SAMPLE_BYTES = 2500, 100_000
EPOCHS, BATCH, CHUNKS_PER_TEXT, RATE = 14, 64, 6, 0.01
ACCEPT = 0.3


@dataclass
class Network:
    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    constant: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(
            normal(256, VECTOR, scale=0.5),
            normal(WIDTH * VECTOR, FILTERS, scale=(2 / (WIDTH * VECTOR)) ** 0.5),
            np.zeros(FILTERS, np.float32),
            normal(3 * FILTERS, scale=0.05),
            np.zeros(1, np.float32),
        )


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of every text, padded with zero bytes, and the bounds of the texts. An empty text has one chunk."""
    size = np.diff(offsets)
    many = 1 + np.maximum(0, -(-(size - CHUNK) // STEP))
    bounds = np.concatenate(([0], np.cumsum(many)))
    row = np.repeat(np.arange(len(size)), many)
    begin = offsets[row] + (np.arange(len(row)) - bounds[row]) * STEP
    at = begin[:, None] + np.arange(CHUNK)
    padded = np.append(data, np.uint8(0))
    return np.where(at < offsets[row + 1][:, None], padded[np.minimum(at, len(data))], 0).astype(np.uint8), bounds


def answers(net: Network, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's largest answer in each chunk, below zero counted as zero, and where it is."""
    pieces = net.vectors[block].reshape(len(block), CHUNK // STRIDE, STRIDE * VECTOR)
    half = STRIDE * VECTOR
    out = pieces[:, :-1] @ net.filters[:half] + pieces[:, 1:] @ net.filters[half:]
    place = out.argmax(axis=1)
    top = np.take_along_axis(out, place[:, None, :], axis=1)[:, 0] + net.bias
    return np.maximum(top, 0), place


def pooled(top: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    first, many = bounds[:-1], np.diff(bounds)[:, None]
    parts = np.add.reduceat(top, first) / many, np.minimum.reduceat(top, first), np.maximum.reduceat(top, first)
    return np.concatenate(parts, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probabilities of label 1 of the texts."""
    block, bounds = chunks(data, offsets)
    top = np.concatenate([answers(net, block[k : k + 128])[0] for k in range(0, len(block), 128)])
    return _sigmoid(pooled(top, bounds) @ net.weights + net.constant[0]).astype(np.float64)


def _gradient(net: Network, block: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Network:
    """The gradient of the mean log loss over some texts."""
    top, place = answers(net, block)
    features = pooled(top, bounds)
    off = ((_sigmoid(features @ net.weights + net.constant[0]) - labels) / len(labels)).astype(np.float32)
    by_feature = off[:, None] * net.weights
    row = np.repeat(np.arange(len(labels)), np.diff(bounds))
    mean, least, most = by_feature[row, :FILTERS], by_feature[row, FILTERS : 2 * FILTERS], by_feature[row, 2 * FILTERS :]
    least_here = top == features[row, FILTERS : 2 * FILTERS]
    most_here = top == features[row, 2 * FILTERS :]
    share = [np.add.reduceat(x.astype(np.float32), bounds[:-1])[row] for x in (least_here, most_here)]
    to_top = mean / np.diff(bounds)[row][:, None] + least * least_here / share[0] + most * most_here / share[1]
    to_top = np.where(top > 0, to_top, 0).astype(np.float32)
    at = place[:, :, None] * STRIDE + np.arange(WIDTH)
    window = block[np.arange(len(block))[:, None, None], at]
    seen = net.vectors[window].reshape(len(block), FILTERS, WIDTH * VECTOR)
    filters = np.einsum("cf,cfd->df", to_top, seen)
    back = (to_top[:, :, None] * net.filters.T[None]).reshape(-1, VECTOR)
    vectors = np.stack([np.bincount(window.reshape(-1), back[:, k], 256) for k in range(VECTOR)], axis=1)
    return Network(vectors.astype(np.float32), filters, to_top.sum(axis=0), features.T @ off, off.sum(keepdims=True))


def train(texts: list[str], labels: list[int], seed: int = 0) -> Network:
    """Fit by Adam. In each epoch a long text is seen by some of its chunks, drawn anew."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    if not texts:
        return net
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    block, bounds = chunks(data, offsets)
    wanted = np.asarray(labels, np.float32)
    net.constant[:] = np.log((wanted.sum() + 1) / (len(wanted) - wanted.sum() + 1))
    names = [f.name for f in fields(Network)]
    first = {x: np.zeros_like(getattr(net, x)) for x in names}
    second = {x: np.zeros_like(getattr(net, x)) for x in names}
    rounds = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(texts))
        rate = RATE * (1 - epoch / EPOCHS)
        for k in range(0, len(order), BATCH):
            mine = order[k : k + BATCH]
            picks = [
                bounds[i] + (np.arange(n) if (n := bounds[i + 1] - bounds[i]) <= CHUNKS_PER_TEXT else rng.choice(n, CHUNKS_PER_TEXT, replace=False))
                for i in mine
            ]
            parts = np.concatenate(([0], np.cumsum([len(x) for x in picks])))
            step = _gradient(net, block[np.concatenate(picks)], parts, wanted[mine])
            rounds += 1
            for x in names:
                g = getattr(step, x)
                first[x] += 0.1 * (g - first[x])
                second[x] += 0.001 * (g * g - second[x])
                move = first[x] / (1 - 0.9**rounds) / (np.sqrt(second[x] / (1 - 0.999**rounds)) + 1e-8)
                setattr(net, x, (getattr(net, x) - rate * move).astype(np.float32))
    return net


def _score(batches: Iterator[pa.RecordBatch], schema: pa.Schema, net: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        held = batch.column(batch.schema.get_field_index("held_out"))
        for a, b in steps(offsets, 1_000_000):
            scores = score(net, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            columns = [ids.slice(a, b - a), held.slice(a, b - a), pa.array(scores), pa.array((scores >= ACCEPT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column) -> Network:
    """A network for ``quality`` in ``labels`` (doc_id, quality), from texts that ``held_out`` leaves.

    Learns from at most SAMPLE_TEXTS of them, those whose ids have the least hashes, without texts of more than
    SAMPLE_BYTES bytes. Without a label the network answers 0.5 or near it for everything.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~F.coalesce(held_out, F.lit(False)))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_TEXTS).withColumnRenamed("doc_id", "_doc")
    short = docs.where(F.octet_length("text") <= SAMPLE_BYTES).select("doc_id", "text")
    # SAMPLE_TEXTS rows of two numbers.
    rows = short.join(F.broadcast(picked), F.col("doc_id") == F.col("_doc")).select("doc_id", "text", "quality")
    rows = rows.dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([r.text for r in rows], [int(r.quality > 0) for r in rows])


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """Quality of every text of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Only texts go into a score. NULL and empty texts are one chunk of padding. Repeated rows are scored alike; other
    columns are ignored; an empty table gives an empty table.
    """
    net = fit(docs, labels, held_out)
    result = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    shape = to_arrow_schema(result)
    texts = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return texts.mapInArrow(lambda it: _score(it, shape, net), result)
