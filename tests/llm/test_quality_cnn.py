"""Gradients against differences, chunks against slices, and held-out accuracy."""

import os
import random
from dataclasses import fields

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwell.llm import quality_cnn as cnn
from gleanwell.llm.bytesets import text_bytes
from gleanwell.llm.frames import remainder

FOLDER = "/root/testdata/sf0.01"


def bytes_of(values):
    import pyarrow as pa

    return text_bytes(pa.array(values, pa.large_string()))


def test_chunks_cover_every_byte():
    values = ["", "a", "b" * cnn.CHUNK, "c" * (cnn.CHUNK + 1), "".join(chr(97 + k % 26) for k in range(3000))]
    block, bounds = cnn.chunks(*bytes_of(values))
    for k, text in enumerate(values):
        mine = block[bounds[k] : bounds[k + 1]]
        joined = b"".join(bytes(c[: cnn.STEP]) for c in mine[:-1]) + bytes(mine[-1])
        assert joined.rstrip(b"\0") == text.encode()


def test_gradient():
    rng = random.Random(19)
    values = ["".join(rng.choice("abc $!") for _ in range(n)) for n in (10, 600, 1500)]
    block, bounds = cnn.chunks(*bytes_of(values))
    labels = np.array([1, 0, 1], np.float32)
    net = cnn.Network(*[x.astype(np.float64) for x in vars(cnn.Network.fresh(1)).values()])

    def loss(n):
        top, _ = cnn.answers(n, block)
        p = 1 / (1 + np.exp(-(cnn.pooled(top, bounds) @ n.weights + n.constant[0])))
        return -np.mean(np.where(labels == 1, np.log(p), np.log(1 - p)))

    found = cnn._gradient(net, block, bounds, labels)
    rnd = np.random.default_rng(20)
    for f in fields(cnn.Network):
        value, grad = getattr(net, f.name), getattr(found, f.name)
        for at in rnd.choice(value.size, min(value.size, 12), replace=False):
            kept = value.flat[at]
            value.flat[at] = kept + 1e-5
            up = loss(net)
            value.flat[at] = kept - 1e-5
            down = loss(net)
            value.flat[at] = kept
            assert grad.flat[at] == pytest.approx((up - down) / 2e-5, abs=2e-4), f.name


def test_odd_and_empty(odd, empty, spark):
    labels = spark.createDataFrame([(3, 0), (5, 1), (5, 1), (6, None), (None, 1), (99, 1)], "doc_id bigint, quality int")
    rows = cnn.classify(odd, labels, F.lit(False)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert cnn.classify(odd, labels.limit(0), F.lit(False)).count() == odd.count()
    assert cnn.classify(empty, labels, F.lit(False)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="captured tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{x}.parquet") for x in ("documents", "labels"))
    rows = cnn.classify(docs, labels, remainder("doc_id", 5) == 0).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
