"""Bloom filters of a bounded size, built by Spark and sent to all tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of a filter per hash, and its largest size in bits (32 MB).
BITS_PER_HASH, MOST_BITS = 64, 2**28
_CHUNK = 2**13
_PROBES = (0, 32)

_U = np.uint64


def _bits_of(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in _PROBES:
        yield ((hashes >> _U(k)) & _U(bits - 1)).astype(np.int64)


def _mark(frames: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        places = np.concatenate(list(_bits_of(frame.seed.to_numpy().view(_U), bits)))
        yield pd.DataFrame({"chunk": (places // _CHUNK).astype(np.int32), "bit": (places % _CHUNK).astype(np.int32)}).drop_duplicates()


def _chunk(frame: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(_CHUNK, np.uint8)
    bits[frame.bit.to_numpy()] = 1
    return pd.DataFrame({"chunk": [frame.chunk.iat[0]], "bytes": [np.packbits(bits, bitorder="little").tobytes()]})


def bloom_filter(hashes: DataFrame) -> np.ndarray:
    """A filter of the 64-bit hashes in column ``seed``, as bytes. Its size is a power of two of at most MOST_BITS bits.

    More hashes than that size suits only make it let more pass. Built chunk by chunk.
    """
    bits = min(MOST_BITS, max(_CHUNK, 1 << (BITS_PER_HASH * hashes.count()).bit_length()))
    marked = hashes.select("seed").mapInPandas(lambda it: _mark(it, bits), "chunk int, bit int").distinct()
    chunks = marked.groupBy("chunk").applyInPandas(_chunk, "chunk int, bytes binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in chunks.collect():
        out[r.chunk * _CHUNK // 8 : (r.chunk + 1) * _CHUNK // 8] = np.frombuffer(r.bytes, np.uint8)
    return out


def passing(filtered: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of the hashes that may be in the filter: all that are, and a few others."""
    passed = np.arange(len(hashes))
    for k in _PROBES:
        at = ((hashes[passed] >> _U(k)) & _U(len(filtered) * 8 - 1)).astype(np.int64)
        passed = passed[(filtered[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return passed


def part(batches: Iterator[pa.RecordBatch], shared, inside: bool) -> Iterator[pa.RecordBatch]:
    """The rows whose column ``seed`` may be in the broadcast filter, or those where it is not."""
    for batch in batches:
        hashes = batch.column(batch.schema.get_field_index("seed")).to_numpy(zero_copy_only=False).view(_U)
        mask = np.full(len(hashes), not inside)
        mask[passing(shared.value, hashes)] = inside
        yield batch.filter(pa.array(mask))


def split(rows: DataFrame, shared) -> tuple[DataFrame, DataFrame]:
    """The rows whose column ``seed`` may be in the broadcast filter, and those where it is not."""
    return tuple(rows.mapInArrow(lambda it, x=x: part(it, shared, x), rows.schema) for x in (True, False))
