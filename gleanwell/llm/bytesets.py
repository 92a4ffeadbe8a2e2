"""Texts of an Arrow batch as one byte array, and hashes of spans in it, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_TABLE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]

#: Bytes of text that one vector step takes, unless a single text is longer.
STEP_BYTES = 2_000_000
#: Tables of powers grow by multiples of this.
_POWERS = 2**18


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows. NULL counts as the empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes each, or a single longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def blank_bytes() -> np.ndarray:
    """Which of the 256 bytes are white space (9-13 and 32)."""
    return np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than 9-13 and 32) and words per row.

    ``offsets`` are the rows' bounds in ``data``; no word crosses one.
    """
    return runs(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, and runs per row; no run crosses a bound in ``offsets``."""
    n = len(inside)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if n else inside
    after = np.concatenate((inside[1:], [False])) if n else inside
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    per_row = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return starts, ends, per_row


def pieces(data: np.ndarray, offsets: np.ndarray, parting: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the rows, longer ones cut before a ``parting`` byte after about ``most`` bytes, and each piece's row.

    ``parting`` says of each of the 256 bytes whether it lies between words. A row without such a byte stays whole.
    """
    cuts: list[tuple[int, int]] = []
    for row in np.flatnonzero(np.diff(offsets) > most):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while end - at > most:
            at += most
            while at < end and not (found := parting[data[at : min(at + most, end)]]).any():
                at = min(at + most, end)
            if at < end:
                at += int(found.argmax())
                cuts.append((at, int(row)))
    bounds = np.concatenate((offsets, np.array([c for c, _ in cuts], np.int64)))
    rows = np.concatenate((np.arange(len(offsets)), np.array([r for _, r in cuts], np.int64)))
    order = np.lexsort((bounds, rows))
    return bounds[order], rows[order][:-1]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        n = -(-n // _POWERS) * _POWERS
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(n, base, _U)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=_U)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every input bit spread over all output bits (one-to-one)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hashes`` takes the hash of any span of ``data``."""
    up, _ = _power_tables(len(data) + 1)
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_TABLE[data] * up[: len(data)], dtype=_U, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes have equal hashes wherever they stand."""
    _, down = _power_tables(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def pack(values: np.ndarray) -> bytes:
    """An array of integers as compressed bytes, plane by plane."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(values.dtype.char.encode() + np.ascontiguousarray(planes).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(bytes(blob))
    kind = np.dtype(raw[:1].decode())
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def smallest_int(values: np.ndarray) -> np.ndarray:
    """The same counts in the narrowest unsigned type that holds them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else np.uint32 if top < 2**32 else np.uint64)
