"""Token ids of a corpus in binary files of word-aligned codes (Simple-8b), and their way back.

A file is a row of segments. Each holds whole documents and is made of little-endian 64-bit units:

    magic, units in the segment, documents, ids, packed words, literals
    id of each document, 1 for each document whose id is known (0: NULL), number of ids of each document
    place of the first packed word of each block of ``BLOCK`` ids, and of the end
    packed words, literals, and one unit of zeros as the end mark

The top four bits of a packed word are its selector, which says how many ids of how many bits its other 60 bits hold,
the first id lowest. Selector 0 is the escape: the word stands for one id of more than 60 bits and holds its place among
the literals. Selector 1 is a run: 28 bits of count, 32 bits of value. No word crosses a block, so any block can be read
by itself, and the words of many blocks are unpacked together, one vector step per selector.

Documents are put in order by one range shuffle of the texts; a task encodes its range and Spark's text writer, whose
line end is the end mark, puts the segments into files. So the files lie wherever Spark can write, under its commit
rules, and a lost executor costs the tasks it ran. File names sort by part and file number into the order of the ids.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Iterator
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwell.llm.bytesets import STEP_BYTES, blank_bytes, pieces, prefix_sums, span_hashes, steps, text_bytes, word_spans
from gleanwell.operators.ordered import running

#: Ids and bits of a word by selector; the counts of an escape and of a run are in the word.
COUNTS = np.array([1, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([60, 32, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
ESCAPE, RUN = 0, 1
BLOCK = 1024
MAGIC = 0x3142383153444947
END = "\0" * 8

#: Ids in a segment, unless one document has more; segments in a file.
SEGMENT_IDS = 1 << 18
SEGMENTS_PER_FILE = 32
#: Distinct words whose ids a process remembers, and new words given to the tokenizer at once.
REMEMBERED = 1_500_000
NEW_WORDS = 5_000

_U = np.uint64


def _steps(ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Selector and number of ids of a word that starts at each id; ``cuts`` are the first ids of further blocks."""
    n = len(ids)
    # The least selector whose width holds an id, and then all of the ids from each place on; what follows the last is 0.
    need = np.zeros(n + int(COUNTS.max()), np.uint8)
    for s in range(2, 16):
        need[:n] += ids >= _U(1 << int(BITS[s]))
    need += 2
    widest = {1: need}

    def over(count: int) -> np.ndarray:
        """The widest need among ``count`` ids."""
        if count not in widest:
            half = 1 << (count - 1).bit_length() - 1
            first, rest = over(half), over(count - half)
            out = first.copy()
            np.maximum(first[: len(out) - half], rest[half:], out=out[: len(out) - half])
            widest[count] = out
        return widest[count]

    selector = np.where(need[:n] > 15, ESCAPE, 15).astype(np.int8)
    for s in range(14, 1, -1):
        np.copyto(selector, s, where=over(int(COUNTS[s]))[:n] <= s)
    size = COUNTS[selector]
    # Ids of the same value, where they are more than the word would hold.
    again = np.zeros(n + 1, bool)
    again[1:-1] = (ids[1:] == ids[:-1]) & (ids[1:] < _U(1 << 32))
    again[cuts] = False
    edges = np.flatnonzero(again[1:] != again[:-1])
    starts, length = edges[::2], edges[1::2] - edges[::2] + 1
    upto = np.cumsum(length)
    at = np.repeat(starts - (upto - length), length) + np.arange(length.sum())
    alike = np.repeat(starts + length, length) - at
    more = alike > size[at]
    selector[at[more]] = RUN
    size[at[more]] = alike[more]
    left = BLOCK - np.arange(BLOCK)
    left = np.resize(left, n)
    left[n - n % BLOCK :] -= -n % BLOCK
    return selector, np.minimum(size, left)


def pack_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the blocks' first words (and of the end), packed words, and literals of unsigned 64-bit ``ids``."""
    ids = np.asarray(ids).astype(_U, copy=False)
    n = len(ids)
    if not n:
        return np.zeros(1, _U), np.zeros(0, _U), np.zeros(0, _U)
    firsts = np.arange(0, n, BLOCK)
    selector, size = _steps(ids, firsts[1:])
    # Words follow each other inside a block, all blocks side by side.
    begins = np.zeros(n, bool)
    place, limit = firsts, np.minimum(firsts + BLOCK, n)
    while len(place):
        begins[place] = True
        place = place + size[place]
        open_ = place < limit
        place, limit = place[open_], limit[open_]
    starts = np.flatnonzero(begins)
    selector, size = selector[starts].astype(np.int64), size[starts]
    words = selector.astype(_U) << _U(60)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            k = np.arange(COUNTS[s])
            held = k < size[mine][:, None]
            values = np.where(held, ids[np.minimum(starts[mine][:, None] + k, n - 1)], _U(0))
            words[mine] |= np.bitwise_or.reduce(values << (k.astype(_U) * BITS[s]), axis=1)
    run = selector == RUN
    words[run] |= (size[run].astype(_U) << _U(32)) | ids[starts[run]]
    far = np.flatnonzero(selector == ESCAPE)
    words[far] |= np.arange(len(far), dtype=_U)
    return np.append(np.searchsorted(starts, firsts), len(starts)).astype(_U), words, ids[starts[far]]


def unpack_ids(n: int, places: np.ndarray, words: np.ndarray, literals: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` (excluded) of ``n`` packed ids."""
    last = len(places) - 1 if last is None else last
    from_, to = first * BLOCK, min(last * BLOCK, n)
    if to <= from_:
        return np.zeros(0, _U)
    bounds = places[first : last + 1].astype(np.int64)
    words = words[bounds[0] : bounds[-1]]
    selector = (words >> _U(60)).astype(np.int64)
    load = words & _U((1 << 60) - 1)
    size = np.where(selector == RUN, (load >> _U(32)).astype(np.int64), COUNTS[selector])
    per_block = np.diff(bounds)
    block = np.repeat(np.arange(last - first), per_block)
    total = np.concatenate(([0], np.cumsum(size)))
    start = block * BLOCK + total[:-1] - total[bounds[:-1] - bounds[0]][block]
    size = np.minimum(size, np.minimum((block + 1) * BLOCK, to - from_) - start)
    out = np.empty(to - from_, _U)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            k = np.arange(COUNTS[s])
            values = (load[mine][:, None] >> (k.astype(_U) * BITS[s])) & _U((1 << int(BITS[s])) - 1)
            held = k < size[mine][:, None]
            out[(start[mine][:, None] + k)[held]] = values[held]
    for mine in np.flatnonzero(selector == RUN):
        out[start[mine] : start[mine] + size[mine]] = load[mine] & _U((1 << 32) - 1)
    far = selector == ESCAPE
    out[start[far]] = literals[load[far].astype(np.int64)]
    return out


def segment(doc_ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """Documents with ``sizes`` of the ``ids`` each as one segment, without its end mark."""
    places, words, literals = pack_ids(ids)
    head = [MAGIC, 0, len(doc_ids), len(ids), len(words), len(literals)]
    parts = [doc_ids.astype("<i8"), known.astype("<i8"), sizes.astype("<i8"), places.astype("<u8"), words.astype("<u8"), literals.astype("<u8")]
    head[1] = len(head) + sum(map(len, parts)) + 1
    return np.array(head, "<u8").tobytes() + b"".join(p.tobytes() for p in parts)


def segments(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The segments of a file: ids of documents, whether known, their sizes, and all their token ids."""
    units = np.frombuffer(data, "<u8")
    at = 0
    while at < len(units):
        magic, whole, docs, n, n_words, n_literals = (int(x) for x in units[at : at + 6])
        if magic != MAGIC or at + whole > len(units):
            raise ValueError(f"no segment at byte {8 * at}")
        body, parts = at + 6, []
        for size in (docs, docs, docs, -(-n // BLOCK) + 1, n_words, n_literals):
            parts.append(units[body : body + size])
            body += size
        if body + 1 != at + whole or units[body]:
            raise ValueError(f"segment at byte {8 * at} does not end where it says")
        yield parts[0].view(np.int64), parts[1].astype(bool), parts[2].astype(np.int64), unpack_ids(n, *parts[3:])
        at += whole


class WordIds:
    """Ids of words by the words' 64-bit hashes. Forgets all when it knows more than ``REMEMBERED`` words.

    White space parts words and has no ids, so a text's ids are those of its words, one after the other.
    """

    @classmethod
    def here(cls, model: str) -> WordIds:
        """The ones this process keeps for the tokenizer, so that a worker's next tasks know the words of its last."""
        kept = sys.modules.setdefault("gleanwell_word_ids", ModuleType("gleanwell_word_ids")).__dict__
        key = zlib.crc32(model.encode())
        if kept.get("key") != key:
            kept["key"], kept["words"] = key, cls(model)
        return kept["words"]

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are what runs side by side
        self.model = Tokenizer.from_str(model)
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.numbers = np.zeros(0, _U), np.zeros(0, np.int64)
        self.bounds, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each of the words, and all ids."""
        if len(self.hashes) > REMEMBERED:
            self._forget()
        distinct, place, word = np.unique(span_hashes(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != distinct[inside]
        if new.any():
            whole, fresh = data.tobytes(), place[new]
            texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())]
            numbers = len(self.bounds) - 1 + np.arange(len(texts))
            sizes, ids = [], [self.ids]
            for k in range(0, len(texts), NEW_WORDS):
                found = [e.ids for e in self.model.encode_batch_fast(texts[k : k + NEW_WORDS], add_special_tokens=False)]
                sizes += map(len, found)
                ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
            self.ids = np.concatenate(ids)
            self.hashes, self.numbers = np.insert(self.hashes, at[new], distinct[new]), np.insert(self.numbers, at[new], numbers)
        number = self.numbers[np.searchsorted(self.hashes, distinct)][word.reshape(-1)]
        first, size = self.bounds[number], self.bounds[number + 1] - self.bounds[number]
        before = np.cumsum(size) - size
        return size, self.ids[np.repeat(first - before, size) + np.arange(size.sum())]


def _encode(batches: Iterator[pa.RecordBatch], model, end_id: int) -> Iterator[pa.RecordBatch]:
    words, blank = WordIds.here(model.value), blank_bytes()
    docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ids: list[np.ndarray] = []
    waiting = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal docs, ids, waiting
        numbers, known, sizes = (np.concatenate(x) for x in zip(*docs))
        tokens = np.concatenate(ids)
        after, row = np.cumsum(sizes), 0
        while row < len(sizes):
            done = after[row - 1] if row else 0
            last = min(int(np.searchsorted(after, done + SEGMENT_IDS)) + 1, len(sizes))
            blob = segment(numbers[row:last], known[row:last], sizes[row:last], tokens[done : after[last - 1]])
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["segment"])
            row = last
        docs, ids, waiting = [], [], 0

    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        column = batch.column(batch.schema.get_field_index("doc_id"))
        known = np.asarray(column.is_valid())
        numbers = np.asarray(column.cast(pa.int64()).fill_null(0))
        bounds, rows = pieces(data, offsets, blank, STEP_BYTES)
        open_ids = 0
        for a, b in steps(bounds, STEP_BYTES):
            part, cut = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
            starts, ends, per_piece = word_spans(part, cut)
            size, found = words.of(part, starts, ends)
            upto = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(per_piece)))]
            # The last piece of a row is followed by the end id.
            closing = np.append(rows[a + 1 : b] != rows[a : b - 1], b == len(rows) or rows[b] != rows[b - 1])
            ids.append(np.insert(found, upto[1:][closing], np.uint32(end_id)))
            total = np.diff(np.concatenate(([0], upto[1:][closing]))) + 1
            if len(total):
                total[0] += open_ids
                open_ids = 0
            open_ids += int(upto[-1] - (upto[1:][closing][-1] if closing.any() else 0))
            done = rows[a:b][closing]
            docs.append((numbers[done], known[done], total))
            waiting += int(total.sum())
            # Only whole documents are written.
            if waiting >= SEGMENT_IDS and not open_ids:
                yield from flush()
    if docs:
        yield from flush()


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, segments_per_file: int = SEGMENTS_PER_FILE) -> None:
    """Write the ids of every text of ``docs`` (doc_id, text) to files in ``folder``, by ascending doc_id.

    ``tokenizer`` is the path of a file of the tokenizers library whose words end at white space; special tokens are
    not added, and ``end_id`` follows each document. NULL, empty and blank texts have the end id only. Rows without id
    come first; rows that share an id stand side by side, ordered by a hash of their texts; repeated rows are written
    as often as they occur. Other columns are ignored. An empty table gives no segment.
    """
    with open(tokenizer, encoding="utf-8") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())  # as large as the vocabulary
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    coded = placed.mapInArrow(lambda it: _encode(it, model, end_id), "segment binary")
    # The writer takes bytes as they are.
    lines = coded.select(F.col("segment").cast("string").alias("value"))
    lines.write.options(lineSep=END, maxRecordsPerFile=segments_per_file).text(folder)


_READ = "part bigint, file bigint, place bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def _decode(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, file, content in zip(*(batch.column(k) for k in range(3))):
            place = 0
            for numbers, known, sizes, ids in segments(content.as_buffer()):
                after = np.concatenate(([0], np.cumsum(sizes)))
                small = ids.astype("<u4")
                sums = [zlib.crc32(small[a:b]) for a, b in zip(after[:-1], after[1:])]
                n = len(sizes)
                columns = {
                    "part": pa.array([part.as_py()] * n, pa.int64()),
                    "file": pa.array([file.as_py()] * n, pa.int64()),
                    "place": pa.array(place + np.arange(n)),
                    "doc_id": pa.array(numbers, mask=~known),
                    "n_tokens": pa.array(sizes),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.LargeListArray.from_arrays(after, ids.view(np.int64)).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)
                place += n


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The documents of written files: their place (part, file, place), doc_id, n_tokens, crc32 of the ids as unsigned
    little-endian 32-bit integers, and the ids themselves unless ``with_ids`` is False."""
    files = spark.read.format("binaryFile").load(folder)
    number = lambda pattern: F.regexp_extract("path", pattern, 1).cast("bigint")
    named = files.select(number(r"part-(\d+)-[^/]*$"), number(r"-c(\d+)[^/]*$"), "content")
    return named.mapInArrow(lambda it: _decode(it, with_ids), _READ + (", ids array<bigint>" if with_ids else ""))


def id_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document of written files."""
    read = read_ids(spark, folder, with_ids=False)
    placed = running(read, [], ["part", "file", "place"], {"start": F.col("n_tokens")})
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")
