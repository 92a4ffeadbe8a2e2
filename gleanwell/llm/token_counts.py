"""Token counts of texts under a unigram segmentation, with one forward pass per shared prefix.

Each word, with the word mark before it, is a pre-token; its segmentation into pieces of a given vocabulary is the one
with the highest sum of scores. The forward scores of a pre-token's prefixes do not depend on what follows, so the
distinct pre-tokens of a block of texts are put into a trie and the scores are computed once per node; where a
pre-token ends, the number of pieces on its best path is kept. The trie is walked in the order of the sorted
pre-tokens, so that only the nodes of one path are held.

The vocabulary is read from a SentencePiece file and never trained. Its pieces come in the order of their use, so a
piece of rank r scores -log(2 + r). A character that no piece holds falls back to one piece per UTF-8 byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanwell.llm.bytesets import prefix_sums, span_hashes, steps, text_bytes, word_spans

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text that share a trie; more where a single text is longer.
BLOCK_BYTES = 6_000_000
#: Score of a byte piece, below every other.
BYTE_SCORE = -20.0


@dataclass(frozen=True)
class Vocabulary:
    """Scores of the pieces, and the lengths of the pieces that end in given two characters (or are one)."""

    scores: dict[str, float]
    lengths: dict[str, tuple[int, ...]]

    @classmethod
    def of(cls, pieces: list[str]) -> Vocabulary:
        """``pieces`` by falling use."""
        scores = {p: -math.log(2 + r) for r, p in reversed(list(enumerate(pieces))) if p}
        ends: dict[str, set[int]] = {}
        for p in scores:
            ends.setdefault(p[-2:], set()).add(len(p))
        return cls(scores, {k: tuple(sorted(v)) for k, v in ends.items()})

    @classmethod
    def read(cls, path: str = VOCABULARY) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [k for k in range(model.get_piece_size()) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))]
        plain.sort(key=lambda k: (-model.get_score(k), k))
        return cls.of([model.id_to_piece(k) for k in plain])


def count_pieces(words: list[str], vocabulary: Vocabulary) -> list[int]:
    """Pieces on the best path of each of the sorted, distinct ``words``. Of equal paths the one with fewer pieces counts."""
    scores, ends = vocabulary.scores, vocabulary.lengths
    # Forward score and pieces at each character of the current path of the trie.
    score, pieces = [0.0], [0]
    before, out = "", []
    for word in words:
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del score[shared + 1 :], pieces[shared + 1 :]
        for at in range(shared + 1, len(word) + 1):
            last = word[at - 1]
            size = len(last.encode())
            best, many = score[at - 1] + size * BYTE_SCORE, pieces[at - 1] + size
            if (alone := scores.get(last)) is not None and score[at - 1] + alone >= best:
                best, many = score[at - 1] + alone, pieces[at - 1] + 1
            if at > 1:
                for n in ends.get(word[at - 2 : at], ()):
                    if n > at:
                        break
                    if (own := scores.get(word[at - n : at])) is not None:
                        total = score[at - n] + own
                        if total > best or (total == best and pieces[at - n] + 1 < many):
                            best, many = total, pieces[at - n] + 1
            score.append(best)
            pieces.append(many)
        out.append(pieces[-1])
        before = word
    return out


def _count(batches: Iterator[pa.RecordBatch], schema: pa.Schema, shared) -> Iterator[pa.RecordBatch]:
    vocabulary = Vocabulary(*shared.value)
    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for a, b in steps(offsets, BLOCK_BYTES):
            part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            starts, ends, words = word_spans(part, bounds)
            _, place, number = np.unique(span_hashes(prefix_sums(part), starts, ends), return_index=True, return_inverse=True)
            whole = part.tobytes()
            distinct = [MARK + whole[starts[k] : ends[k]].decode("utf-8", "replace") for k in place]
            order = sorted(range(len(distinct)), key=distinct.__getitem__)
            counts = np.zeros(len(distinct), np.int64)
            counts[order] = count_pieces([distinct[k] for k in order], vocabulary)
            sums = np.concatenate(([0], np.cumsum(counts[number.reshape(-1)]))) if len(number) else np.zeros(1, np.int64)
            ends_at = np.concatenate(([0], np.cumsum(words)))
            columns = [ids.slice(a, b - a), pa.array(words.astype(np.int64)), pa.array(np.diff(sums[ends_at]))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_words and n_tokens of every text of ``docs`` (doc_id, text).

    White space parts words and is no token. NULL, empty and blank texts have none. Repeated rows are counted alike;
    other columns are ignored; an empty table gives an empty table. No shuffle: what a task shares is its own block.
    """
    result = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    shape = to_arrow_schema(result)
    # The vocabulary file bounds this, not the corpus.
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.scores, vocabulary.lengths))
    return docs.select("doc_id", "text").mapInArrow(lambda it: _count(it, shape, shared), result)
