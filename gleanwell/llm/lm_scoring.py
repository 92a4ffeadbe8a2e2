"""Language-model scoring with a weighted backoff automaton.

The model is a bigram model with three-step absolute discounts over an add-half unigram model, written as an
automaton: the root holds one arc per known token, each context seen in training is a state with an arc per
follower seen there, and every state has a failure arc to the root whose weight is the mass its discounts set
free. A text is read from left to right, once; each token takes an arc of the current state or fails to the root
first, adds the weights it meets, and leads to the state of the token just read.

The automaton grows with the corpus and is on no machine as a whole. The corpus is cut into blocks of some
million tokens; a block asks, grouped by hash range of the context, for just those arcs its own texts can take, and
gets back their counts in the order it asked, so no keys travel back. Contexts with a large share of the tokens are
dealt by follower instead, so that no range holds all pairs of "the".

Tokens are told apart by 64-bit hashes, followers of one context by ``PAIR_BYTES`` bytes of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gleanwell.llm.bytesets import (
    lower_ascii,
    mixed,
    pack,
    prefix_sums,
    smallest_int,
    span_hashes,
    steps,
    text_bytes,
    unpack,
    word_spans,
)
from gleanwell.llm.frames import partitions
from gleanwell.storage import write_scratch

#: Tokens of a block; a longer text is a block of its own.
BLOCK_TOKENS = 1_200_000
#: A context with at least this share of the tokens of some block is dealt by follower.
HOT_SHARE = 1 / 1024
#: At most so many contexts are dealt by follower: the largest. Which ones they are changes no result.
MOST_HOT = 4096
PAIR_BYTES = 6
#: Hashes of the two tokens that are no words: the end of a text, and what stands before its first token.
END, START = np.uint64(1), np.uint64(0)

_U = np.uint64
_ANSWERS = (
    "block string, range int, totals binary, near binary, free binary, far binary, n bigint, v bigint, "
    "many array<bigint>, hot array<struct<word:bigint,one:bigint,two:bigint,more:bigint>>"
)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> _U(32)) * _U(ranges) >> _U(32)).astype(np.int64)


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, block_tokens: int) -> Iterator[pa.RecordBatch]:
    """Texts as sequences of block-local token numbers. Numbers follow the order of the tokens' hashes."""
    held_back: list[tuple] = []
    kept, made = 0, 0

    def flush() -> pa.RecordBatch:
        nonlocal made
        hashes = np.concatenate([x[3] for x in held_back])
        vocab, ids = np.unique(hashes, return_inverse=True)
        shares = np.bincount(ids, minlength=len(vocab))
        hot = np.flatnonzero(shares >= max(2, HOT_SHARE * len(ids)))
        made += 1
        row = {
            "block": [f"{TaskContext.get().partitionId()}-{made}"],
            "doc_id": [np.concatenate([x[0] for x in held_back]).tolist()],
            "held": [np.concatenate([x[1] for x in held_back]).tolist()],
            "lengths": [pack(smallest_int(np.concatenate([x[2] for x in held_back])))],
            "vocab": [pack(vocab)],
            "ids": [pack(smallest_int(ids.reshape(-1)))],
            "hot": [pack(np.concatenate((vocab[hot], shares[hot].astype(_U))))],
        }
        held_back.clear()
        return pa.RecordBatch.from_pydict(row, schema=schema)

    for batch in batches:
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        doc_id = np.array(batch.column(batch.schema.get_field_index("doc_id")).to_pylist(), dtype=object)
        held = np.array(batch.column(batch.schema.get_field_index("held")).to_pylist(), dtype=bool)
        for a, b in steps(offsets):
            part = lower_ascii(data[offsets[a] : offsets[b]])
            bounds = offsets[a : b + 1] - offsets[a]
            starts, ends, words = word_spans(part, bounds)
            lengths = words + 1
            hashes = np.full(int(lengths.sum()), END, _U)
            places = np.arange(len(starts)) + np.repeat(np.arange(b - a), words)
            hashes[places] = np.maximum(span_hashes(prefix_sums(part), starts, ends), _U(2))
            held_back.append((doc_id[a:b], held[a:b], lengths, hashes))
            kept += len(hashes)
            if kept >= block_tokens:
                yield flush()
                kept = 0
    if held_back:
        yield flush()


class _Arcs:
    """The distinct (context, token) pairs of one block, in the order in which it asks for them.

    Pairs of ordinary contexts come first, by (context, token); those of hot contexts follow, by (range of the
    token, context, token). ``words`` ends with START, which is a context only and always hot.
    """

    def __init__(self, row, ranges: int, hot: np.ndarray):
        vocab = unpack(row.vocab)
        self.size = len(vocab)
        self.ids = unpack(row.ids).astype(np.int64)
        self.lengths = unpack(row.lengths).astype(np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.held = np.asarray(row.held, bool)
        self.training = ~np.repeat(self.held, self.lengths)
        self.before = np.empty_like(self.ids)
        self.before[1:] = self.ids[:-1]
        self.before[self.first] = self.size
        self.words = np.append(vocab, START)
        self.range = _range_of(self.words, ranges)
        far = np.append(np.isin(vocab, hot), True)[self.before]
        span = _U(self.size + 1)
        pair = self.before.astype(_U) * span + self.ids.astype(_U)
        near_keys, near_at = np.unique(pair[~far], return_inverse=True)
        far_keys, far_at = np.unique(
            self.range[self.ids[far]].astype(_U) * (span * span) + pair[far], return_inverse=True
        )
        far_keys = far_keys % (span * span)
        self.near = (near_keys // span).astype(np.int64), (near_keys % span).astype(np.int64)
        self.far = (far_keys // span).astype(np.int64), (far_keys % span).astype(np.int64)
        self.at = np.empty(len(self.ids), np.int64)
        self.at[~far] = near_at.reshape(-1)
        self.at[far] = far_at.reshape(-1) + len(near_keys)


def _ask(frames: Iterator[pd.DataFrame], ranges: int, hot: np.ndarray) -> Iterator[pd.DataFrame]:
    """For each block and hash range: its tokens, its pairs, and how often each stands in training texts."""
    for frame in frames:
        for row in frame.itertuples():
            arcs = _Arcs(row, ranges, hot)
            n_near = len(arcs.near[0])
            pairs = np.bincount(arcs.at[arcs.training], minlength=n_near + len(arcs.far[0]))
            tokens = np.bincount(arcs.ids[arcs.training], minlength=arcs.size)
            followers = np.bincount(arcs.near[0], minlength=arcs.size)
            of_token = np.searchsorted(arcs.range[:-1], np.arange(ranges + 1))
            of_near = np.concatenate(([0], np.cumsum(followers)))[of_token]
            of_far = np.searchsorted(arcs.range[arcs.far[1]], np.arange(ranges + 1))
            out = []
            for q in range(ranges):
                (a, b), (c, d), (e, f) = of_token[q : q + 2], of_near[q : q + 2], of_far[q : q + 2]
                if a == b and e == f:
                    continue
                tails = arcs.words[arcs.near[1][c:d]].view(np.uint8).reshape(-1, 8)[:, :PAIR_BYTES]
                out.append(
                    {
                        "block": row.block,
                        "range": q,
                        "words": pack(arcs.words[a:b]),
                        "tokens": pack(smallest_int(tokens[a:b])),
                        "followers": pack(smallest_int(followers[a:b])),
                        "tails": np.ascontiguousarray(tails).tobytes(),
                        "near": pack(smallest_int(pairs[c:d])),
                        "far_words": pack(arcs.words[arcs.far[0][e:f]]),
                        "far_tails": pack(arcs.words[arcs.far[1][e:f]]),
                        "far": pack(smallest_int(pairs[n_near + e : n_near + f])),
                    }
                )
            yield pd.DataFrame(out)


_ASKED = (
    "block string, range int, words binary, tokens binary, followers binary, tails binary, near binary, "
    "far_words binary, far_tails binary, far binary"
)


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct key the total count and a place where it stands, and for each key its number."""
    _, place, number = np.unique(keys, return_index=True, return_inverse=True)
    return np.bincount(number.reshape(-1), counts, len(place)).astype(np.int64), place, number.reshape(-1)


def _by_count(owner: np.ndarray, totals: np.ndarray, size: int) -> np.ndarray:
    """For each owner: how many of its pairs were seen once, twice, and more often."""
    return np.stack([np.bincount(owner[x], minlength=size) for x in (totals == 1, totals == 2, totals > 2)])


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts for one range, to each block in the order in which it asked."""
    words = [unpack(x) for x in asked.words]
    vocab, number = np.unique(np.concatenate(words), return_inverse=True)
    totals = np.bincount(number.reshape(-1), np.concatenate([unpack(x) for x in asked.tokens]), len(vocab)).astype(np.int64)
    context = np.repeat(number.reshape(-1), np.concatenate([unpack(x) for x in asked.followers]))
    tails = np.frombuffer(b"".join(map(bytes, asked.tails)), np.uint8).reshape(-1, PAIR_BYTES)
    wide = np.zeros((len(tails), 8), np.uint8)
    wide[:, :PAIR_BYTES] = tails
    near_counts = [unpack(x) for x in asked.near]
    near, place, near_at = _totals(mixed(mixed(context.astype(_U)) + wide.view(_U).reshape(-1)), np.concatenate(near_counts))
    free = _by_count(context[place], near, len(vocab))
    far_words = np.concatenate([unpack(x) for x in asked.far_words])
    far_counts = [unpack(x) for x in asked.far]
    far_keys = mixed(mixed(far_words) + np.concatenate([unpack(x) for x in asked.far_tails]))
    far, far_place, far_at = _totals(far_keys, np.concatenate(far_counts))
    hot, hot_owner = np.unique(far_words[far_place], return_inverse=True)
    hot_free = _by_count(hot_owner.reshape(-1), far, len(hot))
    both = np.concatenate((near, far))
    out, at = [], [0, 0, 0]
    number = number.reshape(-1)
    for k, block in enumerate(asked.block):
        to = [at[0] + len(words[k]), at[1] + len(near_counts[k]), at[2] + len(far_counts[k])]
        mine = number[at[0] : to[0]]
        out.append(
            {
                "block": block,
                "range": asked.range[0],
                "totals": pack(smallest_int(totals[mine])),
                "near": pack(smallest_int(near[near_at[at[1] : to[1]]])),
                "free": pack(smallest_int(free[:, mine].reshape(-1))),
                "far": pack(smallest_int(far[far_at[at[2] : to[2]]])),
            }
        )
        at = to
    out.append(
        {
            "range": asked.range[0],
            "n": int(totals.sum()),
            "v": int((totals > 0).sum()),
            "many": [int((both == k).sum()) for k in (1, 2, 3, 4)],
            "hot": [
                {"word": int(w), "one": int(a), "two": int(b), "more": int(c)}
                for w, a, b, c in zip(hot.view(np.int64), *hot_free, strict=True)
            ],
        }
    )
    frame = pd.DataFrame(out, columns=["block", "range", "totals", "near", "free", "far", "n", "v", "many", "hot"])
    return frame.astype(object).where(frame.notna(), None)


def discounts(many: list[int]) -> np.ndarray:
    """What to take from pairs seen once, twice, and more often, from how many pairs were seen 1 to 4 times."""
    n1, n2, n3, n4 = (max(float(x), 0.5) for x in many)
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(out, 0.05, [1.0, 2.0, 3.0])


def _walk(arcs: _Arcs, answers: pd.DataFrame, n: int, v: int, taken: np.ndarray, hot: dict) -> pd.DataFrame:
    """The scores of a block's texts.

    The state after a token is the token's own, so the arc taken at each place of all texts is known at once; the
    weights are then added from left to right, text by text.
    """
    answers = answers.sort_values("range")

    def joined(name: str) -> np.ndarray:
        return np.concatenate([unpack(x) for x in answers[name]]).astype(np.int64)

    totals = joined("totals")
    free = np.concatenate([unpack(x).reshape(3, -1) for x in answers.free], axis=1).astype(np.float64)
    seen = np.concatenate((joined("near"), joined("far")))
    contexts = np.append(totals, totals[np.searchsorted(arcs.words[:-1], END)])
    free = np.append(free, np.zeros((3, 1)), axis=1)
    for k in np.flatnonzero(np.isin(arcs.words, np.fromiter(hot, _U, len(hot)))):
        free[:, k] += hot[int(arcs.words[k])]
    # The root's arcs, the failure arcs, and the arcs of the other states.
    root = np.log10((totals + 0.5) / (n + 0.5 * (v + 1)))
    with np.errstate(divide="ignore", invalid="ignore"):
        freed = np.where(contexts > 0, taken @ free / np.maximum(contexts, 1), 1.0)
        failure = np.log10(freed)
        state = np.concatenate((arcs.near[0], arcs.far[0]))
        token = np.concatenate((arcs.near[1], arcs.far[1]))
        kept = (seen - taken[np.clip(seen, 1, 3) - 1]) / np.maximum(contexts[state], 1)
        weight = np.where(seen > 0, np.log10(np.maximum(kept, 0) + freed[state] * 10 ** root[token]), failure[state] + root[token])
    return pd.DataFrame(
        {
            "n_tokens": arcs.lengths,
            "n_known": np.add.reduceat((totals > 0)[arcs.ids].astype(np.int64), arcs.first),
            "base_score": np.add.reduceat(root[arcs.ids], arcs.first),
            "score": np.add.reduceat(weight[arcs.at], arcs.first),
        }
    )


def score_texts(docs: DataFrame, held_out, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Score every text of ``docs`` (doc_id, text) with a model of those where ``held_out`` is false.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams), score (the automaton), the
    scores as log10 probabilities. A NULL text counts as empty: one end token. Repeated rows are texts of their
    own, in training too. Rows where ``held_out`` is NULL are training texts. An empty table gives an empty table;
    without a training text every token has the same probability. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    rows = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("doc_id", T.ArrayType(kind)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            *[T.StructField(x, T.BinaryType()) for x in ("lengths", "vocab", "ids", "hot")],
        ]
    )
    shape = to_arrow_schema(rows)
    texts = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = write_scratch(texts.mapInArrow(lambda it: _cut(it, shape, block_tokens), rows), "lm-blocks")

    shares = blocks.select("hot").mapInPandas(_hot_rows, "word bigint, share bigint").groupBy("word").agg(F.sum("share").alias("share"))
    hot = np.array([r.word for r in shares.orderBy(F.desc("share"), "word").limit(MOST_HOT).collect()], np.int64).view(_U)
    tokens = blocks.select(F.sum(F.length("ids"))).first()[0] or 0
    ranges = max(partitions(spark), int(tokens // (2 * block_tokens)))

    asked = blocks.select("block", "held", "lengths", "vocab", "ids").mapInPandas(lambda it: _ask(it, ranges, hot), _ASKED)
    answers = write_scratch(asked.groupBy("range").applyInPandas(_answer, _ANSWERS), "lm-answers")
    facts = answers.agg(
        F.sum("n").alias("n"), F.sum("v").alias("v"), *[F.sum(F.col("many")[k]).alias(f"m{k}") for k in range(4)]
    ).first()
    n, v = int(facts.n or 0), int(facts.v or 0)
    taken = discounts([facts[f"m{k}"] or 0 for k in range(4)])
    parts = answers.select(F.explode("hot").alias("h")).groupBy("h.word").agg(*[F.sum(f"h.{x}").alias(x) for x in ("one", "two", "more")])
    # At most MOST_HOT contexts and START.
    free = {r.word % 2**64: np.array([r.one, r.two, r.more], float) for r in parts.collect()}
    result = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(x, T.LongType()) for x in ("n_tokens", "n_known", "train_tokens")],
            *[T.StructField(x, T.DoubleType()) for x in ("base_score", "score")],
        ]
    )

    def walk(block: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        row = next(block.itertuples())
        arcs = _Arcs(row, ranges, hot)
        out = _walk(arcs, answer, n, v, taken, free)
        out.insert(0, "doc_id", pd.Series(list(row.doc_id), dtype=object))
        out.insert(1, "held_out", arcs.held)
        out.insert(4, "train_tokens", n)
        return out

    sequences = blocks.select("block", "doc_id", "held", "lengths", "ids", "vocab")
    replies = answers.where("block IS NOT NULL").select("block", "range", "totals", "near", "free", "far")
    return sequences.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(walk, result)


def _hot_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for blob in frame.hot:
            words, shares = unpack(blob).reshape(2, -1)
            yield pd.DataFrame({"word": words.view(np.int64), "share": shares.astype(np.int64)})
