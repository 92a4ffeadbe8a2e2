"""Against a plain Viterbi pass per word."""

import os
import random
import re

import pytest

from gleanwell.llm.token_counts import BYTE_SCORE, MARK, VOCABULARY, Vocabulary, count_pieces, count_tokens

PIECES = [MARK, "a", "b", MARK + "a", "ab", "ba", "aba", MARK + "ab", "bb", "c", "abc", MARK + "é"]


def plain(word, vocabulary):
    best = [(0.0, 0)] + [(-1e18, 0)] * len(word)
    for end in range(1, len(word) + 1):
        size = len(word[end - 1].encode())
        options = [(best[end - 1][0] + size * BYTE_SCORE, -(best[end - 1][1] + size))]
        for start in range(end):
            if (own := vocabulary.scores.get(word[start:end])) is not None:
                options.append((best[start][0] + own, -(best[start][1] + 1)))
        score, many = max(options)
        best[end] = score, -many
    return best[-1][1]


def test_shared_prefixes_give_the_counts_of_single_words():
    rnd = random.Random(3)
    vocabulary = Vocabulary.of(PIECES)
    words = sorted({MARK + "".join(rnd.choice("abcé☃") for _ in range(rnd.randrange(1, 12))) for _ in range(300)})
    assert count_pieces(words, vocabulary) == [plain(w, vocabulary) for w in words]


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="vocabulary files are not here")
def test_file(texts, prose, odd, empty):
    vocabulary = Vocabulary.read()
    rnd = random.Random(4)
    values = [prose(rnd, 12) for _ in range(20)] + ["Straße ☃☃", None]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in count_tokens(texts(values), vocabulary).collect()}
    for k, text in enumerate(values):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert got[k] == (len(words), sum(plain(MARK + w, vocabulary) for w in words))
    assert count_tokens(odd, vocabulary).count() == odd.count()
    assert count_tokens(empty, vocabulary).count() == 0
