import pytest

#: Columns whose names the operators might use themselves.
CLASHING = ("held", "held_out", "seed", "id", "root", "measures", "chance", "topic", "shard", "size", "_gone", "_source", "_doc", "kept")
ODD_TEXTS = [
    None, "", " \n\t ", "one", "Zeile ohne Ende", "a b c d e f g h i j", "a b c d e f g h i j", "日本語 テキスト 🙂 é",
    "x" * 3000, "word " * 4000, "|" * 50, "\n\n\n", "same line\nsame line\nsame line",
]


@pytest.fixture
def texts(spark):
    """A table of documents: given texts, and columns that clash with internal names."""

    def make(values, ids=None, langs=None, sources=None):
        ids = ids or list(range(len(values)))
        rows = [
            (i, t, (langs or ["en", None])[k % len(langs or [0, 0])], (sources or ["s", None])[k % len(sources or [0, 0])], len(t or ""), *["-"] * len(CLASHING))
            for k, (i, t) in enumerate(zip(ids, values))
        ]
        extra = ", ".join(f"`{c}` string" for c in CLASHING)
        return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")

    return make


@pytest.fixture
def odd(texts):
    """NULL, empty, blank, very long, repeated and unusual texts, a repeated row and a row without id."""
    return texts(ODD_TEXTS + [ODD_TEXTS[5], "no id"], ids=[*range(len(ODD_TEXTS)), 5, None])


@pytest.fixture
def empty(texts):
    return texts([])


WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "so", "ta", "vi") for b in ("n", "r", "st", "l", "m", "x")]


@pytest.fixture
def prose():
    """Random texts of made-up words."""

    def make(rnd, words):
        return " ".join(rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(words))

    return make
