"""Quality by weak supervision: rules vote or abstain, expectation-maximisation finds how far to trust each.

Every rule looks at one property of a text and votes 1 (good), -1 (bad) or 0 (abstains). A rule that knows a
symptom abstains where it is absent, since that says little. How often each rule is right where it votes, and how
many texts are good, is estimated from the votes alone by expectation-maximisation over the distinct vote patterns,
of which there are at most three to the number of rules whatever the size of the corpus. A text is kept when its posterior probability of being good reaches a threshold.

All steps are Spark SQL expressions. A text is read once: its measures are written, and votes, fit and verdicts
work on those.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanwell.storage import write_scratch

# Function words of the languages at hand.
FUNCTION_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au aux dans de des du elle en est et il la le les ou par pour qui que sur un une "
    "auf das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu "
    "al con del el los las no por para se su una y"
).split()

#: A word is a run of anything but the six ASCII white-space characters.
_WORD, _GAP = r"[^\\x20\\x09-\\x0D]", r"[\\x20\\x09-\\x0D]+"
#: Letters, and one mark at most behind them.
_PLAIN = r"^\\p{L}+[.,;:!?]?$"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where an SQL condition over the measures holds, and abstains elsewhere."""

    name: str
    bad: str
    good: str = "false"


#: Thresholds are shares of the words or characters of a text.
RULES = (
    Rule("symbols", "n_symbols > 0.10 * n_words"),
    Rule("repeated_words", "n_repeat_words > 0.30 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.30 * n_lines"),
    Rule("capitals", "n_capitals > 0.30 * word_chars"),
    Rule("word_length", "word_chars > 12 * n_words or word_chars < 2.5 * n_words"),
    Rule("function_words", "n_function < 0.05 * n_words", "n_function >= 0.12 * n_words"),
    Rule("plain_words", "n_plain < 0.60 * n_words", "n_plain >= 0.85 * n_words"),
    Rule(
        "sentences",
        "n_marks > 0.35 * n_words or (n_marks < 0.01 * n_words and n_words >= 100)",
        "n_marks between 0.05 * n_words and 0.25 * n_words",
    ),
)


@dataclass(frozen=True)
class Fit:
    """The share of good texts, and of each rule how often it is right where it votes."""

    good: float
    accuracies: list[float]


def _bound(value: str, name: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it by name in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def measure_columns(text: str) -> dict[str, str]:
    """SQL of the measures of text ``text``, some of them together in a struct."""
    windows = (
        "sort_array(transform(sequence(0, size(w) - 3), i -> "
        "struct(xxhash64(get(w, i), get(w, i + 1), get(w, i + 2)) AS h, i AS i)))"
    )
    twice = (
        "filter(sequence(0, size(s) - 1), k -> coalesce(get(s, k - 1).h = get(s, k).h, false) "
        "OR coalesce(get(s, k + 1).h = get(s, k).h, false))"
    )
    covered = f"size(array_distinct(flatten(transform({twice}, k -> array(get(s, k).i, get(s, k).i + 1, get(s, k).i + 2)))))"
    repeats = f"CASE WHEN size(w) < 4 THEN 0 ELSE {_bound(windows, 's', covered)} END"
    listed = ", ".join(f"'{w}'" for w in dict.fromkeys(FUNCTION_WORDS))
    lines = f"filter(split({text}, '\\n'), l -> l rlike '{_WORD}')"
    per_words = (
        "struct(size(w) AS n_words, char_length(array_join(w, '')) AS word_chars, "
        f"{repeats} AS n_repeat_words, "
        f"size(filter(w, x -> lower(x) IN ({listed}))) AS n_function, "
        f"size(filter(w, x -> x rlike '{_PLAIN}')) AS n_plain, "
        "size(filter(w, x -> right(x, 1) IN ('.', '!', '?', ':', ';'))) AS n_marks)"
    )
    per_lines = "struct(size(l) AS n_lines, size(l) - size(array_distinct(l)) AS n_dup_lines)"
    return {
        "w": _bound(f"array_remove(split({text}, '{_GAP}'), '')", "w", per_words),
        "l": _bound(lines, "l", per_lines),
        "n_symbols": f"regexp_count({text}, '[#*$%&|<>]')",
        "n_capitals": f"regexp_count({text}, '\\\\p{{Lu}}')",
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_function", "n_plain", "n_marks")


def measure(docs: DataFrame, into: str = "measures") -> DataFrame:
    """``docs`` with a struct column of measures and votes of its ``text``. NULL counts as the empty text.

    Other columns stay as they are; ``into`` must not be one of them.
    """
    inner = ", ".join(f"{v} AS {k}" for k, v in measure_columns("t").items())
    from_text = F.expr(f"transform(array(coalesce(text, '')), t -> struct({inner}))[0]")
    flat = {
        **{k: F.col(f"{into}.w.{k}") for k in ("n_words", "word_chars", "n_repeat_words", "n_function", "n_plain", "n_marks")},
        **{k: F.col(f"{into}.l.{k}") for k in ("n_lines", "n_dup_lines")},
        **{k: F.col(f"{into}.{k}") for k in ("n_symbols", "n_capitals")},
    }
    return docs.withColumn(into, from_text).withColumn(into, F.struct(*[flat[k].cast("long").alias(k) for k in MEASURES]))


def votes(into: str = "measures", rules: tuple[Rule, ...] = RULES) -> Column:
    """The rules' votes as an array, by measures in struct column ``into``. A text without words gets no good vote."""
    out = []
    for rule in rules:
        out.append(f"CASE WHEN m.n_words = 0 THEN 0 WHEN {_on(rule.bad)} THEN -1 WHEN {_on(rule.good)} THEN 1 ELSE 0 END")
    return F.expr(f"transform(array({into}), m -> array({', '.join(out)}))[0]")


def _on(condition: str) -> str:
    for name in MEASURES:
        condition = condition.replace(name, f"m.{name}")
    return condition


def fit(cast: DataFrame, rules: int = len(RULES), rounds: int = 50) -> Fit:
    """Estimate rule accuracies from column ``votes`` of ``cast``, in one Spark job.

    Starts from rules that are right nine times out of ten and adds such votes to every count, worth a thousandth of
    the texts, which keeps the two classes from changing places. A rule is never trusted beyond 0.99 nor below
    0.5. An empty table gives the start.
    """
    counted = F.struct(F.col("votes").alias("v"), F.col("count").cast("double").alias("n"))
    patterns = cast.groupBy("votes").count().agg(F.collect_list(counted).alias("p"))
    odds = "x.v[j] * ln(acc.right[j] / (1 - acc.right[j]))"
    log_odds = f"aggregate(sequence(0, {rules - 1}), ln(acc.good / (1 - acc.good)), (s, j) -> s + {odds})"
    shared = f"transform(p, x -> struct(x.v AS v, x.n AS n, x.n / (1 + exp(-({log_odds}))) AS g))"
    hit = "aggregate(q, 0D, (s, x) -> s + CASE x.v[j] WHEN 1 THEN x.g WHEN -1 THEN x.n - x.g ELSE 0D END)"
    cast_votes = "aggregate(q, 0D, (s, x) -> s + abs(x.v[j]) * x.n)"
    right = f"greatest(0.5D, least(0.99D, ({hit} + 0.9D * k) / ({cast_votes} + k)))"
    update = f"struct((g + 0.8D * k) / (n + k) AS good, transform(sequence(0, {rules - 1}), j -> {right}) AS right)"
    total = "aggregate(q, 0D, (s, x) -> s + x.{0})"
    step = _bound(total.format("g"), "g", _bound("0.001D * n + 1", "k", update))
    step = _bound(shared, "q", _bound(total.format("n"), "n", step))
    first = f"struct(0.8D AS good, array_repeat(0.9D, {rules}) AS right)"
    row = patterns.select(F.expr(f"aggregate(sequence(1, {rounds}), {first}, (acc, i) -> {step})").alias("fit")).first()
    return Fit(row.fit.good, list(row.fit.right))


def posterior(found: Fit, column: str = "votes") -> Column:
    """The probability of a good text, from its votes."""
    weights = ", ".join(repr(math.log(a / (1 - a))) + "D" for a in found.accuracies)
    prior = math.log(found.good / (1 - found.good))
    odds = f"aggregate(zip_with({column}, array({weights}), (v, w) -> v * w), {prior!r}D, (s, x) -> s + x)"
    return F.expr(f"1 / (1 + exp(-({odds})))")


def base_failed(into: str = "measures") -> Column:
    words, repeated = F.col(f"{into}.n_words"), F.col(f"{into}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * words)


def judge(docs: DataFrame, threshold: float = 0.5, into: str = "measures") -> DataFrame:
    """Columns of ``docs`` and a struct ``into`` of measures, votes, posterior, base_failed and kept.

    Texts that fail the base rules are not kept, whatever the votes. Repeated rows each vote. An empty table gives
    an empty table.
    """
    voted = measure(docs, into).withColumn(into, F.col(into).withField("votes", votes(into)))
    voted = write_scratch(voted, "quality-votes")
    found = fit(voted.select(F.col(f"{into}.votes").alias("votes")))
    judged = voted.withColumn(into, F.col(into).withField("posterior", posterior(found, f"{into}.votes")))
    judged = judged.withColumn(into, F.col(into).withField("base_failed", base_failed(into)))
    kept = ~F.col(f"{into}.base_failed") & (F.col(f"{into}.posterior") >= threshold)
    return judged.withColumn(into, F.col(into).withField("kept", kept))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns they came with."""
    into = next(x for x in ("measures" + "_" * k for k in range(100)) if x not in docs.columns)
    return judge(docs, threshold, into).where(f"{into}.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
