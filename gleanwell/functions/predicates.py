"""Boolean tests on URLs and texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.config import (
    CC_URL_PREFIXES,
    LICENSE_TERMS,
    SEARCH_BLOCKED_HOSTS,
    WIKI_DOMAINS,
    WIKI_PREFIXES,
)
from gleanwell.functions import wordtrie
from gleanwell.functions.text import WHITESPACE, as_column, let, sanitize_text

# Longer lists go through one loop over a constant array: an OR of many terms would make
# the generated method too large to be compiled.
MAX_UNROLLED = 12
# From here on a list is one pattern (see ``wordtrie``), whose time does not grow with it.
MIN_PATTERN = 40


def any_of(text: Column, values: Iterable[str], test: Callable[[Column, Column], Column]) -> Column:
    """True if ``test(text, value)`` holds for at least one of the constants."""
    distinct = list(dict.fromkeys(values))
    if not distinct:
        return F.lit(False)
    if len(distinct) <= MAX_UNROLLED:
        return reduce(lambda a, b: a | b, [test(text, F.lit(v)) for v in distinct])
    if len(distinct) >= MIN_PATTERN and "" not in distinct and test in (F.contains, F.startswith, F.endswith):
        return _any_by_pattern(text, distinct, test)
    constants = F.array(*[F.lit(v) for v in distinct])
    return let(text, lambda t: F.exists(constants, lambda v: test(t, v)))


def _any_by_pattern(text: Column, words: list[str], test) -> Column:
    """The same for long lists: one walk down a trie at each position, or at the start or the end alone."""
    if test is F.endswith:
        text, words = F.reverse(text), [w[::-1] for w in words]
    found = wordtrie.pattern(words)
    # The position is asked for because its pattern is handed over as a value; that of RLIKE becomes a Java constant,
    # whose length is limited.
    return F.regexp_instr(text, F.lit(found if test is F.contains else rf"\A{found}")) > 0


def is_http(url: Column | str) -> Column:
    return as_column(url).rlike("(?i)^https?:")


def has_ignored_word(url: Column | str, words: Iterable[str], both_sides: bool = False) -> Column:
    """A word occurs in the lowercased URL.

    The words are taken as written, so one with a capital letter never matches;
    ``both_sides`` trims and lowercases them and the URL as well.
    """
    if both_sides:
        text = sanitize_text(url)
        words = [w.strip(WHITESPACE).lower() for w in words]
    else:
        text = F.lower(as_column(url))
    return any_of(text, words, F.contains)


def has_ignored_extension(url: Column | str, suffixes: Iterable[str], trimmed: bool = False) -> Column:
    """The lowercased URL ends with a suffix, taken as written."""
    text = sanitize_text(url) if trimmed else F.lower(as_column(url))
    return any_of(text, suffixes, F.endswith)


def has_media_extension(url: Column | str, suffixes: Iterable[str]) -> Column:
    text = F.lower(as_column(url))
    return any_of(text, [s.lower() for s in suffixes], F.endswith)


def is_foreign_wiki(
    url: Column | str,
    language_code: str,
    strict: bool = False,
    domains: Iterable[str] = WIKI_DOMAINS,
    prefixes: Iterable[str] = WIKI_PREFIXES,
) -> Column:
    """A wiki page in another language; ``strict`` counts every non-wiki URL as foreign too."""
    text = sanitize_text(url)
    host = F.replace(F.replace(text, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    on_wiki = any_of(text, domains, F.contains)
    wanted = any_of(host, [*prefixes, language_code], F.startswith)
    return F.when(on_wiki, ~wanted).otherwise(F.lit(strict))


def is_search_result(url: Column | str, blocked: Iterable[str] = SEARCH_BLOCKED_HOSTS) -> Column:
    u = as_column(url)
    web = F.startswith(u, F.lit("http:")) | F.startswith(u, F.lit("https:"))
    return web & ~any_of(u, blocked, F.contains)


def is_cc_url(url: Column | str, prefixes: Iterable[str] = CC_URL_PREFIXES) -> Column:
    return any_of(as_column(url), prefixes, F.contains)


def has_license_terms(text: Column | str, terms: Iterable[str] = LICENSE_TERMS) -> Column:
    return any_of(as_column(text), terms, F.contains)
