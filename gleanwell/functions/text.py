"""Text helpers: whitespace, script detection, entity decoding, number formatting."""

from __future__ import annotations

import html as _html
from collections.abc import Callable, Iterable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanwell.config import KANNADA_RANGE, TAMIL_RANGE
from gleanwell.functions import sqltext as sql

# Characters that count as whitespace when text is stripped or split.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_NOT_WS = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (Spark's ``trim`` drops spaces only)."""
    return F.trim(as_column(col), F.lit(WHITESPACE))


def rstrip(col: Column | str) -> Column:
    return F.rtrim(as_column(col), F.lit(WHITESPACE))


def strip_sql(text: str) -> str:
    return f"trim(BOTH {sql.chars(WHITESPACE)} FROM {text})"


def sanitize_text(col: Column | str) -> Column:
    return F.lower(strip(col))


def has_script(col: Column | str, lo: str, hi: str, name: str, whole_word: bool = True) -> Column:
    """True if the text has a word in the script ``lo``–``hi`` or names the language.

    ``whole_word`` asks for a whitespace-delimited token written fully in the script;
    otherwise a single letter of it is enough.
    """
    text = as_column(col)
    letter = f"[{lo}-{hi}]"
    # A letter is looked for first; most texts have none and are done.
    word = f"{letter}(?<!{_NOT_WS}{letter}){letter}*+(?!{_NOT_WS})"
    return text.rlike(word if whole_word else letter) | F.contains(F.lower(text), F.lit(name))


def has_kannada(col: Column | str) -> Column:
    return has_script(col, *KANNADA_RANGE, name="kannada")


def has_tamil(col: Column | str) -> Column:
    return has_script(col, *TAMIL_RANGE, name="tamil", whole_word=False)


# --- character references ---------------------------------------------------

_STRICT_REF = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
_LENIENT_REF = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _table(pairs: Iterable[tuple[object, str]]) -> str:
    return "\x01" + "\x01".join(f"{name}\x02{text}" for name, text in pairs) + "\x01"


def _table_entry(table: str, name: str) -> str:
    """Text stored under ``name`` in a constant table, or NULL."""
    found = f"substring({table}, at + length({name}) + 2, 8)"
    return sql.let(
        f"instr({table}, concat('\x01', {name}, '\x02'))",
        "at",
        f"CASE WHEN at > 0 THEN substring_index({found}, '\x01', 1) END",
    )


def _named_entry(name: str) -> str:
    """Text of a named reference. The names are split by initial, so that a search is short."""
    by_initial: dict[str, list] = {}
    for n, t in html5.items():
        # "&apos;" has a case of its own below, as its text would end the literal.
        if n.endswith(";") and n != "apos;":
            by_initial.setdefault(n[0], []).append((n, t))
    cases = " ".join(f"WHEN '{i}' THEN {sql.lit(_table(pairs))}" for i, pairs in by_initial.items())
    return sql.let(f"CASE left({name}, 1) {cases} END", "tbl", _table_entry("tbl", name))


_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_BARE = sql.lit(_table((n, html5[n]) for n in _BARE_NAMES))
# Code points below 0xA0 that a numeric reference does not stand for literally.
_REMAPPED = sql.lit(_table((n, t) for n, t in ((n, _html.unescape(f"&#{n};")) for n in range(0xA0)) if t != chr(n)))


def _numeric(ref: str) -> str:
    point = (
        f"cast(CASE WHEN lower({ref}) LIKE '&#x%' "
        f"THEN conv(nullif(regexp_extract({ref}, r'^&#[xX]0*([0-9a-fA-F]{{1,6}});?$', 1), ''), 16, 10) "
        f"ELSE nullif(regexp_extract({ref}, r'^&#0*([0-9]{{1,7}});?$', 1), '') END AS int)"
    )
    literal = "decode(unhex(lpad(hex(p), 8, '0')), 'UTF-32')"
    text = (
        "CASE WHEN p IS NULL OR p > 1114111 OR p BETWEEN 55296 AND 57343 THEN '�' "
        f"WHEN p < 160 THEN coalesce({_table_entry(_REMAPPED, 'cast(p AS string)')}, {literal}) "
        "WHEN p BETWEEN 64976 AND 65007 OR (p & 65534) = 65534 THEN '' "
        f"ELSE {literal} END"
    )
    return sql.let(point, "p", text)


def _decode_ref(ref: str, lenient: bool) -> str:
    """One reference, ``&`` included, to the text it stands for."""
    named = sql.let(f"substring({ref}, 2)", "nm", _named_entry("nm"))
    rest = f"coalesce({named}, {ref})"
    if lenient:
        # Old names are understood without a semicolon too, also as a prefix of a longer word.
        prefix = f"regexp_extract({ref}, r'^&({'|'.join(_BARE_NAMES)})', 1)"
        bare = f"CASE WHEN n <> '' THEN concat({_table_entry(_BARE, 'n')}, substring({ref}, length(n) + 2)) END"
        exact = f"CASE WHEN endswith({ref}, ';') THEN {named} END"
        rest = f"coalesce({exact}, {sql.let(prefix, 'n', bare)}, {ref})"
    return (
        f"CASE {ref} WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' "
        f"WHEN '&quot;' THEN '\"' WHEN '&apos;' THEN '\\u0027' WHEN '&nbsp;' THEN '\\u00a0' "
        f"ELSE CASE WHEN {ref} LIKE '&#%' THEN {_numeric(ref)} ELSE {rest} END END"
    )


def decode_entities_sql(text: str, lenient: bool = True) -> str:
    pattern = sql.lit(_LENIENT_REF if lenient else _STRICT_REF)
    refs = f"transform(regexp_extract_all(e, {pattern}, 0), ref -> {_decode_ref('ref', lenient)})"
    pieces = f"zip_with(split(e, {pattern}, -1), concat({refs}, array('')), (b, d) -> concat(b, d))"
    # Most texts hold the commonest references only, which plain replacement handles; with
    # the ampersand last, nothing is decoded twice.
    easy = "replace(replace(replace(replace(e, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&nbsp;', '\\u00a0')"
    other = sql.lit("&(?!amp;)(?:#|[A-Za-z])" if lenient else "&(?!amp;)(?:#|[A-Za-z][A-Za-z0-9]*;)")
    simple = sql.let(
        easy, "y", f"CASE WHEN y RLIKE {other} THEN array_join({pieces}, '') ELSE replace(y, '&amp;', '&') END"
    )
    return sql.let(text, "e", f"CASE WHEN contains(e, '&') THEN {simple} ELSE e END")


def decode_entities(text: str, lenient: bool = True) -> Column:
    """Replace HTML character references.

    ``lenient`` follows the rules for free text (old names need no semicolon); strict is
    what a parser does inside attribute values and text nodes.
    """
    return F.expr(decode_entities_sql(text, lenient))


# --- numbers ----------------------------------------------------------------


def round_exact(col: Column | str, digits: int = 3) -> Column:
    """Round a double on its exact binary value, ties to even.

    ``F.round`` works on the decimal text of the double, so 60.03/60 becomes 1.001 there
    although the stored value lies below the tie. Here the scaled product is kept as an
    unevaluated sum ``p + err`` (Dekker's product), which decides such cases exactly. The
    value is named several times: give a column, not a long expression.
    """
    x = as_column(col).cast("double")
    scale = float(10**digits)
    split_at = 134217729.0  # 2**27 + 1
    sh = scale * split_at - (scale * split_at - scale)
    sl = scale - sh
    p = x * F.lit(scale)
    big = x * F.lit(split_at)
    xh = big - (big - x)
    xl = x - xh
    err = xl * F.lit(sl) - (((p - xh * F.lit(sh)) - xl * F.lit(sh)) - xh * F.lit(sl))
    base = F.floor(p)
    side = (p - (base.cast("double") + F.lit(0.5))) + err
    up = F.when(side > 0, 1).when(side < 0, 0).otherwise(F.pmod(base, F.lit(2)))
    return F.when(F.abs(p) < F.lit(2.0**52), (base + up).cast("double") / F.lit(scale)).otherwise(x)


def float_text(col: Column | str) -> Column:
    """A double as plain decimal text, also where Spark's cast would use an exponent."""
    x = as_column(col).cast("double")
    plain = x.cast("string")
    digits = F.rtrim(x.cast("decimal(38,21)").cast("string"), F.lit("0"))
    fixed = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    in_range = (F.abs(x) >= 1e-4) & (F.abs(x) < 1e16)
    return F.when(F.contains(plain, F.lit("E")) & in_range, fixed).otherwise(plain)
