"""Expressions written as SQL text.

The longer markup and URL rules name dozens of functions. As text they reach Spark in one
piece and are parsed there; built call by call from Python they would take seconds to
assemble. Arguments are SQL expressions, of which a column name is the simplest.
"""

from __future__ import annotations


def lit(value: str) -> str:
    """A string literal; backslashes stay as they are."""
    if "'" in value:
        raise ValueError("write a quote inside a pattern as \\x27")
    return f"r'{value}'"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def chars(text: str) -> str:
    """A literal of any characters, by code point."""
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


NO_TEXTS = "cast(array() as array<string>)"
