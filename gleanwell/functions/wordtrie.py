"""Long lists of words as one pattern.

The words form a trie, and the trie one regular expression: a position of the text is walked down the trie once,
however many words there are. A node with many children is split in halves by character range, so that a step looks at a
few of them. A word that begins with another is left out, as the shorter one decides.
"""

from __future__ import annotations

from collections.abc import Iterable

_WIDE = 4


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 else f"\\x{{{ord(c):x}}}" for c in text)


def _code(c: str) -> str:
    return f"\\x{{{ord(c):x}}}"


def _shared(words: list[str], at: int) -> int:
    """Where sorted words that agree up to ``at`` first differ."""
    first, last = words[0], words[-1]
    end = at
    while end < min(len(first), len(last)) and first[end] == last[end]:
        end += 1
    return end


def _node(words: list[str], at: int) -> str:
    """Pattern for what follows position ``at`` of sorted words, none of which begins another."""
    end = _shared(words, at)
    head = _quoted(words[0][at:end])
    if len(words) == 1:
        return head
    children, start = [], 0
    for k in range(1, len(words) + 1):
        if k == len(words) or words[k][end] != words[start][end]:
            children.append((words[start][end], words[start:k]))
            start = k
    return head + _choice(children, end)


def _choice(children: list[tuple[str, list[str]]], at: int) -> str:
    if len(children) <= _WIDE:
        return "(?:" + "|".join(_node(own, at) for _, own in children) + ")"
    half = len(children) // 2
    parts = (children[:half], children[half:])
    ranged = [f"(?=[{_code(part[0][0])}-{_code(part[-1][0])}]){_choice(part, at)}" for part in parts]
    return "(?:" + "|".join(ranged) + ")"


def pattern(words: Iterable[str]) -> str:
    """A regular expression that matches where one of the (non-empty) words begins."""
    kept: list[str] = []
    for word in sorted(set(words)):
        if not (kept and word.startswith(kept[-1])):
            kept.append(word)
    return _node(kept, 0)
