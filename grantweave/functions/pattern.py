"""One regular expression for a whole term dictionary.

Terms share their prefixes in the pattern, so at any word start the regex engine walks one
path instead of trying every term. Optional tails are greedy, which makes the longest term that
ends on a word boundary win; scanning resumes after it.
"""

from __future__ import annotations

from collections.abc import Iterable

# Word characters are ASCII only: an accented letter is a boundary.
NOT_AFTER_WORD = "(?<![A-Za-z0-9_])"
NOT_BEFORE_WORD = "(?![A-Za-z0-9_])"

_END = ""


def never_matches() -> str:
    return "(?!)"


def _literal(char: str) -> str:
    return char if char.isalnum() or char in "_ " or not char.isascii() else "\\" + char


def _render(node: dict) -> str:
    branches = []
    for char in sorted(c for c in node if c != _END):
        literal, child = _literal(char), node[char]
        while len(child) == 1 and _END not in child:
            ((char, child),) = child.items()
            literal += _literal(char)
        branches.append(literal + _render(child))
    if not branches:
        return ""
    if _END in node:
        return f"(?:{'|'.join(branches)})?"
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def term_pattern(terms: Iterable[str]) -> str:
    """Pattern whose leftmost matches are the longest whole-word terms."""
    terms = sorted({t for t in terms if t})
    if not terms:
        return never_matches()
    root: dict = {}
    for term in terms:
        node = root
        for char in term:
            node = node.setdefault(char, {})
        node[_END] = {}
    starts = "".join(_literal(c) for c in sorted(root))
    return f"{NOT_AFTER_WORD}(?=[{starts}]){_render(root)}{NOT_BEFORE_WORD}"
