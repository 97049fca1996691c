"""ASCII spellings of Latin, Greek and Cyrillic text, and of the many compatibility forms of these letters.

The table is built by rule: a code point is replaced by its Unicode decomposition, marks are left out, and what
remains is spelled by the fixed tables below. A sequence of code points that is canonically equal to a code point of
the table has the spelling of that one, so it goes before the single code points it is made of.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters and punctuation whose ASCII form is not in their decomposition.
LATIN = {
    "Æ": "AE", "Ð": "D", "Ø": "O", "Þ": "Th", "ß": "ss", "æ": "ae", "ð": "d", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "k", "Ł": "L", "ł": "l", "Œ": "OE", "œ": "oe",
    "Ŋ": "NG", "ŋ": "ng", "Ŧ": "T", "ŧ": "t", "ƀ": "b", "ƒ": "f", "ə": "@", "ẞ": "Ss",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "−": "-", "⁄": "/",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‹": "<", "›": ">", "«": "<<", "»": ">>",
    "…": "...", "•": "*", "×": "x", "÷": "/", "©": "(c)", "®": "(r)", "¡": "!", "¿": "?",
}

# Small Greek letters.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
    "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "u", "φ": "ph",
    "χ": "kh", "ψ": "ps", "ω": "o",
}

# Small Cyrillic letters.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
    "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
    "ѐ": "ie", "ё": "io", "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj",
    "њ": "nj", "ћ": "tsh", "ќ": "kj", "ѝ": "i", "ў": "u", "џ": "dzh", "ґ": "g",
}

# Spellings of single letters that their compatibility decomposition would change.
EXCEPTIONS = {"µ": "u"}

#: code points that are looked at: all planes with compatibility forms of these letters
_RANGES = ((0x80, 0x3400), (0xA640, 0xAB70), (0xF900, 0x10000), (0x1D400, 0x1D800), (0x1F100, 0x1F200))
#: private code points that stand for spellings of several letters; in a text they have no meaning and are left out
_MARKS = 0x10F000


def _letters() -> dict[str, str]:
    letters = dict(LATIN)
    for script in (GREEK, CYRILLIC):
        for letter, spelling in script.items():
            letters[letter] = spelling
            if len(capital := letter.upper()) == 1:
                letters.setdefault(capital, spelling.capitalize())
    return letters | EXCEPTIONS


@lru_cache(maxsize=1)
def spellings() -> Mapping[str, str]:
    """ASCII spelling of each code point that has one; combining marks have the empty one."""
    letters = _letters()

    def spelled(text: str) -> str | None:
        out = ""
        for c in text:
            if c in letters:
                out += letters[c]
            elif c.isascii():
                out += c
            elif unicodedata.combining(c):
                continue
            elif (parts := unicodedata.normalize("NFKD", c)) != c and (inner := spelled(parts)) is not None:
                out += inner
            else:
                return None
        return out

    table = {}
    for first, last in _RANGES:
        for c in map(chr, range(first, last)):
            spelling = spelled(c)
            # An accent by itself decomposes to a space and a mark; it is not a space.
            plain = unicodedata.combining(c) or unicodedata.category(c) == "Zs" or (spelling or "").strip()
            if spelling is not None and plain and unicodedata.category(c)[0] != "C":
                table[c] = spelling
    return table


@lru_cache(maxsize=1)
def sequences() -> Mapping[str, str]:
    """Sequences of code points that are spelled otherwise than one by one, and the code point each is equal to."""
    table = spellings()
    parts = {unicodedata.normalize("NFD", c): c for c in table}
    return {
        p: c for p, c in parts.items() if len(p) > 1 and "".join(table.get(x, x) for x in p) != table[c]
    }


def rewritten(text: Column, table: Mapping[str, str], longer: Mapping[str, str]) -> Column:
    """``text`` with each code point of ``table`` replaced by its value, after the sequences ``longer`` have been
    replaced by the code point they stand for, the longest first.

    One pass of ``translate`` does all code points: those with a value of several letters become a private mark,
    and only texts with marks are cut at them and looked up.
    """
    several = sorted({v for v in table.values() if len(v) > 1})
    mark = {v: chr(_MARKS + i) for i, v in enumerate(several)}
    for sequence in sorted(longer, key=len, reverse=True):
        text = F.replace(text, F.lit(sequence), F.lit(longer[sequence]))
    kept = {k: mark.get(v, v) for k, v in table.items() if v}
    gone = [*(k for k, v in table.items() if not v), *mark.values()]
    text = F.translate(text, "".join([*kept, *gone]), "".join(kept.values()))
    if not mark:
        return text
    marks = f"{chr(_MARKS)}-{chr(_MARKS + len(mark) - 1)}"
    lookup = F.create_map(*[F.lit(x) for v, m in mark.items() for x in (m, v)])
    parts = F.regexp_extract_all(text, F.lit(f"[^{marks}]+|[{marks}]"), F.lit(0))
    spelled = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(lookup, p), p)), "")
    return F.when(text.rlike(f"[{marks}]"), spelled).otherwise(text)


def to_ascii(text: Column) -> Column:
    """``text`` with all letters that have an ASCII spelling; pure ASCII skips the work, other scripts stay."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, text).otherwise(rewritten(text, spellings(), sequences()))
