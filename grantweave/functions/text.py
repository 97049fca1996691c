"""Text clean-up expressions. Everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantweave.functions.translit import to_ascii

# White space in the Unicode sense, at either end of a text.
_EDGES = r"^[\s\p{Z}\x1c-\x1f\x85]++|[\s\p{Z}\x1c-\x1f\x85]++$"

# Cell texts that mean "missing" in the yearly dumps.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, _EDGES, "")


def normalize_key(col: Column | str) -> Column:
    """Join-key spelling: text, stripped, upper case. Null stays null."""
    return F.upper(strip(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")))


def null_tokens(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null where the cell holds one of the missing-value spellings."""
    return F.when(~col.isin(*tokens), col)


def fold_accents(col: Column) -> Column:
    """Latin, Greek and Cyrillic letters in ASCII; rows that are pure ASCII skip the work."""
    return to_ascii(col)


def normalize_keyword(col: Column) -> Column:
    """Dictionary spelling: stripped, lower case, accents folded to ASCII."""
    return fold_accents(F.lower(strip(col)))


def concat_text(columns: Sequence[str], fold_text: bool = False) -> Column:
    """Lower-cased text columns joined by `` | ``; nulls are skipped, all-null gives ``''``."""
    text = F.concat_ws(" | ", *[F.lower(F.col(f"`{c}`").cast("string")) for c in columns])
    return fold_accents(text) if fold_text else text
