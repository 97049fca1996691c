"""Spelling variants of a normalised keyword, as one array expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ends_with_any(col: Column, endings: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [col.endswith(e) for e in endings])


def variant_terms(keyword: Column) -> Column:
    """Distinct variants of ``keyword`` (already stripped, lower-cased and folded).

    The keyword itself, its plural, its form without the possessive apostrophe, its
    hyphen-free form and plural, and the regular plural of its punctuation-free form.
    """
    # Letters and digits of any script count as word characters.
    bare = F.regexp_replace(keyword, r"(?U)[^\w\s]", "")
    spaced = F.replace(keyword, F.lit("-"), F.lit(" "))
    has_hyphen = keyword.contains("-")
    takes_ies = bare.endswith("y") & ~_ends_with_any(bare, ("ay", "ey", "oy", "uy"))
    takes_es = _ends_with_any(bare, ("s", "x", "z", "ch", "sh"))

    candidates = F.array(
        keyword,
        F.when(~keyword.endswith("s"), F.concat(keyword, F.lit("s"))),
        F.when(keyword.contains("'s"), F.replace(keyword, F.lit("'s"), F.lit("s"))),
        F.when(has_hyphen, spaced),
        F.when(has_hyphen, F.concat(spaced, F.lit("s"))),
        F.when(F.trim(bare) == "", F.lit(None))
        .when(takes_ies, F.regexp_replace(bare, "y$", "ies"))
        .when(takes_es, F.concat(bare, F.lit("es")))
        .otherwise(F.concat(bare, F.lit("s"))),
    )
    return F.array_distinct(F.filter(candidates, lambda t: t.isNotNull() & (t != "")))
