"""Column expressions shared by the operators."""

from grantweave.functions.pattern import never_matches, term_pattern
from grantweave.functions.text import (
    concat_text,
    fold_accents,
    normalize_key,
    normalize_keyword,
    null_tokens,
)
from grantweave.functions.variants import variant_terms

__all__ = [
    "concat_text",
    "fold_accents",
    "never_matches",
    "normalize_key",
    "normalize_keyword",
    "null_tokens",
    "term_pattern",
    "variant_terms",
]
