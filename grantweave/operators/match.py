"""Finding dictionary terms in text: leftmost, longest, whole words, no overlaps.

Two plans give the same hits. A dictionary of up to a few thousand terms becomes one regular
expression, evaluated row by row with no shuffle. A table-sized dictionary is joined to the word
sequences of the text. Hits depend on the text alone, so that join works on distinct texts, named by a
digest, and rows need no id of their own. Terms are matched in lower case, as texts are.

Beyond a broadcast that join is shuffled, and a text has as many sequences as tokens times term lengths. A Bloom filter
of fixed size over the first two words of the terms, each with the term's length, is looked up before sequences
are formed, so about as many are shuffled as there are hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave.functions.pattern import term_pattern
from grantweave.functions.text import concat_text
from grantweave.operators.bloom import block_of, bloom_filter, might_contain
from grantweave.operators.skew import DEFAULT_POLICY, SkewPolicy, balanced_join
from grantweave.operators.terms import pattern_terms, term_pool
from grantweave.session import scratch_path
from grantweave.sources.tables import write_table

COUNT_COLUMNS = ["total_count", "total_unique_count", "flagged"]

#: largest dictionary that is turned into one pattern
MAX_PATTERN_TERMS = 5_000
#: largest dictionary, in characters, that is broadcast in the join plan
MAX_BROADCAST_CHARS = 64 * 1024**2

_TOKENS = r"(?s)[A-Za-z0-9_]+|[^A-Za-z0-9_]"
_WORD = "^[A-Za-z0-9_]"
_DIGEST = "_text_digest"
#: tokens of a term that name its block of the filter: two words and what is between them
_PREFIX_TOKENS = 3


def _hit_columns(hits: Column) -> list[Column]:
    distinct = F.array_distinct(hits)
    return [
        F.size(hits).cast("bigint").alias("total_count"),
        F.size(distinct).cast("bigint").alias("total_unique_count"),
        distinct.alias("flagged"),
    ]


def term_hits(text: Column, terms: Iterable[str]) -> Column:
    """All hits in ``text`` in order, repeats included."""
    return F.regexp_extract_all(text, F.lit(term_pattern(terms)), F.lit(0))


def match_regex(df: DataFrame, text: Column, terms: Iterable[str]) -> DataFrame:
    """``df`` plus the three count columns, by pattern.

    The hits come out of a generator of one row: a later filter on a count then stays above it
    instead of being pushed down with a second copy of the regular expression.
    """
    hits = F.inline(F.array(F.struct(term_hits(text, terms).alias("_hits"))))
    return df.select("*", hits).select(
        *[F.col(f"`{c}`") for c in df.columns], *_hit_columns(F.col("_hits"))
    )


def _tokenised_terms(terms: DataFrame) -> DataFrame:
    tokens = F.regexp_extract_all(F.col("term"), F.lit(_TOKENS), F.lit(0))
    return (
        term_pool(terms)
        .filter("term != ''")
        .select(
            "term",
            F.size(tokens).alias("tokens"),
            F.element_at(tokens, 1).alias("head"),
            F.array_join(F.slice(tokens, 1, _PREFIX_TOKENS), "").alias("prefix"),
        )
    )


def _places(df: DataFrame, id_column: str, text: Column) -> DataFrame:
    """One row per token. The row keeps the token array of its text; within one codegen stage
    that is a reference, so the stages below only take slices where a term may start.

    The outer explode is on purpose: for the inner one Spark adds a filter on the array size,
    which would tokenise each text a second time.
    """
    return df.select(
        F.col(id_column).alias("_id"),
        F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0)).alias("_tokens"),
    ).select("_id", "_tokens", F.posexplode_outer("_tokens").alias("pos", "head"))


def _candidates(places: DataFrame, odd_heads: bool) -> DataFrame:
    """Token sequences of length ``n`` between word boundaries."""
    tokens, pos, n = F.col("_tokens"), F.col("pos"), F.col("n")
    after = F.get(tokens, pos + n)
    fits = (F.size(tokens) >= pos + n) & (after.isNull() | ~after.rlike(_WORD))
    if odd_heads:
        # A word always starts at a boundary; another character does unless a word precedes it.
        before = F.get(tokens, pos - 1)
        fits &= F.col("head").rlike(_WORD) | before.isNull() | ~before.rlike(_WORD)
    return places.filter(fits).select(
        "_id", "pos", "n", F.array_join(F.slice(tokens, pos + 1, n), "").alias("term")
    )


def probable_starts(places: DataFrame, dictionary: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``places`` with each length ``n`` of a term that may start there, told by the filter alone.

    The filter's size is fixed, so it is broadcast whatever the dictionary; places are not shuffled.
    """
    tokens, pos = F.col("_tokens"), F.col("pos")
    blocks = bloom_filter(dictionary, "prefix", "tokens")
    options = []
    for k in range(1, _PREFIX_TOKENS + 1):
        found = [n for n in lengths if (n == k if k < _PREFIX_TOKENS else n >= k)]
        if found:
            prefix = F.when(F.size(tokens) >= pos + k, F.array_join(F.slice(tokens, pos + 1, k), ""))
            options.append(F.struct(prefix.alias("prefix"), F.array(*map(F.lit, found)).alias("ns")))
    looked_up = (
        places.select("*", F.inline(F.array(*options)))
        .filter("prefix is not null")
        .join(F.broadcast(blocks), block_of(F.col("prefix")) == F.col("block"))
    )
    ns = F.filter("ns", lambda n: might_contain(F.col("words"), F.col("prefix"), n))
    return looked_up.select(*places.columns, F.explode(ns).alias("n"))


def _without_overlaps(spans: Column) -> Column:
    """Terms kept when (start, -length, term) spans are taken left to right."""
    start = F.struct(F.lit(0).alias("free"), F.expr("cast(array() as array<string>)").alias("hits"))

    def take(acc: Column, span: Column) -> Column:
        return F.when(
            span["pos"] >= acc["free"],
            F.struct(
                (span["pos"] - span["neg"]).alias("free"),
                F.concat(acc["hits"], F.array(span["term"])).alias("hits"),
            ),
        ).otherwise(acc)

    return F.aggregate(F.array_sort(spans), start, take, lambda acc: acc["hits"])


def match_join(
    df: DataFrame,
    text: Column,
    terms: DataFrame,
    max_broadcast_chars: int = MAX_BROADCAST_CHARS,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``df`` plus the three count columns, by a join with a ``term`` table.

    Equal texts are matched once. The dictionary is stored once, and broadcast only when its measured size
    allows; a larger one meets the text in a shuffled join that splits frequent terms.
    """
    spark = df.sparkSession
    dictionary = write_table(_tokenised_terms(terms), scratch_path(spark, "dictionary"))
    size = dictionary.agg(
        F.sum(F.length("term")).alias("chars"),
        F.bool_or(~F.col("head").rlike(_WORD)).alias("odd_heads"),
        F.sort_array(F.collect_set("tokens")).alias("lengths"),
    ).first()
    if size.chars is None:
        empty = F.expr("cast(array() as array<string>)")
        return df.select("*", *_hit_columns(empty))

    keyed = df.withColumn(_DIGEST, F.sha2(text, 256))
    texts = df.select(F.sha2(text, 256).alias(_DIGEST), text.alias("_text")).filter("_text != ''")
    texts = texts.dropDuplicates([_DIGEST])
    places = _places(texts, _DIGEST, F.col("_text"))
    lookup = dictionary.select("term", F.lit(True).alias("_known"))
    if size.chars <= max_broadcast_chars:
        heads = dictionary.groupBy("head").agg(F.collect_set("tokens").alias("lengths"))
        starts = places.join(F.broadcast(heads), "head").withColumn("n", F.explode("lengths"))
        spans = _candidates(starts, size.odd_heads).join(F.broadcast(lookup), "term")
    else:
        starts = probable_starts(places, dictionary, size.lengths)
        spans = balanced_join(
            _candidates(starts, size.odd_heads),
            lookup,
            ["term"],
            "inner",
            right_unique=True,
            policy=policy,
        )
    hits = (
        spans.groupBy("_id")
        .agg(F.collect_list(F.struct("pos", (-F.col("n")).alias("neg"), "term")).alias("spans"))
        .select(F.col("_id").alias(_DIGEST), _without_overlaps(F.col("spans")).alias("_hits"))
    )
    empty = F.expr("cast(array() as array<string>)")
    # A boilerplate text can hold many rows, so its digest can be a hot key.
    return balanced_join(keyed, hits, [_DIGEST], "left", right_unique=True, policy=policy).select(
        *[F.col(f"`{c}`") for c in df.columns], *_hit_columns(F.coalesce(F.col("_hits"), empty))
    )


def present_columns(df: DataFrame, text_columns: Sequence[str]) -> list[str]:
    return [c for c in text_columns if c in df.columns]


def enrich(
    df: DataFrame,
    text_columns: Sequence[str],
    terms: DataFrame,
    fold_text: bool = False,
    max_pattern_terms: int = MAX_PATTERN_TERMS,
) -> DataFrame:
    """``df`` with ``total_count``, ``total_unique_count`` and ``flagged``.

    Text columns the table lacks are ignored; with none left, ``df`` comes back unchanged.
    """
    columns = present_columns(df, text_columns)
    if not columns:
        return df
    text = concat_text(columns, fold_text)
    listed = pattern_terms(terms, max_pattern_terms)
    if listed is not None:
        return match_regex(df, text, listed)
    return match_join(df, text, terms)
