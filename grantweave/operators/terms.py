"""The keyword dictionary: normalised keywords, spelling variants, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.functions.text import normalize_keyword
from grantweave.functions.variants import variant_terms


def text_table(spark: SparkSession, **columns: Sequence[str]) -> DataFrame:
    """A small table of text columns. As Arrow data it is part of the plan and needs no tasks."""
    schema = pa.schema([(name, pa.string()) for name in columns])
    return spark.createDataFrame(pa.table({n: list(v) for n, v in columns.items()}, schema))


def keyword_table(spark: SparkSession, keywords: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(category, keyword)`` from the configured lists."""
    rows = [(category, k) for category, ks in keywords.items() for k in ks]
    return text_table(spark, category=[r[0] for r in rows], keyword=[r[1] for r in rows])


def english_stopwords(spark: SparkSession) -> DataFrame:
    """Spark's own English stopword list as a ``word`` table."""
    return text_table(spark, word=StopWordsRemover.loadDefaultStopWords("english"))


def remove_stopwords(keywords: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Drop keywords that, normalised, equal a stopword; a stopword inside a phrase stays."""
    return keywords.join(
        stopwords.select("word").distinct(),
        normalize_keyword(F.col("keyword")) == F.col("word"),
        "left_anti",
    )


def expand_terms(keywords: DataFrame, stopwords: DataFrame | None = None) -> DataFrame:
    """Distinct ``(category, term)``: every spelling variant of every kept keyword."""
    # Equal keywords are merged before they are looked up and expanded.
    distinct = keywords.select(
        "category", normalize_keyword(F.col("keyword")).alias("keyword")
    ).distinct()
    if stopwords is not None:
        distinct = remove_stopwords(distinct, stopwords)
    variants = F.explode(variant_terms(F.col("keyword"))).alias("term")
    return distinct.select("category", variants).distinct()


def term_pool(terms: DataFrame) -> DataFrame:
    """The terms of all categories in lower case, each once."""
    return terms.select(F.lower("term").alias("term")).distinct()


def dictionary_stats(terms: DataFrame) -> DataFrame:
    """Terms per category and over all categories (``category = 'pool'``)."""
    per_category = (
        terms.select("category", "term")
        .distinct()
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("terms"))
    )
    pool = term_pool(terms).agg(F.count(F.lit(1)).alias("terms"))
    return per_category.unionByName(pool.select(F.lit("pool").alias("category"), "terms"))


def pattern_terms(terms: DataFrame, limit: int) -> list[str] | None:
    """The term pool on the driver if it has at most ``limit`` terms, else ``None``."""
    rows = term_pool(terms).limit(limit + 1).collect()
    return None if len(rows) > limit else sorted(r.term for r in rows)
