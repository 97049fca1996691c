"""A training corpus from raw documents: filter, deduplicate three times, pack.

Every stage takes the rows its predecessor kept. ``run`` writes each stage to the shared folder and reads it back,
so lineage is cut and a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grantweave.llm.exact_dedup import drop_copies
from grantweave.llm.jaccard_join import drop_near_copies
from grantweave.llm.packing import packed
from grantweave.llm.quality import keep_good
from grantweave.llm.substring_dedup import without_repeats
from grantweave.llm.tables import stored, table

#: near copies share this percent of their shingles of so many words; ``op4_jaccard_join`` has limits of its own
NEAR_WIDTH = 5
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    return drop_near_copies(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the text."""
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: SQL has no zstandard, tokens or curve; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
