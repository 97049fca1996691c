"""Coverage statistics over enriched rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave.session import scratch_path
from grantweave.sources.tables import write_table

#: bits of a distinct sketch's registers: 2 % standard error; items of a quantile sketch: about 1 % of rank
DISTINCT_BITS = 12
QUANTILE_ITEMS = 200


def dimensions(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns")
    )


def enrichment_stats(df: DataFrame) -> DataFrame:
    """One row of hit figures; shares are null for an empty table."""
    n, total = F.count(F.lit(1)), F.col("total_count")

    def share(part: Column) -> Column:
        return F.round(F.try_divide(part, n) * 100, 2)

    hit, miss = F.count_if(total > 0), F.count_if(total == 0)
    return df.agg(
        n.alias("total_rows_processed"),
        F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total_keyword_hits"),
        F.round(F.avg(total), 2).alias("avg_hits_per_row"),
        F.round(F.avg("total_unique_count"), 2).alias("avg_unique_per_row"),
        hit.alias("rows_with_hits"),
        share(hit).alias("rows_with_hits_pct"),
        miss.alias("rows_without_hits"),
        share(miss).alias("rows_without_hits_pct"),
        F.count_if(F.size("flagged") > 0).alias("rows_flagged"),
    )


def top_terms(df: DataFrame, n: int = 10) -> DataFrame:
    """The terms flagged in most rows; equal counts are listed by term."""
    return (
        df.select(F.explode("flagged").alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), "term")
        .limit(n)
    )


def cooccurrence(df: DataFrame) -> DataFrame:
    """Rows in which two terms occur together, ``term_a < term_b``.

    Rows are first reduced to their distinct term sets, so pairs are formed once per set. All pairs come out; with
    a large dictionary use :func:`frequent_pairs`.
    """
    sets = df.groupBy(F.array_sort("flagged").alias("terms")).agg(F.count(F.lit(1)).alias("n"))
    return _pairs(sets.filter(F.size("terms") > 1))


def _pairs(sets: DataFrame) -> DataFrame:
    """Pairs within sorted ``terms`` of two or more, with the sum of ``n``."""
    pairs = F.transform(
        F.slice("terms", F.col("i") + 2, F.size("terms")),
        lambda b: F.struct(F.get("terms", F.col("i")).alias("term_a"), b.alias("term_b")),
    )
    return (
        sets.select("n", "terms", F.explode(F.sequence(F.lit(0), F.size("terms") - 2)).alias("i"))
        .select("n", F.inline(pairs))
        .groupBy("term_a", "term_b")
        .agg(F.sum("n").alias("row_count"))
    )


def frequent_pairs(df: DataFrame, min_rows: int) -> DataFrame:
    """Pairs of terms that occur together in at least ``min_rows`` rows, ``term_a < term_b``.

    Two passes over distinct term sets: a pair is frequent only if both its terms are, so terms of too few rows leave
    the sets before pairs are formed. The list of frequent terms is joined, not collected; it has at most one term
    per ``min_rows`` flagged ones.
    """
    sets = (
        df.select(F.array_sort(F.array_distinct("flagged")).alias("terms"))
        .filter(F.size("terms") > 1)
        .groupBy("terms")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Both passes start from the sets, which are far fewer than the rows.
    sets = write_table(
        sets.select(F.sha2(F.to_json("terms"), 256).alias("id"), "terms", "n"),
        scratch_path(df.sparkSession, "term-sets"),
    )
    members = sets.select("id", "n", F.explode("terms").alias("term"))
    frequent = members.groupBy("term").agg(F.sum("n").alias("rows")).filter(F.col("rows") >= min_rows)
    pruned = (
        members.join(frequent.select("term"), "term")
        .groupBy("id")
        .agg(F.first("n").alias("n"), F.sort_array(F.collect_list("term")).alias("terms"))
    )
    return _pairs(pruned.filter(F.size("terms") > 1)).filter(F.col("row_count") >= min_rows)


def category_frequency(hits: DataFrame, terms: DataFrame) -> DataFrame:
    """Hits and rows per ``(category, term)`` from a ``_hits`` array column.

    Hits are counted per term first; the dictionary then joins one row per term.
    """
    counts = F.transform(
        F.array_distinct("_hits"),
        lambda t: F.struct(
            t.alias("term"),
            F.size(F.filter("_hits", lambda h: h == t)).cast("bigint").alias("n"),
        ),
    )
    # The outer generator keeps Spark from filtering on the array size, a second evaluation.
    per_term = (
        hits.select(F.inline_outer(counts))
        .filter("term is not null")
        .groupBy("term")
        .agg(F.sum("n").alias("hit_count"), F.count(F.lit(1)).alias("row_count"))
    )
    return terms.join(per_term, "term").select("category", "term", "hit_count", "row_count")


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: nulls, distinct values, shortest and longest text."""

    def text(c: str) -> Column:
        return F.col(f"`{c}`").cast("string")

    def value(c: str) -> Column:
        # Long texts are told apart by their digest, so they are not shuffled.
        return F.when(F.length(text(c)) > 64, F.sha2(text(c), 256)).otherwise(text(c))

    # One pass for the lengths; distinct values are merged locally before they are counted.
    facts = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(text(c).isNull()).alias("null_count"),
                F.min(F.length(text(c))).cast("bigint").alias("min_length"),
                F.max(F.length(text(c))).cast("bigint").alias("max_length"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    ).select(F.inline(F.array(*[f"c{i}" for i in range(len(columns))])))
    values = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), value(c).alias("v")) for c in columns])
        ).alias("x")
    ).select("x.*")
    distinct = (
        values.filter("v is not null")
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return facts.join(F.broadcast(distinct), "column_name", "left").select(
        "column_name",
        "null_count",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("distinct_count"),
        "min_length",
        "max_length",
    )


def column_sketches(df: DataFrame, columns: Sequence[str], by: Column | str | None = None) -> DataFrame:
    """One row per column, and per value of ``by``, with figures that merge: counts, extremes and two sketches.

    A profile is stored per file or year and merged later, so old files are never read again. The size of a row
    does not depend on the data.
    """
    part = F.lit(None).cast("string") if by is None else (F.col(by) if isinstance(by, str) else by)

    def facts(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        return F.struct(F.lit(c).alias("column_name"), text.alias("value"), F.length(text).cast("bigint").alias("length"))

    values = df.select(part.alias("part"), F.inline(F.array(*[facts(c) for c in columns])))
    return values.groupBy("part", "column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        F.hll_sketch_agg("value", F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_bigint("length", F.lit(QUANTILE_ITEMS)).alias("length_sketch"),
    )


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all parts together: one row per column, with estimates of distinct values and of the median
    length. Reads sketches only."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr("kll_merge_agg_bigint(length_sketch)").alias("length_sketch"),
    )
    some = F.col("row_count") > F.col("null_count")
    return merged.select(
        "column_name",
        "row_count",
        "null_count",
        "min_length",
        "max_length",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        F.when(some, F.kll_sketch_get_quantile_bigint("length_sketch", F.lit(0.5))).alias("median_length"),
    )
