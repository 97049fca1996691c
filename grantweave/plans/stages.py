"""preprocess, metrics, keywords and mlexport.

Every stage takes tables and returns ``(result, summary)``, both lazy unless ``output`` names a
folder. With a folder the result is written once and read back, so the summary is computed from
the stored table and nothing is run twice.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grantweave.operators import append as ap
from grantweave.operators import stats
from grantweave.operators.duplicates import count_copies, duplicate_totals
from grantweave.operators.link import link_audit, suffix_collisions, with_normal_key
from grantweave.operators.match import (
    enrich,
    present_columns,
)
from grantweave.operators.outcomes import (
    attach_counts,
    outcome_counts,
    outcome_duplicates,
    outcome_pairs,
)
from grantweave.operators.skew import DEFAULT_POLICY, SkewPolicy, balanced_join
from grantweave.operators.split import (
    split_by_cutoff,
    split_totals,
    with_shares,
    with_split_flag,
)
from grantweave.operators.terms import (
    dictionary_stats,
    english_stopwords,
    expand_terms,
    keyword_table,
)
from grantweave.operators.types import column_types, typed
from grantweave.plans.config import DEFAULT_CONFIG, EXPORT_NAMES, OUTCOMES, StageConfig
from grantweave.plans.summaries import assemble, row_list, row_struct
from grantweave.session import scratch_path
from grantweave.sources import csv_source
from grantweave.sources.keyed import write_linkable
from grantweave.sources.tables import REJECTED_FLAG, export_csv, write_observed, write_table

COPIES = "_copies"
FIGURES = ["unique_duplicate_rows", "total_duplicates", "extra_duplicates", "rows"]


def preprocess(
    spark: SparkSession,
    root: str,
    config: StageConfig = DEFAULT_CONFIG,
    output: str | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """CSV folders under ``root`` to one table per source; text, unless ``infer_types`` asks for types.

    With ``output``, records that were left out are stored with their source, in a partition of their own.
    """
    folders = csv_source.list_folders(spark, root, config.sources)
    files = csv_source.inspect_files(spark, folders, config.rename_columns, config.multi_line)
    by_source: dict[str, list] = {f.source: [] for f in folders if f.files}
    for f in files:
        by_source[f.source].append(f)

    drift = {
        s: ap.schema_drift([f.columns for f in fs], config.force_append)
        for s, fs in by_source.items()
    }
    scanned = {s: csv_source.scan_source(spark, fs) for s, fs in by_source.items() if fs}
    appended = {s: csv_source.rows_of(df) for s, df in scanned.items() if not drift[s].skipped}
    loads: dict[str, tuple[int, int]] = {}
    if output:
        # Rows and rejected records are written and counted in one pass over each source.
        left_out = F.col(csv_source.REJECTED).isNotNull()
        figures = {"rows": F.count_if(~left_out), "rejected": F.count_if(left_out)}
        for source in appended:
            stored, seen = write_observed(
                scanned[source].withColumn(REJECTED_FLAG, left_out),
                f"{output.rstrip('/')}/{source}",
                figures,
                partition_by=REJECTED_FLAG,
            )
            loads[source] = (seen["rows"], seen["rejected"])
            appended[source] = csv_source.rows_of(stored.filter(~F.col(REJECTED_FLAG)).drop(REJECTED_FLAG))
    loads |= csv_source.scan_counts(spark, {s: df for s, df in scanned.items() if s not in loads})
    if config.infer_types:
        appended = {s: typed(df, column_types(df)) for s, df in appended.items()}

    counts = {s: len(fs) for s, fs in by_source.items()}
    sections = {
        "sources": row_list(csv_source.source_presence(spark, folders), "source"),
        "columns_renamed": row_list(
            csv_source.rename_audit(spark, files, config.rename_columns), "source", "file", "old"
        ),
        "appended": row_list(ap.append_audit(spark, appended, drift, counts), "source"),
        "dimensions": row_struct(ap.appended_dimensions(spark, appended)),
    }
    if scanned:
        sections["initial_load"] = row_list(csv_source.load_audit(spark, files, loads), "source")
    return appended, assemble(sections)


def outcome_links(tables: Mapping[str, DataFrame]) -> dict[str, tuple[DataFrame, str, str]]:
    """The outcome sources at hand; an absent one has no count column."""
    return {
        name: (tables[source], "PROJECT_NUMBER", item)
        for name, source, item in OUTCOMES
        if source in tables
    }


def stored_links(
    tables: Mapping[str, DataFrame], folder: str, buckets: int | None = None
) -> dict[str, DataFrame]:
    """``tables`` with projects and abstracts stored by their normalised application id.

    The shuffle that stores them is the only one their id needs: duplicates of abstracts are removed and abstracts
    linked in place, however often the stage runs. Use with ``normal=True``.
    """
    keyed = {
        s: write_linkable(tables[s], f"{folder.rstrip('/')}/{s}", "APPLICATION_ID", buckets) for s in ("PRJ", "PRJABS")
    }
    return {**tables, **keyed}


def linked_outcomes(
    tables: Mapping[str, DataFrame],
    config: StageConfig = DEFAULT_CONFIG,
    policy: SkewPolicy = DEFAULT_POLICY,
    pairs: DataFrame | None = None,
    normal: bool = False,
) -> DataFrame:
    """Distinct project rows with abstract and outcome counts; ``pairs`` may hold stored pairs, and ``normal`` says that
    application ids are normalised already, as in ``stored_links``.

    Full-row duplicates of the joined table can only come from full-row duplicates of its inputs,
    so each input is reduced to distinct rows with a number of copies before the join. The product
    of both numbers, ``_copies``, is how often the row would have occurred.
    """
    missing = [s for s in ("PRJ", "PRJABS") if s not in tables]
    if missing:
        raise ValueError(f"missing sources: {missing}")
    key = "APPLICATION_ID"
    projects, abstracts = (tables[s] if normal else with_normal_key(tables[s], key) for s in ("PRJ", "PRJABS"))
    abstracts = suffix_collisions(projects, abstracts, key, "_abs")
    columns = [*projects.columns, *[c for c in abstracts.columns if c != key]]
    left = count_copies(projects, name="_left_copies")
    right = count_copies(abstracts, name="_right_copies")

    links = outcome_links(tables)
    if links:
        pairs = outcome_pairs(links) if pairs is None else pairs
        # Counts join the projects first, while rows are still free of abstract texts.
        left = attach_counts(
            left,
            outcome_counts(pairs, list(links)),
            "PROJECT_NUMBER",
            list(links),
            config.normalize_left,
            policy,
            searched=tables["PRJ"],
        )
    linked = balanced_join(
        left,
        right,
        [key],
        "left",
        null_safe=config.null_safe,
        policy=policy,
        left_keys=projects.select(key),
        right_keys=abstracts.select(key),
    )
    copies = F.col("_left_copies") * F.coalesce("_right_copies", F.lit(1))
    return linked.select(*[F.col(f"`{c}`") for c in [*columns, *links]], copies.alias(COPIES))


def metrics(
    tables: Mapping[str, DataFrame],
    config: StageConfig = DEFAULT_CONFIG,
    output: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    normal: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Projects with abstracts and distinct outcome counts, without full-row duplicates.

    ``normal`` says that application ids are normalised already, as in ``stored_links``.
    """
    links = outcome_links(tables)
    pairs = outcome_pairs(links) if links else None
    if output and links:
        # Counts and duplicate figures both start from the pairs, so they are stored.
        pairs = write_table(pairs, scratch_path(pairs.sparkSession, "pairs"))
    table = linked_outcomes(tables, config, policy, pairs, normal)
    result = table.drop(COPIES)
    figures = [*duplicate_totals(COPIES), F.count(F.lit(1)).alias("rows")]
    if output:
        # The copies are summed up while the table is written, so they need not be stored.
        seen = Observation()
        result = write_table(table.observe(seen, *figures).drop(COPIES), output)
        totals = table.sparkSession.createDataFrame(
            [tuple(seen.get[name] for name in FIGURES)],
            ", ".join(f"{name} bigint" for name in FIGURES),
        )
    else:
        totals = table.agg(*figures)
    columns = F.lit(len(result.columns)).cast("bigint").alias("columns")
    sections = {
        "linked": row_struct(
            link_audit(tables["PRJ"], tables["PRJABS"], "APPLICATION_ID", config.null_safe)
        ),
        "deduplication": row_struct(totals.select(*FIGURES[:3])),
        "dimensions": row_struct(totals.select("rows", columns)),
    }
    if pairs is not None:
        sections["aggregate_outcomes"] = row_list(outcome_duplicates(pairs), "outcome")
    return result, assemble(sections)


def config_terms(spark: SparkSession, config: StageConfig = DEFAULT_CONFIG) -> DataFrame:
    """The configured dictionary, expanded."""
    stopwords = english_stopwords(spark) if config.remove_stopwords else None
    return expand_terms(keyword_table(spark, config.keywords), stopwords)


def terms_used(terms: DataFrame) -> DataFrame:
    """The dictionary as a table of its own, ``(category, term)``; it may have any size."""
    return terms.select("category", "term").distinct()


def keywords(
    df: DataFrame,
    config: StageConfig = DEFAULT_CONFIG,
    output: str | None = None,
    terms: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows with hit counts and flagged terms. Without any text column: input and no summary.

    The summary counts the dictionary's terms; :func:`terms_used` lists them.
    """
    used = present_columns(df, config.text_columns)
    if not used:
        return df, None
    terms = config_terms(df.sparkSession, config) if terms is None else terms
    table = enrich(df, used, terms, config.fold_text)
    if output:
        table = write_table(table, output)
    figures = stats.enrichment_stats(table)
    columns = F.lit(len(table.columns)).cast("bigint")
    sections = {
        "keyword_library": row_list(dictionary_stats(terms), "category"),
        "text_columns_used": df.sparkSession.createDataFrame([(used,)], "value array<string>"),
        "enrichment_metrics": row_struct(figures),
        "top_flagged_terms": row_list(
            stats.top_terms(table), (-F.col("row_count")).alias("n"), "term"
        ),
        # The same aggregate as above, so its exchange is reused.
        "output_dimensions": row_struct(
            figures.select(F.col("total_rows_processed").alias("rows"), columns.alias("columns"))
        ),
    }
    return table, assemble(sections)


def mlexport(
    df: DataFrame,
    config: StageConfig = DEFAULT_CONFIG,
    output: str | None = None,
    row_id: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(retained, dropped, summary). With ``output``, both sides are written in one pass."""
    retained, dropped = split_by_cutoff(df, config.cutoff_value, config.ml_columns)
    totals = split_totals(config.cutoff_value, row_id)
    if output:
        # The figures are taken while the rows are written, so nothing is matched again for them.
        seen = Observation()
        flagged = with_split_flag(df.observe(seen, *totals), config.cutoff_value, config.ml_columns)
        if not config.export_drop_output:
            flagged = flagged.filter("retained")
        stored = write_table(flagged, output, partition_by="retained")
        retained = stored.filter("retained").drop("retained")
        if config.export_drop_output:
            dropped = stored.filter("not retained").drop("retained")
        schema = df.agg(*totals).schema
        figures = with_shares(
            df.sparkSession.createDataFrame([tuple(seen.get[name] for name in schema.names)], schema)
        )
    else:
        figures = with_shares(df.agg(*totals))
    exported = F.col("total_dropped_rows") if config.export_drop_output else F.lit(0)
    summary = figures.select(
        F.struct(
            F.array(*[F.lit(c) for c in config.ml_columns]).alias("ml_columns_used"),
            F.lit(config.cutoff_value).cast("bigint").alias("cutoff_value"),
            *figures.columns,
        ).alias("filter_summary"),
        F.struct(
            F.col("total_retained_rows").alias("total_rows"),
            F.lit(len(config.ml_columns)).cast("bigint").alias("total_columns"),
            exported.cast("bigint").alias("exported_dropped_rows"),
        ).alias("output_dimensions"),
    )
    return retained, dropped, summary


def export_stage_csv(df: DataFrame, path: str) -> None:
    """CSV export of a stage table under the spaced column names."""
    export_csv(df.withColumnsRenamed(EXPORT_NAMES), path)


__all__ = [
    "config_terms",
    "export_stage_csv",
    "keywords",
    "linked_outcomes",
    "metrics",
    "mlexport",
    "preprocess",
    "stored_links",
    "terms_used",
]
