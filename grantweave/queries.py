"""One query per operator over the driver's tables.

``documents`` stands in for project texts, ``orders`` and ``lineitem`` for projects and their
linked rows, ``events``, ``customer`` and ``lineitem`` for outcome links.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.functions.text import concat_text, normalize_key, normalize_keyword
from grantweave.operators import append as ap
from grantweave.operators import duplicates as dup
from grantweave.operators import link, match, outcomes, split, stats
from grantweave.operators import terms as tm
from grantweave.plans import stages
from grantweave.plans.config import StageConfig
from grantweave.session import scratch_path, spread
from grantweave.sources import csv_source as cs
from grantweave.sources import keyed as kd
from grantweave.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]

#: terms that occur in the invented prose; they share prefixes and overlap
TEXT_TERMS = (
    "the",
    "the that",
    "of",
    "of that",
    "and attion",
    "eriner thanea",
    "to thanedble",
    "by-nc",
    "es",
    "la",
    "de la",
)
CUTOFF = 4
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(values: Column) -> Column:
    return F.array_join(values, "|")


# --- sources ---------------------------------------------------------------------------------


def _write_lines(df: DataFrame, header: str, line: Column, path: str) -> None:
    """CSV files whose lines are given as text, each file starting with ``header``.

    The separator and quote are control characters, so lines are written as they are.
    """
    (
        df.select(line.alias(header))
        .write.option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("sep", "\x01")
        .option("quote", "\x02")
        .option("escape", "\x02")
        .csv(path)
    )


def _write_source(df: DataFrame, path: str) -> None:
    (
        df.write.mode("append")
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("escape", '"')
        .csv(path)
    )


def _csv_sources(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    root = scratch_path(spark, "sources")
    for name in names:
        _write_source(table(spark, sf_dir, name), f"{root}/{name}")
    return root


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "sources")
    customer = table(spark, sf_dir, "customer")
    key, name, segment = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
    line = (
        F.when(segment == "FURNITURE", F.concat_ws(",", key, name, segment, F.lit("EXTRA")))
        .when(F.col("c_acctbal") < 0, key)
        .when(segment == "HOUSEHOLD", F.concat_ws(",", key, F.lit("NA"), segment))
        .otherwise(F.concat_ws(",", key, name, segment))
    )
    # Records that span lines go through the ordinary writer, which quotes them.
    spanning = (segment == "BUILDING") & (F.col("c_acctbal") >= 0)
    header = 'ï»¿"c_custkey",c_name,c_mktsegment'
    _write_lines(customer.filter(~spanning), header, line, f"{root}/customer")
    quoted = customer.filter(spanning).select(
        "c_custkey", F.lit('a\nb, "c"').alias("c_name"), "c_mktsegment"
    )
    _write_source(quoted, f"{root}/customer")
    files = cs.inspect_files(spark, cs.list_folders(spark, root, ["customer"]))
    return cs.read_source(spark, files)


def source_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _csv_sources(spark, sf_dir, ["customer", "supplier"])
    folders = cs.list_folders(spark, root, ["customer", "supplier", "absent"])
    return cs.source_presence(spark, folders).select(
        "source", "status", (F.col("file_count") > 0).alias("has_files")
    )


def _long_lines(spark: SparkSession, sf_dir: str) -> str:
    """Customers as CSV; a line has a cell too many where the segment is FURNITURE."""
    root = scratch_path(spark, "sources")
    customer = table(spark, sf_dir, "customer")
    cells = [F.col("c_custkey").cast("string"), F.col("c_name")]
    over = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("EXTRA"))
    _write_lines(customer, "c_custkey,c_name", F.concat_ws(",", *cells, over), f"{root}/customer")
    return root


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["region", "nation"]
    root = _csv_sources(spark, sf_dir, names)
    folders = cs.list_folders(spark, root, names) + cs.list_folders(spark, _long_lines(spark, sf_dir), ["customer"])
    files = cs.inspect_files(spark, folders)
    scanned = {n: cs.scan_source(spark, [f for f in files if f.source == n]) for n in [*names, "customer"]}
    counts = cs.scan_counts(spark, scanned)
    return cs.load_audit(spark, files, counts).select("source", "total_rows", "rejected_records")


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first stage leaves out of a source, stored beside its rows in the same pass."""
    output = scratch_path(spark, "preprocess")
    config = StageConfig(sources=("customer",), rename_columns={})
    stages.preprocess(spark, _long_lines(spark, sf_dir), config, output)
    return tb.read_rejected(spark, output, "customer").select("text", "reason")


def typed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that disagree on types: whole numbers, numbers with a fraction, and text in one of the columns."""
    root = scratch_path(spark, "typed")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), F.col("p_size").alias("n"), F.col("p_name").alias("t")
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("n"), F.col("s_nationkey").alias("t")
    )
    for df in (part, supplier):
        _write_source(df, f"{root}/items")
    config = StageConfig(sources=("items",), rename_columns={}, infer_types=True)
    tables, _ = stages.preprocess(spark, root, config)
    types = [f.dataType.simpleString() for f in tables["items"].schema.fields]
    return tables["items"].withColumn("types", F.lit("|".join(types)))


def rename_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"c_custkey": "custkey", "s_suppkey": "suppkey", "absent": "nothing"}
    root = _csv_sources(spark, sf_dir, ["customer", "supplier"])
    folders = cs.list_folders(spark, root, ["customer", "supplier"])
    files = cs.inspect_files(spark, folders, names)
    return cs.rename_audit(spark, files, names).select("source", "old", "new").distinct()


def snapshot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "snapshot")
    tb.write_snapshot({n: table(spark, sf_dir, n) for n in ("customer", "supplier")}, folder)
    stored = tb.read_snapshot(spark, folder, ["customer", "supplier", "absent"])
    return ap.append_by_name(
        [stored[n].withColumn("source", F.lit(n)).select("source", *cols) for n, cols in (
            ("customer", [F.col("c_custkey").alias("id"), F.col("c_name").alias("name")]),
            ("supplier", [F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")]),
        )]
    )


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    stages.export_stage_csv(_enriched(spark, sf_dir).select("doc_id", *match.COUNT_COLUMNS), path)
    stored = cs.read_table_csv(
        spark,
        path,
        "doc_id bigint, `total count` bigint, `total unique count` bigint, flagged string",
    )
    return stored.withColumnsRenamed(
        {"total count": "total_count", "total unique count": "total_unique_count"}
    )


def split_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    retained, dropped, _ = stages.mlexport(
        _enriched(spark, sf_dir), _doc_config(), scratch_path(spark, "split")
    )
    columns = ["doc_id", "total_count", "total_unique_count", joined(F.col("flagged")).alias("flagged")]
    return retained.select(*columns, F.lit("retained").alias("side")).unionByName(
        dropped.select(*columns, F.lit("dropped").alias("side"))
    )


def split_write_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only retained rows are stored, and the summary says so."""
    config = dataclasses.replace(_doc_config(), export_drop_output=False)
    retained, _, summary = stages.mlexport(
        _enriched(spark, sf_dir), config, scratch_path(spark, "split")
    )
    figures = summary.select(
        "filter_summary.total_dropped_rows", "output_dimensions.exported_dropped_rows"
    ).first()
    return retained.select(
        "doc_id", "total_count", *[F.lit(v).cast("bigint").alias(k) for k, v in figures.asDict().items()]
    )


def summary_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, summary = stages.mlexport(_enriched(spark, sf_dir), _doc_config())
    path = scratch_path(spark, "summary")
    tb.export_summary(summary, path)
    stored = spark.read.schema(summary.schema).json(path)
    return stored.select(
        joined(F.col("filter_summary.ml_columns_used")).alias("ml_columns_used"),
        "filter_summary.cutoff_value",
        "filter_summary.total_input_rows",
        "filter_summary.total_retained_rows",
        "filter_summary.total_dropped_rows",
        "filter_summary.percent_retained",
        "filter_summary.percent_dropped",
        "output_dimensions.total_columns",
        "output_dimensions.exported_dropped_rows",
    )


# --- names, keys, appends ------------------------------------------------------------------


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"c_custkey": "PROJECT_NUMBER", "c_name": "PROJECT_TITLE", "absent": "nothing"}
    customer = table(spark, sf_dir, "customer")
    return customer.toDF(*cs.rename_header(customer.columns, names))


def key_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t "), F.lower("p_brand"), F.lit(" \n"))
    return table(spark, sf_dir, "part").select("p_partkey", normalize_key(padded).alias("brand_key"))


def _people(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return {"customer": customer, "supplier": supplier}


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ap.append_by_name(list(_people(spark, sf_dir).values()))


def append_type_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("k"), "s_nationkey")
    return ap.append_by_name([part, supplier], widen=True)


def append_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _people(spark, sf_dir)
    drift = {
        "people": ap.schema_drift([df.columns for df in people.values()], force_append=True),
        "customer": ap.schema_drift([people["customer"].columns], force_append=False),
    }
    appended = {
        "people": ap.append_by_name(list(people.values())),
        "customer": people["customer"],
    }
    audit = ap.append_audit(spark, appended, drift, {"people": 2, "customer": 1})
    return audit.withColumn("unexpected_columns", joined(F.col("unexpected_columns")))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drifting files in one source, once refused and once forced."""
    root = scratch_path(spark, "drift")
    for name, df in _people(spark, sf_dir).items():
        _write_source(df, f"{root}/{name}")
    folders = cs.list_folders(spark, root, ["customer", "supplier"])
    files = cs.inspect_files(spark, folders)
    headers = [f.columns for f in files]
    drift = {
        "refused": ap.schema_drift(headers, force_append=False),
        "forced": ap.schema_drift(headers, force_append=True),
    }
    appended = {"forced": cs.read_source(spark, files)}
    audit = ap.append_audit(spark, appended, drift, {})
    return audit.select(
        "source",
        "total_rows",
        "total_columns",
        joined(F.col("unexpected_columns")).alias("unexpected_columns"),
        "skipped",
    )


def drift_by_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables whose names differ by case alone are one table in drift, audit and append."""
    upper = _people(spark, sf_dir)["customer"].withColumnRenamed("name", "NAME")
    same = {"a": _people(spark, sf_dir)["customer"], "b": upper}
    drift = {"both": ap.schema_drift([df.columns for df in same.values()], force_append=False)}
    appended = {"both": ap.append_by_name(list(same.values()))}
    return ap.append_audit(spark, appended, drift, {"both": 2}).select(
        "source", "total_rows", "total_columns", "unexpected_columns_added", "skipped"
    )


def appended_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ap.appended_dimensions(spark, _people(spark, sf_dir))


# --- links and outcomes --------------------------------------------------------------------


def link_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").withColumn("source", F.lit("labels"))
    return link.link_left(documents, labels, "doc_id")


def link_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link and full-row duplicates of two tables stored by key, each shuffled once, when it was written."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").withColumn("source", F.lit("labels"))
    folder = scratch_path(spark, "keyed")
    for name, df in (("documents", documents), ("labels", labels.unionByName(labels))):
        kd.write_linkable(df, f"{folder}/{name}", "doc_id")
    left, right = (kd.open_keyed(spark, f"{folder}/{name}") for name in ("documents", "labels"))
    return link.link_left(left, dup.drop_full_duplicates(right), "doc_id", normal=True)


def link_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k")
    lineitem = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "k")
    return link.link_audit(orders, lineitem, "k")


def count_unique_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return outcomes.count_unique_pairs(lineitem, "l_partkey", "l_suppkey", "supplier_count")


def count_unique_pairs_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").withColumn(
        "item", F.nullif(F.col("l_suppkey"), F.lit(1))
    )
    return outcomes.count_unique_pairs(lineitem, "l_partkey", "item", "item_count")


def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup.keep_first(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


def _one_outcome(
    projects: DataFrame, project: str, links: DataFrame, link_project: str, item: str, name: str
) -> DataFrame:
    pairs = outcomes.outcome_pairs({name: (links, link_project, item)})
    counts = outcomes.outcome_counts(pairs, [name])
    return outcomes.attach_counts(projects, counts, project, [name])


def publication_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    lineitem = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    return _one_outcome(
        orders, "o_orderkey", lineitem, "l_orderkey", "l_partkey", "publication_count"
    )


def patent_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders")
    return _one_outcome(
        customer, "c_custkey", orders, "o_custkey", "o_orderpriority", "patent_count"
    )


def study_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    events = table(spark, sf_dir, "events")
    return _one_outcome(
        customer, "c_custkey", events, "user_id", "event_type", "clinical_study_count"
    )


def grant_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver's tables under the column names of the grant sources."""
    orders = table(spark, sf_dir, "orders")
    lineitem = spread(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    text = lambda c: F.col(c).cast("string")
    return {
        "PRJ": orders.select(
            text("o_orderkey").alias("APPLICATION_ID"),
            F.concat(F.lit(" p"), text("o_custkey")).alias("PROJECT_NUMBER"),
            F.col("o_orderpriority").alias("PROJECT_TITLE"),
        ),
        "PRJABS": lineitem.select(
            F.concat(text("l_orderkey"), F.lit(" ")).alias("APPLICATION_ID"),
            F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("ABSTRACT_TEXT"),
        ),
        "PUBLINK": table(spark, sf_dir, "events").select(
            F.col("event_type").alias("PMID"),
            F.concat(F.lit("P"), text("user_id")).alias("PROJECT_NUMBER"),
        ),
        "Patents": lineitem.select(
            F.nullif(text("l_partkey"), F.lit("1")).alias("PATENT_ID"),
            F.concat(F.lit("p"), text("l_suppkey")).alias("PROJECT_NUMBER"),
        ),
        "ClinicalStudies": table(spark, sf_dir, "customer").select(
            F.col("c_mktsegment").alias("ClinicalTrials.gov ID"),
            F.concat(F.lit("P"), text("c_nationkey")).alias("PROJECT_NUMBER"),
        ),
    }


def project_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.linked_outcomes(grant_tables(spark, sf_dir)).drop(stages.COPIES)


def project_outcomes_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables stored by application id."""
    tables = stages.stored_links(grant_tables(spark, sf_dir), scratch_path(spark, "keyed"))
    return stages.linked_outcomes(tables, normal=True).drop(stages.COPIES)


def absent_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without one outcome source there is no count of it; without abstracts there is no link."""
    tables = grant_tables(spark, sf_dir)
    without = {s: df for s, df in tables.items() if s != "PUBLINK"}
    linked = stages.linked_outcomes(without)
    try:
        stages.linked_outcomes({s: df for s, df in tables.items() if s != "PRJABS"})
        refused = False
    except ValueError:
        refused = True
    return linked.groupBy("patent_count").agg(F.count(F.lit(1)).alias("projects")).select(
        "patent_count",
        "projects",
        F.lit("publication_count" in linked.columns).alias("has_publications"),
        F.lit(refused).alias("refused_without_abstracts"),
    )


def outcome_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = stages.outcome_links(grant_tables(spark, sf_dir))
    return outcomes.outcome_duplicates(outcomes.outcome_pairs(links))


def metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, summary = stages.metrics(grant_tables(spark, sf_dir), output=scratch_path(spark, "metrics"))
    return summary.select(
        "linked.left_rows",
        "linked.right_rows",
        "linked.merged_rows",
        "linked.merged_cols",
        "linked.rows_added",
        "deduplication.*",
        "dimensions.*",
        F.size("aggregate_outcomes").cast("bigint").alias("outcome_sources"),
    )


# --- duplicates ----------------------------------------------------------------------------


def dup_stats_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup.duplicate_stats(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("text", "lang", "source")


def dedupe_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup.drop_full_duplicates(_texts(spark, sf_dir))


def dup_stats_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup.duplicate_stats(_texts(spark, sf_dir))


def _line_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spread(table(spark, sf_dir, "lineitem").select(*LINE_ORDER), *LINE_ORDER[:2])
    return dup.duplicate_flags(lineitem, ["l_partkey", "l_suppkey"], LINE_ORDER)


def dup_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_flags(spark, sf_dir)


def dup_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return dup.duplicate_representatives(lineitem, ["l_partkey", "l_suppkey"])


def dup_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup.duplicate_sample(_line_flags(spark, sf_dir), LINE_ORDER)


# --- dictionary ----------------------------------------------------------------------------


def _part_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as keywords, dressed up so that every variant rule applies somewhere."""
    name = F.col("p_name")
    keyword = (
        F.when(F.col("p_type") == "ECONOMY", F.concat(F.lit("  "), F.upper(name), F.lit("\t")))
        .when(F.col("p_type") == "SMALL", F.replace(name, F.lit(" "), F.lit("-")))
        .when(F.col("p_type") == "MEDIUM", F.replace(name, F.lit(" "), F.lit("'s ")))
        .when(F.col("p_type") == "LARGE", F.concat(name, F.lit(" thérapy")))
        .when(F.col("p_type") == "PROMO", F.concat(name, F.lit(" öesophagus")))
        .otherwise(F.concat(name, F.lit("-ray"))))
    return table(spark, sf_dir, "part").select(F.col("p_type").alias("category"), keyword.alias("keyword"))


#: letters of three scripts that stand for one or two ASCII letters
SCRIPTS = {
    "ECONOMY": ("abgdzklmnoprstx", "αβγδζκλμνοπρστξ"),
    "SMALL": ("abvgdezikl", "абвгдезикл"),
    "MEDIUM": ("abcdefghijklmnopqrstuvwxyz", "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ"),
    "LARGE": ("aeiou", "άέίόύ"),
}


def keyword_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names spelled with Greek, Cyrillic and wide letters, ligatures and loose accents, and folded again."""
    name, kind = F.col("p_name"), F.col("p_type")
    spelled = F.when(kind == "ECONOMY", F.translate(name, *SCRIPTS["ECONOMY"]))
    for other in ("SMALL", "MEDIUM"):
        spelled = spelled.when(kind == other, F.translate(name, *SCRIPTS[other]))
    # Accented Greek vowels; the accent of the first is a mark of its own.
    spelled = spelled.when(
        kind == "LARGE", F.replace(F.translate(name, "aiou", "άίόυ"), F.lit("e"), F.lit("e\u0301"))
    )
    spelled = spelled.when(kind == "PROMO", F.concat(name, F.lit(" ﬁbroﬂuﬀ άλφα"))).otherwise(
        F.concat(name, F.lit(" болезнь щё"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", normalize_keyword(spelled).alias("keyword"))


def term_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.expand_terms(_part_keywords(spark, sf_dir))


def sorted_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.expand_terms(_part_keywords(spark, sf_dir)).orderBy("category", "term")


def _words(df: DataFrame, column: str) -> DataFrame:
    found = F.regexp_extract_all(F.lower(column), F.lit("[a-z0-9_]+"), F.lit(0))
    return df.select(F.explode(found).alias("word")).distinct()


def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = _words(table(spark, sf_dir, "conversations"), "text")
    keywords = said.select(F.lit("said").alias("category"), F.upper("word").alias("keyword"))
    stopwords = _words(table(spark, sf_dir, "benchmark"), "text")
    return tm.remove_stopwords(keywords, stopwords)


def dictionary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.dictionary_stats(tm.expand_terms(_part_keywords(spark, sf_dir)))


def category_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.term_pool(tm.expand_terms(_part_keywords(spark, sf_dir)))


# --- matching ------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.match_regex(_documents(spark, sf_dir), concat_text(["text"]), TEXT_TERMS)


def _doc_config() -> StageConfig:
    return StageConfig(
        text_columns=("text",),
        ml_columns=("doc_id", "total_count", "total_unique_count", "flagged"),
        cutoff_value=CUTOFF,
    )


def _term_table(spark: SparkSession) -> DataFrame:
    rows = [("phrase" if " " in t else "word", t) for t in TEXT_TERMS] + [("word", "de la")]
    return tm.text_table(spark, category=[r[0] for r in rows], term=[r[1] for r in rows])


def text_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn(
        "lang", F.nullif(F.col("lang"), F.lit("de"))
    )
    return documents.select("doc_id", concat_text(["lang", "source", "text"]).alias("combined"))


def _hit_output(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", "total_count", "total_unique_count", joined(F.col("flagged")).alias("flagged")
    )


def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_output(_enriched(spark, sf_dir))


def keyword_hits_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return _hit_output(
        match.match_join(documents, concat_text(["text"]), _term_table(spark))
    )


def keyword_hits_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join with a dictionary taken as too large to broadcast."""
    documents = _documents(spark, sf_dir)
    hits = match.match_join(documents, concat_text(["text"]), _term_table(spark), max_broadcast_chars=0)
    return _hit_output(hits)


def shuffled_dictionary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of ``documents`` in ``benchmark``, without a broadcast of the dictionary."""
    words = _words(table(spark, sf_dir, "documents"), "text").withColumnRenamed("word", "term")
    hits = match.match_join(
        table(spark, sf_dir, "benchmark"), concat_text(["text"]), words, max_broadcast_chars=0
    )
    return hits.select("item_id", "total_count", "total_unique_count")


def data_dictionary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary held as a table: the words of ``benchmark``, found in ``conversations``."""
    terms = _words(table(spark, sf_dir, "benchmark"), "text").withColumnRenamed("word", "term")
    turns = table(spark, sf_dir, "conversations").withColumn(
        "turn_id", F.concat_ws(":", "conv_id", "turn")
    )
    return match.match_join(spread(turns, "turn_id"), concat_text(["text"]), terms).select(
        "turn_id", "total_count", "total_unique_count"
    )


def hits_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share an id, matched by join with a dictionary in upper case."""
    words = _words(table(spark, sf_dir, "benchmark"), "text")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "text")
    hits = match.enrich(
        turns, ["text"], words.select(F.upper("word").alias("term")), max_pattern_terms=0
    )
    return hits.select("conv_id", "total_count", "total_unique_count")


def large_dictionary_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary beyond any pattern: the words of ``documents``, found in ``benchmark``."""
    words = _words(table(spark, sf_dir, "documents"), "text").withColumnRenamed("word", "term")
    hits = match.enrich(table(spark, sf_dir, "benchmark"), ["text"], words)
    return hits.select("item_id", "total_count", "total_unique_count")


def no_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without any of the text columns the stage gives its input back."""
    same, _ = stages.keywords(_documents(spark, sf_dir), StageConfig(text_columns=("absent",)))
    return same.select("doc_id", F.length("text").alias("chars"))


def hits_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = match.match_regex(
        _documents(spark, sf_dir), concat_text(["text"], fold_text=True), ["le", "eau", "un la"]
    )
    return _hit_output(folded)


def enrichment_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.enrichment_stats(_enriched(spark, sf_dir))


def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_terms(_enriched(spark, sf_dir))


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.cooccurrence(_enriched(spark, sf_dir))


#: rows in which a pair of terms has to occur
PAIR_ROWS = 40


def frequent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.frequent_pairs(_enriched(spark, sf_dir), PAIR_ROWS)


def category_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = F.array(F.struct(match.term_hits(concat_text(["text"]), TEXT_TERMS).alias("_hits")))
    return stats.category_frequency(
        _documents(spark, sf_dir).select(F.inline(hits)), _term_table(spark)
    )


def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn(
        "lang", F.nullif(F.col("lang"), F.lit("de"))
    )
    return stats.column_stats(documents, ["doc_id", "lang", "source", "text"])


def merged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles per source and language, stored and merged; estimates are held against exact figures."""
    documents = table(spark, sf_dir, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("de")))
    columns = ["doc_id", "lang", "source", "text"]
    parts = stats.column_sketches(documents, columns, F.concat_ws("/", "source", "lang"))
    merged = stats.merged_profile(tb.write_table(parts, scratch_path(spark, "profile")))
    exact = stats.column_stats(documents, columns).select("column_name", "distinct_count")
    # Four standard errors; small numbers are exact to one.
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_count"))
    return merged.join(exact, "column_name").select(
        "column_name",
        "row_count",
        "null_count",
        "min_length",
        "max_length",
        (off <= F.greatest(F.lit(1), 0.08 * F.col("distinct_count"))).alias("distinct_within_error"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dimensions(table(spark, sf_dir, "documents"))


def terms_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.terms_used(tm.expand_terms(_part_keywords(spark, sf_dir)))


def keywords_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    _, summary = stages.keywords(
        documents,
        _doc_config(),
        output=scratch_path(spark, "keywords"),
        terms=_term_table(spark),
    )
    first = F.get("top_flagged_terms", F.lit(0))
    return summary.select(
        F.size("keyword_library").cast("bigint").alias("library_rows"),
        joined(F.col("text_columns_used")).alias("text_columns_used"),
        "enrichment_metrics.*",
        first["term"].alias("top_term"),
        first["row_count"].alias("top_term_rows"),
        "output_dimensions.rows",
        "output_dimensions.columns",
    )


# --- cutoff split --------------------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    config = _doc_config()
    return split.split_by_cutoff(_enriched(spark, sf_dir), CUTOFF, config.ml_columns)


def cutoff_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_output(_split(spark, sf_dir)[0])


def cutoff_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hit_output(_split(spark, sf_dir)[1])


def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_stats(_enriched(spark, sf_dir), CUTOFF, "doc_id")


def split_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of row places on both sides of the cutoff, for a table without an id of its own."""
    documents = tb.read_with_positions(spark, f"{sf_dir}/documents.parquet").drop("doc_id")
    enriched = match.match_regex(documents, concat_text(["text"]), TEXT_TERMS)
    return split.split_stats(enriched, CUTOFF, "row_position")


def column_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training columns that a table lacks are named, and the split is refused."""
    documents = table(spark, sf_dir, "documents")
    wanted = ["doc_id", "text", "absent", "flagged"]
    try:
        split.split_by_cutoff(documents, CUTOFF, wanted)
        refused = False
    except ValueError:
        refused = True
    missing = "|".join(split.missing_columns(documents, wanted))
    return stats.dimensions(documents).select(
        "rows", "columns", F.lit(missing).alias("missing"), F.lit(refused).alias("refused")
    )


def ml_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the configured dictionary plus the prose terms over three text columns."""
    config = StageConfig(
        text_columns=("source", "absent", "lang", "text"),
        ml_columns=("doc_id", "lang", "total_count", "total_unique_count", "flagged"),
        cutoff_value=CUTOFF,
    )
    prose = tm.text_table(spark, category=["prose"] * len(TEXT_TERMS), term=TEXT_TERMS)
    terms = stages.config_terms(spark, config).unionByName(prose)
    enriched = match.enrich(_documents(spark, sf_dir), config.text_columns, terms)
    retained, _ = split.split_by_cutoff(enriched, config.cutoff_value, config.ml_columns)
    return retained.withColumn("flagged", joined(F.col("flagged")))


def preprocess_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV copies of two tables through the first stage and back as one keyed list."""
    root = _csv_sources(spark, sf_dir, ["customer", "orders"])
    config = StageConfig(
        sources=("customer", "orders", "absent"),
        rename_columns={"c_custkey": "PROJECT_NUMBER", "o_custkey": "PROJECT_NUMBER"},
    )
    tables, _ = stages.preprocess(spark, root, config, scratch_path(spark, "preprocess"))
    return ap.append_by_name(
        [
            tables["customer"].select("PROJECT_NUMBER", "c_name"),
            tables["orders"].select("PROJECT_NUMBER", "o_orderkey"),
        ]
    )


def preprocess_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _csv_sources(spark, sf_dir, ["customer", "orders"])
    config = StageConfig(
        sources=("customer", "orders", "absent"),
        rename_columns={"c_custkey": "PROJECT_NUMBER", "o_custkey": "PROJECT_NUMBER"},
    )
    _, summary = stages.preprocess(spark, root, config)
    return summary.select(
        F.size("sources").cast("bigint").alias("expected_sources"),
        "dimensions.total_rows",
        "dimensions.total_columns",
        joined(F.transform("appended", lambda a: a["source"])).alias("appended_sources"),
        joined(F.array_distinct("columns_renamed.old")).alias("renamed"),
    )


ALL: dict[str, Query] = {
    f.__name__: f
    for f in (
        ml_export,
        csv_scan,
        source_presence,
        load_audit,
        rename_audit,
        snapshot_round_trip,
        csv_export,
        split_write,
        split_write_retained,
        summary_json,
        rename_columns,
        key_normalize,
        append_by_name,
        append_type_widen,
        append_audit,
        schema_drift,
        appended_dimensions,
        link_left,
        link_audit,
        count_unique_pairs,
        count_unique_pairs_null,
        keep_first,
        publication_count,
        patent_count,
        study_count,
        project_outcomes,
        outcome_duplicates,
        metrics_summary,
        dup_stats_subset,
        dedupe_full_row,
        dup_stats_full_row,
        dup_flags,
        dup_representatives,
        dup_sample,
        term_variants,
        sorted_terms,
        stopword_filter,
        dictionary_stats,
        category_union,
        text_concat,
        keyword_hits,
        keyword_hits_join,
        data_dictionary_hits,
        hits_repeated_ids,
        large_dictionary_hits,
        no_text_columns,
        hits_folded,
        enrichment_stats,
        top_terms,
        cooccurrence,
        category_frequency,
        column_stats,
        dimensions,
        keywords_summary,
        cutoff_retained,
        cutoff_dropped,
        split_stats,
        preprocess_tables,
        preprocess_summary,
        rejected_records,
        typed_append,
        drift_by_case,
        absent_outcome,
        keyword_scripts,
        keyword_hits_shuffled,
        shuffled_dictionary_hits,
        frequent_pairs,
        merged_profile,
        terms_used,
        split_positions,
        column_guard,
        link_stored,
        project_outcomes_stored,
    )
}
