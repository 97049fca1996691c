"""One query per operator of this subpackage, over the driver's tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantweave.llm.bin_completion import bin_packed
from grantweave.llm.chat_format import TURNS, canonical, formatted, read_back
from grantweave.llm.exact_dedup import exact_duplicates
from grantweave.llm.html_template import extracted
from grantweave.llm.jaccard_join import jaccard_components
from grantweave.llm.lexical_search import ranked
from grantweave.llm.license_scan import scanned
from grantweave.llm.packing import packed
from grantweave.llm.periodic_runs import periodic_runs
from grantweave.llm.quality import quality_rules
from grantweave.llm.segmentation import segmented
from grantweave.llm.substring_dedup import repeated_passages
from grantweave.llm.tables import table
from grantweave.llm.toxicity import scored, trained

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from labelled rows of folds 1 to 4 and scores all rows; fold 0 is held out."""
    documents = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = trained(documents.filter(fold != 0), table(spark, sf_dir, "labels").filter(fold != 0))
    return scored(documents, model).withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


#: a text that looks like a template's own markers
LOOKALIKE = r"\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a record, mapped by its layout, formatted by conversation and read back."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(LOOKALIKE).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    # A record above the JSON reader's limit on strings does not parse; its turn is the row's own columns.
    own = F.array(F.struct("role", "text")).cast(TURNS)
    turns = canonical(rows.select("*", record.alias("record")), "record").select(
        "conv_id", "turn", F.inline(F.coalesce("turns", own))
    )
    back = read_back(formatted(turns, "conv_id", "turn"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_text", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op7_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document and of every chat text; the other table's keys are null."""
    keys = ["doc_id", "conv_id", "turn"]
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return segmented(documents.unionByName(chats, allowMissingColumns=True).select(*keys, "text"), keys)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item as a query against all documents."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; of a tenth of the documents, told by their id, the words from some place on
    repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # The generator of one row computes the words once.
    marked = documents.select(
        "doc_id", "text", F.floor(h / 10).alias("g"), F.inline(F.array(F.struct(F.when(h % 10 == 0, words).alias("words"))))
    )
    n = F.size("words")
    marked = marked.select("*", F.when(n > 0, F.col("g") % n).cast("int").alias("a"))
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int").alias("p")
    marked = marked.select("doc_id", "text", "words", "a", period, (n - F.col("a")).alias("tail"))
    root = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.flatten(F.array_repeat(root, F.ceil(F.col("tail") / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), F.col("tail")))
    return marked.select(
        "doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text")
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), "")
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"]))
    )
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), lines.alias("lines"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.col3")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.col3)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packed(table(spark, sf_dir, "documents"))


ALL: dict[str, Query] = {f.__name__: f for f in (
        op1_toxicity,
        op2_quality_rules,
        op3_chat_format,
        op4_jaccard_join,
        op5_license_scan,
        op6_html_extraction,
        op7_segmentation,
        op8_exact_dedup,
        op9_substring_dedup,
        op10_packing,
        op11_lexical_search,
        op12_periodic_runs,
        op13_bin_completion,
    )}

ORACLES: dict[str, str] = {
    "op3_chat_format": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<turn >' || '</turn>' || role || text)
                   + length(regexp_replace(role || text, '[^\\<>]', '', 'g')))::BIGINT AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS n FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY n) AS kept, sha256(n) AS text_sha256
        FROM t""",
    "op11_lexical_search": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        q AS (
          SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        size AS (SELECT count(*) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
        doc AS (SELECT doc_id, 100 - 50 + (50 * len(ts) * n_docs) // n_terms AS m FROM d, size WHERE len(ts) > 0),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d)
               WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
              FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), size),
        part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS part
                 FROM tf JOIN w USING (term) JOIN doc USING (doc_id)),
        s AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM q JOIN part USING (term) GROUP BY ALL),
        r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                     doc_id, score FROM s WHERE score > 0)
        SELECT * FROM r WHERE rank <= 50""",
}
