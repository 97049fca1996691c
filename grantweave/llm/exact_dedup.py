"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of characters. Equal blocks get one integer
name, found by sorting the blocks that share a hash bucket; then names of adjacent blocks are
paired, and the pairs are named in the same way, until a document is one name. Names compare whole
contents, so two documents have one identity only if their texts are equal; hashes only choose where
a value is sorted. Everything is made of built-in expressions.

Most documents are one block, so the text crosses the network once, and each level of pairing has at
most half the rows of the one below. A value that holds a large share of all rows (a page that was
copied a million times) is not sorted row by row: it is reduced to one row per task first and its name
is joined back by broadcast. At most ``1 / HOT_SHARE`` buckets can be that frequent, whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grantweave.llm.tables import HOT_ROWS, HOT_SHARE, SPACE, join_groups, stored, text_or_empty

#: characters of a block
BLOCK_CHARS = 4096
#: a name is the hash bucket in the high bits and the rank in the bucket in the low ones
BUCKET_BITS = 36
RANK_BITS = 63 - BUCKET_BITS


def normalized(text: str) -> Column:
    """Runs of white space as one space; null as the empty text."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def _hot(counts: DataFrame, name: str) -> DataFrame:
    """Of keys with their row counts ``_n`` (stored first), those that hold a large share."""
    counts = stored(counts, name)
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") >= max(HOT_ROWS, rows * HOT_SHARE))


def named(rows: DataFrame, values: list[str], name: str) -> DataFrame:
    """``rows`` with one integer ``name`` for each distinct content of ``values``, which are dropped.

    The integer depends on the set of contents alone, not on partitions or on the order of rows.
    """
    others = [c for c in rows.columns if c not in values]
    bucket = F.shiftrightunsigned(F.xxhash64(*values), 64 - BUCKET_BITS)
    rows = rows.withColumn("_bucket", bucket)
    rank = F.dense_rank().over(W.partitionBy("_bucket").orderBy(*values)).cast("long")
    integer = (F.shiftleft("_bucket", RANK_BITS) + rank).alias(name)
    hot = _hot(rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "buckets").select("_bucket")
    cold = rows.join(F.broadcast(hot), "_bucket", "left_anti").select(*others, integer)
    frequent = rows.join(F.broadcast(hot), "_bucket", "left_semi")
    names = frequent.select("_bucket", *values).distinct().select("_bucket", *values, integer)
    return cold.unionByName(
        frequent.join(F.broadcast(names), ["_bucket", *values]).select(*others, name)
    )


def identities(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``row_id``, the id, ``text_sha256``, ``n_blocks`` and ``name``.

    Rows have equal (``n_blocks``, ``name``) if and only if their normalised texts are equal.
    """
    # Exploding an array of one keeps the normalised text from being computed per use.
    texts = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(f"`{id_column}`").alias("doc_id"),
        F.explode(F.array(normalized(text_column))).alias("_text"),
    )
    cut = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    blocks = texts.select(
        "row_id", "doc_id", F.sha2("_text", 256).alias("text_sha256"), cut.alias("_blocks")
    ).select(
        "row_id",
        "doc_id",
        "text_sha256",
        F.greatest(F.size("_blocks"), F.lit(1)).alias("n_blocks"),
        F.posexplode_outer("_blocks").alias("_at", "_block"),
    )
    first = F.coalesce("_at", F.lit(0)) == 0
    blocks = blocks.select(
        "row_id",
        F.when(first, F.col("doc_id")).alias("doc_id"),
        F.when(first, F.col("text_sha256")).alias("text_sha256"),
        "n_blocks",
        F.coalesce("_at", F.lit(0)).alias("_at"),
        F.coalesce("_block", F.lit("")).alias("_block"),
    )
    level = stored(named(blocks, ["_block"], "name"), "blocks")
    documents = level.filter("_at = 0").select("row_id", "doc_id", "text_sha256", "n_blocks", "name")
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    if longest == 1:
        return documents

    whole = []
    open_names = level.filter("n_blocks > 1").select(
        "row_id", "_at", "name", F.col("n_blocks").alias("_left")
    )
    for _ in range(math.ceil(math.log2(longest))):
        half = F.floor(F.col("_at") / 2).cast("int")
        odd = F.col("_at") % 2 == 1
        pairs = open_names.groupBy("row_id", "_left", half.alias("_pair")).agg(
            F.max(F.when(~odd, F.col("name"))).alias("_first"),
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("_second"),
        )
        pairs = pairs.select(
            "row_id",
            F.col("_pair").alias("_at"),
            F.ceil(F.col("_left") / 2).cast("int").alias("_left"),
            "_first",
            "_second",
        )
        open_names = stored(named(pairs, ["_first", "_second"], "name"), "pairs")
        whole.append(open_names.filter("_left = 1").select("row_id", "name"))
        open_names = open_names.filter("_left > 1")
    long_names = whole[0]
    for part in whole[1:]:
        long_names = long_names.unionByName(part)
    long_documents = documents.filter("n_blocks > 1").drop("name").join(long_names, "row_id")
    return documents.filter("n_blocks = 1").unionByName(long_documents)


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Groups of rows whose texts are equal after white space is made one space.

    Returns a row for each input row: the id, ``keep_id`` (smallest id of the group), ``group_size``,
    ``kept`` and ``text_sha256`` of the normalised text. Null texts count as empty. Exactly one row of a
    group is kept: the one with the smallest id; null ids come last, and of rows that repeat an id, the
    one read first. An empty table gives no rows. Other columns are not looked at.
    """
    rows = stored(identities(docs, id_column, text_column), "identities")
    key = ["n_blocks", "name"]
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_id"))
    groups = stored(
        rows.groupBy(*key).agg(F.min(order).alias("_best"), F.count(F.lit(1)).alias("group_size")),
        "groups",
    ).select(*key, F.col("_best.doc_id").alias("keep_id"), F.col("_best.row_id").alias("_row"), "group_size")
    return join_groups(rows, groups, key, "group_size").select(
        F.col("doc_id").alias(id_column),
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("_row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged.

    Of a group the row with the smallest id stays, null ids last. Rows are told by id and text, so repeated ids
    keep each their own texts; of rows that repeat both, one stays. Null texts count as empty; an empty table gives no
    rows; extra columns may have any name.
    """
    verdicts = exact_duplicates(docs, id_column, text_column)
    kept = stored(verdicts.filter("kept").select(F.col(f"`{id_column}`").alias("id"), "text_sha256"), "kept")
    # One row of each id and text, whatever the columns of the input are called.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_column}`").alias("own_id"),
        F.sha2(normalized(text_column), 256).alias("own_sha256"),
    )
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_sha256") == F.col("text_sha256"))
    out = rows.join(kept, same, "left_semi")
    again = docs.groupBy(f"`{id_column}`").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    if not again.isEmpty():
        out = out.dropDuplicates(["own_id", "own_sha256"])
    return out.select("row.*")
