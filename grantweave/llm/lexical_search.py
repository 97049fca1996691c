"""Ranked lexical search: documents are grouped by the set of query terms they hold.

Documents are reduced, in one pass over the texts, to their number of terms and the counts of the terms that
some query asks for. A second pass takes these small rows in blocks. In a block every term has a bitmap of
the documents that hold it. For a query the bitmaps of its terms are turned into one presence mask per
document, documents with equal masks form a group, and the most a group can score is the sum of the largest
contributions of its terms in the block. Groups are scored in falling order of that maximum, and the rest is
left out once no group can reach the worst of the best documents so far.

Nothing is shuffled but the best documents of each task. Queries are taken in blocks of bounded size; a block is
what travels to the tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.llm.tables import stored

#: best documents of each query
LIMIT = 50
#: text of the queries that are searched at once, in characters
QUERY_CHARS = 8 * 1024 * 1024
#: documents of a block
BLOCK = 8_192
#: masks scored before the bound is looked at again; doubles
FIRST_MASKS = 32
#: tasks whose best documents are merged in a first step
MERGED_TASKS = 64
#: part of a term's score that falls with the length of the document, percent
LENGTH_SHARE = 50

#: ASCII letters in lower case, digits and bytes of other characters as they are, all else a space
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Queries:
    """A block of queries: their ids, and the numbers of their distinct terms."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple]) -> Queries:
        vocabulary: dict[bytes, int] = {}
        numbers = [
            np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text)}), np.int64)
            for _, text in rows
        ]
        return cls([i for i, _ in rows], numbers, vocabulary)


def postings(docs: DataFrame, id_column: str, text_column: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n_terms``, and ``terms`` with ``counts`` for the terms of ``vocabulary``, of every document
    with a term."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("n_terms", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, ends, terms, counts = [], [], [0], [], []
            for i, text in enumerate(batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    at.append(i)
                    sizes.append(len(found))
                    for term, n in Counter(found).items():
                        number = vocabulary.get(term)
                        if number is not None:
                            terms.append(number)
                            counts.append(n)
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                schema.names,
            )

    return docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").cast("binary").alias("text")
    ).mapInArrow(run, schema)


def term_weights(table: DataFrame, n_terms: int, documents: int) -> np.ndarray:
    """Weight of each term from the number of documents that hold it; one row per task and term is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = np.zeros(n_terms, np.int64)
        for batch in batches:
            holders += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(holders[held])], ["term", "holders"])

    counted = table.select("terms").mapInArrow(count, "term long, holders long")
    weights = np.zeros(n_terms, np.int64)
    for row in counted.groupBy("term").agg(F.sum("holders").alias("holders")).collect():
        weights[row.term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row.holders + 1)))
    return weights


class Block:
    """Documents of one block: contributions by document, and a bitmap of documents by term."""

    def __init__(self, n_terms: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights, share):
        self.n = len(n_terms)
        self.begins = np.concatenate([[0], np.cumsum(sizes)])
        self.terms = terms
        document = np.repeat(np.arange(self.n), sizes)
        length = 100 - LENGTH_SHARE + share(n_terms)
        self.parts = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * length[document]))
        #: largest contribution of each term, 0 if no document holds it
        self.most = np.zeros(len(weights), np.int64)
        np.maximum.at(self.most, terms, self.parts)
        present, row = np.unique(terms, return_inverse=True)
        self.row = np.full(len(weights), -1)
        self.row[present] = np.arange(len(present))
        width = -(-self.n // 8)
        # Each bit is added once, so a sum is a union.
        bits = np.bincount(row * width + (document >> 3), 1 << (7 - (document & 7)), len(present) * width)
        self.bitmaps = bits.astype(np.uint8).reshape(len(present), width)

    def masks(self, rows: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold one of the first ``needed`` terms, the number of each one's mask, and the
        distinct masks as rows of one bit per term."""
        maps = self.bitmaps[rows]
        union = np.bitwise_or.reduce(maps[:needed], axis=0)
        documents = np.flatnonzero(np.unpackbits(union, count=self.n))
        bits = np.unpackbits(maps, axis=1, count=self.n)[:, documents]
        packed = np.packbits(bits, axis=0).T
        words = np.zeros((len(documents), -(-packed.shape[1] // 8) * 8), np.uint8)
        words[:, : packed.shape[1]] = packed
        words = words.view(np.uint64)
        if words.shape[1] == 1:
            distinct, which = np.unique(words[:, 0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, which = np.unique(words, axis=0, return_inverse=True)
        matched = np.unpackbits(np.ascontiguousarray(distinct).view(np.uint8), axis=1, count=len(rows))
        return documents, which.reshape(-1), matched

    def scores(self, documents: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores of documents, each with at least one term of the block."""
        sizes = self.begins[documents + 1] - self.begins[documents]
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        at = np.arange(sizes.sum()) + np.repeat(self.begins[documents] - first, sizes)
        return np.add.reduceat(np.where(asked[self.terms[at]], self.parts[at], 0), first)

    def best(self, query: np.ndarray, limit: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and their scores, that can be among the best ``limit`` of a query; ``least`` is what
        the last of them has so far."""
        terms = query[self.most[query] > 0]
        terms = terms[np.argsort(-self.most[terms], kind="stable")]
        most = self.most[terms]
        least = max(least, 1)
        # A document that holds none of the first terms has at most what the others add up to.
        needed = int(np.count_nonzero(np.cumsum(most[::-1])[::-1] >= least))
        none = np.zeros(0, np.int64)
        if not needed:
            return none, none
        documents, which, matched = self.masks(self.row[terms], needed)
        bound = matched.astype(np.int64) @ most
        order = np.argsort(-bound, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_mask = np.argsort(place[which], kind="stable")
        ends = np.cumsum(np.bincount(place[which], minlength=len(order)))
        asked = np.zeros(len(self.most), bool)
        asked[terms] = True
        found, scored, begin, step = [none], [none], 0, FIRST_MASKS
        while begin < len(order) and bound[order[begin]] >= least:
            end = min(begin + step, len(order))
            chosen = documents[by_mask[ends[begin - 1] if begin else 0 : ends[end - 1]]]
            score = self.scores(chosen, asked)
            good = score >= least
            found.append(chosen[good])
            scored.append(score[good])
            so_far = np.concatenate(scored)
            if len(so_far) >= limit:
                least = max(least, int(np.partition(so_far, -limit)[-limit]))
            begin, step = end, 2 * step
        found, scored = np.concatenate(found), np.concatenate(scored)
        good = scored >= least
        return found[good], scored[good]


def _order(entry: tuple) -> tuple:
    score, name = entry
    return (-score, name is None, 0 if name is None else name)


def _searched(table: DataFrame, queries: Queries, limit: int, id_type, item_type) -> DataFrame:
    """The best documents of each query in each task: ``query`` (its number), ``item_id``, ``doc_id``, ``score``."""
    totals = table.agg(F.count(F.lit(1)).alias("documents"), F.sum("n_terms").alias("terms")).first()
    n_documents, all_terms = totals.documents, totals.terms or 1
    weights = term_weights(table, len(queries.vocabulary), n_documents)
    schema = T.StructType(
        [
            T.StructField("query", T.IntegerType()),
            T.StructField("item_id", item_type),
            T.StructField("doc_id", id_type),
            T.StructField("score", T.LongType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    wanted, names = queries.terms, queries.ids

    def share(n_terms: np.ndarray) -> np.ndarray:
        return (LENGTH_SHARE * n_terms * n_documents) // all_terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in wanted]
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                terms, counts = part.column(2), part.column(3)
                block = Block(
                    part.column(1).to_numpy(),
                    terms.value_lengths().to_numpy(),
                    terms.flatten().to_numpy().astype(np.int64),
                    counts.flatten().to_numpy().astype(np.int64),
                    weights,
                    share,
                )
                for q, query in enumerate(wanted):
                    least = best[q][-1][0] if len(best[q]) == limit else 0
                    found, scores = block.best(query, limit, least)
                    if len(found):
                        ids = part.column(0).take(pa.array(found)).to_pylist()
                        best[q] = sorted([*best[q], *zip(scores.tolist(), ids)], key=_order)[:limit]
        rows = [(q, names[q], doc, score) for q, entries in enumerate(best) for score, doc in entries]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return table.mapInArrow(run, schema)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    limit: int = LIMIT,
    query_chars: int = QUERY_CHARS,
) -> DataFrame:
    """The ``limit`` best documents of every item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs of letters, digits and characters beyond ASCII. A term weighs
    ``floor(1000 ln((2N+2)/(2df+1)))`` and adds ``weight * (10**9 tf div (1000 tf + 20 m))``, where m is 100 for a
    document of average length. Only scores above 0 are listed; equal scores are ordered by id, null ids last.

    Null and empty texts hold no term: such a document is not found and not counted, such an item has no rows. Rows
    that repeat an id are documents or items of their own. Empty tables give no rows. Other columns are not read.
    """
    id_type, item_type = docs.schema[id_column].dataType, items.schema[item_id_column].dataType
    wanted = items.select(
        F.col(f"`{item_id_column}`").alias("item_id"),
        F.col(f"`{item_text_column}`").cast("string").cast("binary").alias("text"),
    )
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // query_chars))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for b in range(blocks):
        queries = Queries.of([tuple(r) for r in wanted.filter(block_of == b).collect()])
        table = stored(postings(docs, id_column, text_column, queries.vocabulary), "postings")
        hits = _searched(table, queries, limit, id_type, item_type)
        found.append(hits.withColumn("block", F.lit(b)))
    hits = reduce(DataFrame.unionByName, found)
    parts = -(-hits.rdd.getNumPartitions() // MERGED_TASKS)
    best_first = [F.desc("score"), F.asc_nulls_last("doc_id")]
    query = ["block", "query"]
    if parts > 1:
        # First among the results of some tasks, so that no task sees those of all.
        some = W.partitionBy(*query, "part").orderBy(*best_first)
        hits = (
            hits.withColumn("part", F.spark_partition_id() % parts)
            .withColumn("rank", F.row_number().over(some))
            .filter(F.col("rank") <= limit)
        )
    ranked_hits = hits.withColumn("rank", F.row_number().over(W.partitionBy(*query).orderBy(*best_first)))
    return ranked_hits.filter(F.col("rank") <= limit).select("item_id", "rank", "doc_id", "score")
