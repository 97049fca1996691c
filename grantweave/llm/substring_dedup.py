"""Repeated passages, found from anchors at difference-cover positions.

The positions 0, 1 and 3 modulo 7 are a difference cover: for any two numbers there is a shift below 7
after which both lie on cover positions. Two equal runs of 13 words therefore share an aligned anchor,
a window of 7 words (13 less the largest shift) at a cover position of both documents. Only those
windows, three of seven, are hashed and compared over the corpus.

Every anchor that several documents hold is extended to the windows of 13 words around it, and these
are compared as wholes by 96-bit hashes. A word goes if a window over it also starts in a
document with a smaller id. See ``blocks`` for how keys travel.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from grantweave.llm import blocks as bl

WIDTH = 13
PERIOD = 7
COVER = (0, 1, 3)
ANCHOR = WIDTH - PERIOD + 1


class Anchors:
    """A block's anchors: short keys, made of a bucket and 32 bits, and where they start."""

    def __init__(self, text: bl.BlockText, buckets: int):
        self.text = text
        starts = text.windows(ANCHOR)
        self.starts = starts[np.isin(text.position[starts] % PERIOD, COVER)]
        value = text.hash_at(self.starts, ANCHOR)
        keys = (bl.bucket_of(value, buckets) << np.uint64(32)) | (value & np.uint64(0xFFFFFFFF))
        self.keys, self.which = np.unique(keys, return_inverse=True)
        self.cuts = bl.cut(self.keys >> np.uint64(32), buckets)

    def shared(self, replies: list[tuple[int, bytes]]) -> np.ndarray:
        """Of each anchor, whether another document holds its key."""
        rank = self.text.rank[self.text.document[self.starts]]
        low = np.full(len(self.keys), np.iinfo(np.int64).max)
        high = np.full(len(self.keys), -1)
        np.minimum.at(low, self.which, rank)
        np.maximum.at(high, self.which, rank)
        flags = low < high
        given = dict(replies)
        for bucket, begin, end in self.cuts:
            if bucket in given:
                bits = np.unpackbits(np.frombuffer(given[bucket], np.uint8), count=end - begin)
                flags[begin:end] |= bits.astype(bool)
        return flags[self.which]


class Windows:
    """The windows of 13 words that hold a shared anchor, and their distinct 96-bit keys."""

    def __init__(self, anchors: Anchors, shared: np.ndarray, buckets: int):
        text = anchors.text
        hit = np.zeros(len(text.hashes) + PERIOD, np.int64)
        hit[anchors.starts[shared]] = 1
        before = np.concatenate([[0], np.cumsum(hit)])
        starts = text.windows(WIDTH)
        self.starts = starts[before[starts + PERIOD] > before[starts]]
        high = text.hash_at(self.starts, WIDTH)
        low = text.hash_at(self.starts, WIDTH, 1).astype(np.uint32)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.high, self.low = high[new], low[new]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.cuts = bl.cut(bl.bucket_of(self.high, buckets), buckets)


def _anchor_replies(table: pa.Table) -> pa.Table:
    """Tells each block which of its anchors another block holds too."""
    sent = [(b, np.frombuffer(p, "<u4")) for b, p in zip(*(table.column(c).to_pylist() for c in ("block", "payload")))]
    found, counts = np.unique(np.concatenate([keys for _, keys in sent]), return_counts=True)
    common = found[counts > 1]
    bucket = table.column("bucket")[0].as_py()
    return bl.messages(
        (bucket, block, "anchor", np.packbits(np.isin(keys, common, assume_unique=True)).tobytes())
        for block, keys in sent
    )


def _window_replies(table: pa.Table) -> pa.Table:
    """Tells each block which of its windows a block of smaller ids holds; passes anchor replies on."""
    rows = list(zip(*(table.column(c).to_pylist() for c in ("bucket", "block", "kind", "payload"))))
    out = [row for row in rows if row[2] == "anchor"]
    sent = [(bucket, block, np.frombuffer(p, "u1")) for bucket, block, kind, p in rows if kind == "window"]
    if sent:
        sizes = [len(raw) // 12 for *_, raw in sent]
        high = np.concatenate([raw[: 8 * n].view("<u8") for (*_, raw), n in zip(sent, sizes)])
        low = np.concatenate([raw[8 * n :].view("<u4") for (*_, raw), n in zip(sent, sizes)])
        block = np.repeat([b for _, b, _ in sent], sizes)
        order = np.lexsort((block, low, high))
        again = np.zeros(len(order), bool)
        a, b = order[1:], order[:-1]
        again[a] = (high[a] == high[b]) & (low[a] == low[b])
        at = 0
        for (bucket, owner, _), n in zip(sent, sizes):
            out.append((bucket, owner, "window", np.packbits(again[at : at + n]).tobytes()))
            at += n
    return bl.messages(out)


def _marked(docs: DataFrame, id_column: str, text_column: str, finish, schema) -> DataFrame:
    """``finish(table, order, text, removed)`` for each block gives rows of ``schema``; ``removed`` tells
    of each word of ``text`` whether it goes."""
    placed, n = bl.in_blocks(docs, id_column)
    buckets = n

    def text_of(table: pa.Table) -> bl.BlockText:
        return bl.BlockText(table.column(id_column), table.column(text_column))

    def send_anchors(table: pa.Table) -> pa.Table:
        block = table.column(bl.BLOCK)[0].as_py()
        anchors = Anchors(text_of(table), buckets)
        return bl.messages(
            (bucket, block, "anchor", anchors.keys[i:j].astype("<u4").tobytes()) for bucket, i, j in anchors.cuts
        )

    def send_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return bl.messages([])
        block = table.column(bl.BLOCK)[0].as_py()
        given = bl.answers(replies, "anchor")
        anchors = Anchors(text_of(table), buckets)
        windows = Windows(anchors, anchors.shared(given), buckets)
        rows = [
            (bucket, block, "window", windows.high[i:j].astype("<u8").tobytes() + windows.low[i:j].astype("<u4").tobytes())
            for bucket, i, j in windows.cuts
        ]
        return bl.messages([*rows, *((bucket, block, "anchor", payload) for bucket, payload in given)])

    def decide(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema_arrow.empty_table()
        text = text_of(table)
        anchors = Anchors(text, buckets)
        windows = Windows(anchors, anchors.shared(bl.answers(replies, "anchor")), buckets)
        rank = text.rank[text.document[windows.starts]]
        first = np.full(len(windows.high), np.iinfo(np.int64).max)
        np.minimum.at(first, windows.which, rank)
        earlier = np.zeros(len(windows.high), bool)
        given = dict(bl.answers(replies, "window"))
        for bucket, i, j in windows.cuts:
            earlier[i:j] = np.unpackbits(np.frombuffer(given[bucket], np.uint8), count=j - i)
        goes = earlier[windows.which] | (first[windows.which] < rank)
        edge = np.zeros(len(text.hashes) + 1, np.int64)
        np.add.at(edge, windows.starts[goes], 1)
        np.add.at(edge, windows.starts[goes] + WIDTH, -1)
        return finish(table, text, np.cumsum(edge[:-1]) > 0)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema_arrow = to_arrow_schema(schema)
    answered = bl.answer(bl.send(placed, send_anchors), _anchor_replies)
    answered = bl.answer(bl.receive(placed, answered, send_windows, bl.MESSAGE), _window_replies)
    return bl.receive(placed, answered, decide, schema)


def _kept(text: bl.BlockText, removed: np.ndarray, k: int, words: list[bytes]) -> bytes:
    gone = removed[text.starts[k] : text.starts[k + 1]]
    return b" ".join([w for w, out in zip(words, gone.tolist()) if not out]) if gone.any() else b" ".join(words)


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For every row its id, ``n_words``, ``n_removed`` and ``kept_sha256`` of the words that stay.

    A word is removed if a window of 13 words over it, in this document, also starts in a document
    with a smaller id. Null and short texts lose nothing. Rows that repeat an id do not remove each
    other's words; null ids count as the largest, and ids are integers. An empty table gives no rows. Other columns are not read.
    """
    schema = T.StructType(
        [
            docs.schema[id_column],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def finish(table: pa.Table, text: bl.BlockText, removed: np.ndarray) -> pa.Table:
        texts, totals = table.column(text_column), np.concatenate([[0], np.cumsum(removed)])
        digests = [
            hashlib.sha256(_kept(text, removed, k, bl.words(texts[i].as_py()))).hexdigest()
            for k, i in enumerate(text.order.tolist())
        ]
        gone = totals[text.starts[1:]] - totals[text.starts[:-1]]
        return pa.table(
            [table.column(id_column).take(pa.array(text.order)), pa.array(text.lengths), pa.array(gone), pa.array(digests, pa.string())],
            names=schema.names,
        )

    return _marked(docs.select(id_column, docs[text_column].cast("string").alias(text_column)), id_column, text_column, finish, schema)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, all other columns unchanged.

    A text that loses words is its other words joined by one space; any other text stays as it is, null too. Rows that
    repeat an id do not cut each other's words; null ids count as the largest, and ids are integers. An empty table
    gives no rows. Columns may have any name.
    """
    # Inside, columns are numbered, so none can clash with those that are added.
    names = docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_column, text_column = (f"c{names.index(c)}" for c in (id_column, text_column))

    def finish(table: pa.Table, text: bl.BlockText, removed: np.ndarray) -> pa.Table:
        texts = table.column(text_column)
        new = texts.to_pylist()
        for k, i in enumerate(text.order.tolist()):
            if removed[text.starts[k] : text.starts[k + 1]].any():
                new[i] = _kept(text, removed, k, bl.words(new[i])).decode("utf-8", "surrogatepass")
        table = table.drop_columns(bl.BLOCK)
        at = table.schema.get_field_index(text_column)
        return table.set_column(at, text_column, pa.array(new, pa.string()))

    return _marked(docs, id_column, text_column, finish, docs.schema).toDF(*names)
