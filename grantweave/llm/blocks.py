"""Finding what documents share, with hashes that travel in packed arrays.

Documents are divided into blocks by ranges of their id, some megabytes of text each. A block sends
each of its distinct keys once, whatever the number of its documents that hold it, as one array
per bucket of the key space; a bucket sees the keys of all blocks, and answers each block with a
few bits per key in the order they were sent. So a key that is in every document costs a bucket one
entry per block, and the volume is a few bytes per distinct key of a block. Blocks and buckets both
grow in number with the input, so neither grows in size.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.llm.tables import parts_for

#: name of the column with a row's block
BLOCK = "_block_of_ids"
BLOCK_BYTES = 8 * 1024 * 1024
#: odd multipliers of window hashes, one row per independent hash
_multipliers = np.random.default_rng(11).integers(1, 1 << 63, (2, 32), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_mix = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))

#: what a block sends to a bucket and a bucket answers; ``kind`` tells stages apart
MESSAGE = "bucket long, block long, kind string, payload binary"
MESSAGE_ARROW = pa.schema(
    [("bucket", pa.int64()), ("block", pa.int64()), ("kind", pa.string()), ("payload", pa.binary())]
)


def require_integers(docs: DataFrame, id_column: str) -> None:
    """Ids are compared as 64-bit integers; others are refused before any work."""
    kind = docs.schema[id_column].dataType
    if not isinstance(kind, T.IntegralType):
        raise ValueError(f"{id_column} must be an integer column, not {kind.simpleString()}")


def in_blocks(docs: DataFrame, id_column: str) -> tuple[DataFrame, int]:
    """``docs`` with a column ``BLOCK`` that grows with the id, and the number of blocks.

    Null ids count as the largest.
    """
    require_integers(docs, id_column)
    n = parts_for(docs, BLOCK_BYTES)
    shares = [i / n for i in range(1, n)]
    cuts = docs.agg(
        F.percentile_approx(F.col(f"`{id_column}`").cast("long"), shares, max(10_000, 20 * n))
    ).first()[0]
    bounds = sorted(set(cuts or []))

    @F.pandas_udf("long")
    def block(ids: pd.Series) -> pd.Series:
        return ids.map(lambda i: len(bounds) if pd.isna(i) else bisect.bisect_left(bounds, i)).astype("int64")

    return docs.withColumn(BLOCK, block(F.col(f"`{id_column}`").cast("long"))), len(bounds) + 1


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than the six white-space ones; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class BlockText:
    """The word hashes of a block's documents, one after the other in the order of their ids."""

    def __init__(self, ids: pa.ChunkedArray, texts: pa.ChunkedArray, lower: bool = False):
        numbers = np.array([(1 << 63) - 1 if i is None else i for i in ids.to_pylist()], np.int64)
        self.order = np.argsort(numbers, kind="stable")
        #: rank of each document's id; rows that repeat an id share one
        self.rank = np.unique(numbers[self.order], return_inverse=True)[1].reshape(-1)
        hashes, lengths = [], []
        for i in self.order.tolist():
            found = words(texts[i].as_py())
            if lower:
                found = [w.lower() for w in found]
            lengths.append(len(found))
            hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))
        self.lengths = np.array(lengths, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.document = np.repeat(np.arange(len(lengths)), self.lengths)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.position = np.arange(len(self.hashes)) - self.starts[self.document]

    def windows(self, width: int) -> np.ndarray:
        """Positions at which ``width`` words of one document start."""
        return np.flatnonzero(self.position + width <= self.lengths[self.document])

    def hash_at(self, starts: np.ndarray, width: int, which: int = 0) -> np.ndarray:
        """A 64-bit hash of the ``width`` words from each start."""
        value = np.zeros(len(starts), np.uint64)
        for k in range(width):
            value += self.hashes[starts + k] * _multipliers[which, k]
        return mixed(value)


def mixed(value: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``value``."""
    a, b, shift = _mix
    value = (value ^ (value >> shift)) * a
    value = (value ^ (value >> shift)) * b
    return value ^ (value >> shift)


def bucket_of(value: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket from the high half of a hash; grows with the hash."""
    half = np.uint64(32)
    return ((value >> half) * np.uint64(buckets)) >> half


def cut(sorted_buckets: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Bucket, begin and end of each run."""
    ends = np.searchsorted(sorted_buckets, np.arange(buckets, dtype=sorted_buckets.dtype), "right")
    begins = np.concatenate([[0], ends[:-1]])
    return [(b, int(i), int(j)) for b, (i, j) in enumerate(zip(begins, ends)) if j > i]


def messages(rows: Iterable[tuple[int, int, str, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.Table.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, MESSAGE_ARROW.types)], schema=MESSAGE_ARROW
    )


def answers(table: pa.Table, kind: str) -> list[tuple[int, bytes]]:
    """Bucket and payload of a block's answers of one kind, by bucket."""
    found = zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "payload")))
    return sorted((bucket, payload) for bucket, k, payload in found if k == kind)


def send(blocks: DataFrame, fn) -> DataFrame:
    """What each block sends: ``fn`` takes its table."""
    return blocks.groupBy(BLOCK).applyInArrow(fn, MESSAGE)


def answer(sent: DataFrame, fn) -> DataFrame:
    """What each bucket answers to what it was sent."""
    return sent.groupBy("bucket").applyInArrow(fn, MESSAGE)


def receive(blocks: DataFrame, answered: DataFrame, fn, schema) -> DataFrame:
    """``fn`` takes a block's table and its answers, and gives rows of ``schema``."""
    return (
        blocks.groupBy(BLOCK)
        .cogroup(answered.groupBy("block"))
        .applyInArrow(fn, schema)
    )
