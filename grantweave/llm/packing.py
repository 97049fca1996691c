"""Packing documents into training sequences along a space-filling curve.

A document's tokens are hashed to a vector, the vector is projected to a few dimensions, and the
cell it falls in gives its place on a Hilbert curve. Documents are sorted by that key over the whole
corpus, in range partitions, and neighbours on the curve are packed together.

A document longer than a sequence is cut into full sequences and a remainder; remainders and short
documents stay whole. They are placed by best fit, largest first, in a sliding window of neighbours, so
little is padded. Piece boundaries do not depend on other documents, so each text is tokenised once, its
ids never leave that task, and only a few integers per piece are sorted.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from grantweave.llm.tables import stored
from grantweave.llm.token_ids import TextIds

LENGTH = 2048
#: id that ends each document
END = 1
#: hashed features, dimensions of the curve and bits of each
FEATURES = 512
DIMS = 4
BITS = 10
#: pieces that are placed together, largest first
WINDOW = 2_048
#: sequences that stay open for the next window
OPEN = 512
PIECES_PER_PART = 200_000

#: feature of each id, by a multiplicative hash
_feature = ((np.arange(1 << 17, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(55)).astype(np.int64)
_projection = np.random.default_rng(7).standard_normal((FEATURES, DIMS))


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (rows x dimensions, below ``2**bits``)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def cells_of(vectors: np.ndarray) -> np.ndarray:
    """Cells of hashed count vectors: unit length, projected, each axis cut into equal shares of a normal curve."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = vectors / np.where(norms == 0, 1, norms) @ _projection
    return np.clip(((np.tanh(points) + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


PIECE = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


def pieces(docs: DataFrame, id_column: str, text_column: str, length: int, ranks: str | None) -> DataFrame:
    """Id, ``PIECE`` columns and curve key of every piece."""
    schema = T.StructType(
        [docs.schema[id_column], *PIECE.fields, T.StructField("curve_key", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TextIds(ranks)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            at, rows, vectors = [], [], []
            for i, text in enumerate(batch.column(1)):
                raw = ids_of.encode(text.as_py() or "") + end
                ids = np.frombuffer(raw, "<u4")
                vectors.append(np.bincount(_feature[ids], minlength=FEATURES))
                for start in range(0, len(ids), length):
                    part = raw[4 * start : 4 * (start + length)]
                    at.append(i)
                    rows.append((start, len(part) // 4, zlib.crc32(part), len(ids)))
            if rows:
                keys = hilbert_keys(cells_of(np.array(vectors, np.float64)))[at]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                ids = batch.column(0).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([ids, *columns, pa.array(keys)], schema.names)

    return docs.select(f"`{id_column}`", docs[text_column].cast("string")).mapInArrow(run, schema)


class Sequences:
    """Open sequences, by the room they have left."""

    def __init__(self, length: int, first_id: int):
        self.length, self.next_id = length, first_id
        self.room: list[tuple[int, int]] = []

    def place(self, size: int) -> tuple[int, int]:
        """The fullest sequence that takes ``size`` more ids, and the offset there."""
        at = bisect.bisect_left(self.room, (size, -1))
        if at < len(self.room):
            room, sequence = self.room.pop(at)
        else:
            room, sequence = self.length, self.next_id
            self.next_id += 1
        if room > size:
            bisect.insort(self.room, (room - size, sequence))
        return sequence, self.length - room

    def close(self) -> None:
        """Keeps those with most room open."""
        self.room = self.room[-OPEN:]


def packed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    ranks: str | None = None,
) -> DataFrame:
    """Every piece with its place: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    Null texts count as empty; an empty text is its end id alone. Each row is a document of its own,
    also if ids repeat or are null. An empty table gives no pieces. Other columns are not read. Sequence
    ids are unique but not consecutive: their high bits are the range partition.
    """
    table = stored(pieces(docs, id_column, text_column, length, ranks), "pieces")
    parts = max(1, -(-table.count() // PIECES_PER_PART))
    ordered = table.repartitionByRange(
        max(parts, table.sparkSession.sparkContext.defaultParallelism), "curve_key", id_column, "start"
    ).sortWithinPartitions("curve_key", id_column, "start", "ids_crc32")
    schema = T.StructType(
        [
            docs.schema[id_column],
            *PIECE.fields,
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = Sequences(length, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for begin in range(0, batch.num_rows, WINDOW):
                window = batch.slice(begin, WINDOW)
                sizes = window.column(2).to_numpy()
                places = np.zeros((len(sizes), 2), np.int64)
                for i in np.argsort(-sizes, kind="stable"):
                    places[i] = sequences.place(int(sizes[i]))
                sequences.close()
                yield pa.RecordBatch.from_arrays(
                    [*window.columns[:5], pa.array(places[:, 0]), pa.array(places[:, 1])], schema.names
                )

    return ordered.mapInArrow(run, schema)
