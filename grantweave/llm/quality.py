"""Quality rules: word and line counts, then compression bands.

A text that zstandard makes much smaller than prose of its length says little; one that it can hardly
shrink is encoded data or noise. Both the whole document and each of its fixed-size chunks must
fall in a band that depends on their length: short texts compress worse, since a frame and its first
symbols cost the same for any text.

Texts are judged one by one, so no row is moved and the memory of a task is its Arrow batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: bytes below which a band holds, smallest and largest ratio of raw to compressed bytes. Smallest ratios are above
#: what 6-bit alphabets reach at the upper end (base64 tends to 1.33, random words of letters and digits to 1.41)
BANDS = (
    (256, 0.0, 3.0),
    (512, 1.25, 3.5),
    (1_024, 1.34, 3.5),
    (4_096, 1.4, 4.5),
    (16_384, 1.45, 5.5),
    (float("inf"), 1.45, 6.5),
)
CHUNK_BYTES = 4_096
#: chunks shorter than this, at the end of a text, are judged with the whole only
LEAST_CHUNK = 1_024
#: a text fails if more than this share of its chunks is outside their band
BAD_CHUNKS = 0.2
LEVEL = 3

MIN_WORDS = 50
SYMBOLS = re.compile(r"[#*$%&|<>]")
WHITE = re.compile(r"[\x20\x09-\x0D]")

COLUMNS = (
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("base_failed", T.BooleanType()),
    ("ratio", T.DoubleType()),
    ("n_chunks", T.LongType()),
    ("n_bad_chunks", T.LongType()),
    ("kept", T.BooleanType()),
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = len(number) + 1
    # Pairs are numbered first, so that no product leaves 64 bits.
    _, pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
    _, where, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    again = counts[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.encode("utf-8", "surrogatepass").split():
            count += line in seen
            seen.add(line)
    return count


def in_band(size: int, compressed: int, bands=BANDS) -> bool:
    low, high = next((a, b) for below, a, b in bands if size < below)
    return low <= size / max(compressed, 1) <= high


def judged(text: str | None, compressor: zstandard.ZstdCompressor, bands=BANDS) -> tuple:
    """The values of ``COLUMNS`` for one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n_words = len(words)
    n_repeat = repeated_words(words)
    failed = n_words < MIN_WORDS or 100 * n_repeat > 50 * n_words
    whole = len(compressor.compress(raw))
    chunks = [
        raw[i : i + CHUNK_BYTES]
        for i in range(0, len(raw), CHUNK_BYTES)
        if len(raw) > CHUNK_BYTES and len(raw) - i >= LEAST_CHUNK
    ]
    bad = sum(not in_band(len(c), len(compressor.compress(c)), bands) for c in chunks)
    kept = not failed and in_band(len(raw), whole, bands) and bad <= BAD_CHUNKS * len(chunks)
    return (
        n_words,
        len(text) - len(WHITE.findall(text)),
        len(SYMBOLS.findall(text)),
        repeated_lines(text),
        n_repeat,
        failed,
        len(raw) / whole,
        len(chunks),
        bad,
        kept,
    )


def quality_rules(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bands=BANDS
) -> DataFrame:
    """Counts and verdict for every row: its id and ``COLUMNS``.

    A null text counts as empty; an empty text has no words and fails. Repeated rows are judged each for
    itself, and an empty table gives no rows. Columns other than the two named are not read.
    """
    schema = T.StructType(
        [T.StructField(id_column, docs.schema[id_column].dataType)]
        + [T.StructField(n, t) for n, t in COLUMNS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = zip(*(judged(t.as_py(), compressor, bands) for t in batch.column(1)))
            columns = list(rows) or [[] for _ in COLUMNS]
            kinds = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.DoubleType(): pa.float64()}
            arrays = [pa.array(c, kinds[t]) for c, (_, t) in zip(columns, COLUMNS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema.names)

    return docs.select(f"`{id_column}`", docs[text_column].cast("string")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, text_column: str = "text", bands=BANDS) -> DataFrame:
    """The rows of ``docs`` that pass, all columns unchanged, in one pass without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_column))
            yield batch.filter(pa.array([judged(t.as_py(), compressor, bands)[-1] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
