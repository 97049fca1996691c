"""Yearly CSV dumps: one folder per source, headers that drift from file to file.

The driver handles file names and header names only. All data cells are read as text, so files
whose columns look like different types still append.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantweave.functions.text import NULL_TOKENS, null_tokens
from grantweave.operators.append import append_by_name
from grantweave.sources.tables import REJECTED

_BAD = "_unparsed_line"
_SECOND = "_second_cell"
_PATH = "_path_of_file"
TOO_MANY_CELLS = "too many cells"

# The byte-order mark, as itself and as Latin-1 shows its three bytes.
BYTE_ORDER_MARKS = ("\ufeff", "ï»¿")

#: how a file is parsed: in splits, or in one task because its records span lines
SPLITS, WHOLE = "splits", "whole"

#: a line of white space alone is no record; quotes or a separator make it one
_BLANK = r"^[\x00-\x20]*$"

CSV_OPTIONS = {"encoding": "ISO-8859-1", "quote": '"', "escape": '"', "sep": ","}


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def separators(record: Column) -> Column:
    """Cell separators of a record, those inside quotes not counted."""
    plain = F.when(record.contains('"'), F.regexp_replace(record, '(?s)"[^"]*+"', "")).otherwise(record)
    return count_char(plain, ",")


@dataclass(frozen=True)
class SourceFolder:
    """What the file listing says about one expected source."""

    source: str
    exists: bool
    files: tuple[tuple[str, int], ...]  # (path, bytes)


@dataclass(frozen=True)
class SourceFile:
    """One CSV file that holds data rows."""

    source: str
    path: str
    size: int
    raw_columns: tuple[str, ...]
    columns: tuple[str, ...]  # after renaming
    parse: str = WHOLE
    #: cells of the header where the parser takes a line of white space before it for the header
    header_row: tuple[str, ...] | None = None


def list_folders(spark: SparkSession, root: str, sources: Sequence[str]) -> list[SourceFolder]:
    """The ``*.csv`` files of each expected source folder, from file-system metadata."""
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    folders = []
    for source in sources:
        folder = path_class(f"{root.rstrip('/')}/{source}")
        fs = folder.getFileSystem(conf)
        exists = bool(fs.exists(folder))
        found = fs.globStatus(path_class(folder, "*.csv")) if exists else []
        files = sorted((f.getPath().toString(), int(f.getLen())) for f in found if f.isFile())
        folders.append(SourceFolder(source, exists, tuple(files)))
    return folders


def source_presence(spark: SparkSession, folders: Sequence[SourceFolder]) -> DataFrame:
    """``(source, status, file_count)``; status is missing, empty or ok."""
    rows = [
        (f.source, "missing" if not f.exists else "ok" if f.files else "empty", len(f.files))
        for f in folders
    ]
    return spark.createDataFrame(rows, "source string, status string, file_count bigint")


def clean_header(cells: Sequence[str | None]) -> tuple[str, ...]:
    """Column names without byte-order marks and outer quotes; repeats become ``A, A.1``.

    Names that differ only by case repeat each other, as Spark takes them for one column.
    """
    names: list[str] = []
    taken: set[str] = set()
    for i, cell in enumerate(cells):
        name = cell or f"Unnamed: {i}"
        copy, n = name, 0
        while copy.lower() in taken:
            n += 1
            copy = f"{name}.{n}"
        taken.add(copy.lower())
        names.append(copy)
    cleaned = []
    for name in names:
        for mark in BYTE_ORDER_MARKS:
            name = name.replace(mark, "")
        cleaned.append(name.strip('"'))
    return tuple(cleaned)


def rename_header(columns: Sequence[str], names: Mapping[str, str]) -> tuple[str, ...]:
    """Apply the rename map; unknown names are ignored, two columns with one target are refused."""
    renamed = tuple(names.get(c, c) for c in columns)
    doubled = sorted({c for c in renamed if renamed.count(c) > 1})
    if doubled:
        raise ValueError(f"renaming gives several columns the name {doubled}")
    return renamed


def _scan(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str],
    multi_line: bool,
    header_row: Sequence[str] | None = None,
    with_path: bool = False,
) -> DataFrame:
    """All records of files that share one header, with ``REJECTED``. Short ones are padded; an over-long one has
    no cells, as it is not a row. With ``header_row``, records of just these cells are left out."""
    # A record whose number of cells is not the schema's comes with its raw text. Of one column, that is what tells
    # a blank line from a quoted blank cell, so there the schema has a second column no record should fill.
    extra = [_SECOND] if len(columns) == 1 else []
    fields = [T.StructField(c, T.StringType()) for c in [*columns, *extra, _BAD]]
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        # A pruned parse skips the cells whose number tells over-long lines.
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _BAD)
        .schema(T.StructType(fields))
        .csv(list(paths))
    )
    bad, first = F.col(_BAD), F.col(f"`{columns[0]}`")
    # Spark refuses to read the unparsed text alone, so a data column takes part.
    some_cell = F.length(F.concat_ws("", first)) >= 0
    fits = F.coalesce(separators(bad) < len(columns), F.lit(not extra))
    text = bad
    if extra:
        text = F.coalesce(bad, F.concat_ws(",", F.coalesce(first, F.lit("")), F.coalesce(_SECOND, F.lit(""))))
    rejected = F.struct(
        F.col("_metadata.file_path").alias("path"), text.alias("text"), F.lit(TOO_MANY_CELLS).alias("reason")
    )
    if header_row:
        cells = [F.col(f"`{c}`").eqNullSafe(F.lit(h or None)) for c, h in zip(columns, header_row)]
        raw = raw.filter(~reduce(lambda a, b: a & b, cells))
    return raw.filter(some_cell & ~F.coalesce(bad.rlike(_BLANK), F.lit(False))).select(
        *[F.when(fits, F.col(f"`{c}`")).alias(c) for c in columns],
        F.when(~fits, rejected).alias(REJECTED),
        *([F.col("_metadata.file_path").alias(_PATH)] if with_path else []),
    )


def rows_of(scanned: DataFrame) -> DataFrame:
    """The records that are rows."""
    return scanned.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_of(scanned: DataFrame) -> DataFrame:
    """``(path, text, reason)`` of the records that are not."""
    return scanned.filter(F.col(REJECTED).isNotNull()).select(f"{REJECTED}.*")


def _line_facts(spark: SparkSession, paths: Sequence[str]) -> dict[str, Row]:
    """Of each file: ``first``, its first line that is not blank; ``odd``, whether some line has an odd number of
    quotes; ``counts``, how many lines have how many separators; ``after_space``, whether a line of white space comes
    before the first. One job for all files, read in splits."""
    line = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("id")).alias("place"),
        line.alias("line"),
    )
    kind = F.when(F.col("line").rlike(_BLANK), F.lit(-1)).otherwise(separators(F.col("line")))
    counted = (
        lines.filter("line != ''")
        .groupBy("path", kind.alias("separators"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("place", "line")).alias("first"),
            F.bool_or(count_char(F.col("line"), '"') % 2 == 1).alias("odd"),
        )
    )
    record = F.col("separators") >= 0
    facts = counted.groupBy("path").agg(
        F.min(F.when(record, F.col("first"))).alias("record"),
        F.min(F.when(~record, F.col("first"))).alias("space"),
        F.bool_or("odd").alias("odd"),
        F.map_from_entries(F.collect_list(F.when(record, F.struct("separators", "n")))).alias("counts"),
    )
    facts = facts.filter("record is not null").select(
        "path",
        F.col("record.line").alias("first"),
        "odd",
        "counts",
        F.coalesce(F.col("space.place") < F.col("record.place"), F.lit(False)).alias("after_space"),
    )
    return {_tail(unquote(r.path)): r for r in facts.collect()}


def _tail(path: str) -> str:
    """A path without its scheme, which listings and scans spell differently."""
    return path.split(":", 1)[-1].lstrip("/")


def _files_with_rows(spark: SparkSession, files: Sequence[SourceFile]) -> set[str]:
    """Of files that are parsed whole, those that hold a row. One job for each different number of columns."""
    groups: dict[tuple, list[str]] = {}
    for f in files:
        groups.setdefault((len(f.columns), f.header_row), []).append(f.path)
    found = set()
    for (width, header_row), paths in groups.items():
        names = [f"c{i}" for i in range(width)]
        rows = rows_of(_scan(spark, paths, names, True, header_row, with_path=True))
        found |= {_tail(unquote(r[0])) for r in rows.select(_PATH).distinct().collect()}
    return found


def inspect_files(
    spark: SparkSession,
    folders: Sequence[SourceFolder],
    rename: Mapping[str, str] | None = None,
    multi_line: bool | None = None,
) -> list[SourceFile]:
    """Headers of all files that hold data rows; files without any are left out.

    ``multi_line`` None finds out per file whether records span lines. The number of jobs does not depend on the
    number of files, but for headers that span lines.
    """
    listed = [(f.source, path, size) for f in folders for path, size in f.files]
    facts = _line_facts(spark, [path for _, path, _ in listed]) if listed else {}
    found, unsure = [], []
    for source, path, size in listed:
        fact = facts.get(_tail(path))
        if fact is None or sum(fact.counts.values()) < 2:
            continue
        if fact.first.count('"') % 2:
            scan = spark.read.options(**CSV_OPTIONS).option("multiLine", True)
            cells = list(scan.csv(path).first())
        else:
            cells = next(csv.reader([fact.first]))
        header = clean_header(cells)
        whole = fact.odd if multi_line is None else multi_line
        file = SourceFile(
            source,
            path,
            size,
            header,
            rename_header(header, rename or {}),
            WHOLE if whole else SPLITS,
            tuple(cells) if whole and fact.after_space else None,
        )
        if fact.odd:
            unsure.append(file)
        elif sum(n for separators, n in fact.counts.items() if separators < len(header)) < 2:
            continue  # all other lines are too long
        found.append(file)
    with_rows = _files_with_rows(spark, unsure) if unsure else set()
    without = {f.path for f in unsure if _tail(f.path) not in with_rows}
    return [f for f in found if f.path not in without]


def rename_audit(
    spark: SparkSession, files: Sequence[SourceFile], rename: Mapping[str, str]
) -> DataFrame:
    """``(source, file, old, new)`` for every rename that took place."""
    rows = [
        (f.source, f.path.rsplit("/", 1)[-1].removesuffix(".csv"), old, new)
        for f in files
        for old, new in rename.items()
        if old in f.raw_columns
    ]
    return spark.createDataFrame(rows, "source string, file string, old string, new string")


def scan_source(
    spark: SparkSession,
    files: Sequence[SourceFile],
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """All records of one source appended by column name, every column text, with ``REJECTED``.

    Files with the same header share one scan. Missing-value spellings become null here, once.
    """
    groups: dict[tuple, list[str]] = {}
    for f in files:
        groups.setdefault((f.columns, f.parse == WHOLE, f.header_row), []).append(f.path)
    scans = [_scan(spark, paths, columns, whole, row) for (columns, whole, row), paths in groups.items()]
    table = append_by_name(scans)
    cells = [null_tokens(F.col(f"`{c}`"), tokens).alias(c) for c in table.columns if c != REJECTED]
    return table.select(*cells, REJECTED)


def read_source(
    spark: SparkSession,
    files: Sequence[SourceFile],
    tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """The rows of one source; over-long records are left out, see :func:`scan_source`."""
    return rows_of(scan_source(spark, files, tokens))


def scan_counts(spark: SparkSession, scanned: Mapping[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """Rows and rejected records of each source, in one job."""
    parts = [
        df.agg(
            F.count_if(F.col(REJECTED).isNull()).alias("rows"), F.count_if(F.col(REJECTED).isNotNull()).alias("rejected")
        ).select(F.lit(source).alias("source"), "rows", "rejected")
        for source, df in scanned.items()
    ]
    return {r.source: (r.rows, r.rejected) for r in reduce(DataFrame.union, parts).collect()} if parts else {}


def load_audit(
    spark: SparkSession, files: Sequence[SourceFile], counts: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Per source: files with data, rows, records left out, input bytes. ``counts`` has rows and rejected records."""
    facts: dict[str, list[int]] = {}
    for f in files:
        fact = facts.setdefault(f.source, [0, 0])
        fact[0] += 1
        fact[1] += f.size
    return spark.createDataFrame(
        [(s, n, *counts.get(s, (0, 0)), size) for s, (n, size) in facts.items()],
        "source string, file_count bigint, total_rows bigint, rejected_records bigint, total_bytes bigint",
    )


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """An exported CSV table with a declared schema; a missing path raises."""
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .schema(schema)
        .csv(path)
    )
