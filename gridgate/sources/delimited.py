"""Folders of CSV and TSV files with one header layout."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgate.errors import HeaderError, SourceError
from gridgate.functions.text import WHITESPACE
from gridgate.sources.positions import FILE, HEAD, ORDINAL, SPLIT, TICK, TORN, Reading, odd_lines, read_lines, settle, with_split
from gridgate.sources.records import assemble, torn


@dataclass(frozen=True)
class Scan:
    """Rows of a source. ``rows`` holds ``_file``, ``_ordinal`` (0-based place of
    the row in its file) and the columns; ``rejected`` lists files left out. A
    ``typed`` source adds ``_kinds``, which tells numbers and booleans from text.
    """

    rows: DataFrame
    columns: list[str]
    rejected: DataFrame
    skip_cols: int = 0
    row_base: int = 1
    typed: bool = False

    @property
    def row(self) -> str:
        """SQL of the 1-based sheet row."""
        return f"{ORDINAL} + {self.row_base}"


def numbered_scan(reading: Reading) -> Scan:
    """A reading with all its row numbers."""
    placed = settle(reading)
    return Scan(placed.numbered(placed.rows), reading.columns, placed.rejected, reading.skip_cols, reading.row_base, reading.typed)


def scan_delimited(spark: SparkSession, paths, delimiter: str | None = None, encoding: str = "utf-8",
                   skip_rows: int = 0, skip_cols: int = 0, max_row: int | None = None,
                   quoted_newlines: bool = False) -> Scan:
    """Text cells of delimited files, empty ones NULL, ragged rows padded or cut; see :func:`open_delimited`."""
    return numbered_scan(open_delimited(spark, paths, delimiter, encoding, skip_rows, skip_cols, max_row, quoted_newlines))


def open_delimited(spark: SparkSession, paths, delimiter: str | None = None, encoding: str = "utf-8",
                   skip_rows: int = 0, skip_cols: int = 0, max_row: int | None = None,
                   quoted_newlines: bool = False) -> Reading:
    """Rows of delimited files before any of them is read.

    The layout is the header of the first file by path. Empty files and files with another header are left out and listed in
    ``rejected`` rather than read askew. ``delimiter`` defaults to a tab for ``.tsv`` files and a comma for the rest, file by file.
    Files are read by lines. One in which a quoted cell holds a line end is read again by records, in as many tasks; a record
    counts as one row, and so does a blank line. ``quoted_newlines`` reads all files so from the start.
    """
    files = sorted(spark.read.format("binaryFile").load(paths).inputFiles())
    if not files:
        raise SourceError(f"no files in {paths}")
    tabs = [f.lower().split("?")[0].endswith(".tsv") for f in files]
    names = _header(spark, unquote(files[0]), delimiter or _default_delimiter(tabs[0]), encoding, skip_rows)
    columns = names[skip_cols:]
    if not columns:
        raise SourceError(f"no columns left after skip_cols={skip_cols}")
    if len(set(columns)) != len(columns):
        raise HeaderError(f"duplicate column names: {sorted(c for c in set(columns) if columns.count(c) > 1)}")
    delimiters = [delimiter] if delimiter else [_default_delimiter(tab) for tab in sorted(set(tabs))]
    # Empty files too, which no scan shows; a scan names local files with one slash.
    listed = spark.createDataFrame([(re.sub("^file:/+", "file:/", f),) for f in files], f"{FILE} string")

    def reading(some, by_records: bool, listed: DataFrame) -> Reading:
        source = read_lines(spark, some, encoding, "\n" if by_records else None)
        if by_records and encoding.lower().startswith("utf-16") and not source.filter("value is null").isEmpty():
            source = odd_lines(spark, some, encoding)
        lines = with_split(source).select(FILE, SPLIT, TICK, "value")
        parts = []
        for mark in delimiters:
            mine = lines if len(delimiters) == 1 else lines.filter(F.lower(FILE).endswith(".tsv") == (mark == "\t"))
            value = F.col("value")
            rows = assemble(mine, mark) if by_records else mine.withColumn(TORN, value.isNull() | torn(value, mark))
            head = F.when((F.col(SPLIT) == 0) & F.contains(F.lower(value), F.lit(_guard(names))), _same(value, names, mark))
            cells = F.from_csv(value, _layout(len(names)), _options(mark)).alias("_cells")
            parts.append(rows.select(FILE, SPLIT, TICK, TORN, F.coalesce(head, F.lit(False)).alias(HEAD), cells).select(
                FILE, SPLIT, TICK, TORN, HEAD, *[F.col(f"_cells._c{i + skip_cols}").alias(c) for i, c in enumerate(columns)]))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        again = None if by_records else lambda some: reading(
            [unquote(f) for f in some], True, listed.filter(F.col(FILE).isin(some)))
        return Reading(rows, columns, skip_rows, skip_cols, max_row, files=listed, again=again)

    return reading(paths, quoted_newlines, listed)


def _default_delimiter(tab: bool) -> str:
    return "\t" if tab else ","


def _layout(width: int) -> str:
    return ", ".join(f"_c{i} string" for i in range(width))


def _options(delimiter: str) -> dict[str, str]:
    return {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "maxColumns": "100000"}


def _guard(names: list[str]) -> str:
    """What every form of the header line holds: most rows are told from it by this alone."""
    plain = [n for n in names if '"' not in n and "\n" not in n]
    return max(plain, key=len, default="")


def _same(value: Column, names: list[str], delimiter: str) -> Column:
    """The row's cells are the names of the header, and no more."""
    cells = F.from_csv(value, _layout(len(names) + 1), _options(delimiter))
    clean = F.array(*[F.btrim(F.lower(F.coalesce(cells[f"_c{i}"], F.lit(""))), F.lit(WHITESPACE + '"')) for i in range(len(names) + 1)])
    return clean == F.array(*[F.lit(n) for n in names], F.lit(""))


def _header(spark: SparkSession, path: str, delimiter: str, encoding: str, skip_rows: int) -> list[str]:
    """Column names of one file, from its first rows only."""
    for lines in (skip_rows + 1, 100 * (skip_rows + 1)):  # a header may run over several lines
        head = [r.value or "" for r in read_lines(spark, path, encoding).take(lines)]
        if sum(line.count('"') for line in head) % 2 == 0:
            break
    rows = list(islice(csv.reader((line + "\n" for line in head), delimiter=delimiter), skip_rows + 1))
    if len(rows) <= skip_rows:
        raise SourceError(f"{path} is empty or has only skipped rows")
    names = [c.lower().strip(WHITESPACE) for c in rows[skip_rows]]
    if not names:
        raise SourceError(f"{path} has an empty header")
    return names
