"""Row positions of splittable text files, without a global sort or window, and only for the rows that need one.

Spark reads a split in order, so the running id of a task numbers the rows of one split. Rows carry file, split and running id
through the checks and are written once, checked or not. What is missing for a row number is the number of rows in the earlier
splits of the file: one count per split, taken from the three columns of that copy and summed up per file on a frame with one row
per split. Only findings, and callers that ask for all numbers, ever meet that frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridgate.config import JVM_CHARSETS
from gridgate.session import staged

FILE, ORDINAL, SPLIT, TICK = "_file", "_ordinal", "_split", "_tick"
#: Kinds of a row's cells in column order, beside the text cells of a source that has typed ones.
KINDS = "_kinds"
#: Marks of a row of a delimited file: it reads like the header; its line ends inside a quoted cell.
HEAD, TORN = "_head", "_torn"


def with_split(df: DataFrame) -> DataFrame:
    """Add file, split start and running id to a frame read straight from files."""
    placed = df.select("*", F.col("_metadata.file_path").alias(FILE),
                       F.col("_metadata.file_block_start").alias(SPLIT))
    return retick(placed)


def retick(df: DataFrame) -> DataFrame:
    """(Re)start the running id, say after rows were filtered out or exploded."""
    return df.withColumn(TICK, F.monotonically_increasing_id())


def split_offsets(ticked: DataFrame, **more) -> DataFrame:
    """One row per split: first running id, rows in it, rows of the file before it, and ``more`` aggregates.

    The window runs over the splits of one file, not over rows.
    """
    counts = ticked.groupBy(FILE, SPLIT).agg(
        F.min(TICK).alias("_first"), F.count("*").alias("_n"), *[agg.alias(name) for name, agg in more.items()])
    splits = Window.partitionBy(FILE).orderBy(SPLIT)
    before = F.coalesce(F.sum("_n").over(splits.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select("*", before.alias("_before"))


def number(rows: DataFrame, offsets: DataFrame, name: str = ORDINAL) -> DataFrame:
    """Rows with their 0-based position in the file; split and running id go."""
    return (rows.join(offsets.select(FILE, SPLIT, "_first", "_before"), [FILE, SPLIT])
            .withColumn(name, F.col("_before") + F.col(TICK) - F.col("_first"))
            .drop(SPLIT, TICK, "_first", "_before"))


def with_ordinals(ticked: DataFrame, name: str = ORDINAL) -> DataFrame:
    """0-based position of every row in its file.

    ``ticked`` is any narrow, deterministic transformation of a file scan whose last step was :func:`retick`. The source is read
    once: how it is cut into splits may change between two readings, say when the cluster grows, and ids of one reading would
    then miss the counts of another.
    """
    held = staged(ticked, "lines")
    return number(held, staged(split_offsets(held), "splits"), name)


@dataclass(frozen=True)
class Reading:
    """A source as it is read: lazy rows with file, split, running id and cells, header rows and all.

    ``skip_rows`` is the row of the header, None for sources without one; such rows carry ``_head`` and ``_torn``. ``files`` lists
    the files of the source. ``again`` reads the files of a list by records, where lines are torn by quoted line ends. ``pinned``
    rows come from a written copy already; ``exact`` ones have their row number as running id.
    """

    rows: DataFrame
    columns: list[str]
    skip_rows: int | None = None
    skip_cols: int = 0
    max_row: int | None = None
    row_base: int = 1
    typed: bool = False
    files: DataFrame | None = None
    rejected: DataFrame | None = None
    again: Callable[[list[str]], Reading] | None = None
    pinned: bool = False
    exact: bool = False

    @property
    def row(self) -> str:
        """SQL of the 1-based sheet row."""
        return f"{ORDINAL} + {self.row_base}"


@dataclass(frozen=True)
class Placed:
    """Written data rows of a reading, still with split and running id, and what numbers them. ``rejected`` lists files left out."""

    rows: DataFrame
    offsets: DataFrame | None
    rejected: DataFrame

    def numbered(self, rows: DataFrame) -> DataFrame:
        """These rows, or any narrow transformation of them, by number."""
        return number(rows, self.offsets) if self.offsets is not None else rows.withColumnRenamed(TICK, ORDINAL).drop(SPLIT)


HEADER_DIFFERS = "header differs from the first file"
NO_HEADER = "the file is empty or has only skipped rows"
OPEN_QUOTE = "a quoted cell is never closed"


def settle(reading: Reading, prepare: Callable[[DataFrame], DataFrame] | None = None, label: str = "rows") -> Placed:
    """Write the prepared rows once; header rows, rows beyond ``max_row`` and files with another header do not come back.

    ``prepare`` keeps file, split, running id and the marks. Header rows are known by their running ids, a few per file, so no
    row meets its offset here; only ``max_row`` makes rows meet the bounds of their split.
    """
    held = reading.rows if reading.pinned and not prepare else staged(prepare(reading.rows) if prepare else reading.rows, label)
    if reading.skip_rows is None:
        return Placed(held, None if reading.exact else staged(split_offsets(held), "splits"), reading.rejected)
    offsets = staged(split_offsets(held, torn=F.bool_or(TORN), lead=F.min_by(HEAD, TICK)), "splits")
    skip = reading.skip_rows
    in_head = offsets.filter(F.col("_before") <= skip).withColumn("_place", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.least(F.col("_n"), skip + 1 - F.col("_before")) - 1)))
    heads = in_head.select(FILE, (F.col("_first") + F.col("_place")).alias(TICK), (F.col("_before") + F.col("_place")).alias("_at"), "lead")
    heads = staged(heads, "heads")
    judged = heads.filter(F.col("_at") == skip)
    judged = (judged.withColumnRenamed("lead", HEAD) if skip == 0 else judged.drop("lead").join(held.select(TICK, HEAD), TICK)).select(FILE, HEAD)
    torn = offsets.groupBy(FILE).agg(F.bool_or("torn").alias("torn"))
    verdict = reading.files.join(torn, FILE, "left").join(judged, FILE, "left")
    by_records = F.coalesce(F.col("torn"), F.lit(False))
    reason = (F.when(by_records, F.lit(OPEN_QUOTE) if reading.again is None else F.lit(None))
              .when(F.col(HEAD).isNull(), NO_HEADER).when(~F.col(HEAD), HEADER_DIFFERS))
    # Files that are odd in some way; their names are part of the listing that the driver holds anyway.
    odd = [tuple(r) for r in verdict.select(FILE, reason.alias("reason"), by_records.alias("torn")).filter("torn or reason is not null").collect()]
    session = held.sparkSession
    rejected = session.createDataFrame([(f, why) for f, why, _ in odd if why], f"{FILE} string, reason string")
    rows = held.join(heads.select(TICK), TICK, "left_anti")
    if odd:
        rows = rows.join(session.createDataFrame([(f,) for f, *_ in odd], f"{FILE} string"), FILE, "left_anti")
    if reading.max_row is not None:
        last = F.col("_first") + (skip + reading.max_row - F.col("_before"))
        rows = rows.join(offsets.select(FILE, SPLIT, last.alias("_last")), [FILE, SPLIT]).filter(F.col(TICK) <= F.col("_last")).drop("_last")
    rows, offsets = rows.drop(HEAD, TORN), offsets.drop("torn", "lead")
    again = [f for f, why, by_records in odd if by_records and not why]
    if again:
        other = settle(reading.again(again), prepare, label)
        mine = offsets.join(session.createDataFrame([(f,) for f in again], f"{FILE} string"), FILE, "left_anti")
        return Placed(rows.unionByName(other.rows), mine.unionByName(other.offsets), rejected.unionByName(other.rejected))
    return Placed(rows, offsets, rejected)


def read_lines(spark: SparkSession, paths, encoding: str = "utf-8", separator: str | None = None) -> DataFrame:
    """Lines (or pieces between ``separator``) of text files in one ``value`` column.

    Charsets other than UTF-8 go through the CSV reader with a separator that
    cannot occur and without quotes; those of two bytes a character see
    :func:`read_wide_lines`.
    """
    charset = JVM_CHARSETS[encoding.lower()]
    if charset in ("UTF-8", "US-ASCII"):
        reader = spark.read.option("lineSep", separator) if separator else spark.read
        return reader.text(paths)
    if charset.startswith("UTF-16"):
        return read_wide_lines(spark, paths, charset, separator or "\n")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = _plain_csv(spark, charset)
    return (reader.option("lineSep", separator) if separator else reader).csv(paths)


def _plain_csv(spark: SparkSession, charset: str):
    return (spark.read.schema("value string").option("sep", "\x01").option("quote", "")
            .option("encoding", charset).option("maxCharsPerColumn", -1)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_wide_lines(spark: SparkSession, paths, charset: str, separator: str = "\n") -> DataFrame:
    """Lines of UTF-16 files, read split by split: cut at the bytes of the separator, then decoded.

    Without a byte order in its name the charset takes that of the first file's mark, or the higher byte first. The separator's bytes may
    lie across two characters, U+0Axx before U+xx00; such a piece has an odd number of bytes and is NULL, see :func:`odd_lines`.
    """
    if charset == "UTF-16":
        lead = sorted(spark.read.format("binaryFile").load(paths).inputFiles())
        mark = spark.read.text(unquote(lead[0])).select(F.substring(F.col("value").cast("binary"), 1, 2)).first() if lead else None
        charset = "UTF-16LE" if mark and bytes(mark[0]) == b"\xff\xfe" else "UTF-16BE"
    raw = spark.read.option("encoding", charset).option("lineSep", separator).text(paths)
    piece = F.col("value").cast("binary")
    text = F.when(F.length(piece) % 2 == 0, F.decode(piece, charset))
    text = F.when(F.col("_metadata.file_block_start") == 0, F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
    return raw.select((F.regexp_replace(text, r"\r$", "") if separator == "\n" else text).alias("value"), "_metadata")


def odd_lines(spark: SparkSession, paths, encoding: str) -> DataFrame:
    """Lines of UTF-16 files in which a character pair looks like a line end: by characters, one task per file."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return _plain_csv(spark, JVM_CHARSETS[encoding.lower()]).option("multiLine", True).csv(paths)
