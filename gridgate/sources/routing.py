"""Which scan reads which file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgate.config import PLACEHOLDER_TABLE
from gridgate.errors import SourceError

# Suffixes of the known formats.
FORMATS = {"xlsx": "workbook", "xls": "workbook", "xlsm": "workbook",
           "csv": "delimited", "tsv": "delimited", "sql": "dump", "txt": "dump"}


def file_format(path):
    """Format of a path column, NULL for unknown suffixes."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
    known = F.create_map(*[F.lit(x) for pair in FORMATS.items() for x in pair])
    return F.try_element_at(known, suffix)


def route(files: DataFrame, path: str = "path") -> DataFrame:
    """Listing with ``format`` and, for unknown suffixes, ``reason``."""
    kind = file_format(F.col(path))
    return files.select(path, kind.alias("format"), F.when(kind.isNull(), "unsupported suffix").alias("reason"))


def source_format(spark: SparkSession, paths) -> str:
    """The one format of all files of a run."""
    names = spark.read.format("binaryFile").load(paths).inputFiles()
    kinds = {FORMATS.get(n.rsplit(".", 1)[-1].lower()) for n in names}
    if not names:
        raise SourceError(f"no files in {paths}")
    if len(kinds) != 1 or None in kinds:
        raise SourceError(f"{paths} mixes formats or has unsupported suffixes; known: {sorted(FORMATS)}")
    return kinds.pop()


def table_or_dump_name(configured: str, found: str) -> str:
    """Target name: the one of the dump while the configured one is a placeholder."""
    return found if configured == PLACEHOLDER_TABLE else configured
