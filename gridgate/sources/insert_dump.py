"""SQL dumps made of ``INSERT INTO … VALUES`` statements."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgate.config import JVM_CHARSETS
from gridgate.errors import SourceError
from gridgate.functions.brackets import SHALLOW, deepest, groups, parts, shallow_group
from gridgate.session import staged
from gridgate.sources.delimited import Scan, numbered_scan
from gridgate.sources.positions import FILE, KINDS, SPLIT, TICK, Reading, read_lines, retick, with_split

# Possessive quantifiers keep the patterns linear and free of recursion on long statements.
_PLAIN_QUOTED = r"'(?:[^']++|'')*+'"
_ESCAPED_QUOTED = r"'(?:[^'\\]++|''|\\.)*+'"
# Statements that nest deeper are cut by running depth, with the same result.
_PATTERN_DEPTH = SHALLOW
_COMMA = r"\s*+,?+\s*+"
# What may follow the tuples of a statement.
_CLAUSE = r"(?is)^\s*+(?:,\s*+)?(?:$|(?:ON\s+CONFLICT|ON\s+DUPLICATE\s+KEY|RETURNING|SETTINGS)\b)"
# Escapes of the ch dialect that stand for another character.
_CONTROL = {"b": "\b", "f": "\f", "r": "\r", "n": "\n", "t": "\t", "0": "\0", "a": "\a", "v": "\v"}


def read_dump(spark: SparkSession, paths, dialect: str = "gp", encoding: str = "utf-8",
              separator: str = ";\n", whole_files: bool = False) -> DataFrame:
    """Statements of dump files, one row each.

    Files split at ``separator``; a piece may still hold several statements. A statement ends at a semicolon
    or at the next INSERT. A quoted text that contains the separator leaves pieces with an open quote, marked
    ``_broken``; ``whole_files`` reads such files in one piece. A statement of which anything but tuples and a
    known clause follows VALUES, or that names no columns, makes its piece broken too. Parentheses may nest to
    any depth. Backslashes escape in the ``ch`` dialect only.
    """
    if whole_files:
        files = spark.read.format("binaryFile").load(paths)
        source = files.select(F.decode("content", JVM_CHARSETS[encoding.lower()]).alias("value"), "_metadata")
    else:
        source = read_lines(spark, paths, encoding, separator)
    quoted, text = _quoted(dialect), F.col("value")
    commented = F.contains(text, F.lit("--")) | F.contains(text, F.lit("/*"))
    clean = F.when(commented, F.regexp_replace(
        text, F.lit(rf"(?s)({quoted})|--[^\n]*+|/\*.*?\*/"), F.lit("$1"))).otherwise(text)
    head = r"INSERT\s+INTO\s+([^\s(]+)\s*\(([^)]+)\)\s*VALUES\s*+"
    whole = rf"(?is){head}(?:[^';iI]++|{quoted}|(?!INSERT\s+INTO\s)[iI])*+"
    pieces = with_split(source).select(FILE, "_split", "_tick", clean.alias("_clean")).withColumn(
        "_statements", F.regexp_extract_all("_clean", F.lit(whole), F.lit(0)))
    # Statements that fill a piece leave nothing over to look at.
    filled = F.length(F.array_join("_statements", "")) == F.length("_clean")
    other = F.regexp_replace(F.regexp_replace("_clean", whole, ""), f"(?s){quoted}", "")
    unread = ~filled & other.rlike(r"(?is)INSERT\s+INTO\s+[^\s(]+\s*(?:\([^)]*\)\s*)?VALUES\b")
    found = pieces.select(FILE, "_split", "_tick", (_open_quote(F.col("_clean"), dialect) | unread).alias("_odd"),
                          F.explode_outer("_statements").alias("_statement")
                          ).filter("_odd or _statement is not null")
    part = lambda i: F.regexp_extract("_statement", rf"(?is)^{head}", i)
    full = F.lower(F.regexp_replace(part(1), r'[`"\[\]]', ""))
    names = F.transform(F.split(part(2), ","), lambda c: F.btrim(F.lower(c), F.lit(' `"[]\n\r\t')))
    body = F.substring("_statement", F.length(part(0)) + 1, F.length("_statement"))
    read = found.select(FILE, "_split", "_tick", "_odd", full.alias("_full_table"), names.alias("_names"), body.alias("_body"))
    read = _read_tuples(read, dialect)
    broken = F.col("_odd") | F.coalesce(~F.col("_read.tail").rlike(_CLAUSE) | (F.size("_read.groups") == 0), F.lit(False))
    return read.select(
        FILE, "_split", "_tick", broken.alias("_broken"), "_full_table",
        F.regexp_replace("_full_table", r"^[^.]*\.", "").alias("_table"), "_names", F.col("_read.groups").alias("_tuples"))


def _read_tuples(read: DataFrame, dialect: str) -> DataFrame:
    """Add ``_read``, a ``struct<groups, tail>`` of a statement's body: its tuples, and what follows them.

    What is used twice is a column of its own, so that no pattern runs twice over a statement. Statements that nest too deep for the
    pattern are cut by running depth, with the same result.
    """
    quoted, body = _quoted(dialect), F.col("_body")
    row = shallow_group(quoted, _PATTERN_DEPTH)[1]
    read = read.withColumn("_lead", F.regexp_extract(body, f"(?s)^(?:{_COMMA}{row})*+", 0))
    read = read.withColumn("_tail", F.substring(body, F.length("_lead") + 1, F.length(body)))
    deep = F.col("_tail").rlike(rf"^{_COMMA}\(") & (deepest(body, quoted) > _PATTERN_DEPTH)
    by_pattern = F.struct(F.regexp_extract_all("_lead", F.lit(f"(?s){row}"), F.lit(0)).alias("groups"), F.col("_tail").alias("tail"))
    return read.withColumn("_read", F.when(body.isNull(), None).when(deep, groups(body, quoted, _COMMA)).otherwise(by_pattern))


def _open_quote(text: Column, dialect: str) -> Column:
    """An odd number of quotes; escaped ones come in pairs or do not count."""
    if dialect == "ch":
        text = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit("\\'"), F.lit(""))
    return (F.length(text) - F.length(F.replace(text, F.lit("'"), F.lit("")))) % 2 == 1


def _quoted(dialect: str) -> str:
    return _ESCAPED_QUOTED if dialect == "ch" else _PLAIN_QUOTED


def dump_rows(dump: DataFrame, dialect: str = "gp") -> DataFrame:
    """One row per tuple: ``items`` as ``struct<kind, text>``, NULL for SQL NULL.

    Pieces marked ``_broken`` keep a row even without a tuple.
    """
    words = F.transform("_raw", lambda raw: F.struct(F.trim(raw).alias("word")))
    kinds = F.transform(words, lambda w: F.struct(w["word"].alias("word"), _kind(w["word"]).alias("kind")))
    texts = F.transform(kinds, lambda w: F.struct(w["kind"].alias("kind"), _text(w["word"], w["kind"], dialect).alias("text")))
    items = F.transform(texts, lambda w: F.when(w["text"] != "", w))
    return _raw_rows(dump, dialect).withColumn("items", items).drop("_raw")


def _raw_rows(dump: DataFrame, dialect: str) -> DataFrame:
    """One row per tuple: ``_raw`` holds its items as they are written."""
    quoted = _quoted(dialect)
    item = rf"\s*+({quoted}|(?:[^,'()]++|{quoted})*+)\s*+(?:,|$)"
    rows = dump.select(FILE, "_split", "_tick", "_broken", "_full_table", "_table", "_names",
                       F.explode_outer("_tuples").alias("_t")).filter("_broken or _t is not null")
    body = F.substring("_t", F.lit(2), F.length("_t") - 2)
    nested = F.contains(body, F.lit("(")) & body.rlike(rf"(?s)^(?:[^()']++|{quoted})*+\(")
    raw = F.when(nested, parts(body, quoted)).otherwise(F.regexp_extract_all(body, F.lit(f"(?s){item}"), F.lit(1)))
    return rows.select(FILE, "_split", "_tick", "_broken", "_full_table", "_table", "_names",
                       raw.alias("_raw"))


def _kind(word: Column) -> Column:
    """Quoted means text; bare words are NULL, booleans, whole numbers, fractions, or text."""
    return (F.when(F.startswith(word, F.lit("'")), "str").when(word.rlike(r"^[+-]?\d+$"), "int")
            .when(F.upper(word) == "NULL", None).when(F.upper(word).isin("TRUE", "FALSE"), "bool")
            .when(word.rlike(r"^[+-]?(\d+\.\d*|\.\d+|\d+(\.\d*)?[eE][+-]?\d+)$"), "float").otherwise("str"))


def _text(word: Column, kind: Column, dialect: str) -> Column:
    """Cell of a word: text without its quotes and escapes, integers without plus sign and leading zeros; NULL or empty without a value."""
    text = F.replace(F.substring(word, F.lit(2), F.length(word) - 2), F.lit("''"), F.lit("'"))
    if dialect == "ch":
        plain = F.replace(text, F.lit("\\\\"), F.lit("\\\x01"))
        for letter, char in _CONTROL.items():
            plain = F.replace(plain, F.lit("\\" + letter), F.lit(char))
        plain = F.replace(F.regexp_replace(plain, r"\\([^\x01])", "$1"), F.lit("\\\x01"), F.lit("\\"))
        text = F.when(F.contains(word, F.lit("\\")), plain).otherwise(text)
    # Signs and zeros in front are rare; the patterns that take them off run only there.
    signed = F.substring(word, F.lit(1), F.lit(1)).isin("+", "0", "-")
    whole = F.when(signed, F.regexp_replace(F.regexp_replace(word, r"^\+", ""), r"^(-?)0+(?=\d)", "$1")).otherwise(word)
    return F.when(F.startswith(word, F.lit("'")), text).when(kind == "int", whole).when(kind.isNotNull(), word)


def dump_tables(rows: DataFrame) -> DataFrame:
    """Tables of each file: row count, columns, and place of the first row."""
    return rows.filter("items is not null").groupBy(FILE, "_table").agg(
        F.count("*").alias("rows"), F.min_by("_names", F.struct("_split", "_tick")).alias("columns"),
        F.min(F.struct("_split", "_tick")).alias("first_at"))


def first_table(spark: SparkSession, paths, dialect: str = "gp", encoding: str = "utf-8",
                separator: str = ";\n", whole_files: bool = False) -> str:
    """Name of the first table of the first file that has one; reads no further."""
    for path in sorted(spark.read.format("binaryFile").load(paths).inputFiles()):
        lead = read_dump(spark, unquote(path), dialect, encoding, separator, whole_files).filter("_table != ''").first()
        if lead is not None:
            return lead._table
    raise SourceError("no INSERT statements found")


def scan_insert_dump(spark: SparkSession, paths, table: str | None = None, dialect: str = "gp",
                     encoding: str = "utf-8", separator: str = ";\n", whole_files: bool = False) -> Scan:
    """Cells of one table of a dump, with their kinds; see :func:`open_insert_dump`."""
    return numbered_scan(open_insert_dump(spark, paths, table, dialect, encoding, separator, whole_files))


def open_insert_dump(spark: SparkSession, paths, table: str | None = None, dialect: str = "gp",
                     encoding: str = "utf-8", separator: str = ";\n", whole_files: bool = False) -> Reading:
    """Rows of one table of a dump, those of all its statements together.

    ``table`` may carry a schema, which is then compared too. Without it the
    first table of the first file is taken. Short tuples are padded with NULL.
    The statements are taken apart once; everything else uses staged tuples.
    Files with a text that crosses the separator, or with a statement that
    cannot be read, are listed in ``rejected``.
    """
    rows = _raw_rows(read_dump(spark, paths, dialect, encoding, separator, whole_files), dialect)
    if table is None:
        wanted = F.col("_table") == first_table(spark, paths, dialect, encoding, separator, whole_files)
    else:
        key = table.lower()
        wanted = F.col("_full_table" if "." in key else "_table") == key
    wanted = wanted & F.col("_raw").isNotNull()
    taken = staged(retick(rows.filter(wanted | F.col("_broken")).select(
        FILE, SPLIT, "_broken", "_names", F.when(wanted, F.col("_raw")).alias("_raw"))), "tuples")
    mine = taken.filter("_raw is not null")
    lead = mine.select("_names").first()
    broken = taken.filter("_broken").select(FILE).distinct().withColumn(
        "reason", F.lit("quoted text contains the statement separator, or something that is no tuple follows VALUES"))
    if lead is None:
        known = [r[0] for r in rows.select("_full_table").distinct().limit(20).collect()]
        raise SourceError(f"table {table!r} not found in the dump; it has {sorted(k for k in known if k)}")
    columns = list(lead._names)
    # Words, kinds and cells are columns, a step each: compiled code works each of them out once.
    numbers, place = range(len(columns)), [FILE, SPLIT, TICK]
    words = mine.select(*place, *[F.trim(F.get("_raw", F.array_position("_names", c).cast("int") - 1)).alias(f"_w{i}") for i, c in enumerate(columns)])
    kinds = words.select("*", *[_kind(F.col(f"_w{i}")).alias(f"_k{i}") for i in numbers])
    cells = kinds.select(*place, *[f"_k{i}" for i in numbers], *[_text(F.col(f"_w{i}"), F.col(f"_k{i}"), dialect).alias(f"_c{i}") for i in numbers])
    filled = lambda i, shown: F.when(F.col(f"_c{i}") != "", F.col(shown))
    typed = cells.select(*place, *[filled(i, f"_c{i}").alias(c) for i, c in enumerate(columns)],
                         F.array(*[filled(i, f"_k{i}") for i in numbers]).alias(KINDS))
    return Reading(typed, columns, row_base=2, typed=True, rejected=broken, pinned=True)
