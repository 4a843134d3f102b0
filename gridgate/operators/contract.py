"""Contracts: which columns a target has and which type each of them takes.

A :class:`Contract` is the driver-side form for the one table being loaded. The
functions below work on contract *frames* - one row per column of any number of
tables - and never leave Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, replace
from itertools import takewhile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgate.config import dialect_of
from gridgate.errors import ConfigurationError
from gridgate.functions.brackets import leading_group, parts
from gridgate.functions.names import canonical_type, translated_type

FRAME = "table_name string, ordinal int, col_name string, type_text string, is_key boolean"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type_text: str | None = None
    is_key: bool = False
    display: str | None = None
    fixed: str | None = None


@dataclass(frozen=True)
class Contract:
    columns: tuple[ColumnSpec, ...]
    dialect: str = "gp"

    @classmethod
    def of(cls, dtypes: dict[str, str], dialect: str = "gp", keys: Iterable[str] = ()) -> Contract:
        keys = set(keys)
        return cls(tuple(ColumnSpec(n, t, n in keys) for n, t in dtypes.items()), dialect_of(dialect))

    @classmethod
    def collect(cls, frame: DataFrame, dialect: str) -> Contract:
        """The contract of one table; its frame has as many rows as the table has columns."""
        rows = frame.orderBy("ordinal").select("col_name", "type_text", "is_key").collect()
        if not rows:
            raise ConfigurationError("the contract has no columns")
        return cls(tuple(ColumnSpec(r.col_name, r.type_text, bool(r.is_key)) for r in rows), dialect_of(dialect))

    def frame(self, spark: SparkSession, table: str) -> DataFrame:
        rows = [(table, i, c.name, c.type_text, c.is_key) for i, c in enumerate(self.columns, 1)]
        return spark.createDataFrame(rows, FRAME)

    def types(self) -> dict[str, str]:
        return {c.name: c.type_text for c in self.columns if c.type_text}

    def spec(self, name: str) -> ColumnSpec | None:
        return next((c for c in self.columns if c.name == name), None)

    def with_keys(self, keys: Iterable[str]) -> Contract:
        keys = set(keys)
        return replace(self, columns=tuple(replace(c, is_key=c.is_key or c.name in keys) for c in self.columns))


# Declared type for a native column type.
_GP_NATIVE = {"boolean": "boolean", "tinyint": "smallint", "smallint": "smallint", "int": "integer",
              "bigint": "bigint", "float": "real", "double": "double precision", "date": "date",
              "timestamp": "timestamp", "timestamp_ntz": "timestamp", "string": "text"}
_CH_NATIVE = {"boolean": "Bool", "tinyint": "Int8", "smallint": "Int16", "int": "Int32", "bigint": "Int64",
              "float": "Float32", "double": "Float64", "date": "Date32", "timestamp": "DateTime",
              "timestamp_ntz": "DateTime", "string": "String"}


def declared_type(native: T.DataType, dialect: str) -> str:
    if isinstance(native, T.DecimalType):
        return f"{'decimal' if dialect == 'gp' else 'Decimal'}({native.precision},{native.scale})"
    if isinstance(native, T.VarcharType):
        return f"varchar({native.length})" if dialect == "gp" else "String"
    if isinstance(native, T.CharType):
        return f"char({native.length})" if dialect == "gp" else f"FixedString({native.length})"
    known = _GP_NATIVE if dialect == "gp" else _CH_NATIVE
    return known.get(native.simpleString(), known["string"])


# Native type that holds every accepted value of a declared type.
_NATIVE_OF_GP = {"smallint": "smallint", "smallserial": "smallint", "integer": "int", "serial": "int", "bigint": "bigint", "bigserial": "bigint",
                 "real": "float", "double precision": "double", "date": "date", "boolean": "boolean"}
_NATIVE_OF_CH = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int",
                 "uint32": "bigint", "uint64": "decimal(20,0)", "float32": "float", "float64": "double", "date": "date", "date32": "date",
                 "bool": "boolean"}


def native_type(type_text: str, dialect: str, otherwise: T.DataType) -> str:
    """Column type of a new table for a declared type; ``otherwise`` where the declaration leaves it open."""
    name = " ".join(type_text.lower().split())
    if m := re.fullmatch(r"nullable\s*\((.+)\)", name):
        name = m[1]
    known = (_NATIVE_OF_GP if dialect == "gp" else _NATIVE_OF_CH).get(name)
    if known:
        return known
    if m := re.fullmatch(r"(?:decimal|numeric) ?\( ?(\d+) ?(?:, ?(\d+) ?)?\)", name):
        precision, scale = int(m[1]), int(m[2] or 0)
        return f"decimal({precision},{scale})" if scale <= precision <= 38 else "string"
    if dialect == "gp" and (m := re.fullmatch(r"(character varying|varchar|character|char) ?\( ?(\d+) ?\)", name)):
        return f"{'varchar' if 'var' in m[1] else 'char'}({m[2]})"
    if name.startswith(("timestamp", "datetime")):
        return "timestamp_ntz"
    return otherwise.simpleString()


def contract_of_schema(schema: T.StructType, dialect: str = "gp", keys: Iterable[str] = ()) -> Contract:
    """Contract of a table or frame that already has native types."""
    return Contract.of({f.name.lower(): declared_type(f.dataType, dialect) for f in schema}, dialect, keys)


def contract_of_table(spark: SparkSession, table: str, dialect: str = "gp") -> Contract | None:
    """Contract of a catalog table, None when there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    return contract_of_schema(T.StructType([T.StructField(n, T.DataType.fromDDL(kind)) for n, kind in table_columns(spark, table)]), dialect)


def table_columns(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Columns of a table with their types; only DESCRIBE keeps the lengths of char and varchar."""
    rows = spark.sql(f"DESCRIBE TABLE {table}").collect()
    return [(r.col_name, r.data_type) for r in takewhile(lambda r: r.col_name and not r.col_name.startswith("#"), rows)]


# ---------------------------------------------------------------- DDL corpora

# First words of parts that declare no column, and type names of several words.
_GP_CONSTRAINT = r"(?i)^\s*(constraint|primary\s+key|foreign\s+key|unique|check)\b"
_CH_CONSTRAINT = r"(?i)^\s*(index|projection|constraint)\b"
_GP_WORDS = ("timestamp without time zone|timestamp with time zone|time without time zone|"
             "time with time zone|double precision|character varying|character")


def parse_ddl(corpus: DataFrame, dialect: str = "gp", key: str = "table_name", ddl: str = "ddl") -> DataFrame:
    """Columns declared by a corpus of ``CREATE TABLE`` texts, one row per text.

    Result: ``key, status, ordinal, col_name, type_text``. A text that declares
    nothing keeps one row whose ``status`` says why (``empty``,
    ``no parentheses``, ``unbalanced parentheses``, ``no columns``,
    ``unknown part: …`` for one that is neither column nor constraint).
    """
    dialect = dialect_of(dialect)
    clean = F.regexp_replace(F.regexp_replace(F.col(ddl), r"(?s)/\*.*?\*/", " "), r"--[^\n]*", " ")
    constraint = _GP_CONSTRAINT if dialect == "gp" else _CH_CONSTRAINT
    quote = '"' if dialect == "gp" else "`"
    column = rf"(?U)^\s*{quote}?(\w+){quote}?\s+(.*)$"
    # What is used twice is a column, or a field of a part, of its own: inlined, its patterns would run at every use.
    texts = corpus.select(F.col(key), F.coalesce(F.trim(ddl), F.lit("")).alias("_ddl"), F.translate(clean, "\n\r", "  ").alias("_clean"))
    texts = texts.withColumn("_open", F.instr("_clean", "("))
    texts = texts.withColumn("_from", F.substring("_clean", F.col("_open"), F.length("_clean")))
    texts = texts.withColumn("_body", leading_group(F.col("_from")))
    texts = texts.withColumn("_parts", F.when(F.col("_body") != "", parts(F.substring("_body", F.lit(2), F.length("_body") - 2))))
    split = F.transform("_parts", lambda part: F.struct(
        part.alias("part"), part.rlike(constraint).alias("fixed"), F.lower(F.regexp_extract(part, column, 1)).alias("name"),
        F.regexp_extract(part, column, 2).alias("rest")))
    types = _gp_types(split) if dialect == "gp" else _ch_types(split)
    texts = texts.withColumn("_defs", F.transform(types, lambda d: F.struct(
        F.when(~d["fixed"], d["name"]).alias("col_name"), d["type_text"].alias("type_text"),
        F.when((F.trim(d["part"]) != "") & ~d["fixed"] & (d["name"] == ""), F.trim(d["part"])).alias("unknown"))))
    texts = texts.withColumn("_declared", F.transform(F.filter("_defs", lambda d: (d.col_name != "") & (d.type_text != "")), lambda d: F.struct(
        d.col_name.alias("col_name"), d.type_text.alias("type_text"))))
    declared, unknown = F.col("_declared"), F.filter(F.col("_defs")["unknown"], lambda p: p.isNotNull())
    status = (F.when(F.col("_ddl") == "", "empty").when(F.col("_open") == 0, "no parentheses")
              .when(F.col("_defs").isNull(), "unbalanced parentheses")
              .when(F.size(declared) == 0, "no columns")
              .when(F.size(unknown) > 0, F.concat(F.lit("unknown part: "), F.get(unknown, F.lit(0)))).otherwise("ok"))
    # Judged below the explode: a status above it would be worked out for every column again.
    judged = texts.select(key, status.alias("status"), "_declared")
    rows = judged.select(key, "status", F.posexplode_outer("_declared").alias("_at", "_def"))
    return rows.select(key, "status", (F.col("_at") + 1).alias("ordinal"), "_def.col_name", "_def.type_text")


def _gp_types(defs: Column) -> Column:
    """Parts with ``type_text``: the words of the type and the balanced group that follows them, if one does."""
    lowered = F.transform(defs, lambda d: F.struct(*[d[c].alias(c) for c in ("part", "fixed", "name")], F.lower(F.trim(d["rest"])).alias("text")))
    named = F.transform(lowered, lambda d: F.struct(*[d[c].alias(c) for c in ("part", "fixed", "name", "text")], F.regexp_extract(
        d["text"], rf"^((?:{_GP_WORDS})(?!\w)|[^\s(,]+)", 1).alias("word")))
    after = lambda d: F.ltrim(F.substring(d["text"], F.length(d["word"]) + 1, F.length(d["text"])))
    return _with_arguments(named, after)


def _ch_types(defs: Column) -> Column:
    """Parts with ``type_text``: the word of the type and the group right behind it, or what stands inside ``Nullable``."""
    trimmed = F.transform(defs, lambda d: F.struct(*[d[c].alias(c) for c in ("part", "fixed", "name")], F.trim(d["rest"]).alias("text")))
    named = F.transform(trimmed, lambda d: F.struct(
        *[d[c].alias(c) for c in ("part", "fixed", "name", "text")], F.regexp_extract(d["text"], r"^([^\s(,]+)", 1).alias("word")))
    typed = _with_arguments(named, lambda d: F.substring(d["text"], F.length(d["word"]) + 1, F.length(d["text"])))
    return F.transform(typed, lambda d: F.struct(*[d[c].alias(c) for c in ("part", "fixed", "name")], F.coalesce(F.get(F.regexp_extract_all(
        d["type_text"], F.lit(r"^[Nn]ullable\((.+)\)$"), F.lit(1)), F.lit(0)), d["type_text"]).alias("type_text")))


def _with_arguments(named: Column, after) -> Column:
    """``type_text`` of parts: their ``word`` and the balanced group that opens what ``after`` gives."""
    cut = F.transform(named, lambda d: F.struct(*[d[c].alias(c) for c in ("part", "fixed", "name", "word")], after(d).alias("after")))
    return F.transform(cut, lambda d: F.struct(
        *[d[c].alias(c) for c in ("part", "fixed", "name")], F.concat(d["word"], leading_group(d["after"])).alias("type_text")))


def contract_from_ddl(spark: SparkSession, ddl: str, dialect: str) -> Contract:
    """Contract of one ``CREATE TABLE`` text."""
    rows = parse_ddl(spark.createDataFrame([("t", ddl or "")], "table_name string, ddl string"), dialect).collect()
    problems = [r.status for r in rows if r.status != "ok"]
    if problems or not rows:
        raise ConfigurationError(f"DDL cannot be used: {problems[0] if problems else 'empty'}")
    ordered = sorted(rows, key=lambda r: r.ordinal)
    return Contract.of({r.col_name: r.type_text for r in ordered}, dialect)


# ------------------------------------------------------------------ inference

KINDS = ("str", "datetime", "date", "time", "bool", "float", "int")
# Type chosen for the first kind present, in the order of KINDS; the last is for no value at all.
GP_LATTICE = ("text", "timestamp", "date", "time", "boolean", "decimal(18,6)", "bigint", "text")
CH_LATTICE = ("String", "DateTime", "Date32", "String", "Bool", "Float64", "Int64", "String")
SAMPLE_ROWS = 200

_KIND_OF_NATIVE = {
    "boolean": "bool", "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "float": "float",
    "double": "float", "date": "date", "timestamp": "datetime", "timestamp_ntz": "datetime"}


def kind_of_native(native: T.DataType) -> str:
    return "float" if isinstance(native, T.DecimalType) else _KIND_OF_NATIVE.get(native.simpleString(), "str")


def kind_of_text(cell: Column) -> Column:
    """Kind a text cell reads as; NULL for NULL."""
    return (F.when(cell.isNull(), None)
            .when(cell.rlike(r"^[+-]?\d+$"), "int")
            .when(cell.rlike(r"^[+-]?(\d+\.\d*|\.\d+|\d+(\.\d*)?[eE][+-]?\d+)$"), "float")
            .when(cell.rlike(r"^(?i)(true|false)$"), "bool")
            .when(cell.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date")
            .when(cell.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"), "datetime")
            .when(cell.rlike(r"^\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"), "time")
            .otherwise("str"))


def lattice(present: dict[str, Column], dialect: str) -> Column:
    """Most general type over flags saying which kinds occur."""
    *names, nothing = GP_LATTICE if dialect == "gp" else CH_LATTICE
    choice = F.lit(nothing)
    for kind, name in reversed(list(zip(KINDS, names))):
        choice = F.when(present[kind], name).otherwise(choice)
    return choice


def infer_types(cells: DataFrame, dialect: str = "gp", keys: tuple[str, ...] = ("table_name", "col_name"),
                kind: str = "kind") -> DataFrame:
    """Type per column from a long frame of cell kinds, in one hash aggregation.

    The flags combine on the map side, so a column with most of the rows costs
    no more than any other.
    """
    flags = [F.bool_or(F.col(kind) == k).alias(f"_{k}") for k in KINDS]
    present = {k: F.coalesce(F.col(f"_{k}"), F.lit(False)) for k in KINDS}
    return cells.groupBy(*keys).agg(*flags).select(*keys, lattice(present, dialect).alias("type_text"))


def head_sample(rows: DataFrame, lineage: list[str], ordinal: str, sample: int = SAMPLE_ROWS) -> DataFrame:
    """First ``sample`` rows of every file; each task keeps no more than that per file before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*lineage).orderBy(ordinal))
    return rows.withColumn("_place", place).filter(F.col("_place") <= sample).drop("_place")


def infer_contract(rows: DataFrame, columns: list[str], dialect: str = "gp", detect: bool = False,
                   ordinal: str | None = None, first_row: int = 0, sample: int | None = None, kinds: str | None = None) -> Contract:
    """Contract of one frame: one pass, one row of flags comes back.

    Native columns bring their kind along. Text columns are text unless
    ``detect`` asks to read kinds from them, or ``kinds`` names the column that
    holds those of every row. ``sample`` looks only at that many rows from
    ``first_row`` on, by ``ordinal``.
    """
    if sample is not None and ordinal:
        rows = rows.filter(F.col(ordinal) < first_row + sample)
    dialect, flags = dialect_of(dialect), []
    for i, name in enumerate(columns):
        cell, native = F.col(f"`{name}`"), rows.schema[name].dataType
        if isinstance(native, T.StringType) and (detect or kinds):
            seen = F.when(cell.isNotNull(), F.get(kinds, F.lit(i))) if kinds else kind_of_text(cell)
            flags += [F.bool_or(seen == k).alias(f"{i}_{k}") for k in KINDS]
        else:
            own = "str" if isinstance(native, T.StringType) else kind_of_native(native)
            flags.append(F.bool_or(cell.isNotNull()).alias(f"{i}_{own}"))
    found = rows.agg(*flags).first().asDict()
    *names, nothing = GP_LATTICE if dialect == "gp" else CH_LATTICE
    pick = lambda i: next((t for k, t in zip(KINDS, names) if found.get(f"{i}_{k}")), nothing)
    return Contract.of({name: pick(i) for i, name in enumerate(columns)}, dialect)


# ------------------------------------------- resolution, translation, coverage

def resolve(candidates: DataFrame, keys: tuple[str, ...] = ("table_name", "col_name")) -> DataFrame:
    """Per column the type of the candidate with the lowest ``priority``.

    A table takes all its columns from its best candidate contract, so a stale
    column of a weaker source does not slip in.
    """
    table, column = keys
    best = candidates.groupBy(table).agg(F.min("priority").alias("priority"))
    return candidates.join(best, [table, "priority"], "left_semi").groupBy(table, column).agg(
        F.min_by("type_text", F.struct("priority", "type_text")).alias("type_text"),
        F.min("priority").alias("priority"))


def canonical(frame: DataFrame, dialect: str) -> DataFrame:
    """Contract rows with canonical type names."""
    return frame.withColumn("type_text", canonical_type(F.col("type_text"), dialect_of(dialect)))


def translate(frame: DataFrame) -> DataFrame:
    """gp contract rows as ch contract rows."""
    return frame.withColumn("type_text", translated_type(F.col("type_text")))


def coverage(headers: DataFrame, contract: DataFrame, keys: list[str]) -> DataFrame:
    """How header and contract meet, per column: ``checked`` when both have it,
    ``unchecked`` when only the file has it, ``missing`` when only the contract has."""
    both = headers.select(*keys, F.lit(True).alias("_h")).union(contract.select(*keys, F.lit(False).alias("_h")))
    held, wanted = F.bool_or("_h"), F.bool_or(~F.col("_h"))
    state = F.when(held & wanted, "checked").when(held, "unchecked").otherwise("missing")
    return both.groupBy(*keys).agg(state.alias("coverage"))


# ------------------------------------------------------------------- DDL text

def render_ddl(frame: DataFrame, dialect: str, scheme: str, timestamp: str | None = None,
               order_by: str = "tuple()") -> DataFrame:
    """``CREATE TABLE`` text per table of a contract frame.

    A load-time column is added as the last one unless the table declares it.
    One aggregation per table; its size is the table's column count.
    """
    gp = dialect_of(dialect) == "gp"
    name, kind = F.col("col_name"), F.col("type_text")
    line = (F.concat(F.lit("\t"), name, F.lit("\t"), kind, F.lit("\tNULL")) if gp else
            F.concat(F.lit("    `"), name, F.lit("` Nullable("), kind, F.lit(") DEFAULT NULL")))
    tables = frame.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", line.alias("line")))).alias("_lines"),
        F.coalesce(F.bool_or(name == timestamp) if timestamp else F.lit(True), F.lit(False)).alias("_stamped"))
    columns = F.array_join(F.col("_lines.line"), ",\n")
    if timestamp:
        extra = (f"\t{timestamp}\ttimestamp\tNULL" if gp else f"    `{timestamp}` Nullable(DateTime()) DEFAULT NULL")
        columns = F.when(F.col("_stamped"), columns).otherwise(F.concat(columns, F.lit(",\n" + extra)))
    target = F.concat(F.lit(scheme + "."), F.col("table_name"))
    if gp:
        text = F.concat(
            F.lit("-- "), target, F.lit(" definition\n-- DROP TABLE "), target, F.lit(";\nCREATE TABLE "), target,
            F.lit(" (\n"), columns, F.lit("\n)\nDISTRIBUTED RANDOMLY;\n"
                                          "-- Рекомендуется заменить RANDOMLY на явный ключ распределения"))
    else:
        text = F.concat(
            F.lit("-- DROP TABLE IF EXISTS "), target, F.lit(";\nCREATE TABLE "), target, F.lit("\n(\n"), columns,
            F.lit(f"\n)\nENGINE = MergeTree\nORDER BY {order_by}\nSETTINGS allow_nullable_key = 1,\n"
                  "         index_granularity = 8192;"))
    return tables.select("table_name", text.alias("ddl"))
