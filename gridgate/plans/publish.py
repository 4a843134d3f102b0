"""Table sinks: append, replace, rename to backup; JDBC.

Spark has no transaction over several statements. Replacing modes therefore
load a new table first and swap names at the end, so a load that fails never
touches the old rows; a swap that fails is undone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgate.errors import ConfigurationError
from gridgate.functions.text import sql_name
from gridgate.operators.contract import Contract, native_type

Load = Callable[[DataFrame, str], None]
# Accepted boolean literals by meaning; the literal null is neither.
TRUE_WORDS, FALSE_WORDS = ("true", "t", "1", "y", "yes", "on"), ("false", "f", "0", "n", "no", "off")


def _insert(df: DataFrame, table: str) -> None:
    """Insert by name: columns the table lacks are an error, those the rows lack are NULL."""
    target = df.sparkSession.table(table).schema
    held = {c.lower() for c in df.columns}
    unknown = sorted(c for c in df.columns if c.lower() not in {f.name.lower() for f in target})
    if unknown:
        raise ConfigurationError(f"table {table} has no column {', '.join(unknown)}")
    row = [F.col(f"`{f.name}`") if f.name.lower() in held else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
    df.select(*row).write.insertInto(table)


def create(df: DataFrame, table: str, contract: Contract | None = None) -> None:
    """An empty table with the columns of ``df``: of the type that the contract declares, else of the frame's own."""
    declared = contract.types() if contract else {}
    columns = [f"{sql_name(f.name)} {native_type(declared[f.name], contract.dialect, f.dataType) if f.name in declared else f.dataType.simpleString()}"
               for f in df.schema]
    df.sparkSession.sql(f"CREATE TABLE {table} ({', '.join(columns)})")


def shaped(df: DataFrame, table: str) -> DataFrame:
    """Rows whose text columns are cast to the type that the table has for them."""
    held = {f.name.lower(): f.dataType for f in df.sparkSession.table(table).schema}

    def cast(field: T.StructField) -> Column:
        cell, wanted = F.col(sql_name(field.name)), held.get(field.name.lower(), field.dataType)
        if not isinstance(field.dataType, T.StringType) or isinstance(wanted, T.StringType):
            return cell
        if isinstance(wanted, T.BooleanType):
            word = F.lower(F.trim(cell))
            return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).alias(field.name)
        return cell.cast(wanted).alias(field.name)

    return df.select(*[cast(f) for f in df.schema])


def append(df: DataFrame, table: str, load: Load = _insert, contract: Contract | None = None) -> None:
    """Create the table if it is missing, then add the rows in one job.

    The rows show up when the job commits. A table made here has the contract's
    types and goes again when the job fails.
    """
    spark = df.sparkSession
    created = not spark.catalog.tableExists(table)
    if created:
        create(df, table, contract)
    try:
        load(shaped(df, table), table)
    except Exception:
        if created:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise


def replace(df: DataFrame, table: str, load: Load = _insert, contract: Contract | None = None) -> None:
    """New rows instead of the old ones; schema and properties of the table stay."""
    if not df.sparkSession.catalog.tableExists(table):
        return append(df, table, load, contract)
    old = f"{table}_old_{uuid.uuid4().hex}"
    _swap(df, table, old, load, lambda fresh: df.sparkSession.sql(f"CREATE TABLE {fresh} LIKE {table}"))
    df.sparkSession.sql(f"DROP TABLE {old}")


def via_backup(df: DataFrame, table: str, now: datetime | None = None, load: Load = _insert,
               contract: Contract | None = None) -> str | None:
    """The old table becomes ``<table>_before_YYMMDD_HHMM``, a new one takes its place.

    Returns the name of the backup, None when there was no table. The new table
    has the columns of ``df`` in the types of the contract.
    """
    backup = f"{table}_before_{(now or datetime.now()).strftime('%y%m%d_%H%M')}"
    had = df.sparkSession.catalog.tableExists(table)
    _swap(df, table, backup if had else None, load, lambda fresh: create(df, fresh, contract))
    return backup if had else None


def _swap(df: DataFrame, table: str, old: str | None, load: Load, make: Callable[[str], object]) -> None:
    spark, fresh = df.sparkSession, f"{table}_next_{uuid.uuid4().hex}"
    moved = False
    try:
        make(fresh)
        load(shaped(df, fresh), fresh)
        if old:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
            moved = True
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        if moved:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise


PUBLISH = {"append": append, "truncate_load": replace, "via_backup": via_backup}


def publish(df: DataFrame, table: str, mode: str, contract: Contract | None = None):
    if mode not in PUBLISH:
        raise ConfigurationError(f"unknown publish mode {mode!r}")
    return PUBLISH[mode](df, table, contract=contract)


# ----------------------------------------------------------------------- JDBC

# Drivers and catalog views of the two databases.
_DRIVERS = {"gp": "org.postgresql.Driver", "ch": "com.clickhouse.jdbc.ClickHouseDriver"}
_CATALOGS = {
    "gp": "select column_name, ordinal_position, data_type, character_maximum_length, numeric_precision, numeric_scale "
          "from information_schema.columns where table_schema = '{scheme}' and table_name = '{table}'",
    "ch": "select name, position, type from system.columns where database = '{scheme}' and table = '{table}'",
}


def jdbc_options(dialect: str, url: str, table: str, batch_size: int = 1000, connections: int = 8,
                 user: str | None = None, password: str | None = None) -> dict[str, str]:
    """Writer options; ``connections`` bounds how many tasks write at a time."""
    options = {"url": url, "dbtable": table, "driver": _DRIVERS[dialect], "batchsize": str(batch_size),
               "numPartitions": str(connections), "truncate": "true"}
    if dialect == "ch":
        options["isolationLevel"] = "NONE"
    if user is not None:
        options |= {"user": user, "password": password or ""}
    return options


def write_jdbc(df: DataFrame, options: dict[str, str], replace_rows: bool = False) -> None:
    """Batched inserts into a database table, after emptying it if asked to."""
    df.write.format("jdbc").options(**options).mode("overwrite" if replace_rows else "append").save()


def jdbc_contract(spark: SparkSession, dialect: str, url: str, scheme: str, table: str, **login) -> DataFrame:
    """Contract rows of a database table; no rows when it does not exist."""
    names = {"scheme": scheme.replace("'", "''"), "table": table.replace("'", "''")}
    options = jdbc_options(dialect, url, table, **login)
    keep = {k: v for k, v in options.items() if k in ("url", "driver", "user", "password")}
    rows = spark.read.format("jdbc").options(**keep).option("query", _CATALOGS[dialect].format(**names)).load()
    return catalog_columns(rows, dialect)


def catalog_columns(rows: DataFrame, dialect: str) -> DataFrame:
    """``col_name, ordinal, type_text`` from rows of a database's column catalog.

    Lengths and digits that the catalog leaves open leave the type unbounded.
    """
    if dialect == "ch":
        inner = F.regexp_extract("type", r"^Nullable\((.+)\)$", 1)
        return rows.select(F.col("name").alias("col_name"), F.col("position").cast("int").alias("ordinal"),
                           F.when(inner != "", inner).otherwise(F.col("type")).alias("type_text"))
    kind = F.col("data_type")
    sized = F.when(kind.isin("character varying", "character", "char"), F.format_string(
        "(%d)", F.col("character_maximum_length").cast("int")))
    digits = F.when(kind.isin("numeric", "decimal"), F.format_string(
        "(%d,%d)", F.col("numeric_precision").cast("int"), F.col("numeric_scale").cast("int")))
    known = F.coalesce(F.when(F.col("character_maximum_length").isNotNull(), sized),
                       F.when(F.col("numeric_precision").isNotNull(), digits), F.lit(""))
    return rows.select(F.col("column_name").alias("col_name"), F.col("ordinal_position").cast("int").alias("ordinal"),
                       F.concat(kind, known).alias("type_text"))
