"""Row-level projections before and after the checks. All of them are narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgate.errors import ConfigurationError
from gridgate.functions.text import blank_to_null, stripped
from gridgate.operators.contract import Contract


def _text_columns(df: DataFrame, columns: list[str]) -> set[str]:
    return {f.name for f in df.schema if f.name in columns and isinstance(f.dataType, T.StringType)}


def clean_cells(df: DataFrame, columns: list[str], strip: bool = False, blanks: bool = True) -> DataFrame:
    """Strip text cells, then turn blank ones into NULL."""
    texts = _text_columns(df, columns)

    def cleaned(name: str) -> Column:
        cell = F.col(f"`{name}`")
        if name not in texts:
            return cell
        cell = stripped(cell) if strip else cell
        return (blank_to_null(cell) if blanks else cell).alias(name)

    return df.select(*[cleaned(name) for name in df.columns])


def is_blank_row(columns: list[str]) -> Column:
    """True when every cell of the row is NULL."""
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns]).isNull()


def drop_blank_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(~is_blank_row(columns))


def rename_by_position(df: DataFrame, columns: list[str], names: list[str]) -> DataFrame:
    """Give the columns technical names, first to first; other columns stay."""
    if len(columns) != len(names):
        raise ConfigurationError(f"{len(columns)} columns cannot take {len(names)} names")
    return df.withColumnsRenamed(dict(zip(columns, names)))


def insert_fixed(df: DataFrame, contract: Contract, lineage: tuple[str, ...] = (),
                 per_file: DataFrame | None = None, key: str = "_file") -> DataFrame:
    """Columns in contract order; fixed columns become constants at their place.

    ``per_file`` holds the fixed values of each file in columns of their own.
    """
    if per_file is not None:
        df = df.join(per_file, key)

    def column(spec):
        if spec.fixed is not None and per_file is None:
            return F.lit(spec.fixed).alias(spec.name)
        return F.col(f"`{spec.name}`") if spec.name in df.columns else F.lit(None).cast("string").alias(spec.name)

    return df.select(*lineage, *[column(c) for c in contract.columns])


def add_lineage(df: DataFrame, source_columns: list[str], timestamp: str | None = None,
                stamp: Column | None = None, source_name: Column | None = None) -> DataFrame:
    """Load time and source name at the end, each only if the source lacks it.

    ``stamp`` is one value per run. Both keep to the column plan: a load-time
    column the source brings along is neither overwritten nor repeated.
    """
    if timestamp and timestamp not in source_columns:
        now = F.current_timestamp() if stamp is None else stamp
        df = df.withColumn(timestamp, F.date_format(now, "yyyy-MM-dd HH:mm:ss"))
    if source_name is not None and "wf_load_idn" not in source_columns:
        df = df.withColumn("wf_load_idn", source_name)
    return df
