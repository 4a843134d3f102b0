"""SQL literals of the two target dialects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters escaped with a backslash in the ch dialect; the backslash goes first.
CH_ESCAPES = (
    ("\\", "\\\\"), ("'", "\\'"), ("\b", "\\b"), ("\f", "\\f"), ("\r", "\\r"), ("\n", "\\n"),
    ("\t", "\\t"), ("\0", "\\0"), ("\a", "\\a"), ("\v", "\\v"),
)


def _quoted(text: Column, dialect: str) -> Column:
    if dialect == "gp":
        body = F.replace(text, F.lit("'"), F.lit("''"))
    else:
        body = text
        for char, escape in CH_ESCAPES:
            body = F.replace(body, F.lit(char), F.lit(escape))
    return F.concat(F.lit("'"), body, F.lit("'"))


def literal(cell: Column, source: T.DataType, dialect: str, quote_all: bool = False, kind: Column | None = None) -> Column:
    """SQL literal of a cell: NULL, bare numbers, dialect booleans, quoted text.

    ``quote_all`` quotes every value that is not NULL and escapes backslashes
    and quotes by doubling. ``kind`` tells numbers and booleans from text in a
    text column of a typed source.
    """
    if kind is not None and not quote_all:
        true = literal(F.lower(cell) == "true", T.BooleanType(), dialect)
        shown = (F.when(kind.isin("int", "float"), cell).when(kind == "bool", true)
                 .otherwise(_quoted(cell.cast("string"), dialect)))
    elif quote_all:
        text = F.replace(F.replace(cell.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
        shown = F.concat(F.lit("'"), text, F.lit("'"))
    elif isinstance(source, T.BooleanType):
        yes, no = ("TRUE", "FALSE") if dialect == "gp" else ("1", "0")
        shown = F.when(cell, F.lit(yes)).when(~cell, F.lit(no))
    elif isinstance(source, T.NumericType):
        shown = cell.cast("string")
    else:
        shown = _quoted(cell.cast("string"), dialect)
    return F.coalesce(shown, F.lit("NULL"))


def tuple_text(columns: list[tuple[Column, T.DataType, Column | None]], dialect: str, quote_all: bool = False) -> Column:
    """``(a, b, …)`` of one row; each column comes with its type and, from a typed source, its kind."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[literal(c, t, dialect, quote_all, kind) for c, t, kind in columns]),
                    F.lit(")"))
