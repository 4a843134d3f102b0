"""Text cleaning that agrees with Unicode-aware stripping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points that count as white space at the ends of a cell.
WHITESPACE = "".join(
    map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def sql_text(value: str) -> str:
    """SQL string literal of a Python text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    """Quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_stripped(cell: str) -> str:
    return f"btrim({cell}, {sql_text(WHITESPACE)})"


def stripped(col: Column) -> Column:
    """Cell text without white space at both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    """NULL for empty and white-space-only text, else the text unchanged.

    A printable first character settles it for nearly every cell.
    """
    return F.when(F.ascii(col).between(33, 126) | (stripped(col) != ""), col)


def py_repr(col: Column) -> Column:
    """Text as a quoted literal, the way samples are shown in a report."""
    body = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(char), F.lit(shown))
    double = F.contains(col, F.lit("'")) & ~F.contains(col, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)
