"""Sheet addresses such as ``AA17``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column_letter(index: int) -> str:
    """Letters of a 0-based column index known on the driver."""
    letters, rest = "", index + 1
    while rest:
        rest, digit = divmod(rest - 1, 26)
        letters = chr(65 + digit) + letters
    return letters


_LETTERS, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789ABCDEFGHIJKLMNOP"
#: Index of the first column with so many letters; 14 of them hold any bigint.
_FIRST = [0, *(sum(26 ** k for k in range(1, n)) for n in range(1, 15))]


def column_letters(index: Column) -> Column:
    """Letters of a 0-based column index: one or two from one expression each, more as digits of base 26 after those of fewer letters."""
    i = index.cast("long")
    letter = lambda n: F.char(F.lit(65) + n % 26)
    one = letter(i)
    two = F.concat(letter(F.floor(i / 26) - 1), one)
    size, first = F.lit(14), F.lit(_FIRST[14])
    for n in range(13, 2, -1):
        size, first = F.when(i < _FIRST[n + 1], n).otherwise(size), F.when(i < _FIRST[n + 1], F.lit(_FIRST[n])).otherwise(first)
    digits = F.lpad(F.conv((i - first).cast("string"), 10, 26), size, F.lit("0"))
    return F.when(i < 26, one).when(i < _FIRST[3], two).otherwise(F.translate(digits, _DIGITS, _LETTERS))


def cell_address(row: Column, index: Column) -> Column:
    """Address of a 1-based sheet row and a 0-based column index."""
    return F.concat(column_letters(index), row.cast("string"))


def address_letters(address: Column) -> Column:
    return F.regexp_extract(address, r"^([A-Z]+)(\d+)", 1)


def address_row(address: Column) -> Column:
    return F.regexp_extract(address, r"^([A-Z]+)(\d+)", 2).try_cast("bigint")


def address_index(address: Column) -> Column:
    """0-based column index of an address."""
    letters = address_letters(address)
    digit = lambda at: F.ascii(F.substring(letters, at, 1)) - 64
    return (F.when(F.length(letters) == 1, digit(1))
            .when(F.length(letters) == 2, digit(1) * 26 + digit(2))
            .when(F.length(letters) == 3, digit(1) * 676 + digit(2) * 26 + digit(3))
            .when(F.length(letters) > 3, F.conv(F.translate(letters, _LETTERS, _DIGITS), 26, 10).cast("decimal(20,0)")
                  + sum(F.when(F.length(letters) >= n, 26 ** (n - 1)).otherwise(0).cast("decimal(20,0)") for n in range(2, 15)) + 1) - 1
            ).cast("bigint")
