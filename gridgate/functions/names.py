"""Column names and type names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cyrillic letters with a one-letter Latin form.
CYRILLIC_SINGLE = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "з": "z", "и": "i", "й": "y", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "h", "ы": "y", "э": "e", " ": "_", "-": "_",
}
# Cyrillic letters with several Latin letters, or none.
CYRILLIC_MULTI = {
    "ё": "yo", "ж": "zh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ю": "yu", "я": "ya", "ъ": "", "ь": "",
}

# Words that should not name a column.
CH_RESERVED = (
    "all alter and any array as ascending asof between by case cast check cluster collate column create "
    "cross database date desc descending distinct drop else end exists final first format from full "
    "global group having id if ilike in inner insert intersect into is join key left like limit not "
    "null offset on optimize or order outer over partition prewhere primary right sample select semi "
    "set show sync then to top totals trailing trim truncate union update using when where window with"
).split()
GP_RESERVED = (
    "all analyse analyze and any array as asc asymmetric authorization between binary both case cast check "
    "collate column constraint create cross current_date current_role current_time current_timestamp "
    "current_user default deferrable desc distinct do else end except false for foreign freeze from full "
    "grant group having ilike in initially inner intersect into is isnull join leading left like limit "
    "localtime localtimestamp natural not notnull null offset on only or order outer overlaps placing primary "
    "references returning right select session_user similar some symmetric table then to trailing true union "
    "unique user using verbose when where window with"
).split()

# Spellings of a type and its canonical name.
GP_ALIASES = {
    "smallint": "smallint", "int2": "smallint", "integer": "integer", "int": "integer", "int4": "integer",
    "bigint": "bigint", "int8": "bigint", "smallserial": "smallserial", "serial2": "smallserial",
    "serial": "serial", "serial4": "serial", "bigserial": "bigserial", "serial8": "bigserial",
    "real": "real", "float4": "real", "double precision": "double precision", "double": "double precision",
    "float8": "double precision", "float": "double precision",
    "text": "text", "interval": "interval", "uuid": "uuid", "time": "time",
}
CH_ALIASES = {
    "tinyint": "int8", "int8": "int8", "smalint": "int16", "smallint": "int16", "int16": "int16",
    "int": "int32", "integer": "int32", "int32": "int32", "bigint": "int64", "int64": "int64",
    "float": "float32", "float32": "float32", "double": "float64", "float64": "float64",
    "string": "string", "uint8": "uint8", "uint16": "uint16", "uint32": "uint32", "uint64": "uint64",
    "uint128": "uint128", "uint256": "uint256", "int128": "int128", "int256": "int256", "time": "time",
    "uuid": "uuid",
}
# Tests by part of the name, in order, for names without an exact entry.
# "=" keeps the spelling as it is.
GP_PARTS = (("numeric", "="), ("dec", "="), ("char", "="), ("timestamp", "timestamp"), ("date", "date"),
            ("tsrange", "tsrange"), ("bool", "boolean"), ("array", "array"))
CH_PARTS = (("dec", "="), ("datetime64", "datetime64"), ("datetime32", "datetime32"), ("datetime", "datetime"),
            ("timestamp", "datetime"), ("date32", "date32"), ("date", "date"), ("bool", "bool"),
            ("array", "array"))
# Ch type that takes the place of a gp type.
GP_TO_CH = {
    "date": "Date32", "timestamp": "DateTime", "real": "Float64", "double": "Float64",
    "decimal": "Decimal(32,8)", "numeric": "Decimal(32,8)", "smallint": "Int16", "integer": "Int32",
    "bigint": "Int64", "serial": "UInt32", "bigserial": "UInt64", "text": "String", "char": "String",
    "array": "Array", "timestamp without time zone": "DateTime64(6)", "boolean": "Bool",
    "double precision": "Int32", "character varying": "String", "tsrange": "String", "interval": "String",
    "unknown": "String",
}


def cleaned_name(name: Column) -> Column:
    """Latin lower-case form of a display name: transliterated, blanks and
    hyphens to ``_``, other characters dropped, runs of ``_`` collapsed."""
    text = F.translate(F.lower(name), "".join(CYRILLIC_SINGLE), "".join(CYRILLIC_SINGLE.values()))
    spelled = text
    for letter, latin in CYRILLIC_MULTI.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(latin))
    text = F.when(text.rlike(f"[{''.join(CYRILLIC_MULTI)}]"), spelled).otherwise(text)
    text = F.regexp_replace(text, "[^a-z0-9_]", "")
    return F.regexp_replace(F.btrim(text, F.lit("_")), "_{2,}", "_")


def _lookup(key: Column, table: dict[str, str]) -> Column:
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def canonical_type(type_text: Column, dialect: str) -> Column:
    """Canonical spelling of a type name; unknown names fall back to text."""
    name = F.lower(F.trim(type_text))
    exact, parts, fallback = ((GP_ALIASES, GP_PARTS, "text") if dialect == "gp"
                              else (CH_ALIASES, CH_PARTS, "string"))
    by_part = F.lit(fallback)
    for part, canonical in reversed(parts):
        by_part = F.when(F.contains(name, F.lit(part)),
                         name if canonical == "=" else F.lit(canonical)).otherwise(by_part)
    return F.coalesce(_lookup(name, exact), by_part)


def translated_type(type_text: Column) -> Column:
    """ch type for a gp type; parameters do not take part in the lookup."""
    name = F.lower(F.trim(type_text))
    base = F.trim(F.regexp_replace(name, r"\s*\(.*\)", ""))
    return F.coalesce(_lookup(name, GP_TO_CH), _lookup(base, GP_TO_CH), F.lit(GP_TO_CH["unknown"]))


def is_reserved(name: Column, dialect: str) -> Column:
    """gp words count for both dialects, ch words for ch alone."""
    words = GP_RESERVED if dialect == "gp" else sorted({*GP_RESERVED, *CH_RESERVED})
    return F.lower(name).isin(*words)
