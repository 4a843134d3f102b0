"""Type rules: one declared type in, one pair of native expressions out.

A rule turns the SQL of a cell into ``(value, fault)``. ``value`` is the normalised cell,
NULL when the cell is NULL or rejected. ``fault`` is NULL for accepted cells,
else ``struct<code, message>``. Messages sit in branches that only rejected
cells reach, so clean data pays for the check alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import types as T

from gridgate.config import dialect_of
from gridgate.errors import UnsupportedTypeError
from gridgate.functions.temporal import parse_datetime, parse_time
from gridgate.functions.text import sql_stripped, sql_text

# Shapes of literals.
LONG_TEXT = r"^\s*[+-]?0*\d{1,19}\s*$"
INTEGER_TEXT = r"^[+-]?\d+$"
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NOT_FINITE_TEXT = r"(?i)^[+-]?(inf|infinity|s?nan\d*)$"
DECIMAL_TEXT = r"^[+-]?(\d*)(?:\.(\d*))?(?:[eE]([+-]?\d+))?$"
UUID_TEXT = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
INTERVAL_TEXT = (
    r"(?i)^-?\d+\s+(?:year|month|day|hour|minute|second)s?"
    r"(?:\s+-?\d+\s+(?:year|month|day|hour|minute|second)s?)*$"
)
RANGE_TEXT = r"^([\[(])\s*'?([^,']*?)'?\s*,\s*'?([^,']*?)'?\s*([\])])$"
ARRAY_TEXT = r"(?s)^\s*\[.*\]\s*$"
# Accepted boolean literals.
BOOLEAN_LITERALS = ("true", "false", "0", "1", "t", "f", "y", "n", "yes", "no", "on", "off", "null")


@dataclass(frozen=True)
class Verdict:
    """SQL of one cell under one rule.

    ``parsed`` is the costly part of the rule; ``value`` reads it from ``Slots.parsed``
    and ``fault`` reads the accepted value from ``Slots.kept``, so that a caller
    with three projections evaluates each part once.
    """

    value: str
    fault: str
    parsed: str | None = None


@dataclass(frozen=True)
class Slots:
    """Names of the columns that hold earlier parts of a verdict; None repeats them."""

    parsed: str | None = None
    kept: str | None = None


Rule = Callable[[str, T.DataType, Slots], Verdict]
Finding = tuple[str, str, str]
FAULT_TYPE = "struct<severity: string, code: string, message: string, value: string>"


def finding(cell: str, severity: str, code: str, message: str) -> str:
    return (f"named_struct('severity', '{severity}', 'code', '{code}', 'message', {message}, "
            f"'value', cast({cell} as string))")


def _verdict(cell: str, slots: Slots, ok: str, value: str, findings: list[Finding],
             parsed: str | None = None) -> Verdict:
    """``findings`` are (condition, code, message); the first true one is reported.

    An accepted cell always has a value, hence a missing one means rejection.
    """
    branches = " ".join(
        f"when {condition} then {finding(cell, 'error', code, message)}" for condition, code, message in findings)
    kept = f"case when {ok} then {value} end"
    return Verdict(
        kept, f"case when {cell} is not null and {slots.kept or f'({kept})'} is null then case {branches} end end",
        parsed)


def _is_text(source: T.DataType) -> bool:
    return isinstance(source, (T.StringType, T.VarcharType, T.CharType))


def _is_float(source: T.DataType) -> bool:
    return isinstance(source, (T.DoubleType, T.FloatType))


def _text(cell: str, source: T.DataType) -> str:
    return cell if _is_text(source) else f"cast({cell} as string)"


def _like(text: str, regex: str) -> str:
    return f"({text} rlike {sql_text(regex)})"


def _plain_digits(text: str) -> str:
    """Canonical form of an integer literal: no plus sign, no leading zeros."""
    clean = sql_stripped(text)
    digits = rf"regexp_extract({clean}, {sql_text(r'^[+-]?0*(?=[0-9])([0-9]+)$')}, 1)"
    return f"if({_like(clean, '^-0*[1-9]')}, concat('-', {digits}), {digits})"


def _guarded(attempts: list[tuple[str, str]], spark_type: str) -> str:
    """Cast of the first text that has the shape of a literal.

    A failing cast of text to a number builds an exception, which costs ten
    times the pattern; the guard keeps bad cells as cheap as good ones.
    """
    return "case " + " ".join(
        f"when {_like(text, shape)} then try_cast({text} as {spark_type})" for text, shape in attempts) + " end"


def integer(low: int, high: int, spark_type: str) -> Rule:
    """Integer literal, or a native number truncated, inside ``[low, high]``."""

    def build(cell, source, slots):
        known, digits = "true", _plain_digits(_text(cell, source))
        if _is_text(source):
            clean = sql_stripped(cell)
            number = _guarded([(cell, LONG_TEXT), (clean, LONG_TEXT)], "bigint")
            known = _like(clean, INTEGER_TEXT)
        elif _is_float(source):
            number = f"case when abs({cell}) < 9.2e18D then cast({cell} as bigint) end"
            known = f"(abs({cell}) < double('Infinity'))"
            digits = f"cast(try_cast({cell} as decimal(38,0)) as string)"
        else:
            number = f"try_cast({cell} as bigint)"
        parsed, number = number, slots.parsed or number
        shown = f"coalesce(cast({number} as string), {digits}, cast({cell} as string))"
        return _verdict(
            cell, slots, f"{number} between {low if low > -2 ** 63 else '-9223372036854775808'} and {high}",
            f"cast({number} as {spark_type})", [
                (f"{number} is null and not {known}", "not_integer", "'not an integer'"),
                ("true", "out_of_range", f"concat('value ', {shown}, ' out of range [{low}, {high}]')")], parsed)

    return build


def wide_integer(low: int, high: int, spark_type: str = "string") -> Rule:
    """Integers beyond 64 bit, compared as digit strings: first length, then text."""

    def within(digits: str, bound: int) -> str:
        size = len(str(bound))
        return f"(length({digits}) < {size} or (length({digits}) = {size} and {digits} <= '{bound}'))"

    def build(cell, source, slots):
        text = f"cast(try_cast({cell} as decimal(38,0)) as string)" if _is_float(source) else _text(cell, source)
        number = f"case when {_like(sql_stripped(text), INTEGER_TEXT)} then {_plain_digits(text)} end"
        parsed, number = number, slots.parsed or number
        below = within(f"substring({number}, 2)", -low) if low < 0 else "false"
        value = number if spark_type == "string" else f"try_cast({number} as {spark_type})"
        return _verdict(cell, slots, f"if(startswith({number}, '-'), {below}, {within(number, high)})", value, [
            (f"({number}) is null", "not_integer", "'not an integer'"),
            ("true", "out_of_range", f"concat('value ', {number}, ' out of range [{low}, {high}]')")], parsed)

    return build


def floating(low: float, high: float, spark_type: str) -> Rule:
    """Floating-point literal inside ``[low, high]``; NaN and infinities fall outside."""

    def build(cell, source, slots):
        parsed = f"try_cast({cell} as double)"
        known = f"{slots.parsed or parsed} is not null"
        if _is_text(source):
            clean = sql_stripped(cell)
            parsed = _guarded([(cell, NUMBER_TEXT), (clean, NUMBER_TEXT)], "double")
            known = f"({_like(clean, NUMBER_TEXT)} or {_like(clean, NOT_FINITE_TEXT)})"
        number = slots.parsed or parsed
        ok = f"{number} between double('{low}') and double('{high}')"
        return _verdict(cell, slots, ok, f"cast({number} as {spark_type})", [
            (f"not {known}", "not_float", "'not a floating-point number'"),
            ("true", "out_of_range", f"'value out of allowed range [{low}, {high}]'")], parsed)

    return build


def _plain_decimal(precision: int, scale: int) -> str:
    """Pattern of the literals without exponent that fit ``(precision, scale)``."""
    room = precision - scale
    forms = []  # nothing fits when both stay empty
    if room > 0:
        forms.append(rf"0*\d{{1,{room}}}(?:\.\d{{0,{scale}}})?")
    if scale > 0:
        forms.append(rf"0*\.\d{{1,{scale}}}")
    return rf"^\s*[+-]?(?:{'|'.join(forms)})\s*$"


def decimal(precision: int | None, scale: int | None, on_scale_overflow: str = "reject") -> Rule:
    """Exact digit counts, taken from the text before any cast could round it.

    One pattern accepts plain literals; exponents and everything rejected go
    through the counts. ``on_scale_overflow='round'`` counts all digits against
    the precision and rounds extra fraction digits away instead of rejecting.
    """
    bounded = precision is not None
    rounding = on_scale_overflow == "round"
    target = f"decimal({precision},{scale})" if bounded and precision <= 38 and scale <= precision else None

    def build(cell, source, slots):
        text = _text(cell, source)
        if _is_float(source):
            text = f"cast({f'round({cell}, {scale})' if bounded else cell} as string)"
        clean = sql_stripped(text)
        part = lambda i: f"regexp_extract({clean}, {sql_text(DECIMAL_TEXT)}, {i})"
        power = f"if({part(3)} = '', 0, try_cast({part(3)} as int))"
        scientific = f"({clean} rlike '[eE]')"
        is_number = f"({_like(clean, NUMBER_TEXT)} and (not {scientific} or {power} is not null))"
        after_dot = f"if(instr({clean}, '.') > 0, length({clean}) - instr({clean}, '.'), 0)"
        digits = f"translate({clean}, '+-.', '')"
        significant = f"greatest(1, length(ltrim('0', if({scientific}, concat({part(1)}, {part(2)}), {digits}))))"
        fraction = f"if({scientific}, greatest(0, length({part(2)}) - {power}), {after_dot})"
        whole = (f"greatest(0, {significant} - if({scientific}, length({part(2)}) - {power}, {after_dot}))")
        findings = [
            (f"contains({text}, ',')", "comma_separator",
             "'use a dot instead of a comma as decimal separator'"),
            (f"not {is_number} and {_like(clean, NOT_FINITE_TEXT)}", "not_finite", "'not a finite number'"),
            (f"not {is_number}", "not_number", "'not a number'")]
        ok = is_number
        if bounded and rounding:
            total = f"if({scientific}, length({part(1)}) + length({part(2)}), length({digits}))"
            ok = f"{is_number} and {total} <= {precision}"
            findings.append(("true", "too_many_digits",
                             f"concat('total digits (', {total}, ') exceed precision ({precision})')"))
        elif bounded:
            room = precision - scale
            plain = _plain_decimal(precision, scale)
            ok = (f"{_like(text, plain)} or {_like(clean, plain)} or "
                  f"({scientific} and {is_number} and {fraction} <= {scale} and {whole} <= {room})")
            findings += [
                (f"{fraction} > {scale}", "scale_exceeded",
                 f"concat('fractional digits (', {fraction}, ') exceed scale ({scale})')"),
                ("true", "precision_exceeded",
                 f"concat('integer digits (', {whole}, ') exceed {room} (precision={precision}, scale={scale})')")]
        value = f"coalesce(try_cast({text} as {target}), try_cast({clean} as {target}))" if target else clean
        return _verdict(cell, slots, ok, value, findings)

    return build


def moment(low: str, high: str, kind: str, fraction: bool = False,
           day_first: bool = False, formats: tuple[str, ...] = ()) -> Rule:
    """Date or timestamp inside ``[low, high]``, both ISO texts."""
    to_second = not fraction and kind != "date"

    def build(cell, source, slots):
        if _is_text(source):
            at = parse_datetime(cell, day_first, formats, to_second)
        else:
            at = f"cast({cell} as timestamp_ntz)"
            if to_second:
                at = f"cast(date_trunc('second', {at}) as timestamp_ntz)"
        parsed, at = at, slots.parsed or at
        return _verdict(
            cell, slots, f"{at} between timestamp_ntz'{low}' and timestamp_ntz'{high}'",
            f"cast({at} as date)" if kind == "date" else at, [
                (f"{at} is null", "not_datetime", "'could not parse date/time value'"),
                ("true", "out_of_range", f"'date out of allowed range [{low[:10]} — {high[:10]}]'")], parsed)

    build.temporal = True
    return build


def time_of_day(day_first: bool = False, formats: tuple[str, ...] = ()) -> Rule:
    def build(cell, source, slots):
        clock = (parse_time(cell, day_first, formats) if _is_text(source)
                 else f"date_format({cell}, 'HH:mm:ss')")
        return _verdict(cell, slots, f"{slots.parsed or clock} is not null", slots.parsed or clock, [
            ("true", "not_time", "'could not parse time value'")], clock)

    build.temporal = True
    return build


def boolean() -> Rule:
    """One of the accepted literals in any case; kept as lower-case text."""
    literals = ", ".join(f"'{word}'" for word in BOOLEAN_LITERALS)
    message = sql_text(f"allowed values: {sorted(BOOLEAN_LITERALS)}")

    def build(cell, source, slots):
        text = _text(cell, source)
        word = f"if({text} in ({literals}), {text}, lower({sql_stripped(text)}))"
        return _verdict(cell, slots, f"{word} in ({literals})", word, [("true", "not_boolean", message)])

    return build


def strict_boolean() -> Rule:
    """``true``/``false`` or an integer; integers become ``true`` only when they are 1."""

    def build(cell, source, slots):
        text = _text(cell, source)
        value = (f"case when {text} in ('true', 'false') then {text} "
                 f"when {_like(sql_stripped(text), INTEGER_TEXT)} "
                 f"then if({_plain_digits(text)} = '1', 'true', 'false') end")
        return _verdict(cell, slots, f"({value}) is not null", value, [
            ("true", "not_boolean", "'value must be true, false (1, 0)'")])

    return build


def any_text() -> Rule:
    def build(cell, source, slots):
        return Verdict(_text(cell, source), f"cast(null as {FAULT_TYPE})")

    return build


def pattern(regex: str, code: str, message: str) -> Rule:
    """Trimmed text that matches ``regex``."""

    def build(cell, source, slots):
        text = _text(cell, source)
        clean = sql_stripped(text)
        return _verdict(cell, slots, f"{_like(text, regex)} or {_like(clean, regex)}", clean, [
            ("true", code, sql_text(message))])

    return build


def array_text() -> Rule:
    def build(cell, source, slots):
        text = _text(cell, source)
        return _verdict(cell, slots, _like(text, ARRAY_TEXT), text, [
            ("true", "not_array", "'does not match array format [...]'")])

    return build


def timestamp_range(day_first: bool = False, formats: tuple[str, ...] = ()) -> Rule:
    """``[a,b)`` text whose two ends are timestamps; both are rewritten to seconds."""

    def build(cell, source, slots):
        clean = sql_stripped(_text(cell, source))
        part = lambda i: f"regexp_extract({clean}, {sql_text(RANGE_TEXT)}, {i})"
        low, high = (f"date_format({parse_datetime(part(i), day_first, formats)}, 'yyyy-MM-dd HH:mm:ss')"
                     for i in (2, 3))
        value = f"concat({part(1)}, {low}, ', ', {high}, {part(4)})"
        return _verdict(cell, slots, f"{slots.parsed or value} is not null", slots.parsed or value, [
            (f"not {_like(clean, RANGE_TEXT)}", "not_range", "'does not match range format [a,b)'"),
            ("true", "not_datetime", "'could not parse date/time value'")], value)

    return build


def max_length(size: int) -> Rule:
    def build(cell, source, slots):
        text = _text(cell, source)
        return _verdict(cell, slots, f"length({text}) <= {size}", text, [
            ("true", "too_long", f"concat('length ', length({text}), ' exceeds maximum {size}')")])

    return build


def exact_length(size: int) -> Rule:
    def build(cell, source, slots):
        text = _text(cell, source)
        return _verdict(cell, slots, f"length({text}) = {size}", text, [
            ("true", "wrong_length", f"concat('expected exactly {size} characters, got ', length({text}))")])

    return build


def max_bytes(size: int) -> Rule:
    def build(cell, source, slots):
        text = _text(cell, source)
        return _verdict(cell, slots, f"octet_length({text}) <= {size}", text, [
            ("true", "too_long", f"'byte length exceeds FixedString({size})'")])

    return build


_UUID = pattern(UUID_TEXT, "not_uuid", "does not match UUID format (xxxxxxxx-xxxx-xxxx-xxxx-xxxxxxxxxxxx)")
_INTERVAL = pattern(INTERVAL_TEXT, "not_interval",
                    "does not match interval format, e.g. '1 year 2 months' or '3 days'")
_EVER = ("0001-01-01 00:00:00", "9999-12-31 23:59:59")
_EVER_DATES = ("0001-01-01 00:00:00", "9999-12-31 00:00:00")
_WIDE_DATES = ("1900-01-01 00:00:00", "2299-12-31 00:00:00")
_WIDE_TIMES = ("1900-01-01 00:00:00", "2299-12-31 23:59:59")


def _signed(bits: int) -> tuple[int, int]:
    return -(2 ** (bits - 1)), 2 ** (bits - 1) - 1


def _registry(dialect: str, options: dict) -> dict[str, Rule]:
    when = {k: options[k] for k in ("day_first", "formats") if k in options}
    shared = {"uuid": _UUID}
    if dialect == "gp":
        stamp, clock = moment(*_EVER, "timestamp", **when), time_of_day(**when)
        return shared | {
            "smallint": integer(*_signed(16), "smallint"),
            "integer": integer(*_signed(32), "int"),
            "bigint": integer(*_signed(64), "bigint"),
            "smallserial": integer(1, 2 ** 15 - 1, "smallint"),
            "serial": integer(1, 2 ** 31 - 1, "int"),
            "bigserial": integer(1, 2 ** 63 - 1, "bigint"),
            "real": floating(-3.4e38, 3.4e38, "float"),
            "double precision": floating(-1.7e308, 1.7e308, "double"),
            "decimal": decimal(None, None), "numeric": decimal(None, None),
            "text": any_text(), "varchar": any_text(), "character varying": any_text(),
            "date": moment(*_EVER_DATES, "date", **when),
            "time": clock, "time without time zone": clock, "time with time zone": clock,
            "timestamp": stamp, "timestamp without time zone": stamp, "timestamp with time zone": stamp,
            "interval": _INTERVAL,
            "boolean": boolean(),
            "tsrange": timestamp_range(**when) if options.get("strict_ranges") else any_text(),
            "array": array_text(),
        }
    return shared | {
        "int8": integer(*_signed(8), "tinyint"),
        "int16": integer(*_signed(16), "smallint"),
        "int32": integer(*_signed(32), "int"),
        "int64": integer(*_signed(64), "bigint"),
        "int128": wide_integer(*_signed(128)),
        "int256": wide_integer(*_signed(256)),
        "uint8": integer(0, 2 ** 8 - 1, "smallint"),
        "uint16": integer(0, 2 ** 16 - 1, "int"),
        "uint32": integer(0, 2 ** 32 - 1, "bigint"),
        "uint64": wide_integer(0, 2 ** 64 - 1, "decimal(20,0)"),
        "uint128": wide_integer(0, 2 ** 128 - 1),
        "uint256": wide_integer(0, 2 ** 256 - 1),
        "float32": floating(-3.4e38, 3.4e38, "float"),
        "float64": floating(-1.7e308, 1.7e308, "double"),
        "string": any_text(),
        "bool": strict_boolean() if options.get("strict_booleans") else boolean(),
        "date": moment("1970-01-01 00:00:00", "2149-06-06 00:00:00", "date", **when),
        "date32": moment(*_WIDE_DATES, "date", **when),
        "datetime": moment("1970-01-01 00:00:00", "2106-02-07 06:28:15", "timestamp", **when),
        "datetime32": moment(*_WIDE_DATES, "timestamp", **when),
        "datetime64": moment(*_WIDE_TIMES, "timestamp", fraction=True, **when),
        "time": time_of_day(**when),
        "array": array_text(),
    }


def _parametric(name: str, dialect: str, options: dict) -> Rule | None:
    when = {k: options[k] for k in ("day_first", "formats") if k in options}
    if m := re.fullmatch(r"(?:decimal|numeric)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", name):
        return decimal(int(m[1]), int(m[2] or 0), options.get("on_scale_overflow", "reject"))
    if m := re.fullmatch(r"(?:character varying|varchar)\s*\(\s*(\d+)\s*\)", name):
        return max_length(int(m[1]))
    if m := re.fullmatch(r"(?:char|character)\s*\(\s*(\d+)\s*\)", name):
        return exact_length(int(m[1]))
    if dialect == "gp" and re.fullmatch(r"timestamp\s*\(\d\)(?: with(?:out)? time zone)?", name):
        return moment(*_EVER, "timestamp", **when)
    if dialect == "ch":
        if m := re.fullmatch(r"fixedstring\(\s*(\d+)\s*\)", name):
            return max_bytes(int(m[1]))
        if re.fullmatch(r"datetime64\(\d+(?:,\s*'[^']*')?\)", name):
            return moment(*_WIDE_TIMES, "timestamp", fraction=True, **when)
        if m := re.fullmatch(r"nullable\((.+)\)", name):
            return rule_for(m[1], dialect, options)
    return None


_custom: list[tuple[str, re.Pattern, Callable[[re.Match], Rule]]] = []


def register_rule(dialect: str, type_pattern: str, factory: Callable[[re.Match], Rule]) -> None:
    """Add a rule for lower-case type names that match ``type_pattern``."""
    _custom.append((dialect_of(dialect), re.compile(type_pattern), factory))


def rule_for(type_text: str, dialect: str, options: dict | None = None) -> Rule:
    """Rule of a declared type. Options: ``day_first``, ``formats``,
    ``on_scale_overflow``, ``strict_ranges``, ``strict_booleans``."""
    options, dialect = options or {}, dialect_of(dialect)
    name = type_text.lower().strip()
    for known, regex, factory in _custom:
        if known == dialect and (m := regex.fullmatch(name)):
            return factory(m)
    registry = _registry(dialect, options)
    rule = registry.get(name) or _parametric(name, dialect, options)
    if rule is None:
        raise UnsupportedTypeError(
            f"type {type_text!r} is not supported for {dialect}; known: {sorted(registry)}")
    return rule


def check(cell: str, type_text: str, dialect: str, source: T.DataType | None = None,
          options: dict | None = None) -> Verdict:
    """Self-contained verdict of one cell expression, text unless ``source`` says otherwise."""
    return rule_for(type_text, dialect, options)(cell, source or T.StringType(), Slots())
