"""Lenient date and time parsing as native expressions.

ISO text takes one cast. Other layouts are rewritten to ISO by a pattern and
cast again, so a cell that fails costs no exception. ``coalesce`` stops at the
first hit, hence the later branches run only for cells the earlier ones missed.

Expressions are SQL text: one column may need a hundred function calls, and
text reaches the JVM in a single one.
"""

from __future__ import annotations

from gridgate.functions.text import sql_stripped, sql_text

_CLOCK = r"\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?"
_TAIL = rf"(?:[ T,]+({_CLOCK}))?"
# First three letters of the month names, four characters apart.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_MONTH = rf"({_MONTHS.replace(' ', '|')})[a-z]{{0,6}}\.?"
_ISO = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[ T]{_CLOCK})?$"
_ZONED = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[ T]{_CLOCK} ?(?:Z|UTC|[+-]\d{{2}}:?\d{{2}})$"
_TO_12, _TO_31 = r"(0?[1-9]|1[0-2])", r"(\d{1,2})"
_MONTH_DAY = rf"^{_TO_12}[./-]{_TO_31}[./-](\d{{4}}){_TAIL}$"
_DAY_MONTH = rf"^{_TO_31}[./-]{_TO_12}[./-](\d{{4}}){_TAIL}$"
_YEAR_FIRST = rf"^(\d{{4}})[./](\d{{1,2}})[./](\d{{1,2}}){_TAIL}$"
_COMPACT_DATE = r"^(\d{4})(\d{2})(\d{2})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})$"
_DAY_NAME = rf"(?i)^(\d{{1,2}})[ -]{_MONTH}[ ,-]+(\d{{4}}){_TAIL}$"
_NAME_DAY = rf"(?i)^{_MONTH} (\d{{1,2}}),? (\d{{4}}){_TAIL}$"
_HALF_DAY = r"(?i)^(.*?)\b(0?[1-9]|1[0-2])((?::\d{1,2}){0,2}) ?([ap])\.?m\.?$"


def _ntz(text: str) -> str:
    return f"try_cast({text} as timestamp_ntz)"


def _named(text: str, pattern: str, name: int, day: int) -> str:
    part = lambda i: f"regexp_extract({text}, {sql_text(pattern)}, {i})"
    month = f"cast((instr('{_MONTHS}', lower({part(name)})) + 3) div 4 as string)"
    return f"concat({part(3)}, '-', {month}, '-', {part(day)}, ' ', {part(4)})"


def _numeric_orders(day_first: bool) -> list[tuple[str, str]]:
    """Month first unless the first number cannot be one, or the other way round."""
    orders = [(_MONTH_DAY, "$3-$1-$2 $4"), (_DAY_MONTH, "$3-$2-$1 $4")]
    return orders[::-1] if day_first else orders


def _full_day(text: str) -> str:
    """A 12-hour clock at the end of the text turned into a 24-hour one."""
    part = lambda i: f"regexp_extract({text}, {sql_text(_HALF_DAY)}, {i})"
    hour = f"try_cast({part(2)} as int) % 12 + if(lower({part(4)}) = 'p', 12, 0)"
    return f"concat({part(1)}, {hour}, if({part(3)} = '', ':00', {part(3)}))"


def _plain_iso(cell: str) -> str:
    """``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` by one cast, told by length alone."""
    fits = f"(length({cell}) = 10 or (length({cell}) = 19 and substring({cell}, 17, 1) = ':'))"
    return f"case when {fits} then {_ntz(cell)} end"


def parse_datetime(cell: str, day_first: bool = False, formats: tuple[str, ...] = (),
                   to_second: bool = False) -> str:
    """SQL for text to TIMESTAMP_NTZ, NULL when no known layout fits.

    ISO, ``yyyy/MM/dd``, ``yyyyMMdd[HHmmss]``, numeric day/month/year with
    ``.``, ``/`` or ``-`` (month first unless it cannot be), English month names,
    a 12-hour clock, and zone suffixes (converted to UTC). ``formats`` adds
    layouts in Spark's own pattern letters; ``to_second`` drops fractions.
    """
    text = sql_stripped(cell)
    (first, first_iso), (second, second_iso) = _numeric_orders(day_first)
    rewrite = lambda t, pattern, iso: f"regexp_replace({t}, {sql_text(pattern)}, '{iso}')"
    layouts = [
        (_ISO, text),
        (first, rewrite(text, first, first_iso)),
        (second, rewrite(text, second, second_iso)),
        (_YEAR_FIRST, rewrite(text, _YEAR_FIRST, "$1-$2-$3 $4")),
        (_COMPACT_DATE, rewrite(text, _COMPACT_DATE, "$1-$2-$3")),
        (_COMPACT, rewrite(text, _COMPACT, "$1-$2-$3 $4:$5:$6")),
        (_DAY_NAME, _named(text, _DAY_NAME, 2, 1)),
        (_NAME_DAY, _named(text, _NAME_DAY, 1, 2)),
        (_HALF_DAY, rewrite(rewrite(_full_day(text), first, first_iso), second, second_iso)),
    ]
    iso = " ".join(f"when {text} rlike {sql_text(pattern)} then {form}" for pattern, form in layouts)
    utc = f"cast(to_utc_timestamp(try_cast({text} as timestamp), current_timezone()) as timestamp_ntz)"
    tries = [
        _ntz(f"(case {iso} end)"),
        f"case when {text} rlike {sql_text(_ZONED)} then {utc} end",
        *[f"cast(try_to_timestamp({text}, {sql_text(f)}) as timestamp_ntz)" for f in formats],
    ]
    lenient = f"coalesce({', '.join(tries)})"
    if to_second:
        lenient = f"cast(date_trunc('second', {lenient}) as timestamp_ntz)"
    return f"coalesce({_plain_iso(cell)}, {lenient})"


def parse_time(cell: str, day_first: bool = False, formats: tuple[str, ...] = ()) -> str:
    """SQL for text to ``HH:mm:ss``, from a clock time or from a full date and time."""
    text = sql_stripped(cell)
    clock = rf"(?i)^{_CLOCK}(?: ?[ap]\.?m\.?)?$"
    dated = f"if({text} rlike {sql_text(clock)}, concat('1900-01-01 ', {text}), {text})"
    return f"date_format({parse_datetime(dated, day_first, formats)}, 'HH:mm:ss')"
