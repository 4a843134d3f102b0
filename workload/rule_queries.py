"""Type rules over text made from the tables' own values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgate.functions.rules import Slots, rule_for
from gridgate.session import spread
from workload.registry import query


@dataclass(frozen=True)
class Case:
    """A cell, its declared type, and the same judgement in DuckDB's SQL."""

    name: str
    cell: str
    type_text: str
    dialect: str
    code: str
    value: str
    duck_cell: str | None = None
    shown: str = "cast({} as string)"
    options: tuple = ()

    def sql(self, table: str) -> str:
        return (f"SELECT '{self.name}' AS case_name, code, count(*) AS cells, "
                f"sum(('0x' || left(md5(v), 7))::bigint)::bigint AS checksum FROM (SELECT code, CASE WHEN code = 'ok' THEN {self.value} END AS v FROM "
                f"(SELECT *, CASE WHEN c IS NULL THEN 'null' ELSE {self.code} END AS code FROM "
                f"(SELECT *, {self.duck_cell or self.cell} AS c FROM {table}))) GROUP BY code")


def judged(df: DataFrame, cases: list[Case]) -> DataFrame:
    """Cells per case and code, with a checksum over every accepted value.

    Numbers only, so that the aggregation stays a hash aggregation.
    """
    cells = spread(df).select(*[F.expr(c.cell).alias(f"c{i}") for i, c in enumerate(cases)])
    parts = ([], [], [])
    for i, case in enumerate(cases):
        slots = Slots(f"p{i}", f"k{i}")
        rule = rule_for(case.type_text, case.dialect, dict(case.options))
        verdict = rule(f"c{i}", cells.schema[f"c{i}"].dataType, slots)
        if verdict.parsed:
            parts[0].append(F.expr(verdict.parsed).alias(slots.parsed))
        parts[1].append(F.expr(verdict.value).alias(slots.kept))
        parts[2].append(F.expr(f"({verdict.fault}).code").alias(f"f{i}"))
    for step in parts:
        cells = cells.select("*", *step) if step else cells
    entries = ", ".join(
        f"named_struct('case_name', '{c.name}', 'code', coalesce(f{i}, if(c{i} is null, 'null', 'ok')), "
        f"'v', cast(conv(left(md5({c.shown.format(f'k{i}')}), 7), 16, 10) as bigint))" for i, c in enumerate(cases))
    return (cells.select(F.explode(F.expr(f"array({entries})")).alias("x")).groupBy("x.case_name", "x.code")
            .agg(F.count("*").alias("cells"), F.sum("x.v").alias("checksum")))


def oracle(cases: list[Case], table: str) -> str:
    return " UNION ALL ".join(c.sql(table) for c in cases)


def _ints(low, high):
    return (f"CASE WHEN NOT regexp_matches(trim(c), '^[+-]?[0-9]+$') THEN 'not_integer' "
            f"WHEN cast(trim(c) AS hugeint) BETWEEN {low} AND {high} THEN 'ok' ELSE 'out_of_range' END")


_INT_VALUE = "cast(cast(trim(c) AS hugeint) AS varchar)"
INTEGERS = [
    Case("quantity_smallint", "cast(l_quantity as string)", "smallint", "gp", _ints(-32768, 32767), _INT_VALUE,
         "cast(l_quantity AS varchar)"),
    Case("partkey_smallint", "cast(l_partkey * 7 as string)", "smallint", "gp", _ints(-32768, 32767), _INT_VALUE,
         "cast(l_partkey * 7 AS varchar)"),
    Case("partkey_integer", "concat(' ', l_partkey * 1000003, ' ')", "integer", "gp",
         _ints(-2147483648, 2147483647), _INT_VALUE, "' ' || cast(l_partkey * 1000003 AS varchar) || ' '"),
    Case("partkey_serial", "concat('+', l_partkey)", "serial", "gp", _ints(1, 2147483647), _INT_VALUE,
         "'+' || cast(l_partkey AS varchar)"),
    Case("suppkey_int8", "cast(-l_suppkey as string)", "Int8", "ch", _ints(-128, 127), _INT_VALUE,
         "cast(-l_suppkey AS varchar)"),
    Case("orderkey_uint32", "concat(l_orderkey, '000000')", "UInt32", "ch", _ints(0, 4294967295), _INT_VALUE,
         "cast(l_orderkey AS varchar) || '000000'"),
    Case("price_integer", "l_extendedprice * 1000", "integer", "gp",
         "CASE WHEN trunc(c) BETWEEN -2147483648 AND 2147483647 THEN 'ok' ELSE 'out_of_range' END",
         "cast(cast(trunc(c) AS bigint) AS varchar)"),
]


@query(oracle(INTEGERS, "lineitem"))
def validate_integers(spark, t):
    return judged(t.lineitem, INTEGERS)


def _wide(prefix, digits, times, size, bound, sign=""):
    scaled = f"(o_orderkey * {times}) % {10 ** digits}"
    limit = str(bound)
    return dict(
        cell=f"concat('{sign}{prefix}', lpad(cast({scaled} as string), {digits}, '0'))",
        duck_cell=f"'{sign}{prefix}' || lpad(cast({scaled} AS varchar), {digits}, '0')",
        code=f"CASE WHEN ltrim(c, '-') <= '{limit}' THEN 'ok' ELSE 'out_of_range' END", value="c")


WIDE = [
    Case("int128", type_text="Int128", dialect="ch",
         **_wide("17014118346046923173168730371588", 7, 700, 39, 2 ** 127 - 1)),
    Case("int128_negative", type_text="Int128", dialect="ch",
         **_wide("17014118346046923173168730371588", 7, 700, 39, 2 ** 127, "-")),
    Case("uint128", type_text="UInt128", dialect="ch",
         **_wide("3402823669209384634633746074317", 8, 7000, 39, 2 ** 128 - 1)),
    Case("uint64", type_text="UInt64", dialect="ch", **_wide("1844674407370", 7, 1100, 20, 2 ** 64 - 1)),
    Case("int256", type_text="Int256", dialect="ch",
         **_wide(str(2 ** 255 - 1)[:-7], 7, 900, 77, 2 ** 255 - 1)),
    Case("zeros", "concat('000', o_orderkey)", "UInt256", "ch", "'ok'", "cast(o_orderkey AS varchar)",
         "'000' || cast(o_orderkey AS varchar)"),
    Case("unsigned_negative", "cast(-o_orderkey as string)", "UInt128", "ch",
         "CASE WHEN c = '0' THEN 'ok' ELSE 'out_of_range' END", "c", "cast(-o_orderkey AS varchar)"),
]


@query(oracle(WIDE, "orders"))
def validate_wide_ints(spark, t):
    return judged(t.orders, WIDE)


_FLOAT_DUCK = ("CASE event_id % 6 WHEN 0 THEN cast(value AS varchar) WHEN 1 THEN 'nan' WHEN 2 THEN '1e400' "
               "WHEN 3 THEN cast(value AS varchar) || 'd' WHEN 4 THEN ' ' || cast(value AS varchar) || 'e1 ' "
               "ELSE '-inf' END")
_FLOAT_CODE = ("CASE WHEN NOT regexp_matches(lower(trim(c)), '^[+-]?(inf|nan|[0-9]+[.]?[0-9]*(e[+-]?[0-9]+)?)$') "
               "THEN 'not_float' WHEN event_id % 6 IN (0, 4) AND abs(cast(trim(c) AS double)) <= {} THEN 'ok' "
               "ELSE 'out_of_range' END")
_FLOAT_VALUE = "cast(cast(cast(trim(c) AS double) AS decimal(20,4)) AS varchar)"
_FLOAT_CELL = _FLOAT_DUCK.replace("varchar", "string")
_SHOW_DECIMAL = "cast(cast({} as decimal(20,4)) as string)"
FLOATS = [
    Case("text_double", _FLOAT_CELL, "double precision", "gp", _FLOAT_CODE.format("1.7e308"), _FLOAT_VALUE,
         _FLOAT_DUCK, _SHOW_DECIMAL),
    Case("text_float64", _FLOAT_CELL, "Float64", "ch", _FLOAT_CODE.format("1.7e308"), _FLOAT_VALUE, _FLOAT_DUCK,
         _SHOW_DECIMAL),
    Case("native", "value", "Float64", "ch", "'ok'", "cast(cast(c AS decimal(20,4)) AS varchar)",
         shown=_SHOW_DECIMAL),
]


@query(oracle(FLOATS, "events"))
def validate_floats(spark, t):
    return judged(t.events, FLOATS)


_PRICE = "cast(cast(o_totalprice as decimal(18,2)) as {})"
_WHOLE = "length(ltrim(split_part(c, '.', 1), '0'))"
DECIMALS = [
    Case("price_7_2", _PRICE.format("string"), "decimal(7,2)", "gp",
         f"CASE WHEN {_WHOLE} <= 5 THEN 'ok' ELSE 'precision_exceeded' END", "c", _PRICE.format("varchar")),
    Case("price_12_1", _PRICE.format("string"), "numeric(12, 1)", "gp", "'scale_exceeded'", "c",
         _PRICE.format("varchar")),
    Case("comma", f"if(o_orderkey % 5 = 0, replace({_PRICE.format('string')}, '.', ','), "
                  f"{_PRICE.format('string')})", "Decimal(10,2)", "ch",
         "CASE WHEN contains(c, ',') THEN 'comma_separator' ELSE 'ok' END", "c",
         f"CASE WHEN o_orderkey % 5 = 0 THEN replace({_PRICE.format('varchar')}, '.', ',') "
         f"ELSE {_PRICE.format('varchar')} END"),
    Case("exponent", "concat(o_orderkey, 'e', o_orderkey % 4)", "decimal(6,0)", "gp",
         "CASE WHEN o_orderkey = 0 AND o_orderkey % 4 = 0 THEN 'ok' "
         "WHEN length(cast(o_orderkey AS varchar)) + o_orderkey % 4 <= 6 THEN 'ok' ELSE 'precision_exceeded' END",
         "cast(cast(o_orderkey * power(10, o_orderkey % 4) AS bigint) AS varchar)",
         "cast(o_orderkey AS varchar) || 'e' || cast(o_orderkey % 4 AS varchar)"),
    Case("words", "concat_ws('', array(o_orderpriority, if(o_orderkey % 3 = 0, 'x', null)))", "decimal", "gp",
         "'not_number'", "c", "o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END"),
    Case("native_rounded", "o_totalprice", "decimal(9,1)", "gp", "'ok'",
         "cast(cast(round(c, 1) AS decimal(9,1)) AS varchar)", "cast(o_totalprice AS decimal(18,2))"),
    Case("legacy_rounding", _PRICE.format("string"), "decimal(8,1)", "gp",
         "CASE WHEN length(replace(c, '.', '')) <= 8 THEN 'ok' ELSE 'too_many_digits' END",
         "cast(cast(c AS decimal(18,1)) AS varchar)", _PRICE.format("varchar"),
         options=(("on_scale_overflow", "round"),)),
]


@query(oracle(DECIMALS, "orders"))
def validate_decimals(spark, t):
    return judged(t.orders, DECIMALS)


# Three layouts of one moment, shifted by years so that the type bounds matter.
_SHIFTED = "ts + make_interval(((event_id % 7) - 3) * 60)"
_DUCK_SHIFTED = "(ts + to_years(cast(((event_id % 7) - 3) * 60 AS integer)))"
_LAYOUTS = ("case event_id % 4 when 0 then date_format({0}, 'yyyy-MM-dd HH:mm:ss') "
            "when 1 then date_format({0}, 'dd.MM.yyyy HH:mm') when 2 then date_format({0}, 'yyyyMMdd') "
            "else concat('on ', date_format({0}, 'yyyy')) end").format(_SHIFTED)
_DUCK_LAYOUTS = ("CASE event_id % 4 WHEN 0 THEN strftime({0}, '%Y-%m-%d %H:%M:%S') "
                 "WHEN 1 THEN strftime({0}, '%d.%m.%Y %H:%M') WHEN 2 THEN strftime({0}, '%Y%m%d') "
                 "ELSE 'on ' || strftime({0}, '%Y') END").format(_DUCK_SHIFTED)
_DUCK_PARSED = ("CASE event_id % 4 WHEN 0 THEN strptime(c, '%Y-%m-%d %H:%M:%S') "
                "WHEN 1 THEN strptime(c, '%d.%m.%Y %H:%M') WHEN 2 THEN strptime(c, '%Y%m%d') END")


def _moment(name, type_text, dialect, low, high, fmt, shown):
    return Case(name, _LAYOUTS, type_text, dialect,
                f"CASE WHEN event_id % 4 = 3 THEN 'not_datetime' WHEN {_DUCK_PARSED} BETWEEN TIMESTAMP '{low}' AND "
                f"TIMESTAMP '{high}' THEN 'ok' ELSE 'out_of_range' END",
                f"strftime({_DUCK_PARSED}, '{fmt}')", _DUCK_LAYOUTS, shown, (("day_first", True),))


_DATE = ("%Y-%m-%d", "cast({} as string)")
_TIME = ("%Y-%m-%d %H:%M:%S", "date_format({}, 'yyyy-MM-dd HH:mm:ss')")
MOMENTS = [
    _moment("gp_timestamp", "timestamp", "gp", "0001-01-01", "9999-12-31 23:59:59", *_TIME),
    _moment("ch_date", "Date", "ch", "1970-01-01", "2149-06-06", *_DATE),
    _moment("ch_date32", "Date32", "ch", "1900-01-01", "2299-12-31", *_DATE),
    _moment("ch_datetime", "DateTime", "ch", "1970-01-01", "2106-02-07 06:28:15", *_TIME),
    Case("native_date", "ts", "date", "gp", "'ok'", "strftime(c, '%Y-%m-%d')"),
    Case("fractions", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')", "DateTime64(6)", "ch", "'ok'", "c",
         "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')", "date_format({}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"),
]


@query(oracle(MOMENTS, "events"))
def validate_datetimes(spark, t):
    return judged(t.events, MOMENTS)


TIMES = [
    Case("clock", "if(event_id % 9 = 0, 'noon', date_format(ts, 'HH:mm:ss'))", "time", "gp",
         "CASE WHEN event_id % 9 = 0 THEN 'not_time' ELSE 'ok' END", "c",
         "CASE WHEN event_id % 9 = 0 THEN 'noon' ELSE strftime(ts, '%H:%M:%S') END"),
    Case("short_clock", "date_format(ts, 'h:mm a')", "time without time zone", "gp", "'ok'",
         "strftime(ts, '%H:%M:00')", "strftime(ts, '%I:%M %p')"),
    Case("from_moment", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')", "time with time zone", "gp", "'ok'",
         "strftime(ts, '%H:%M:%S')", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
    Case("native", "ts", "time", "gp", "'ok'", "strftime(c, '%H:%M:%S')"),
]


@query(oracle(TIMES, "events"))
def validate_times(spark, t):
    return judged(t.events, TIMES)


_LITERALS = "('true','false','0','1','t','f','y','n','yes','no','on','off','null')"
_WORD = "case quality when 1 then ' TRUE ' else cast(toxic as {0}) end"
BOOLEANS = [
    Case("quality", "cast(quality as string)", "boolean", "gp",
         f"CASE WHEN c IN {_LITERALS} THEN 'ok' ELSE 'not_boolean' END", "c", "cast(quality AS varchar)"),
    Case("words", _WORD.format("string"), "Bool", "ch",
         f"CASE WHEN lower(trim(c)) IN {_LITERALS} THEN 'ok' ELSE 'not_boolean' END", "lower(trim(c))",
         _WORD.format("varchar")),
    Case("doc_id", "cast(doc_id as string)", "boolean", "gp",
         f"CASE WHEN c IN {_LITERALS} THEN 'ok' ELSE 'not_boolean' END", "c", "cast(doc_id AS varchar)"),
    Case("strict", "cast(doc_id as string)", "Bool", "ch", "'ok'", "CASE WHEN c = '1' THEN 'true' ELSE 'false' END",
         "cast(doc_id AS varchar)", options=(("strict_booleans", True),)),
]


@query(oracle(BOOLEANS, "labels"))
def validate_booleans(spark, t):
    return judged(t.labels, BOOLEANS)


_MD5 = ("concat_ws('-', substring(md5({0}), 1, 8), substring(md5({0}), 9, 4), substring(md5({0}), 13, 4), "
        "substring(md5({0}), 17, 4), substring(md5({0}), 21, 12))")
UUIDS = [
    Case("text_digest", f"if(doc_id % 7 = 0, md5(text), upper({_MD5.format('text')}))", "uuid", "gp",
         "CASE WHEN doc_id % 7 = 0 THEN 'not_uuid' ELSE 'ok' END", "c",
         f"CASE WHEN doc_id % 7 = 0 THEN md5(text) ELSE upper({_MD5.format('text')}) END"),
]


@query(oracle(UUIDS, "documents"))
def validate_uuids(spark, t):
    return judged(t.documents, UUIDS)


_UNIT = "CASE p_partkey % 5 WHEN 0 THEN 'days' WHEN 1 THEN 'Month' WHEN 2 THEN 'fortnight' WHEN 3 THEN 'hours 30 minutes' ELSE '' END"
INTERVALS = [
    Case("size_unit", f"concat(' ', p_size, ' ', {_UNIT})", "interval", "gp",
         "CASE WHEN p_partkey % 5 IN (0, 1, 3) THEN 'ok' ELSE 'not_interval' END", "trim(c)",
         f"' ' || cast(p_size AS varchar) || ' ' || {_UNIT}"),
]


@query(oracle(INTERVALS, "part"))
def validate_intervals(spark, t):
    return judged(t.part, INTERVALS)


_DAY = "date_format({0}, 'yyyy-MM-dd')"
RANGES = [
    Case("day_range", "if(event_id % 8 = 0, concat('[', date_format(ts, 'yyyy-MM-dd'), ',soon)'), "
                      "concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ', ', "
                      "date_format(ts + interval 1 day, 'yyyy-MM-dd'), ')'))", "tsrange", "gp",
         "CASE WHEN event_id % 8 = 0 THEN 'not_datetime' ELSE 'ok' END",
         "'[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ', ' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') || ' 00:00:00)'",
         "CASE WHEN event_id % 8 = 0 THEN '[' || strftime(ts, '%Y-%m-%d') || ',soon)' ELSE '[' || "
         "strftime(ts, '%Y-%m-%d %H:%M:%S') || ', ' || strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d') || ')' END",
         options=(("strict_ranges", True),)),
    Case("json_as_array", "if(event_id % 3 = 0, props, concat('[', props, ']'))", "array", "gp",
         "CASE WHEN event_id % 3 = 0 THEN 'not_array' ELSE 'ok' END", "c",
         "CASE WHEN event_id % 3 = 0 THEN props ELSE '[' || props || ']' END"),
]


@query(oracle(RANGES, "events"))
def validate_ranges(spark, t):
    return judged(t.events, RANGES)


LENGTHS = [
    Case("text_varchar", "text", "varchar(2000)", "gp",
         "CASE WHEN length(c) <= 2000 THEN 'ok' ELSE 'too_long' END", "md5(c)", shown="md5({})"),
    Case("text_fixed", "text", "FixedString(2000)", "ch",
         "CASE WHEN octet_length(encode(c)) <= 2000 THEN 'ok' ELSE 'too_long' END", "md5(c)", shown="md5({})"),
    Case("source_varchar", "source", "character varying(4)", "gp",
         "CASE WHEN length(c) <= 4 THEN 'ok' ELSE 'too_long' END", "c"),
    Case("lang_char", "lang", "char(2)", "gp", "CASE WHEN length(c) = 2 THEN 'ok' ELSE 'wrong_length' END", "c"),
    Case("source_char", "source", "character(4)", "gp",
         "CASE WHEN length(c) = 4 THEN 'ok' ELSE 'wrong_length' END", "c"),
]


@query(oracle(LENGTHS, "documents"))
def validate_lengths(spark, t):
    return judged(t.documents, LENGTHS)


TEXTS = [
    Case("name", "p_name", "text", "gp", "'ok'", "c"),
    Case("number", "p_size", "String", "ch", "'ok'", "cast(c AS varchar)"),
    Case("range_text", "p_type", "tsrange", "gp", "'ok'", "c"),
]


@query(oracle(TEXTS, "part"))
def validate_text(spark, t):
    return judged(t.part, TEXTS)
