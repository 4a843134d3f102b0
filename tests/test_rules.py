import random
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from gridgate import UnsupportedTypeError, check, register_rule, rule_for
from gridgate.functions import rules

U = "9b2d4c1e-0000-4a4a-8b8b-0123456789ab"
ACCEPTED = [
    ("smallint", "gp", ["42", "-10", "0", " 32767 ", "-32768", "+7", "007"], ["42", "-10", "0", "32767", "-32768", "7", "7"]),
    ("bigint", "gp", ["9223372036854775807", "-9223372036854775808"], ["9223372036854775807", "-9223372036854775808"]),
    ("UInt64", "ch", ["18446744073709551615", "0"], ["18446744073709551615", "0"]),
    ("Int128", "ch", [str(2 ** 127 - 1), str(-2 ** 127), "-000"], [str(2 ** 127 - 1), str(-2 ** 127), "0"]),
    ("real", "gp", ["3.14", "5", "0.0", "1e5", "-.5"], ["3.14", "5.0", "0.0", "100000.0", "-0.5"]),
    ("decimal(5,2)", "gp", ["3.14", "0", "-99.99", "1e2", "000012.5", " 1.5"], ["3.14", "0.00", "-99.99", "100.00", "12.50", "1.50"]),
    ("decimal(2,2)", "gp", ["0.00", ".5"], ["0.00", "0.50"]),
    ("numeric (4)", "gp", ["12"], ["12"]),
    ("Decimal(76, 2)", "ch", ["9" * 70 + ".25"], ["9" * 70 + ".25"]),
    ("date", "gp", ["2024-01-15", "15.01.2024", "01/15/2024", "20240115", "Jan 15, 2024", "15 January 2024", "2024/1/15"],
     ["2024-01-15"] * 7),
    ("timestamp", "gp", ["2024-01-15 10:30:00", "2024-01-15T10:30:00", "01/15/2024 10:30 am", "2024-01-15T13:30:00+03:00",
                         "2024-01-15 10:30:00.75"], ["2024-01-15 10:30:00"] * 5),
    ("Date", "ch", ["2149-06-06", "1970-01-01"], ["2149-06-06", "1970-01-01"]),
    ("DateTime64(6)", "ch", ["2024-01-15 10:30:00.123456"], ["2024-01-15 10:30:00.123456"]),
    ("DateTime64(3, 'UTC')", "ch", ["2024-01-15"], ["2024-01-15 00:00:00"]),
    ("time", "gp", ["10:30", "10:30:15", "9:05 pm", "2024-01-15 10:30:00"], ["10:30:00", "10:30:15", "21:05:00", "10:30:00"]),
    ("boolean", "gp", ["TRUE", " yes ", "0", "Null"], ["true", "yes", "0", "null"]),
    ("uuid", "gp", [U, U.upper(), f" {U} "], [U, U.upper(), U]),
    ("interval", "gp", ["1 year", "2 months", "1 year 2 months", "5 hours 30 minutes", "-1 day"], None),
    ("varchar(5)", "gp", ["hello", "тесты"], None), ("char(3)", "gp", ["abc"], None),
    ("FixedString(5)", "ch", ["hello"], None), ("  INTEGER  ", "gp", ["1"], None),
    ("Nullable(Int8)", "ch", ["127"], None), ("tsrange", "gp", ["anything"], None), ("text", "gp", ["", "x"], None),
]
REJECTED = [
    ("smallint", "gp", "32768", "value 32768 out of range [-32768, 32767]"),
    ("serial", "gp", "0", "value 0 out of range [1, 2147483647]"),
    ("integer", "gp", "abc", "not an integer"), ("integer", "gp", "3.14", "not an integer"), ("integer", "gp", "", "not an integer"),
    ("integer", "gp", "1_000", "not an integer"),
    ("bigint", "gp", "99999999999999999999", "value 99999999999999999999 out of range [-9223372036854775808, 9223372036854775807]"),
    ("Int128", "ch", str(2 ** 127), f"value {2 ** 127} out of range [{-2 ** 127}, {2 ** 127 - 1}]"),
    ("real", "gp", "1e400", "value out of allowed range [-3.4e+38, 3.4e+38]"), ("real", "gp", "hello", "not a floating-point number"),
    ("Float64", "ch", "1d", "not a floating-point number"), ("Float64", "ch", "nan", "value out of allowed range [-1.7e+308, 1.7e+308]"),
    ("decimal(5,2)", "gp", "3,14", "use a dot instead of a comma as decimal separator"),
    ("decimal(5,2)", "gp", "12345678901", "integer digits (11) exceed 3 (precision=5, scale=2)"),
    ("decimal(5,2)", "gp", "3.14159265", "fractional digits (8) exceed scale (2)"), ("decimal(5,2)", "gp", "abc", "not a number"),
    ("decimal(5,2)", "gp", "1e10", "integer digits (11) exceed 3 (precision=5, scale=2)"),
    ("decimal(5,2)", "gp", "-inf", "not a finite number"), ("decimal(2,2)", "gp", "0", "integer digits (1) exceed 0 (precision=2, scale=2)"),
    ("Date", "ch", "2200-01-01", "date out of allowed range [1970-01-01 — 2149-06-06]"),
    ("date", "gp", "not-a-date", "could not parse date/time value"), ("date", "gp", "2024-02-30", "could not parse date/time value"),
    ("time", "gp", "noon", "could not parse time value"),
    ("boolean", "gp", "maybe", f"allowed values: {sorted(rules.BOOLEAN_LITERALS)}"),
    ("uuid", "gp", U.replace("-", ""), "does not match UUID format (xxxxxxxx-xxxx-xxxx-xxxx-xxxxxxxxxxxx)"),
    ("interval", "gp", "forever", "does not match interval format, e.g. '1 year 2 months' or '3 days'"),
    ("varchar(5)", "gp", "toolong", "length 7 exceeds maximum 5"), ("char(3)", "gp", "ab", "expected exactly 3 characters, got 2"),
    ("FixedString(3)", "ch", "тест", "byte length exceeds FixedString(3)"),
]


def judge(spark, type_text, dialect, cells, source="string", options=None):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {source}")
    v = check("c", type_text, dialect, df.schema["c"].dataType, options)
    return [(r.v, r.f) for r in df.select("i", F.expr(f"cast({v.value} as string)").alias("v"), F.expr(v.fault).alias("f"))
            .orderBy("i").collect()]


@pytest.mark.parametrize("type_text,dialect,cells,values", ACCEPTED, ids=lambda x: x if isinstance(x, str) else "")
def test_accepted(spark, type_text, dialect, cells, values):
    for (value, fault), cell, wanted in zip(judge(spark, type_text, dialect, cells), cells, values or cells):
        assert fault is None and value == wanted, cell


def test_rejected(spark):
    groups = {}
    for type_text, dialect, cell, message in REJECTED:
        groups.setdefault((type_text, dialect), []).append((cell, message))
    for (type_text, dialect), pairs in groups.items():
        for (value, fault), (cell, message) in zip(judge(spark, type_text, dialect, [c for c, _ in pairs]), pairs):
            assert value is None and fault.message == message and fault.value == cell, (type_text, cell)


def test_null_is_never_checked(spark):
    for type_text in ("integer", "decimal(5,2)", "date", "uuid", "varchar(1)", "boolean", "interval", "real", "time", "text"):
        assert judge(spark, type_text, "gp", [None, None]) == [(None, None)] * 2


def test_native_cells(spark):
    assert [v for v, _ in judge(spark, "integer", "gp", [3.7, -3.7], "double")] == ["3", "-3"]
    assert [f.message for _, f in judge(spark, "integer", "gp", [float("nan"), float("inf")], "double")] == ["not an integer"] * 2
    assert judge(spark, "decimal(5,2)", "gp", [3.14159], "double")[0] == ("3.14", None)
    assert judge(spark, "varchar(3)", "gp", [1234], "int")[0][1].code == "too_long"
    assert judge(spark, "boolean", "gp", [True], "boolean")[0] == ("true", None)


def test_options(spark):
    assert judge(spark, "date", "gp", ["01.02.2024"])[0][0] == "2024-01-02"
    assert judge(spark, "date", "gp", ["01.02.2024"], options={"day_first": True})[0][0] == "2024-02-01"
    assert judge(spark, "date", "gp", ["2024|05|06"], options={"formats": ("yyyy|MM|dd",)})[0][0] == "2024-05-06"
    assert judge(spark, "decimal(5,2)", "gp", ["3.149"], options={"on_scale_overflow": "round"})[0][0] == "3.15"
    strict = judge(spark, "tsrange", "gp", ["[2024-01-15, 2024-01-16)", "[a,b]", "x"], options={"strict_ranges": True})
    assert strict[0][0] == "[2024-01-15 00:00:00, 2024-01-16 00:00:00)" and [f.code for _, f in strict[1:]] == ["not_datetime", "not_range"]
    assert [v for v, _ in judge(spark, "Bool", "ch", ["true", "1", "7", "x"], options={"strict_booleans": True})] == ["true", "true", "false", None]
    assert [v for v, _ in judge(spark, "array", "gp", ["[1]", "1"])] == ["[1]", None]


def test_unknown_and_registered_types(spark):
    for type_text, dialect in (("jsonb", "gp"), ("xml", "ch"), ("text", "ch")):
        with pytest.raises(UnsupportedTypeError):
            rule_for(type_text, dialect)
    register_rule("gp", r"jsonb", lambda m: rules.pattern(r"^\{.*\}$", "not_json", "not a JSON object"))
    try:
        assert judge(spark, "jsonb", "gp", ["{}", "x"])[1][1].message == "not a JSON object"
    finally:
        rules._custom.clear()


def expected_decimal(text, precision, scale):
    """Digit counts the plain way, from Python's own decimals."""
    try:
        number = Decimal(text)
    except InvalidOperation:
        return None
    _, digits, exponent = number.as_tuple()
    if not isinstance(exponent, int) or max(0, -exponent) > scale or max(0, len(digits) + exponent) > precision - scale:
        return None
    return number


def random_literal(dice):
    whole = "".join(dice.choice("0123456789") for _ in range(dice.randrange(0, 6)))
    fraction = dice.choice(["", ".", "." + "".join(dice.choice("0019") for _ in range(dice.randrange(0, 5)))])
    power = dice.choice(["", "", "", f"e{dice.randrange(-4, 5)}", "E+2"])
    return dice.choice(["", "-", "+"]) + whole + fraction + power


@pytest.mark.parametrize("precision,scale", [(5, 2), (2, 2), (4, 0), (9, 6), (1, 1)])
def test_decimals_match_python(spark, precision, scale):
    dice = random.Random(precision * 10 + scale)
    texts = [random_literal(dice) for _ in range(400)]
    for text, (value, fault) in zip(texts, judge(spark, f"decimal({precision},{scale})", "gp", texts)):
        wanted = expected_decimal(text, precision, scale)
        assert (None if value is None else Decimal(value)) == wanted, (text, value, fault)


def test_integers_match_python(spark):
    dice = random.Random(1)
    texts = [dice.choice(["", "-", "+", " "]) + "".join(dice.choice("0123456789") for _ in range(dice.randrange(0, 21))) for _ in range(400)]
    for type_text, bits in (("Int64", 64), ("Int8", 8), ("Int128", 128)):
        for text, (value, _) in zip(texts, judge(spark, type_text, "ch", texts)):
            try:
                wanted = int(text)
            except ValueError:
                wanted = None
            if wanted is not None and not -(2 ** (bits - 1)) <= wanted < 2 ** (bits - 1):
                wanted = None
            assert (None if value is None else int(value)) == wanted, (type_text, text)
