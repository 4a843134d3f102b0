"""Kinds of dump cells from scan to sink, and parentheses of any depth."""

import pytest
from pyspark.sql import functions as F

from gridgate import IntakeConfig, SourceError, run_load
from gridgate.functions.brackets import deepest, groups, leading_group, parts
from gridgate.operators.contract import contract_from_ddl, infer_contract, parse_ddl
from gridgate.sources import insert_dump
from gridgate.sources.insert_dump import dump_rows, read_dump, scan_insert_dump
from gridgate.sources.positions import KINDS, ORDINAL

DUMP = ("INSERT INTO s.t (id, amount, ok, name, code, nothing) VALUES (1, 3.149, TRUE, 'a', '007', NULL),\n"
        "(+02, -1.5e2, false, 'it''s', '8', NULL);\nINSERT INTO s.t (id, amount) VALUES (3, 4);\n")


def put(folder, text, name="in.sql"):
    path = folder / name
    path.write_text(text)
    return str(path)


def written(spark, path):
    return "\n".join(r.value for r in spark.read.text(path).collect())


def test_kinds_of_a_scan(spark, tmp_path):
    scan = scan_insert_dump(spark, put(tmp_path, DUMP))
    rows = scan.rows.orderBy("_ordinal").collect()
    assert [r[KINDS] for r in rows] == [["int", "float", "bool", "str", "str", None], ["int", "float", "bool", "str", "str", None],
                                        ["int", "int", None, None, None, None]]
    assert [r.id for r in rows] == ["1", "2", "3"]
    types = infer_contract(scan.rows, scan.columns, kinds=KINDS).types()
    assert types == {"id": "bigint", "amount": "decimal(18,6)", "ok": "boolean", "name": "text", "code": "text", "nothing": "text"}
    assert infer_contract(scan.rows, scan.columns, "ch", kinds=KINDS).types()["amount"] == "Float64"


@pytest.mark.parametrize("dialect,first", [("gp", "(1, 3.149, TRUE, 'a', '007', NULL)"), ("ch", "(1, 3.149, 1, 'a', '007', NULL)")])
def test_dump_in_dump_out(spark, tmp_path, dialect, first):
    out = run_load(spark, IntakeConfig(put(tmp_path, DUMP), dialect, "sql", "ignore", output_dir=str(tmp_path / "out")))
    text = written(spark, out.output)
    assert first in text and "(2, -1.5e2, " in text and "(3, 4, NULL" in text


def test_quote_all_in_a_run(spark, tmp_path):
    out = run_load(spark, IntakeConfig(put(tmp_path, DUMP), export="sql", quote_all=True, output_dir=str(tmp_path / "out")))
    assert "('1', '3.149', 'TRUE', 'a', '007', NULL)" in written(spark, out.output)


def test_inferred_run_of_a_dump(spark, tmp_path):
    out = run_load(spark, IntakeConfig(put(tmp_path, DUMP), export="sql", error_mode="coerce", policy="bd", output_dir=str(tmp_path / "out")))
    assert out.contract.types()["id"] == "bigint" and out.violations.count() == 0
    assert "(1, 3.149000, 'true', 'a', '007', NULL)" in written(spark, out.output)


def test_numbers_are_judged_as_numbers(spark, tmp_path):
    text = "INSERT INTO t (a, b, c, d, e, f) VALUES (3.149, '3.149', 2.9, '2.9', TRUE, 1.50), (1e40, 'x', 5, '5', 'TRUE', 'abcd');\n"
    types = {"a": "decimal(5,2)", "b": "decimal(5,2)", "c": "integer", "d": "integer", "e": "bigint", "f": "varchar(3)"}
    out = run_load(spark, IntakeConfig(put(tmp_path, text), export="sql", error_mode="coerce", dtypes=types, output_dir=str(tmp_path / "out")))
    found = {(r.cell, r.code) for r in out.violations.collect()}
    assert found == {("B2", "scale_exceeded"), ("D2", "not_integer"), ("A3", "precision_exceeded"), ("B3", "not_number"), ("E3", "not_integer"), ("F3", "too_long")}
    assert "(3.15, NULL, 2, NULL, 1, '1.5')" in written(spark, out.output)


def test_float_under_a_date_is_text(spark, tmp_path):
    out = run_load(spark, IntakeConfig(put(tmp_path, "INSERT INTO t (d) VALUES (3.5), ('2024-01-02');\n"), export="sql", error_mode="coerce",
                                       dtypes={"d": "date"}, output_dir=str(tmp_path / "out")))
    assert [(r.cell, r.code) for r in out.violations.collect()] == [("A2", "not_datetime")]


@pytest.mark.parametrize("values,rows", [
    ("(1,'x'), ROW(2,'y'), (3,'z')", None), ("(1, 'x') (2, 'y'),", 2), ("(1, 'x') ON CONFLICT (id) DO NOTHING", 1), ("(1, 'x') nonsense", None),
    ("(1, f(2, (3), '(')), (((4)), 'a(b')", 2), ("(1, 'x'", None), ("(1, 'x'))", None), ("", None), ("(1, 2) on duplicate key update a = VALUES(a)", 1),
])
@pytest.mark.parametrize("depth", [40, 0])
def test_what_follows_values(spark, tmp_path, monkeypatch, values, rows, depth):
    monkeypatch.setattr(insert_dump, "_PATTERN_DEPTH", depth)
    path = put(tmp_path, f"INSERT INTO t (a, b) VALUES (0, 'i');\nINSERT INTO t (a, b) VALUES {values};\n")
    scan = scan_insert_dump(spark, path, "t")
    assert (scan.rejected.count() == 0) == (rows is not None)
    if rows is not None:
        assert scan.rows.count() == rows + 1


@pytest.mark.parametrize("levels", [1, 13, 60, 300])
def test_any_nesting_in_a_dump(spark, tmp_path, levels):
    nest = "(" * levels + "1, ')'" + ")" * levels
    got = dump_rows(read_dump(spark, put(tmp_path, f"INSERT INTO t (a, b, c) VALUES (1, f{nest}, 'x'), (2, g{nest}, NULL);\n"))).collect()
    assert [[i and i.text for i in r["items"]] for r in got] == [["1", f"f{nest}", "x"], ["2", f"g{nest}", None]]
    assert not any(r["_broken"] for r in got)


def test_insert_without_columns_is_reported(spark, tmp_path):
    path = put(tmp_path, "INSERT INTO t (a) VALUES (1);\nINSERT INTO t VALUES (2);\nCOMMENT ON t IS 'INSERT INTO t VALUES (3)';\n")
    assert scan_insert_dump(spark, path, "t").rejected.count() == 1
    with pytest.raises(SourceError):
        run_load(spark, IntakeConfig(path, export="sql"))


def test_deep_types_in_ddl(spark):
    deep = "Array(" * 40 + "Int8" + ")" * 40
    assert contract_from_ddl(spark, f"CREATE TABLE t (id UInt64, deep {deep}, x Decimal (10, 2))", "ch").types() == {
        "id": "UInt64", "deep": deep, "x": "Decimal"}
    ddl = f"create table t (a numeric (10, 2) not null, b text check (((b) <> '')), c {'f(' * 30}1{')' * 30})"
    assert contract_from_ddl(spark, ddl, "gp").types() == {"a": "numeric(10, 2)", "b": "text", "c": "f(" * 30 + "1" + ")" * 30}
    odd = parse_ddl(spark.createDataFrame([("t", "create table t (a decimal((1)")], "table_name string, ddl string"), "gp").first()
    assert odd.status == "unbalanced parentheses"


def test_brackets(spark):
    one = lambda column: spark.range(1).select(column.alias("x")).first().x
    quoted = "'(?:[^']++|'')*+'"
    assert one(deepest(F.lit("a(b(c)')('((d)))"), quoted)) == 3 and one(deepest(F.lit(""))) == 0
    assert one(parts(F.lit("a, f(b, c), ',', ,"), quoted)) == ["a", " f(b, c)", " ','", " ", ""]
    assert one(leading_group(F.lit("(a(b))c"))) == "(a(b))" and one(leading_group(F.lit("(a"))) == "" and one(leading_group(F.lit("a()"))) == ""
    read = one(groups(F.lit(" (1), (2, (3)) , x (4)"), quoted, r"\s*+,?+\s*+"))
    assert read.groups == ["(1)", "(2, (3))"] and read.tail == " , x (4)"
    assert one(groups(F.lit("(1), (2"), quoted, r"\s*+,?+\s*+")).groups == ["(1)"]


def test_patterns_run_once_at_each_use(spark, tmp_path):
    """Reading a dump or a DDL never lets one pattern grow with its uses, nor with the rows."""
    path = put(tmp_path, "INSERT INTO t (a, b) VALUES (1, f('x', (2))), (+007, '');\n")
    plan = read_dump(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(sequence") == 0 and plan.count("ON\\s+CONFLICT") == 1
    ddl = spark.createDataFrame([("t", "create table t (a numeric (10, 2), b text)")], "table_name string, ddl string")
    for dialect in ("gp", "ch"):
        assert parse_ddl(ddl, dialect)._jdf.queryExecution().optimizedPlan().toString().count("--[^") == 1


@pytest.mark.parametrize("levels", [1, 4, 5, 40, 63, 64, 65, 90])
def test_patterns_and_running_depth_agree(spark, levels):
    quoted, nest = "'(?:[^']++|'')*+'", "f(" * levels + "1, ')'" + ")" * levels
    frame = spark.createDataFrame([(f"a, {nest}, ',' , {nest}",)], "x string")
    assert frame.select(parts(F.col("x"), quoted).alias("p")).first().p == ["a", f" {nest}", " ',' ", f" {nest}"]
    plain = "(" * levels + "1" + ")" * levels
    assert spark.createDataFrame([(plain + "(2)",)], "x string").select(leading_group(F.col("x")).alias("p")).first().p == plain


def test_words_of_a_dump(spark, tmp_path):
    path = put(tmp_path, "INSERT INTO t (a, b, c) VALUES (+007, -0, 00), (-01.50, 'TRUE', true), ('', null, 'null'), (1e5, x'y', .5), (-, +), (0, '+1', '01');\n")
    want = [[("int", "7"), ("int", "-0"), ("int", "0")], [("float", "-01.50"), ("str", "TRUE"), ("bool", "true")], [None, None, ("str", "null")],
            [("float", "1e5"), ("str", "x'y'"), ("float", ".5")], [("str", "-"), ("str", "+"), None], [("int", "0"), ("str", "+1"), ("str", "01")]]
    rows = dump_rows(read_dump(spark, path)).orderBy("_tick").collect()
    assert [([i and (i.kind, i.text) for i in r["items"]] + [None])[:3] for r in rows] == want
    scan = scan_insert_dump(spark, path, "t")
    got = [[k and (k, v) for k, v in zip(r[KINDS], (r.a, r.b, r.c), strict=True)] for r in scan.rows.orderBy(ORDINAL).collect()]
    assert got == want


def test_statements_name_columns_in_any_order(spark, tmp_path):
    path = put(tmp_path, "INSERT INTO t (a, b, c) VALUES (1, 2, 3);\nINSERT INTO t (C, a) VALUES (6, 4);\nINSERT INTO t (d) VALUES (7);\n")
    rows = scan_insert_dump(spark, path, "t").rows.orderBy(ORDINAL).collect()
    assert [(r.a, r.b, r.c, r[KINDS]) for r in rows] == [
        ("1", "2", "3", ["int"] * 3), ("4", None, "6", ["int", None, "int"]), (None, None, None, [None] * 3)]
