import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgate import ConfigurationError, Contract, apply_contract, violations
from gridgate.functions.cells import address_index, cell_address, column_letter
from gridgate.functions.literals import literal
from gridgate.functions.names import cleaned_name
from gridgate.operators import contract as contracts
from gridgate.operators import headers, reports
from gridgate.operators.numbering import number_by, rank_within
from gridgate.operators.project import add_lineage, clean_cells


def ranges_of(rows, shown=10):
    spans, rows = [], sorted(set(rows))
    for r in rows:
        if spans and spans[-1][1] == r - 1:
            spans[-1][1] = r
        else:
            spans.append([r, r])
    text = ", ".join(str(a) if a == z else f"{a}–{z}" for a, z in spans[:shown])
    return len(rows), len(spans), text, sum(z - a + 1 for a, z in spans[shown:])


@pytest.mark.parametrize("width", [1, 64, 128, 1000])
def test_row_ranges_match_brute_force(spark, width):
    dice = random.Random(width)
    groups = {"dense": list(range(2, 120)), "pairs": [r for r in range(2, 200) if r % 3], "one": [7], "dup": [3, 3, 4, 9, 9],
              "fixture": [1, 2, 3, 5, 6, 8], "random": [dice.randrange(1, 300) for _ in range(150)], "alternate": list(range(1, 400, 2)),
              "words": [63, 64, 127, 128, 191, *range(256, 512), 640, 1023, 1024]}
    df = spark.createDataFrame([(g, r) for g, rows in groups.items() for r in rows], "g string, row bigint")
    found = {r.g: (r.n_rows, r.n_ranges, r.ranges, r.hidden_rows) for r in reports.row_ranges(df, ["g"], width=width).collect()}
    assert found == {g: ranges_of(rows) for g, rows in groups.items()}


def test_ranges_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("row"))
    plan = reports.row_ranges(df, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rank_within_and_number_by(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i * 3) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, o bigint")
    found = {(r.k, r.o): r.n for r in rank_within(df, ["k"], "o", "n", width=50).collect()}
    wanted, seen = {}, {}
    for k, o in sorted(rows, key=lambda x: x[1]):
        seen[k] = seen.get(k, 0) + 1
        wanted[k, o] = seen[k]
    assert found == wanted
    numbered = number_by(df, "k", "n").collect()
    places = {k: i for i, k in enumerate(sorted({k for k, _ in rows}), 1)}
    assert sorted((r.k, r.o, r.n) for r in numbered) == sorted((k, o, places[k]) for k, o in rows)


def test_number_by_spreads_a_hot_value(spark):
    df = spark.createDataFrame([(None if i % 50 == 0 else "hot" if i % 3 else f"k{i % 11:02}", i) for i in range(4000)], "k string, o bigint").repartition(8)
    numbered = number_by(df, "k", "n")
    assert "Join [k" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    order = [None, *sorted({r.k for r in df.collect() if r.k is not None})]
    assert {(r.k, r.n) for r in numbered.collect()} == {(k, i) for i, k in enumerate(order, 1)} and numbered.count() == 4000


def checked(spark, rows, dtypes, keys=(), schema=None):
    columns = list(dtypes) + (["extra"] if schema is None else [])
    df = spark.createDataFrame(rows, schema or "pos int, " + ", ".join(f"{c} string" for c in columns))
    contract = Contract.of(dtypes, "gp", keys)
    found = apply_contract(df, contract, columns)
    return found, violations(found, contract, columns, [], "pos + 2")


def test_apply_contract(spark):
    rows = [(0, "1", "x", "a"), (1, "bad", None, "b"), (2, None, "toolong", "c"), (3, None, None, None)]
    found, broken = checked(spark, rows, {"id": "integer", "name": "varchar(3)"}, ["id"])
    assert [(r.id, r.name, r.extra) for r in found.orderBy("pos").collect()] == [
        (1, "x", "a"), (None, None, "b"), (None, None, "c"), (None, None, None)]
    assert [(r.cell, r.severity, r.code, r.expected_type) for r in broken.orderBy("row", "col_idx").collect()] == [
        ("A3", "error", "not_integer", "integer"), ("A4", "warning", "key_null", "integer"),
        ("B4", "error", "too_long", "varchar(3)"), ("A5", "warning", "key_null", "integer")]


def test_checks_add_no_shuffle_and_run_once(spark):
    found, broken = checked(spark, [(0, "1", "x", "a")], {"id": "integer", "name": "decimal(5,2)"})
    plan = broken._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("not_integer") == 1 and "Python" not in plan


def test_report_text(spark):
    rows = [(i, "bad" if i < 3 else "1", None if i == 1 else "k", "z") for i in range(5)]
    _, broken = checked(spark, rows, {"id": "integer", "name": "text"}, ["name"])
    report = reports.report_text(broken.withColumn("_file", F.lit("in.csv")), ["_file"], F.col("_file"), "now", values=True).first()
    assert not report.is_valid and report.report == (
        "=== Validation Report: in.csv ===\nGenerated: now\n\nResult: FAILED — 3 error(s) in 1 column(s)\n"
        "Warnings: 1 warning(s) in 1 column(s)\n\n[integer]  column id (A)  (3 error(s))\n  Rows: 2–4\n"
        "  Sample values: \"'bad'\" (A2),  \"'bad'\" (A3),  \"'bad'\" (A4)\n\n--- Warnings ---\n\n"
        "[text]  column name (B)  (1 warning(s))\n  Rows: 3\n")


def test_clean_file_gets_a_verdict(spark):
    _, broken = checked(spark, [(0, "1", "x", "a")], {"id": "integer"}, schema="pos int, id string, n string, e string")
    files = spark.createDataFrame([("f",)], "_file string")
    verdict = reports.verdicts(broken.withColumn("_file", F.lit("f")), ["_file"], files).first()
    assert verdict.is_valid and verdict.errors == 0


def test_addresses(spark):
    df = spark.createDataFrame([(i, column_letter(i)) for i in (0, 25, 26, 51, 52, 701, 702, 728, 18277)], "i bigint, l string")
    for r in df.select("l", "i", cell_address(F.lit(7), F.col("i")).alias("a"), address_index(F.concat("l", F.lit("9"))).alias("b")).collect():
        assert r.a == f"{r.l}7" and r.b == r.i


def test_clean_cells(spark):
    df = spark.createDataFrame([(" x\t",), ("  ",), ("",)], "c string")
    assert [r.c for r in clean_cells(df, ["c"], strip=True).collect()] == ["x", None, None]
    assert [r.c for r in clean_cells(df, ["c"], blanks=False).collect()] == [" x\t", "  ", ""]


def test_lineage_is_not_repeated(spark):
    df = spark.createDataFrame([("old", 1)], "load_dttm string, a int")
    assert add_lineage(df, ["load_dttm", "a"], "load_dttm", source_name=F.lit("f")).columns == ["load_dttm", "a", "wf_load_idn"]


def test_literals(spark):
    df = spark.createDataFrame([("O'Br\\ien\n\a",), (None,)], "c string")
    rows = df.select(literal(F.col("c"), T.StringType(), "gp").alias("g"), literal(F.col("c"), T.StringType(), "ch").alias("h")).collect()
    assert rows[0].g == "'O''Br\\ien\n\a'" and rows[0].h == "'O\\'Br\\\\ien\\n\\a'" and rows[1].g == "NULL"


def test_names(spark):
    df = spark.createDataFrame([("f", i, n) for i, n in enumerate(["Имя Клиента", "имя-клиента", "Щука__Ё ", "имя клиента"])], "f string, pos int, raw string")
    assert [r.col_name for r in headers.clean_names(df, ["f"]).orderBy("pos").collect()] == [
        "imya_klienta", "imya_klienta_1", "schuka_yo", "imya_klienta_2"]
    assert df.select(cleaned_name(F.lit("_A  b_"))).first()[0] == "a_b"


def test_header_check(spark):
    rows = [("f", i, n) for i, n in enumerate(["id", "col-1", "имя", "id", "42", "ok_1", ""])]
    found = {r.name: r.fault for r in headers.check(spark.createDataFrame(rows, "f string, pos int, name string"), ["f"]).collect()}
    assert found == {"id": "duplicate", "col-1": "invalid_characters", "имя": "invalid_characters", "42": "only_digits", "": "empty"}


GP_DDL = """/* staff */ create table hr.employees ( -- note
  id integer not null, full_name text, "Hired_At" date, amount decimal (12, 2) default 0, code character varying(50),
  seen timestamp(3) without time zone, at timestamp with time zone, ratio double precision, ok boolean default true,
  constraint pk primary key (id)) distributed by (id)"""
CH_DDL = """CREATE TABLE hr.t (`id` UInt64, amount Nullable(Decimal(18, 2)) DEFAULT NULL, price Decimal(10, 4) CODEC(ZSTD),
  at DateTime64(6), tags Array(Tuple(a Int8, b Nullable(String))), INDEX i id TYPE minmax) ENGINE = MergeTree"""


def test_ddl_contracts(spark):
    types = contracts.contract_from_ddl(spark, GP_DDL, "gp").types()
    assert list(types.items())[:5] == [("id", "integer"), ("full_name", "text"), ("hired_at", "date"), ("amount", "decimal(12, 2)"),
                                       ("code", "character varying(50)")]
    assert types["at"] == "timestamp with time zone" and types["ratio"] == "double precision" and types["ok"] == "boolean" and "constraint" not in types
    assert contracts.contract_from_ddl(spark, CH_DDL, "ch").types() == {
        "id": "UInt64", "amount": "Decimal(18, 2)", "price": "Decimal(10, 4)", "at": "DateTime64(6)", "tags": "Array(Tuple(a Int8, b Nullable(String)))"}
    for bad in ("", "  ", "create table x", "create table x (id int", "create table x (primary key (id))"):
        with pytest.raises(ConfigurationError):
            contracts.contract_from_ddl(spark, bad, "gp")


def test_long_ddl_does_not_exhaust_the_stack(spark):
    ddl = "create table wide (" + ", ".join(f"c{i} numeric({i % 30 + 5}, 2) default (1 + (2))" for i in range(3000)) + ")"
    assert len(contracts.contract_from_ddl(spark, ddl, "gp").columns) == 3000


def test_inference(spark):
    for values, gp, ch in [
            (["int"], "bigint", "Int64"), (["int", "float"], "decimal(18,6)", "Float64"), (["datetime"], "timestamp", "DateTime"),
            (["date"], "date", "Date32"), (["date", "datetime"], "timestamp", "DateTime"), (["time"], "time", "String"),
            (["bool"], "boolean", "Bool"), (["int", "str"], "text", "String"), ([None], "text", "String")]:
        df = spark.createDataFrame([("t", "c", v) for v in values], "table_name string, col_name string, kind string")
        assert contracts.infer_types(df, "gp").first().type_text == gp and contracts.infer_types(df, "ch").first().type_text == ch


def test_sampled_inference(spark):
    df = spark.range(250).selectExpr("id", "if(id < 200, cast(id as string), 'x') as c", "cast(id as double) as d")
    assert contracts.infer_contract(df, ["c", "d"], "gp", detect=True, ordinal="id", sample=200).types() == {"c": "bigint", "d": "decimal(18,6)"}
    assert contracts.infer_contract(df, ["c"], "gp").types() == {"c": "text"}


def test_render_round_trip(spark):
    contract = Contract.of({"id": "bigint", "name": "text", "amount": "decimal(18,6)", "created": "date"})
    text = contracts.render_ddl(contract.frame(spark, "t"), "gp", "s", "load_dttm").first().ddl
    assert text.startswith("-- s.t definition\n-- DROP TABLE s.t;\nCREATE TABLE s.t (\n\tid\tbigint\tNULL,\n") and "\tload_dttm\ttimestamp\tNULL\n)" in text
    assert contracts.contract_from_ddl(spark, text, "gp").types() == contract.types() | {"load_dttm": "timestamp"}
