import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridgate import ConfigurationError, Contract, DataValidationError, IntakeConfig, SourceError, run_load
from gridgate.plans import publish
from gridgate.sources.delimited import scan_delimited
from gridgate.sources.insert_dump import scan_insert_dump
from gridgate.streaming.intake import append_stream, checked_stream, read_arriving
from workload.books import workbook
from tests.test_sources import DATA, SIMPLE, make_template, put

TYPES = {"id": "integer", "amount": "decimal(5,2)"}
TEXT = "id,amount,note\n1,2.50,a\n,,\n2,bad,  \n x,3,c\n"


@pytest.fixture
def table(spark):
    name = f"d{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    return f"{name}.t"


def rows_of(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "a int")


def boom(df, table):
    df.write.insertInto(table)
    raise RuntimeError("lost")


def test_publish_append(spark, table):
    publish.append(numbers(spark, 1), table)
    publish.append(numbers(spark, 2), table)
    assert rows_of(spark, table) == [(1,), (2,)]


def test_publish_replace(spark, table):
    publish.replace(numbers(spark, 1), table)
    publish.replace(numbers(spark, 2), table)
    with pytest.raises(RuntimeError):
        publish.replace(numbers(spark, 3), table, load=boom)
    publish.replace(spark.table(table).select((F.col("a") + 10).alias("a")), table)
    assert rows_of(spark, table) == [(12,)] and [t.name for t in spark.catalog.listTables(table.split(".")[0])] == ["t"]


def test_publish_via_backup(spark, table):
    assert publish.via_backup(numbers(spark, 1), table) is None
    with pytest.raises(RuntimeError):
        publish.via_backup(numbers(spark, 2), table, load=boom)
    assert rows_of(spark, table) == [(1,)]
    backup = publish.via_backup(numbers(spark, 3), table, datetime(2024, 5, 6, 7, 8))
    assert backup == f"{table}_before_240506_0708" and rows_of(spark, backup) == [(1,)] and rows_of(spark, table) == [(3,)]


def test_publish_failure_without_original(spark, table):
    for mode in (publish.append, publish.replace, publish.via_backup):
        with pytest.raises(RuntimeError):
            mode(numbers(spark, 1), table, load=boom)
        assert not spark.catalog.tableExists(table)


def test_jdbc_options():
    options = publish.jdbc_options("ch", "jdbc:ch://h/db", "s.t", 500, 4, "me")
    assert options["batchsize"] == "500" and options["numPartitions"] == "4" and options["isolationLevel"] == "NONE"


def test_catalog_columns(spark):
    rows = [("id", 1, "integer", None, 32, 0), ("name", 2, "character varying", 50, None, None), ("free", 3, "character varying", None, None, None),
            ("amount", 4, "numeric", None, 12, 2), ("any", 5, "numeric", None, None, None), ("code", 6, "character", 3, None, None)]
    df = spark.createDataFrame(rows, "column_name string, ordinal_position int, data_type string, character_maximum_length int, "
                                     "numeric_precision int, numeric_scale int")
    assert [r.type_text for r in publish.catalog_columns(df, "gp").orderBy("ordinal").collect()] == [
        "integer", "character varying(50)", "character varying", "numeric(12,2)", "numeric", "character(3)"]
    df = spark.createDataFrame([("a", 1, "Nullable(Decimal(18, 2))"), ("b", 2, "UInt8")], "name string, position int, type string")
    assert [r.type_text for r in publish.catalog_columns(df, "ch").collect()] == ["Decimal(18, 2)", "UInt8"]


def config(tmp_path, source, **options):
    return IntakeConfig(source, **{"dtypes": TYPES, "output_dir": str(tmp_path / "out"), **options})


def test_coerce_writes_csv(spark, tmp_path):
    run = run_load(spark, config(tmp_path, put(tmp_path, "in.csv", TEXT), export="csv", error_mode="coerce", timestamp="load_dttm", source_name_column=True))
    back = scan_delimited(spark, run.output)
    assert back.columns == ["id", "amount", "note", "load_dttm", "wf_load_idn"]
    rows = back.rows.orderBy("_ordinal").collect()
    assert [(r.id, r.amount, r.note) for r in rows] == [("1", "2.50", "a"), ("2", None, None), (None, "3.00", "c")]
    assert {r.wf_load_idn for r in rows} == {"in.csv"} and len({r.load_dttm for r in rows}) == 1
    assert [(r.cell, r.message) for r in run.violations.orderBy("row").collect()] == [("B4", "not a number"), ("A5", "not an integer")]
    metrics = run.metrics.first()
    assert (metrics.rows_written, metrics.rows_skipped) == (3, 1)


def test_sql_export_has_no_gaps(spark, tmp_path):
    text = "id,amount\n" + "".join(f"{i},1\n" if i % 4 else ",\n" for i in range(40))
    run = run_load(spark, config(tmp_path, put(tmp_path, "in.csv", text), error_mode="raise", batch_size=7, scheme_name="s", table_name="t"))
    statements = [r.value for r in spark.read.text(run.output, lineSep=";\n").collect()]
    assert [s.count("(") - 1 for s in sorted(statements, key=lambda s: int(s.split("VALUES (")[1].split(",")[0]))] == [7, 7, 7, 7, 2]
    assert scan_insert_dump(spark, run.output).rows.count() == 30


@pytest.mark.parametrize("mode", ["raise", "verify"])
def test_bad_data_is_not_published(spark, tmp_path, mode):
    with pytest.raises(DataValidationError) as error:
        run_load(spark, config(tmp_path, put(tmp_path, "in.csv", TEXT), error_mode=mode, report_dir=str(tmp_path / "reports")))
    assert not (tmp_path / "out").exists() and error.value.outcome.verdicts.first().errors == 2
    report = "\n".join(r.value for r in spark.read.text(str(tmp_path / "reports")).collect())
    assert "Result: FAILED — 2 error(s) in 2 column(s)" in report and "Sample" not in report


def test_ignore_and_verify_good_data(spark, tmp_path):
    assert run_load(spark, config(tmp_path, put(tmp_path, "in.csv", TEXT), export="csv", dtypes=None)).violations is None
    good = run_load(spark, config(tmp_path, put(tmp_path, "ok.csv", "id,amount\n1,2\n"), error_mode="verify"))
    assert good.output is None and good.verdicts.first().is_valid


def test_policies(spark, tmp_path, table):
    source = put(tmp_path, "in.csv", "id,note\n1,a\n2,b\n")
    scheme, name = table.split(".")
    into = dict(dtypes=None, export="append", scheme_name=scheme, table_name=name, error_mode="raise")
    made = run_load(spark, config(tmp_path, source, policy="bd", **into))
    assert made.contract.types() == {"id": "text", "note": "text"} and rows_of(spark, table) == [("1", "a"), ("2", "b")]
    run_load(spark, config(tmp_path, source, policy="bd", **into | {"export": "truncate_load"}))
    assert spark.table(table).count() == 2
    ddl = run_load(spark, config(tmp_path, source, policy="user_string", ddl="create table t (id bigint, more text)", **into | {"export": "via_backup"}))
    assert ddl.contract.types() == {"id": "bigint", "more": "text"} and rows_of(spark, table) == [(1, "a"), (2, "b")]
    with pytest.raises(ConfigurationError):
        IntakeConfig(source, policy="user_string")


def test_template_run(spark, tmp_path):
    source = put(tmp_path, "in.xlsx", make_template(SIMPLE, DATA))
    run = run_load(spark, config(tmp_path, source, policy="ods_template", dtypes=None, export="csv", error_mode="raise"))
    back = scan_delimited(spark, run.output)
    assert back.columns == ["id", "full_name", "origin"]
    assert [tuple(r[c] for c in back.columns) for r in back.rows.orderBy("_ordinal").collect()] == [("1", "Анна", "file 7"), ("2", None, "file 7")]
    wrong = put(tmp_path, "bad.xlsx", make_template([["Другое", "table", None, "id", "text"]], DATA))
    with pytest.raises(SourceError, match="mismatch"):
        run_load(spark, config(tmp_path, wrong, policy="ods_template", dtypes=None))


def test_templates_keep_their_own_fixed_values(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a.xlsx", make_template(SIMPLE, DATA))
    put(tmp_path / "in", "b.xlsx", make_template(SIMPLE, [["file 8"], *DATA[1:3]]))
    inbox = config(tmp_path, str(tmp_path / "in"), policy="ods_template", dtypes=None, export="csv", error_mode="raise")
    back = scan_delimited(spark, run_load(spark, inbox).output).rows
    assert sorted((r.id, r.origin) for r in back.collect()) == [("1", "file 7"), ("1", "file 8"), ("2", "file 7")]
    for odd in (make_template([["Код", "table", "true", "id", "text"], *SIMPLE[1:]], DATA), workbook({"data": DATA})):
        put(tmp_path / "in", "c.xlsx", odd)
        with pytest.raises(SourceError, match="template differs"):
            run_load(spark, inbox)


def test_dump_run_takes_the_table_name(spark, tmp_path):
    run = run_load(spark, config(tmp_path, put(tmp_path, "in.sql", "INSERT INTO a.users (id, amount) VALUES (1, 2), (2, 'x');\n"), error_mode="coerce", scheme_name="b"))
    assert "INSERT INTO b.users (id, amount)" in spark.read.text(run.output, wholetext=True).first().value


@pytest.mark.parametrize("options", [{"batch_size": 0}, {"skip_rows": -1}, {"max_row": 0}, {"encoding_input": "x"}, {"dialect": "oracle"},
                                     {"export": "x"}, {"error_mode": "x"}, {"timestamp": "x"}, {"source": ""}])
def test_config_checks(options):
    with pytest.raises(ConfigurationError):
        IntakeConfig(**{"source": "in.csv", **options})


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a.csv", "id,amount\n1,2\n,\nx,3\n")
    rows = checked_stream(read_arriving(spark, str(tmp_path / "in"), ["id", "amount"]), Contract.of(TYPES))
    for name, total in (("b.csv", 3), ("c.csv", 4)):
        put(tmp_path / "in", name, "id,amount\n5,6\n")
        append_stream(rows, str(tmp_path / "out"), str(tmp_path / "marks"), once=True).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).count() == total
