"""Cases of the second round: changed splits, odd quotes, deep nesting, names in any script, columns by name."""

import pytest
from pyspark.sql import functions as F

from gridgate.errors import ConfigurationError
from gridgate.functions.cells import address_index, cell_address, column_letter
from gridgate.operators.contract import parse_ddl
from gridgate.plans import publish
from gridgate.sources.delimited import scan_delimited
from gridgate.sources.insert_dump import scan_insert_dump


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def cells(scan):
    return [tuple(r[c] for c in scan.columns) for r in scan.rows.orderBy("_file", "_ordinal").collect()]


def test_splits_may_change_between_scan_and_action(spark, tmp_path):
    path = put(tmp_path, "long.csv", "id,name\n" + "".join(f"{i},some text\n" for i in range(200_000)))
    keys = ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set(keys[0], "1000")
        spark.conf.set(keys[1], "5")
        scan = scan_delimited(spark, path)
        spark.conf.set(keys[1], "3")
        found = scan.rows.agg(F.count("*"), F.sum(F.when(F.col("id") + 1 == F.col("_ordinal"), 1))).first()
        assert tuple(found) == (200_000, 200_000)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_quoted_header_and_quoted_line_ends(spark, tmp_path):
    put(tmp_path, "a.csv", 'id,"name, full",x\n1,"Doe, J",2\n')
    put(tmp_path, "b.csv", 'id,"name, full",x\n2,"two\nlines",3\n')
    scan = scan_delimited(spark, str(tmp_path))
    assert scan.columns == ["id", "name, full", "x"] and scan.rejected.count() == 0
    assert cells(scan) == [("1", "Doe, J", "2"), ("2", "two\nlines", "3")]


def test_dump_tuples_of_any_depth(spark, tmp_path):
    path = put(tmp_path, "d.sql", "INSERT INTO t (a, b) VALUES (1,'x'),(2,f(g(h(')'), 3))),(4,'y');\n")
    scan = scan_insert_dump(spark, path, "t")
    assert cells(scan) == [("1", "x"), ("2", "f(g(h(')'), 3))"), ("4", "y")] and scan.rejected.count() == 0


def test_dump_with_an_unreadable_tuple_is_rejected(spark, tmp_path):
    path = put(tmp_path, "d.sql", "INSERT INTO t (a) VALUES (1),((2),(3);\nINSERT INTO t (a) VALUES (4);\n")
    assert scan_insert_dump(spark, path, "t").rejected.count() == 1


def test_ddl_names_and_depth(spark):
    ddl = 'create table t (имя text, "Дата" date, b Tuple(b Array(Tuple(c Map(String, Array(Decimal(3,1)))))))'
    rows = parse_ddl(spark.createDataFrame([("t", ddl)], "table_name string, ddl string"), "gp").orderBy("ordinal").collect()
    assert [r.col_name for r in rows] == ["имя", "дата", "b"] and {r.status for r in rows} == {"ok"}
    odd = parse_ddl(spark.createDataFrame([("t", "create table t (id bigint, ???)")], "table_name string, ddl string"), "gp").first()
    assert odd.status.startswith("unknown part")


def test_letters_without_a_bound(spark):
    at = [0, 25, 26, 701, 702, 18277, 18278, 475253, 475254, 10**12]
    rows = spark.createDataFrame([(i,) for i in at], "i long").select("i", cell_address(F.lit(3), F.col("i")).alias("c")).collect()
    assert [r.c for r in rows] == [column_letter(i) + "3" for i in at]
    back = spark.createDataFrame([(column_letter(i) + "3", i) for i in at], "c string, i long").filter(address_index(F.col("c")) != F.col("i"))
    assert back.count() == 0


def test_append_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS wide_table")
    spark.sql("CREATE TABLE wide_table (id bigint, more string, name string) USING parquet")
    publish.append(spark.createDataFrame([("x", 1)], "name string, id long"), "wide_table")
    assert [tuple(r) for r in spark.table("wide_table").collect()] == [(1, None, "x")]
    with pytest.raises(ConfigurationError):
        publish.append(spark.createDataFrame([(1, 2)], "id long, other long"), "wide_table")
    spark.sql("DROP TABLE wide_table")
