"""Scans, sinks, publishing and whole runs, as round trips of the tables' rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridgate.config import IntakeConfig
from gridgate.errors import DataValidationError
from gridgate.operators.contract import contract_from_ddl as contract_of_ddl
from gridgate.operators.contract import contract_of_table, table_columns
from gridgate.plans import publish
from gridgate.plans.load import run_load
from gridgate.plans.sinks import in_order, insert_statements, write_by_table, write_csv, write_dump
from gridgate.session import scratch_path
from gridgate.sources.delimited import scan_delimited
from gridgate.sources.insert_dump import dump_rows, dump_tables, read_dump, scan_insert_dump
from gridgate.sources.positions import FILE, KINDS, ORDINAL
from gridgate.sources.routing import route
from gridgate.sources.workbook import scan_workbooks
from workload.books import text_files, workbooks_of
from workload.registry import query

CHUNK = 1000
_CUSTOMER = ("SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, cast(c_nationkey AS varchar) AS c_nationkey, "
             "c_mktsegment{} FROM customer{}")
_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def _customer_lines(t, lead, first="", separator=","):
    line = F.concat_ws(separator, *([F.lit(first)] if first else []), *_COLUMNS)
    return text_files(t.customer, F.expr(f"c_custkey div {CHUNK}"), lead, line, "c_custkey")


@query(_CUSTOMER.format(f", c_custkey % {CHUNK} + 1 AS place", ""))
def scan_delimited_lines(spark, t):
    scan = scan_delimited(spark, _customer_lines(t, [" " + ", ".join(c.upper() for c in _COLUMNS)]))
    return scan.rows.select(*_COLUMNS, F.col(ORDINAL).alias("place"))


@query(_CUSTOMER.format("", ""))
def scan_tabs(spark, t):
    return scan_delimited(spark, _customer_lines(t, ["\t".join(_COLUMNS)], separator="\t"), "\t").rows.select(*_COLUMNS)


@query(_CUSTOMER.format(f", c_custkey % {CHUNK} + 3 AS place", f" WHERE c_custkey % {CHUNK} < 900"))
def scan_offsets(spark, t):
    """Two lines above the header and a column at the left are skipped, 900 rows per file are kept."""
    folder = _customer_lines(t, ["made by hand", "", ",".join(["junk", *_COLUMNS])], "x")
    scan = scan_delimited(spark, folder, skip_rows=2, skip_cols=1, max_row=900)
    return scan.rows.select(*_COLUMNS, F.col(ORDINAL).alias("place"))


@query("SELECT cast(doc_id AS varchar) AS doc_id, text, lang, source FROM documents")
def scan_quoted_newlines(spark, t):
    """Whole texts with quotes and line ends, written by the CSV sink and read back."""
    path = scratch_path(spark, "documents")
    write_csv(in_order(t.documents.select("doc_id", "text", "lang", "source"), ["doc_id"]), path)
    return scan_delimited(spark, path).rows.drop(FILE, ORDINAL)


@query("SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, cast(cast(c_acctbal AS decimal(18,2)) AS varchar) AS c_acctbal, "
       "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS note, ' a,\"b\" ' AS odd FROM customer")
def export_csv(spark, t):
    path = scratch_path(spark, "export")
    rows = t.customer.select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("note"), F.lit(' a,"b" ').alias("odd"))
    write_csv(in_order(rows, ["c_custkey"]), path)
    return scan_delimited(spark, path).rows.drop(FILE, ORDINAL)


# A word that the charset can hold, for every charset of a run.
_ENCODED = {**dict.fromkeys(("utf-8", "utf-16", "utf-16-le", "utf-16-be", "cp1251", "cp866", "koi8-r", "koi8-u", "iso-8859-5"), "Клиент"),
            "ascii": "client", "latin1": "Käufer", "cp1252": "Käufer", **dict.fromkeys(("gbk", "big5", "shift_jis", "euc-jp", "euc-kr"), "客")}
_ENCODED_SQL = ", ".join(f"('{encoding}', '{word}')" for encoding, word in _ENCODED.items())


@query(f"SELECT encoding, cast(c_custkey AS varchar) AS c_custkey, word || ' ' || c_custkey AS title "
       f"FROM customer CROSS JOIN (VALUES {_ENCODED_SQL}) AS e(encoding, word)")
def scan_encodings(spark, t):
    frames = []
    for encoding, word in _ENCODED.items():
        path = scratch_path(spark, "encoded")
        rows = t.customer.select("c_custkey", F.concat(F.lit(word + " "), "c_custkey").alias("title"))
        write_csv(in_order(rows, ["c_custkey"]), path, encoding=encoding)
        scan = scan_delimited(spark, path, encoding=encoding)
        frames.append(scan.rows.select(F.lit(encoding).alias("encoding"), "c_custkey", "title"))
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame)
    return united


@query("""SELECT o_orderkey // 500 AS batch, 'INSERT INTO s.orders (o_orderkey, o_orderstatus, price, note)' || chr(10) || chr(9) || 'VALUES '
  || string_agg('(' || o_orderkey || ', ' || chr(39) || o_orderstatus || chr(39) || ', ' || cast(o_totalprice AS decimal(18,2)) || ', '
  || CASE WHEN o_orderkey % 4 = 0 THEN 'NULL' ELSE chr(39) || 'it' || chr(39) || chr(39) || 's ' || o_orderpriority || chr(39) END || ')',
  ',' || chr(10) || chr(9) || chr(9) ORDER BY o_orderkey) || ';' AS statement FROM orders GROUP BY 1""")
def render_insert_dump(spark, t):
    return _order_statements(t)


def _dump_columns(t):
    return t.orders.select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("it's "), "o_orderpriority")).alias("note"))


def _order_statements(t):
    rows = _dump_columns(t)
    return insert_statements(rows, rows.columns, "s.orders", "gp", F.col("o_orderkey"), 500)


@query("""SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus, cast(cast(o_totalprice AS decimal(18,2)) AS varchar) AS price,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'it' || chr(39) || 's ' || o_orderpriority END AS note FROM orders""")
def scan_insert_dump_rows(spark, t):
    path = scratch_path(spark, "dump")
    write_dump(_order_statements(t), path, ["batch"])
    return scan_insert_dump(spark, path, "s.orders").rows.drop(FILE, ORDINAL, KINDS)


@query("""SELECT cast(o_orderkey AS varchar) AS o_orderkey,
  repeat('f(', cast(o_orderkey % 50 AS int)) || o_orderkey || ', ' || chr(39) || ')' || chr(39) || repeat(')', cast(o_orderkey % 50 AS int)) AS nest,
  CASE WHEN o_orderkey % 3 = 0 THEN 'a), (b' END AS note FROM orders WHERE o_orderkey % 50 > 0""")
def scan_nested_tuples(spark, t):
    """Calls nested up to 49 deep inside tuples, parentheses in texts, clauses behind tuples."""
    path, quote, deep = scratch_path(spark, "dump"), F.lit("'"), (F.col("o_orderkey") % 50).cast("int")
    nest = F.concat(F.repeat(F.lit("f("), deep), F.col("o_orderkey"), F.lit(", "), quote, F.lit(")"), quote, F.repeat(F.lit(")"), deep))
    note = F.when(F.col("o_orderkey") % 3 == 0, F.concat(quote, F.lit("a), (b"), quote)).otherwise(F.lit("null"))
    clause = F.when(F.col("o_orderkey") % 2 == 0, F.lit(" ON CONFLICT (o_orderkey) DO NOTHING")).otherwise(F.lit(""))
    write_dump(t.orders.filter(deep > 0).select(F.concat(
        F.lit("INSERT INTO s.orders (o_orderkey, nest, note) VALUES ("), F.col("o_orderkey"), F.lit(", "), nest, F.lit(", "), note, F.lit(")"),
        clause, F.lit(";")).alias("statement")), path)
    return scan_insert_dump(spark, path, "s.orders").rows.drop(FILE, ORDINAL, KINDS)


_LINE_DUMP = {"l_orderkey": "l_orderkey", "l_tax": "l_tax", "l_flag": "if(l_linenumber > 3, true, false)", "l_comment": "l_linestatus",
              "l_mixed": "if(l_linenumber > 3, l_linestatus, null)", "l_none": "cast(null as string)"}


def _line_dump(spark, t):
    """A dump of line items: whole and fractional numbers, booleans, texts, NULLs."""
    path = scratch_path(spark, "lines") + "/in.sql"
    rows = t.lineitem.selectExpr(*[f"{sql} as {name}" for name, sql in _LINE_DUMP.items()])
    write_dump(insert_statements(rows, list(_LINE_DUMP), "s.lines", "gp", F.monotonically_increasing_id(), 200), path, ["batch"])
    return path


@query("""SELECT col_name, kind, count(*) AS cells FROM (SELECT unnest(['l_orderkey', 'l_tax', 'l_flag', 'l_comment', 'l_mixed']) AS col_name,
  unnest(['int', CASE WHEN l_tax IS NOT NULL THEN 'float' END, 'bool', CASE WHEN l_linestatus IS NOT NULL THEN 'str' END,
          CASE WHEN l_linenumber > 3 AND l_linestatus IS NOT NULL THEN 'str' END]) AS kind FROM lineitem) WHERE kind IS NOT NULL GROUP BY 1, 2""")
def scan_dump_kinds(spark, t):
    """What the cells of a dump are, counted by column."""
    scan = scan_insert_dump(spark, _line_dump(spark, t))
    named = F.arrays_zip(F.array(*[F.lit(c) for c in scan.columns]).alias("col_name"), F.col(KINDS).alias("kind"))
    return scan.rows.select(F.explode(named).alias("x")).select(F.col("x")["col_name"].alias("col_name"), F.col("x")["kind"].alias("kind")).filter(
        "kind is not null").groupBy("col_name", "kind").agg(F.count("*").alias("cells"))


@query("""SELECT unnest(['l_orderkey', 'l_tax', 'l_flag', 'l_comment', 'l_mixed', 'l_none']) AS col_name,
  unnest([CASE WHEN n > 0 THEN 'bigint' ELSE 'text' END, CASE WHEN taxes > 0 THEN 'decimal(18,6)' ELSE 'text' END,
          CASE WHEN n > 0 THEN 'boolean' ELSE 'text' END, 'text', 'text', 'text']) AS type_text, n AS rows_written
  FROM (SELECT count(*) AS n, count(l_tax) AS taxes FROM lineitem)""")
def infer_run_types(spark, t):
    """The contract that a run infers from a dump, and the rows that it publishes under it."""
    run = run_load(spark, IntakeConfig(_line_dump(spark, t), error_mode="coerce", policy="bd", output_dir=scratch_path(spark, "out")))
    types = F.explode(F.create_map(*[F.lit(x) for pair in run.contract.types().items() for x in pair])).alias("col_name", "type_text")
    return run.metrics.agg(F.sum("rows_written").alias("rows_written")).select(types, "rows_written")


@query("""SELECT '(' || o_orderkey || ', ' || chr(39) || o_orderstatus || chr(39) || ', ' || cast(o_totalprice AS decimal(18,2)) || ', '
  || CASE WHEN o_orderkey % 4 = 0 THEN 'NULL' ELSE chr(39) || 'it' || chr(39) || chr(39) || 's ' || o_orderpriority || chr(39) END || ')' AS tuple
  FROM orders""")
def run_dump_to_dump(spark, t):
    """A dump through an unchecked run into a dump: numbers stay bare."""
    path = scratch_path(spark, "dump") + "/in.sql"
    write_dump(_order_statements(t), path, ["batch"])
    run = run_load(spark, IntakeConfig(path, output_dir=scratch_path(spark, "out")))
    return spark.read.text(run.output).select(F.regexp_extract("value", r"^\t(?:VALUES |\t)(\(.*\))[,;]$", 1).alias("tuple")).filter("tuple != ''")


@query("SELECT row_number() OVER (ORDER BY c_custkey) AS place, cast(c_custkey AS varchar) AS c_custkey FROM customer")
def export_order(spark, t):
    """The rows of a run's files, one file after the other, stand in the order of its input."""
    inbox = scratch_path(spark, "inbox")
    write_csv(in_order(t.customer.select(*_COLUMNS), ["c_custkey"]), inbox)
    back = scan_delimited(spark, run_load(spark, IntakeConfig(inbox, export="csv", output_dir=scratch_path(spark, "out"))).output)
    sizes = back.rows.groupBy(FILE).agg(F.max(ORDINAL).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return back.rows.join(sizes.select(FILE, before.alias("before")), FILE).select(
        (F.col("before") + F.col(ORDINAL)).alias("place"), "c_custkey")


@query("SELECT cast(doc_id AS varchar) AS doc_id, nullif(text, '') AS text, source FROM documents")
def scan_dump_texts(spark, t):
    """Whole texts as escaped literals; no line end is left inside a literal."""
    path = scratch_path(spark, "dump")
    rows = t.documents.select("doc_id", "text", "source")
    write_dump(insert_statements(rows, rows.columns, "s.documents", "ch", F.col("doc_id"), 100), path, ["batch"])
    return scan_insert_dump(spark, path, dialect="ch").rows.drop(FILE, ORDINAL, KINDS)


@query("SELECT 'customer' AS table_name, count(*) AS \"rows\", sum(length(c_name))::bigint AS chars FROM customer "
       "UNION ALL SELECT 'supplier', count(*), sum(length(s_name))::bigint FROM supplier")
def split_dump_by_table(spark, t):
    path, out = scratch_path(spark, "dump"), scratch_path(spark, "tables")
    customers = t.customer.select("c_custkey", "c_name")
    suppliers = t.supplier.select("s_suppkey", "s_name")
    both = (insert_statements(customers, customers.columns, "a.customer", "gp", F.col("c_custkey"), 300)
            .unionByName(insert_statements(suppliers, suppliers.columns, "b.supplier", "gp", F.col("s_suppkey"), 300)))
    write_dump(both, path, ["batch"])
    write_by_table(dump_rows(read_dump(spark, path)), out)
    rows = spark.read.parquet(out)
    return rows.groupBy(F.col("_table").alias("table_name")).agg(
        F.count("*").alias("rows"), F.sum(F.length(F.element_at("cells", 2))).alias("chars"))


@query("SELECT 'orders' AS table_name, count(*) AS \"rows\", 'o_orderkey,o_orderstatus,price,note' AS columns FROM orders")
def dump_table_list(spark, t):
    path = scratch_path(spark, "dump")
    write_dump(_order_statements(t), path, ["batch"])
    return dump_tables(dump_rows(read_dump(spark, path))).groupBy(F.col("_table").alias("table_name")).agg(
        F.sum("rows").alias("rows"), F.min(F.array_join("columns", ",")).alias("columns"))


@query(_CUSTOMER.format(f", cast(c_custkey // {CHUNK} AS varchar) AS book, c_custkey % {CHUNK} + 2 AS place", ""))
def scan_workbook_rows(spark, t):
    rows = t.customer.select(F.expr(f"c_custkey div {CHUNK}").alias("chunk"), *_COLUMNS)
    scan = scan_workbooks(spark, workbooks_of(rows, "chunk", _COLUMNS, "c_custkey"), "sales", skip_rows=1, columns=_COLUMNS)
    return scan.rows.select(*_COLUMNS, F.regexp_extract(FILE, r"(\d+)", 1).alias("book"), F.col(ORDINAL).alias("place"))


_SUFFIX = "['csv', 'XLSX', 'sql', 'pdf', 'tsv', 'txt', 'xlsm']"


@query(f"""SELECT path, CASE i WHEN 0 THEN 'delimited' WHEN 1 THEN 'workbook' WHEN 2 THEN 'dump' WHEN 4 THEN 'delimited' WHEN 5 THEN 'dump'
  WHEN 6 THEN 'workbook' END AS format, CASE WHEN i = 3 THEN 'unsupported suffix' END AS reason
FROM (SELECT page_id % 7 AS i, url || '/in.' || {_SUFFIX}[page_id % 7 + 1] AS path FROM pages)""")
def route_files(spark, t):
    return route(t.pages.selectExpr(f"concat(url, '/in.', array{_SUFFIX.replace('[', '(').replace(']', ')')}[page_id % 7]) as path"))


# ------------------------------------------------------------------ publishing

def _database(spark) -> str:
    name = f"gridgate_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


_ORDER_DDL = ("create table t (load_no smallint, o_orderkey bigint, o_orderstatus char(1), price decimal(18,2), note varchar(40), "
              "urgent boolean, ordered date)")
_ORDER_KINDS = "smallint,bigint,char(1),decimal(18,2),varchar(40),boolean,date"
_DECLARED = ("o_orderkey, o_orderstatus, cast(o_totalprice AS decimal(18,2)) AS price, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS note, "
             f"o_orderkey % 2 = 0 AS urgent, cast(o_orderdate AS date) AS ordered, '{_ORDER_KINDS}' AS kinds FROM orders")


def _declared_orders(t, number):
    """Orders as text cells, as an unchecked run hands them on."""
    return t.orders.selectExpr(
        f"'{number}' as load_no", "cast(o_orderkey as string) as o_orderkey", "o_orderstatus", "cast(cast(o_totalprice as decimal(18,2)) as string) as price",
        "if(o_orderkey % 4 = 0, null, o_orderpriority) as note", "if(o_orderkey % 2 = 0, 'on', 'F') as urgent", "date_format(o_orderdate, 'yyyy-MM-dd') as ordered")


def _with_kinds(spark, table):
    kinds = ",".join(kind for _, kind in table_columns(spark, table))
    return spark.table(table).withColumn("kinds", F.lit(kinds)).withColumn("load_no", F.col("load_no").cast("int"))


@query(f"SELECT unnest([1, 2]) AS load_no, {_DECLARED}")
def publish_append(spark, t):
    """Two loads of text cells into a table whose types come from DDL."""
    table, contract = f"{_database(spark)}.orders", contract_of_ddl(spark, _ORDER_DDL, "gp")
    for number in (1, 2):
        publish.append(_declared_orders(t, number), table, contract=contract)
    return _with_kinds(spark, table)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def publish_replace(spark, t):
    table = f"{_database(spark)}.orders"
    publish.append(t.orders.select("o_orderkey", F.lit("old").alias("o_orderstatus")), table)
    publish.replace(t.orders.select("o_orderkey", "o_orderstatus"), table)
    return spark.table(table)


@query(f"SELECT 'new' AS kept_in, 2 AS load_no, {_DECLARED} UNION ALL SELECT 'backup', 1, {_DECLARED}")
def publish_with_backup(spark, t):
    table, contract = f"{_database(spark)}.orders", contract_of_ddl(spark, _ORDER_DDL, "gp")
    publish.append(_declared_orders(t, 1), table, contract=contract)
    backup = publish.via_backup(_declared_orders(t, 2), table, contract=contract)
    return _with_kinds(spark, table).withColumn("kept_in", F.lit("new")).unionByName(
        _with_kinds(spark, backup).withColumn("kept_in", F.lit("backup")))


@query("SELECT 'o_orderkey' AS col_name, 'bigint' AS type_text, 0::bigint AS free FROM orders UNION "
       "SELECT 'price', 'decimal(18,2)', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders")
def contract_from_catalog(spark, t):
    table = f"{_database(spark)}.orders"
    publish.append(_dump_columns(t).select("o_orderkey", "price"), table)
    rows = contract_of_table(spark, table, "gp").frame(spark, table)
    free = spark.table(table).agg(F.count_if(F.col("price").isNull()).alias("price"),
                                  F.count_if(F.col("o_orderkey").isNull()).alias("o_orderkey")).unpivot(
        [], ["price", "o_orderkey"], "col_name", "free")
    return rows.join(free, "col_name").select("col_name", "type_text", "free")


# ----------------------------------------------------------------------- runs

_RUN_TYPES = {"c_custkey": "integer", "c_name": "varchar(18)", "c_nationkey": "smallint", "c_mktsegment": "varchar(9)"}


@query(_CUSTOMER.format("", "").replace(
    ", c_mktsegment FROM", ", CASE WHEN length(c_mktsegment) <= 9 THEN c_mktsegment END AS c_mktsegment FROM"))
def load_run(spark, t):
    """Text files to a checked CSV export in coerce mode, read back."""
    outcome = run_load(spark, IntakeConfig(
        _inbox(spark, t), "gp", "csv", "coerce", dtypes=_RUN_TYPES, output_dir=scratch_path(spark, "out"), timestamp="load_dttm",
        source_name_column=True))
    return scan_delimited(spark, outcome.output).rows.select(*_COLUMNS)


def _inbox(spark, t):
    path = scratch_path(spark, "inbox")
    write_csv(in_order(t.customer.select(*_COLUMNS), ["c_custkey"]), path)
    return path


@query("""SELECT unnest(['ignore', 'coerce', 'raise', 'verify']) AS error_mode, unnest([true, true, false, false]) AS published,
  (SELECT count(*) FROM customer) AS rows_read,
  unnest([0, bad, bad, bad]) AS errors FROM (SELECT count(*) FILTER (WHERE length(c_mktsegment) > 9) AS bad FROM customer)""")
def error_modes(spark, t):
    """What each mode publishes, how many rows it read and how many errors it saw."""
    inbox, counts = _inbox(spark, t), None
    for mode in ("ignore", "coerce", "raise", "verify"):
        config = IntakeConfig(inbox, "gp", "sql", mode, dtypes=_RUN_TYPES, output_dir=scratch_path(spark, "out"))
        published = True
        try:
            outcome = run_load(spark, config)
        except DataValidationError as error:
            outcome, published = error.outcome, False
        label = [F.lit(mode).alias("error_mode"), F.lit(published).alias("published")]
        none = F.lit(0).cast("bigint")
        found = outcome.metrics.select(*label, (F.col("rows_written") + F.col("rows_skipped")).alias("rows_read"),
                                       none.alias("errors"))
        if outcome.verdicts is not None:
            found = found.union(outcome.verdicts.select(*label, none, "errors"))
        counts = found if counts is None else counts.union(found)
    return counts.groupBy("error_mode", "published").agg(
        F.sum("rows_read").alias("rows_read"), F.sum("errors").alias("errors"))
