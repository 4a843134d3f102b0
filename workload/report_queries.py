"""Violations and everything derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridgate.operators import reports
from gridgate.operators.contract import Contract
from gridgate.operators.validate import FAULTS, apply_contract, violations
from gridgate.session import spread, staged
from workload.registry import query
from workload.row_queries import ORDER_COLUMNS, checked_orders

LINE_TYPES = {"l_orderkey": "smallint", "l_partkey": "integer", "l_quantity": "decimal(3,1)",
              "l_extendedprice": "decimal(6,2)", "l_discount": "decimal(3,1)", "l_tax": "real",
              "l_returnflag": "char(1)", "l_linestatus": "varchar(1)", "l_shipdate": "date"}
LINE_COLUMNS = list(LINE_TYPES)


def checked_lines(t):
    """Line items as a text sheet per line status, checked against a contract that is too tight."""
    texts = {"l_quantity": "cast(l_quantity as string)",
             "l_extendedprice": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
             "l_shipdate": "date_format(l_shipdate, 'yyyy-MM-dd')"}
    raw = spread(t.lineitem).select(F.col("l_linestatus").alias("_file"), F.col("l_linenumber").alias("_line"), *[
        F.expr(texts.get(c, f"cast({c} as string)")).alias(c) for c in LINE_COLUMNS])
    contract = Contract.of(LINE_TYPES, "gp")
    return apply_contract(raw, contract, LINE_COLUMNS), contract


def line_violations(t):
    checked, contract = checked_lines(t)
    return violations(checked, contract, LINE_COLUMNS, ["_file"], "_line")


@query("""SELECT CASE WHEN l_orderkey <= 32767 THEN l_orderkey END AS l_orderkey, l_partkey,
  cast(cast(l_quantity AS decimal(3,1)) AS varchar) AS l_quantity,
  CASE WHEN l_extendedprice < 10000 THEN cast(cast(l_extendedprice AS decimal(18,2)) AS varchar) END AS l_extendedprice,
  CASE WHEN l_discount IN (0.0, 0.1) THEN cast(cast(l_discount AS decimal(3,1)) AS varchar) END AS l_discount,
  l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
  l_orderkey > 32767 OR l_extendedprice >= 10000 OR l_discount NOT IN (0.0, 0.1) AS broken FROM lineitem""")
def coerce_lineitem(spark, t):
    """Every line item, its rejected cells as NULL."""
    checked, _ = checked_lines(t)
    return checked.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"), F.col("l_partkey").cast("bigint").alias("l_partkey"),
        *[F.col(c).cast("string").alias(c) for c in LINE_COLUMNS[2:] if c != "l_tax"],
        F.col(FAULTS).isNotNull().alias("broken"))


@query("""WITH v AS (SELECT l_linestatus AS file,
    unnest([CASE WHEN l_orderkey > 32767 THEN 0 END,
            CASE WHEN length(cast(l_extendedprice AS varchar)) - position('.' IN cast(l_extendedprice AS varchar)) < 99
                  AND l_extendedprice >= 10000 THEN 3 END,
            CASE WHEN l_discount NOT IN (0.0, 0.1) THEN 4 END]) AS col_idx FROM lineitem)
SELECT file, cast(col_idx AS int) AS col_idx, chr(cast(65 + col_idx AS int)) AS col_letter,
  CASE col_idx WHEN 0 THEN 'l_orderkey' WHEN 3 THEN 'l_extendedprice' ELSE 'l_discount' END AS col_name,
  CASE col_idx WHEN 0 THEN 'smallint' WHEN 3 THEN 'decimal(6,2)' ELSE 'decimal(3,1)' END AS expected_type,
  count(*) AS cells
FROM v WHERE col_idx IS NOT NULL GROUP BY ALL""")
def violation_summary(spark, t):
    return reports.summary(line_violations(t), ["_file"]).withColumnRenamed("_file", "file").drop("severity")


EVENT_TYPES = {"user_id": "smallint", "event_type": "varchar(5)", "value": "decimal(4,2)"}
EVENT_COLUMNS = list(EVENT_TYPES)


def event_violations(t, file="'events'", keys=(), user="user_id"):
    """Events as one text sheet in key order; the sheet row is event_id + 2."""
    raw = spread(t.events).selectExpr(
        "event_id", f"{file} as _file", f"cast({user} as string) as user_id", "event_type",
        "cast(cast(value as decimal(18,2)) as string) as value")
    contract = Contract.of(EVENT_TYPES, "gp", keys)
    checked = apply_contract(raw, contract, EVENT_COLUMNS)
    return violations(checked, contract, EVENT_COLUMNS, ["_file"], "event_id + 2")


_EVENT_FAULTS = """SELECT event_id + 2 AS r, event_type, user_id, value,
  unnest([CASE WHEN user_id > 32767 THEN 'user_id' END, CASE WHEN length(event_type) > 5 THEN 'event_type' END,
          CASE WHEN value >= 100 THEN 'value' END]) AS col_name FROM events"""


@query(f"""WITH f AS (SELECT col_name, r FROM ({_EVENT_FAULTS}) WHERE col_name IS NOT NULL),
g AS (SELECT col_name, r, r - row_number() OVER (PARTITION BY col_name ORDER BY r) AS island FROM f),
i AS (SELECT col_name, island, min(r) AS a, max(r) AS z FROM g GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY col_name ORDER BY a) AS place FROM i)
SELECT col_name, sum(z - a + 1)::bigint AS n_rows, count(*) AS n_ranges,
  string_agg(CASE WHEN a = z THEN cast(a AS varchar) ELSE a || '-' || z END, ', ' ORDER BY a)
    FILTER (WHERE place <= 10) AS ranges,
  coalesce(sum(z - a + 1) FILTER (WHERE place > 10), 0)::bigint AS hidden_rows
FROM n GROUP BY col_name""")
def violation_ranges(spark, t):
    return reports.row_ranges(event_violations(t), ["col_name"], dash="-")


@query(f"""SELECT event_type AS file, col_name, sample, r AS "row", shown AS value FROM
  (SELECT *, row_number() OVER (PARTITION BY event_type, col_name ORDER BY r) AS sample,
     CASE col_name WHEN 'value' THEN cast(cast(value AS decimal(18,2)) AS varchar) WHEN 'user_id'
       THEN cast(user_id AS varchar) ELSE event_type END AS shown
   FROM ({_EVENT_FAULTS}) WHERE col_name IS NOT NULL) WHERE sample <= 3""")
def violation_samples(spark, t):
    found = reports.samples(event_violations(t, "event_type"), ["_file", "col_name"], values=True)
    return found.select(F.col("_file").alias("file"), "col_name", F.col("sample").cast("bigint").alias("sample"),
                        "row", "value")


_ORDER_FAULTS = """SELECT o_orderkey, o_orderstatus AS file, unnest([
  CASE WHEN o_orderkey > 32767 THEN {'i': 0, 'name': 'o_orderkey', 'type': 'smallint', 'code': 'out_of_range',
    'message': 'value ' || o_orderkey || ' out of range [-32768, 32767]', 'value': cast(o_orderkey AS varchar)} END,
  CASE WHEN o_totalprice >= 100000 THEN {'i': 3, 'name': 'o_totalprice', 'type': 'decimal(7,2)',
    'code': 'precision_exceeded', 'message': 'integer digits (6) exceed 5 (precision=7, scale=2)',
    'value': cast(cast(o_totalprice AS decimal(18,2)) AS varchar)} END,
  CASE WHEN length(o_orderpriority) > 8 THEN {'i': 5, 'name': 'o_orderpriority', 'type': 'varchar(8)',
    'code': 'too_long', 'message': 'length ' || length(o_orderpriority) || ' exceeds maximum 8',
    'value': o_orderpriority} END]) AS f FROM orders"""


def order_violations(t):
    checked, contract = checked_orders(t)
    return violations(checked, contract, ORDER_COLUMNS, ["_file"], "_key + 2")


@query(f"""SELECT file, o_orderkey + 2 AS "row", cast(f.i AS int) AS col_idx, chr(cast(65 + f.i AS int)) AS col_letter,
  f.name AS col_name, chr(cast(65 + f.i AS int)) || (o_orderkey + 2) AS cell, f.type AS expected_type,
  'error' AS severity, f.code AS code, f.message AS message, f.value AS value
FROM ({_ORDER_FAULTS}) WHERE f IS NOT NULL""")
def violations_long(spark, t):
    return order_violations(t).withColumnRenamed("_file", "file")


@query(f"""SELECT dense_rank() OVER (ORDER BY f.message) AS message_no, f.message AS message,
  chr(cast(65 + f.i AS int)) || (o_orderkey + 2) AS cell, f.value AS value
FROM ({_ORDER_FAULTS}) WHERE f IS NOT NULL""")
def violations_by_message(spark, t):
    return reports.by_message(staged(order_violations(t), "violations")).select("message_no", "message", "cell", "value")


@query("""SELECT source AS file, sum((length(text) > 4000)::int + (length(source) > 4)::int)::bigint AS errors,
  0::bigint AS warnings, (max((length(text) > 4000)::int) + max((length(source) > 4)::int))::bigint AS error_columns,
  0::bigint AS warning_columns, sum((length(text) > 4000)::int + (length(source) > 4)::int) = 0 AS is_valid
FROM documents GROUP BY source""")
def file_verdicts(spark, t):
    columns = ["text", "lang", "source"]
    contract = Contract.of({"text": "varchar(4000)", "lang": "char(2)", "source": "varchar(4)"}, "gp")
    docs = t.documents.select("doc_id", F.col("source").alias("_file"), *columns)
    found = violations(apply_contract(docs, contract, columns), contract, columns, ["_file"], "doc_id + 2")
    return reports.verdicts(found, ["_file"], docs).withColumnRenamed("_file", "file")


_USER = "if(event_id % 11 = 0, null, user_id)"


@query("""SELECT event_type AS file, event_id + 2 AS "row", 'A' || (event_id + 2) AS cell, 'user_id' AS col_name,
  'key column is NULL' AS message FROM events WHERE event_id % 11 = 0""")
def key_null_alerts(spark, t):
    found = event_violations(t, "event_type", ["user_id"], _USER).filter("severity = 'warning'")
    return found.select(F.col("_file").alias("file"), "row", "cell", "col_name", "message")


@query("""SELECT event_type AS file, unnest(['user_id', 'value']) AS key_column,
  unnest([bool_or(event_id % 11 = 0), bool_or(value IS NULL)]) AS has_null FROM events GROUP BY event_type""")
def key_null_flags(spark, t):
    rows = t.events.selectExpr("event_type as file", f"{_USER} as user_id", "value")
    return reports.key_null_flags(rows, ["user_id", "value"], ["file"])


@query("""SELECT event_type AS file, count(*) FILTER (WHERE value >= 1) AS rows_written,
  count(*) FILTER (WHERE value < 1) AS rows_skipped FROM events GROUP BY event_type""")
def load_metrics(spark, t):
    rows = t.events.select(F.col("event_type").alias("file"), "value")
    return reports.load_metrics(rows, ["file"], F.col("value") < 1)


_SECTIONS = f"""f AS (SELECT file, f.i AS i, f.name AS name, f.type AS type, o_orderkey + 2 AS r, f.value AS value
    FROM ({_ORDER_FAULTS}) WHERE f IS NOT NULL),
g AS (SELECT *, r - row_number() OVER (PARTITION BY file, i ORDER BY r) AS island,
    row_number() OVER (PARTITION BY file, i ORDER BY r) AS sample FROM f),
s AS (SELECT file, i, string_agg('"' || chr(39) || value || chr(39) || '" (' || chr(cast(65 + i AS int)) || r || ')',
    ',  ' ORDER BY r) AS samples FROM g WHERE sample <= 3 GROUP BY ALL),
n AS (SELECT file, i, name, type, min(r) AS a, max(r) AS z, row_number() OVER (PARTITION BY file, i ORDER BY min(r)) AS place
    FROM g GROUP BY file, i, name, type, island),
c AS (SELECT file, i, name, type, sum(z - a + 1)::bigint AS cells,
    string_agg(CASE WHEN a = z THEN cast(a AS varchar) ELSE a || '–' || z END, ', ' ORDER BY a)
      FILTER (WHERE place <= 10) AS ranges,
    coalesce(sum(z - a + 1) FILTER (WHERE place > 10), 0)::bigint AS hidden FROM n GROUP BY ALL),
l AS (SELECT *, name || ' (' || chr(cast(65 + i AS int)) || ')' AS label,
    ranges || CASE WHEN hidden > 0 THEN ' … and ' || hidden || ' more rows' ELSE '' END AS rows_text FROM c)"""


@query(f"""WITH {_SECTIONS}
SELECT file, false AS is_valid, '=== Validation Report: orders ' || file || ' ===' || chr(10) ||
  'Generated: 2024-05-06 07:08:09' || chr(10) || chr(10) || 'Result: FAILED — ' || sum(cells)::bigint || ' error(s) in ' || count(*)
  || ' column(s)' || chr(10) || chr(10) || string_agg('[' || type || ']  column ' || label || '  (' || cells || ' error(s))'
  || chr(10) || '  Rows: ' || rows_text || chr(10) || '  Sample values: ' || samples || chr(10), chr(10) ORDER BY i) AS report
FROM l JOIN s USING (file, i) GROUP BY file""")
def report_text(spark, t):
    found = staged(order_violations(t), "violations")
    title = F.concat(F.lit("orders "), F.col("_file"))
    return reports.report_text(found, ["_file"], title, "2024-05-06 07:08:09", values=True).withColumnRenamed(
        "_file", "file")


@query(f"""WITH {_SECTIONS}
SELECT file, 'error' AS severity, cast(i AS int) AS col_idx,
  '[' || type || '] column ' || label || ' — ' || cells || ' cell(s), rows: ' || rows_text AS line FROM l""")
def summary_lines(spark, t):
    found = staged(order_violations(t), "violations")
    return reports.summary_lines(found, ["_file"]).withColumnRenamed("_file", "file")
