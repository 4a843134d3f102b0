"""Row projections, cell addresses, literals."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridgate.functions.cells import address_letters, address_row, cell_address
from gridgate.functions.literals import literal
from gridgate.operators.contract import ColumnSpec, Contract
from gridgate.operators.project import (
    add_lineage, clean_cells, drop_blank_rows, insert_fixed, is_blank_row, rename_by_position)
from gridgate.operators.validate import FAULTS, apply_contract
from gridgate.session import spread
from workload.registry import query

_PADDED = ("CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN '  ' || p_name || '\t' "
           "WHEN 2 THEN ' ' || p_name ELSE '  \n' END")


def _padded(part):
    return part.select("p_partkey", F.expr(
        "case p_partkey % 4 when 0 then p_name when 1 then concat('  ', p_name, '\t') "
        "when 2 then concat(' ', p_name) else '  \n' end").alias("p_name"))


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN '' ELSE p_name END AS p_name FROM "
       f"(SELECT p_partkey, p_name, {_PADDED} AS padded FROM part)")
def strip_strings(spark, t):
    return clean_cells(_padded(t.part), ["p_name"], strip=True, blanks=False)


@query(f"SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE {_PADDED} END AS p_name FROM part")
def blank_to_null(spark, t):
    return clean_cells(_padded(t.part), ["p_name"])


_BLANKED = "CASE WHEN (conv_id + turn) % 3 = 0 THEN NULL ELSE {} END AS {}"


def _with_blank_rows(t):
    return t.conversations.select("conv_id", "turn", *[
        F.when((F.col("conv_id") + F.col("turn")) % 3 != 0, F.col(c)).alias(c) for c in ("role", "text")])


@query("SELECT conv_id, turn, role, text FROM conversations WHERE (conv_id + turn) % 3 <> 0")
def blank_row_drop(spark, t):
    return drop_blank_rows(_with_blank_rows(t), ["role", "text"])


_RAGGED = "string_split(text || ',' || source || ',' || lang, ',')"


@query(f"SELECT doc_id, nullif(r[1], '') AS a, nullif(r[2], '') AS b, nullif(r[3], '') AS c, nullif(r[4], '') AS d "
       f"FROM (SELECT doc_id, string_split(replace(replace(replace(text, chr(34), ' '), chr(10), ' '), chr(13), ' ') "
       f"|| ',' || source || ',' || lang, ',') AS r FROM documents)")
def align_ragged(spark, t):
    line = F.concat_ws(",", F.translate("text", '"\n\r', "   "), "source", "lang")
    cells = F.from_csv(line, "a string, b string, c string, d string",
                       {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    return t.documents.select("doc_id", cells.alias("cells")).select("doc_id", "cells.*")


@query("""WITH c AS (SELECT event_id, event_id + 1 AS r, event_id * 7 AS i FROM events),
a AS (SELECT event_id, r, CASE WHEN i < 26 THEN chr(cast(65 + i AS int))
  WHEN i < 702 THEN chr(cast(65 + (i - 26) // 26 AS int)) || chr(cast(65 + (i - 26) % 26 AS int))
  WHEN i < 18278 THEN chr(cast(65 + (i - 702) // 676 AS int)) || chr(cast(65 + ((i - 702) // 26) % 26 AS int))
    || chr(cast(65 + (i - 702) % 26 AS int))
  WHEN i < 475254 THEN chr(cast(65 + (i - 18278) // 17576 AS int)) || chr(cast(65 + ((i - 18278) // 676) % 26 AS int))
    || chr(cast(65 + ((i - 18278) // 26) % 26 AS int)) || chr(cast(65 + (i - 18278) % 26 AS int))
  ELSE chr(cast(65 + (i - 475254) // 456976 AS int)) || chr(cast(65 + ((i - 475254) // 17576) % 26 AS int))
    || chr(cast(65 + ((i - 475254) // 676) % 26 AS int)) || chr(cast(65 + ((i - 475254) // 26) % 26 AS int))
    || chr(cast(65 + (i - 475254) % 26 AS int)) END AS letters FROM c)
SELECT event_id, letters || cast(r AS varchar) AS cell, letters, r AS row_number FROM a""")
def cell_address_of_events(spark, t):
    cell = cell_address(F.col("event_id") + 1, F.col("event_id") * 7)
    return t.events.select("event_id", cell.alias("cell")).select(
        "event_id", "cell", address_letters(F.col("cell")).alias("letters"),
        address_row(F.col("cell")).alias("row_number"))


@query("SELECT c_custkey, c_name, '2024-05-06 07:08:09' AS load_dttm, 'customer.parquet' AS wf_load_idn FROM customer")
def enrich_lineage(spark, t):
    rows = t.customer.select("c_custkey", "c_name", F.col("_metadata.file_name").alias("_name"))
    stamp = F.lit("2024-05-06 07:08:09").cast("timestamp")
    return add_lineage(rows, ["c_custkey", "c_name"], "load_dttm", stamp, F.col("_name")).drop("_name")


@query("SELECT s_suppkey AS id, 'sheet 7' AS origin, s_name AS title, '' AS note, s_acctbal AS balance FROM supplier")
def template_project(spark, t):
    shown = ["Код", "Имя", "Остаток"]
    sheet = t.supplier.select("s_suppkey", "s_name", "s_acctbal").toDF(*shown)
    contract = Contract((
        ColumnSpec("id", "bigint", True, "Код"), ColumnSpec("origin", "text", fixed="sheet 7"),
        ColumnSpec("title", "text", display="Имя"), ColumnSpec("note", "text", fixed=""),
        ColumnSpec("balance", "double precision", display="Остаток")))
    return insert_fixed(rename_by_position(sheet, shown, ["id", "title", "balance"]), contract)


ORDER_TYPES = {"o_orderkey": "smallint", "o_custkey": "bigint", "o_orderstatus": "char(1)",
               "o_totalprice": "decimal(7,2)", "o_orderdate": "timestamp", "o_orderpriority": "varchar(8)"}
ORDER_TEXT = {
    "o_orderkey": "cast(o_orderkey as {s})", "o_custkey": "cast(o_custkey as {s})", "o_orderstatus": "o_orderstatus",
    "o_totalprice": "cast(cast(o_totalprice as decimal(18,2)) as {s})", "o_orderpriority": "o_orderpriority"}
ORDER_COLUMNS = list(ORDER_TYPES)


def raw_orders(t):
    """Orders as a text sheet; the date is written day first."""
    texts = ORDER_TEXT | {"o_orderdate": "date_format(o_orderdate, 'dd.MM.yyyy')"}
    return spread(t.orders).select(F.col("o_orderkey").alias("_key"), F.col("o_orderstatus").alias("_file"), *[
        F.expr(texts[c].format(s="string")).alias(c) for c in ORDER_COLUMNS])


def checked_orders(t):
    contract = Contract.of(ORDER_TYPES, "gp")
    return apply_contract(raw_orders(t), contract, ORDER_COLUMNS, {"day_first": True}), contract


@query("""SELECT o_orderkey AS row_key,
  CASE WHEN o_orderkey <= 32767 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_totalprice < 100000 THEN cast(cast(o_totalprice AS decimal(18,2)) AS varchar) END AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  CASE WHEN length(o_orderpriority) <= 8 THEN o_orderpriority END AS o_orderpriority,
  (o_orderkey > 32767)::int + (o_totalprice >= 100000)::int + (length(o_orderpriority) > 8)::int AS faults
FROM orders""")
def validate_coerce(spark, t):
    checked, _ = checked_orders(t)
    faults = F.coalesce(F.aggregate(FAULTS, F.lit(0), lambda n, f: n + f.isNotNull().cast("int")), F.lit(0))
    return checked.select(
        F.col("_key").alias("row_key"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_custkey",
        "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority",
        faults.alias("faults"))


_CH_SQL = "text"
for _char, _escape in (("chr(92)", "chr(92) || chr(92)"), ("chr(39)", "chr(92) || chr(39)"),
                       *[(f"chr({code})", f"chr(92) || '{letter}'") for code, letter in
                         ((8, "b"), (12, "f"), (13, "r"), (10, "n"), (9, "t"), (7, "a"), (11, "v"))]):
    _CH_SQL = f"replace({_CH_SQL}, {_char}, {_escape})"


@query(f"""SELECT doc_id, chr(39) || replace(text, chr(39), chr(39) || chr(39)) || chr(39) AS gp_text,
  chr(39) || {_CH_SQL} || chr(39) AS ch_text, cast(n_chars AS varchar) AS number_literal,
  CASE WHEN n_chars % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS gp_flag,
  CASE WHEN n_chars % 2 = 0 THEN '1' ELSE '0' END AS ch_flag,
  CASE WHEN n_chars % 3 = 0 THEN 'NULL' ELSE chr(39) || source || chr(39) END AS maybe_null,
  chr(39) || cast(n_chars AS varchar) || chr(39) AS quoted_number
FROM documents""")
def render_literals(spark, t):
    text, count, flag = T.StringType(), T.LongType(), T.BooleanType()
    even = F.col("n_chars") % 2 == 0
    return spread(t.documents).select(
        "doc_id", literal(F.col("text"), text, "gp").alias("gp_text"),
        literal(F.col("text"), text, "ch").alias("ch_text"),
        literal(F.col("n_chars"), count, "gp").alias("number_literal"),
        literal(even, flag, "gp").alias("gp_flag"), literal(even, flag, "ch").alias("ch_flag"),
        literal(F.when(F.col("n_chars") % 3 != 0, F.col("source")), text, "gp").alias("maybe_null"),
        literal(F.col("n_chars"), count, "gp", quote_all=True).alias("quoted_number"))


@query("""SELECT conv_id, count(*) AS turns,
  count(*) FILTER (WHERE (conv_id + turn) % 3 = 0) AS blank_turns FROM conversations GROUP BY conv_id""")
def blank_row_count(spark, t):
    rows = _with_blank_rows(t)
    return rows.groupBy("conv_id").agg(F.count("*").alias("turns"),
                                       F.count_if(is_blank_row(["role", "text"])).alias("blank_turns"))
