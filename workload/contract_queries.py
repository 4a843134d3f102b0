"""Contracts, headers, names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from gridgate.functions.names import CH_RESERVED, GP_RESERVED, is_reserved
from gridgate.operators import contract as contracts
from gridgate.operators import headers, template
from gridgate.operators.validate import FAULTS, apply_contract
from gridgate.sources.workbook import sheet
from gridgate.session import spread
from workload.registry import query

_TABLE_TYPES = (("o_orderkey", "bigint", "o_orderkey IS NOT NULL"), ("o_custkey", "bigint", "o_custkey IS NOT NULL"),
                ("o_orderstatus", "text", "o_orderstatus IS NOT NULL"),
                ("o_totalprice", "double precision", "o_totalprice IS NOT NULL"),
                ("o_orderdate", "timestamp", "o_orderdate IS NOT NULL"),
                ("o_orderpriority", "text", "o_orderpriority IS NOT NULL"))


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS col_name, '{kind}' AS type_text, count(*) FILTER (WHERE {filled}) AS accepted, "
    f"0::bigint AS rejected FROM orders" for name, kind, filled in _TABLE_TYPES))
def contract_from_table(spark, t):
    """Declared types of a table, and how many of its cells, as text, keep to them."""
    table = spread(t.orders)
    contract = contracts.contract_of_schema(table.schema, "gp")
    columns = [c.name for c in contract.columns]
    checked = apply_contract(table.select(*[F.col(c).cast("string").alias(c) for c in columns]), contract, columns)
    kinds = F.create_map(*[F.lit(x) for pair in contract.types().items() for x in pair])
    counts = checked.agg(*[F.count(F.col(c)).alias(c) for c in columns], F.count(FAULTS).alias("rejected"))
    return counts.unpivot(["rejected"], columns, "col_name", "accepted").select(
        "col_name", kinds[F.col("col_name")].alias("type_text"), "accepted", "rejected")


_WORDS = "string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ')"


def _turn_words(t, text="text"):
    """One header row per conversation turn: the words of the whole turn."""
    return spread(t.conversations).select(
        "conv_id", "turn", F.split(F.regexp_replace(text, r"\s+", " "), " ").alias("cells"))


@query(f"""WITH w AS (SELECT conv_id, turn % 2 AS side, unnest({_WORDS}) AS name FROM conversations),
h AS (SELECT DISTINCT conv_id, name FROM w WHERE side = 0), c AS (SELECT DISTINCT conv_id, name FROM w WHERE side = 1)
SELECT coalesce(h.conv_id, c.conv_id) AS conv_id, coalesce(h.name, c.name) AS name,
  CASE WHEN h.name IS NOT NULL AND c.name IS NOT NULL THEN 'checked' WHEN h.name IS NOT NULL THEN 'unchecked'
       ELSE 'missing' END AS coverage
FROM h FULL JOIN c ON h.conv_id = c.conv_id AND h.name = c.name""")
def contract_coverage(spark, t):
    words = _turn_words(t).select("conv_id", (F.col("turn") % 2).alias("side"), F.explode("cells").alias("name"))
    return contracts.coverage(words.filter("side = 0"), words.filter("side = 1"), ["conv_id", "name"])


_GP_DDL = ("CASE p_partkey % 8 WHEN 6 THEN '' WHEN 7 THEN 'create table t (id int' WHEN 5 THEN 'create table t' ELSE "
           "'CREATE TABLE s.t' || p_partkey || ' ( -- parts, all of them\n  id bigint not null, \"' || upper(replace(p_name, ' ', '_')) "
           "|| '\" character varying(' || p_size || ') default ''x'',\n /* money */ price numeric(' || (p_size + 10) || ', 2) null, "
           "seen timestamp without time zone, ratio double precision default ' || repeat('(', p_partkey % 40) || '1' || repeat(')', p_partkey % 40) || ', constraint pk primary key (id))\ndistributed by (id)' END")


@query("""WITH p AS (SELECT 't' || p_partkey AS table_name, p_partkey % 8 AS k, lower(replace(p_name, ' ', '_')) AS n, p_size FROM part)
SELECT table_name, 'ok' AS status, unnest([1, 2, 3, 4, 5]) AS ordinal,
  unnest(['id', n, 'price', 'seen', 'ratio']) AS col_name,
  unnest(['bigint', 'character varying(' || p_size || ')', 'numeric(' || (p_size + 10) || ', 2)',
          'timestamp without time zone', 'double precision']) AS type_text FROM p WHERE k < 5
UNION ALL SELECT table_name, CASE k WHEN 6 THEN 'empty' WHEN 7 THEN 'unbalanced parentheses' ELSE 'no parentheses' END,
  NULL, NULL, NULL FROM p WHERE k >= 5""")
def contract_from_ddl(spark, t):
    ddl = F.expr(_GP_DDL.replace("''x''", "\\'x\\'"))
    return contracts.parse_ddl(spread(t.part).select(F.concat(F.lit("t"), "p_partkey").alias("table_name"), ddl.alias("ddl")), "gp")


@query("""WITH p AS (SELECT 't' || p_partkey AS table_name, p_partkey % 3 AS k, lower(replace(p_name, ' ', '_')) AS n, p_size FROM part)
SELECT table_name, CASE WHEN k = 2 THEN 'no columns' ELSE 'ok' END AS status,
  unnest(CASE WHEN k = 2 THEN [NULL] ELSE [1, 2, 3] END) AS ordinal,
  unnest(CASE WHEN k = 2 THEN [NULL] ELSE ['id', n, 'tags'] END) AS col_name,
  unnest(CASE WHEN k = 2 THEN [NULL] ELSE ['UInt64', 'Decimal(' || (p_size + 2) || ', 2)', repeat('Array(', 30) || 'Tuple(a Int8, b String)' || repeat(')', 30)] END)
    AS type_text FROM p""")
def contract_from_ch_ddl(spark, t):
    ddl = F.expr("if(p_partkey % 3 = 2, 'CREATE TABLE t (INDEX i id TYPE minmax)', "
                 "concat('CREATE TABLE t (`id` UInt64 CODEC(ZSTD), `', replace(p_name, ' ', '_'), '` Nullable(Decimal(', p_size + 2, "
                 "', 2)) DEFAULT NULL,\n tags ', repeat('Array(', 30), 'Tuple(a Int8, b String)', repeat(')', 30), ', INDEX i id TYPE minmax) ENGINE = MergeTree ORDER BY id'))")
    return contracts.parse_ddl(spread(t.part).select(F.concat(F.lit("t"), "p_partkey").alias("table_name"), ddl.alias("ddl")), "ch")


_LINE_CELLS = {
    "l_orderkey": ("cast(l_orderkey as {s})", "int"), "l_quantity": ("cast(l_quantity as {s})", "float"),
    "l_linestatus": ("l_linestatus", "str"),
    "l_mixed": ("CASE WHEN l_linenumber > 3 THEN cast(l_orderkey as {s}) ELSE cast(l_tax as {s}) END", None),
    "l_nothing": ("cast(NULL as {s})", None)}


def _line_cells(t):
    texts = {c: sql.format(s="string") for c, (sql, _) in _LINE_CELLS.items()}
    texts["l_shipdate"] = "date_format(l_shipdate, 'yyyy-MM-dd')"
    texts["l_shiptime"] = "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')"
    texts["l_flag"] = "if(l_linenumber > 3, 'true', 'FALSE')"
    entries = ", ".join(f"named_struct('col_name', '{c}', 'cell', {sql})" for c, sql in texts.items())
    cells = spread(t.lineitem).select(F.col("l_returnflag").alias("table_name"), F.explode(F.expr(f"array({entries})")).alias("x"))
    return cells.select("table_name", "x.col_name", contracts.kind_of_text(F.col("x.cell")).alias("kind"))


def _inferred(gp):
    return f"""SELECT table_name, unnest(['l_orderkey', 'l_quantity', 'l_linestatus', 'l_mixed', 'l_nothing', 'l_shipdate',
    'l_shiptime', 'l_flag']) AS col_name, unnest([{gp[0]}, {gp[1]}, {gp[2]},
    CASE WHEN floats > 0 THEN {gp[1]} ELSE {gp[0]} END, {gp[2]}, {gp[3]}, {gp[4]}, {gp[5]}]) AS type_text
  FROM (SELECT l_returnflag AS table_name, count(*) FILTER (WHERE l_linenumber <= 3) AS floats FROM lineitem GROUP BY 1)"""


@query(_inferred(["'bigint'", "'decimal(18,6)'", "'text'", "'date'", "'timestamp'", "'boolean'"]))
def infer_types(spark, t):
    return contracts.infer_types(_line_cells(t), "gp")


@query(_inferred(["'Int64'", "'Float64'", "'String'", "'Date32'", "'DateTime'", "'Bool'"]))
def infer_types_ch(spark, t):
    return contracts.infer_types(_line_cells(t), "ch")


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS place FROM events),
k AS (SELECT event_type AS table_name, count(*) FILTER (WHERE value >= 100) > 0 AS fractions FROM s WHERE place <= 200 GROUP BY 1)
SELECT table_name, unnest(['amount', 'seen', 'props']) AS col_name,
  unnest([CASE WHEN fractions THEN 'decimal(18,6)' ELSE 'bigint' END, 'timestamp', 'text']) AS type_text FROM k""")
def infer_types_sampled(spark, t):
    """Types from the first 200 rows of every file; the sample is the feature."""
    head = contracts.head_sample(t.events, ["event_type"], "event_id")
    entries = ("array(named_struct('col_name', 'amount', 'cell', if(value >= 100, cast(value as string), cast(user_id as string))), "
               "named_struct('col_name', 'seen', 'cell', date_format(ts, 'yyyy-MM-dd HH:mm:ss')), "
               "named_struct('col_name', 'props', 'cell', props))")
    cells = head.select(F.col("event_type").alias("table_name"), F.explode(F.expr(entries)).alias("x"))
    kinds = cells.select("table_name", "x.col_name", contracts.kind_of_text(F.col("x.cell")).alias("kind"))
    return contracts.infer_types(kinds, "gp")


_CANDIDATES = """SELECT p_brand AS table_name, 'c' || p_size AS col_name, unnest([1, 2, 3]) AS priority,
  unnest([CASE WHEN p_partkey % 97 = 0 THEN 'integer' END, CASE WHEN p_partkey % 13 = 0 THEN 'text' END, 'numeric(10,2)']) AS type_text
FROM part"""


@query(f"""WITH c AS (SELECT * FROM ({_CANDIDATES}) WHERE type_text IS NOT NULL),
b AS (SELECT table_name, min(priority) AS priority FROM c GROUP BY 1)
SELECT DISTINCT table_name, col_name, type_text, priority FROM c JOIN b USING (table_name, priority)""")
def contract_resolve(spark, t):
    options = F.expr("array(named_struct('priority', 1, 'type_text', if(p_partkey % 97 = 0, 'integer', null)), "
                     "named_struct('priority', 2, 'type_text', if(p_partkey % 13 = 0, 'text', null)), "
                     "named_struct('priority', 3, 'type_text', 'numeric(10,2)'))")
    candidates = t.part.select(F.col("p_brand").alias("table_name"), F.concat(F.lit("c"), "p_size").alias("col_name"),
                               F.explode(options).alias("o")).select("table_name", "col_name", "o.*")
    return contracts.resolve(candidates.filter("type_text is not null"))


_CUSTOMER_CONTRACT = """SELECT 't' || (c_custkey // 10) AS table_name, c_custkey % 10 + 1 AS ordinal,
  CASE WHEN c_custkey % 77 = 0 THEN 'load_dttm' ELSE 'c' || c_custkey END AS col_name,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'decimal(12,2)' WHEN 'HOUSEHOLD' THEN 'bigint' ELSE 'text' END AS type_text FROM customer"""


def _customer_contract(t):
    return t.customer.selectExpr(
        "concat('t', c_custkey div 10) as table_name", "cast(c_custkey % 10 + 1 as int) as ordinal",
        "if(c_custkey % 77 = 0, 'load_dttm', concat('c', c_custkey)) as col_name",
        "case c_mktsegment when 'MACHINERY' then 'decimal(12,2)' when 'HOUSEHOLD' then 'bigint' else 'text' end as type_text")


@query(f"""SELECT table_name, '-- s.' || table_name || ' definition' || chr(10) || '-- DROP TABLE s.' || table_name || ';' || chr(10)
  || 'CREATE TABLE s.' || table_name || ' (' || chr(10) || string_agg(chr(9) || col_name || chr(9) || type_text || chr(9) || 'NULL',
  ',' || chr(10) ORDER BY ordinal) || CASE WHEN bool_or(col_name = 'load_dttm') THEN '' ELSE ',' || chr(10) || chr(9) || 'load_dttm'
  || chr(9) || 'timestamp' || chr(9) || 'NULL' END || chr(10) || ')' || chr(10) || 'DISTRIBUTED RANDOMLY;' || chr(10)
  || '-- Рекомендуется заменить RANDOMLY на явный ключ распределения' AS ddl FROM ({_CUSTOMER_CONTRACT}) GROUP BY table_name""")
def render_ddl(spark, t):
    return contracts.render_ddl(_customer_contract(t), "gp", "s", "load_dttm")


@query(f"""SELECT table_name, '-- DROP TABLE IF EXISTS s.' || table_name || ';' || chr(10) || 'CREATE TABLE s.' || table_name || chr(10)
  || '(' || chr(10) || string_agg('    `' || col_name || '` Nullable(' || CASE type_text WHEN 'text' THEN 'String' WHEN 'bigint' THEN 'Int64'
  ELSE 'Decimal(32,8)' END || ') DEFAULT NULL', ',' || chr(10) ORDER BY ordinal) || CASE WHEN bool_or(col_name = 'load_dttm') THEN ''
  ELSE ',' || chr(10) || '    `load_dttm` Nullable(DateTime()) DEFAULT NULL' END || chr(10) || ')' || chr(10) || 'ENGINE = MergeTree'
  || chr(10) || 'ORDER BY load_dttm' || chr(10) || 'SETTINGS allow_nullable_key = 1,' || chr(10)
  || '         index_granularity = 8192;' AS ddl FROM ({_CUSTOMER_CONTRACT}) GROUP BY table_name""")
def render_ch_ddl(spark, t):
    return contracts.render_ddl(contracts.translate(_customer_contract(t)), "ch", "s", "load_dttm", "load_dttm")


# Spelling, canonical gp name, canonical ch name, ch type for the gp type.
_SPELLINGS = (
    ("INT4", "integer", "string", "String"), ("int8", "bigint", "int8", "String"),
    ("double", "double precision", "float64", "Float64"), ("numeric(10,2)", "numeric(10,2)", "string", "Decimal(32,8)"),
    ("character varying(5)", "character varying(5)", "string", "String"),
    ("timestamp without time zone", "timestamp", "datetime", "DateTime64(6)"), ("bool", "boolean", "bool", "String"),
    ("jsonb", "text", "string", "String"), (" Serial ", "serial", "string", "UInt32"),
    ("text[] array", "array", "array", "String"), ("date", "date", "date", "Date32"),
    ("decimal(3,1)", "decimal(3,1)", "decimal(3,1)", "Decimal(32,8)"), ("smallint", "smallint", "int16", "Int16"))


def _spelled(t):
    names = F.array(*[F.lit(s[0]) for s in _SPELLINGS])
    return t.part.select("p_partkey", F.element_at(names, (F.col("p_partkey") % len(_SPELLINGS) + 1).cast("int")).alias("type_text"))


def _spelled_sql(*positions):
    picked = ", ".join("[" + ", ".join(f"'{s[i]}'" for s in _SPELLINGS) + f"][p_partkey % {len(_SPELLINGS)} + 1] AS {name}"
                       for i, name in positions)
    return f"SELECT p_partkey, {picked} FROM part"


@query(_spelled_sql((1, "gp_type"), (2, "ch_type")))
def type_aliases(spark, t):
    gp = contracts.canonical(_spelled(t), "gp").withColumnRenamed("type_text", "gp_type")
    return gp.join(contracts.canonical(_spelled(t), "ch").withColumnRenamed("type_text", "ch_type"), "p_partkey")


@query(_spelled_sql((3, "type_text")))
def translate_contract(spark, t):
    return contracts.translate(_spelled(t))


@query(f"""WITH w AS (SELECT conv_id, turn, unnest({_WORDS}) AS raw, generate_subscripts({_WORDS}, 1) - 1 AS pos FROM conversations),
k AS (SELECT *, CASE WHEN length(raw) % 5 = 0 THEN NULL ELSE raw END AS filled FROM w),
l AS (SELECT conv_id, turn, max(pos) FILTER (WHERE filled IS NOT NULL) AS z FROM k GROUP BY ALL)
SELECT conv_id, turn, cast(pos AS int) AS pos, lower(filled) AS name FROM k JOIN l USING (conv_id, turn) WHERE pos <= z""")
def header_normalise(spark, t):
    filled = F.transform("cells", lambda c: F.when(F.length(c) % 5 != 0, c))
    return headers.normalise(_turn_words(t).withColumn("cells", filled), ["conv_id", "turn"])


@query(f"""WITH w AS (SELECT conv_id, turn, lower(unnest({_WORDS})) AS name, generate_subscripts({_WORDS}, 1) - 1 AS pos FROM conversations),
c AS (SELECT conv_id, turn, name, count(*) AS cells, cast(min(pos) AS int) AS first_pos FROM w GROUP BY ALL)
SELECT *, CASE WHEN name = '' THEN 'empty' WHEN NOT regexp_full_match(name, '[a-z0-9_]+') THEN 'invalid_characters'
  WHEN regexp_full_match(name, '[0-9]+') THEN 'only_digits' ELSE 'duplicate' END AS fault
FROM c WHERE name = '' OR NOT regexp_full_match(name, '[a-z0-9_]+') OR regexp_full_match(name, '[0-9]+') OR cells > 1""")
def header_check(spark, t):
    names = headers.header_cells(_turn_words(t), ["conv_id", "turn"]).select("conv_id", "turn", "pos", F.lower("raw").alias("name"))
    return headers.check(names, ["conv_id", "turn"])


@query(f"""WITH w AS (SELECT conv_id, turn, unnest({_WORDS}) AS name, generate_subscripts({_WORDS}, 1) - 1 AS pos FROM conversations),
f AS (SELECT conv_id, turn // 2 AS pair, pos, name FROM w WHERE turn % 2 = 0),
e AS (SELECT conv_id, turn // 2 AS pair, pos, name FROM w WHERE turn % 2 = 1)
SELECT coalesce(f.conv_id, e.conv_id) AS conv_id, coalesce(f.pair, e.pair) AS pair, cast(coalesce(f.pos, e.pos) AS int) AS pos,
  f.name AS found_name, e.name AS expected_name
FROM f FULL JOIN e ON f.conv_id = e.conv_id AND f.pair = e.pair AND f.pos = e.pos WHERE f.name IS DISTINCT FROM e.name""")
def header_alignment(spark, t):
    words = headers.header_cells(_turn_words(t), ["conv_id", "turn"]).select(
        "conv_id", "turn", F.expr("turn div 2").alias("pair"), "pos", F.col("raw").alias("name"))
    return headers.alignment(words.filter("turn % 2 = 0"), words.filter("turn % 2 = 1"), ["conv_id", "pair"])


@query(f"""WITH w AS (SELECT conv_id, turn, unnest({_WORDS}) AS raw, generate_subscripts({_WORDS}, 1) - 1 AS pos FROM conversations),
c AS (SELECT *, trim(regexp_replace(replace(lower(raw), '-', '_'), '[^a-z0-9_]', '', 'g'), '_') AS clean FROM w),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, regexp_replace(clean, '_+', '_', 'g') ORDER BY pos) AS nth FROM c)
SELECT conv_id, turn, cast(pos AS int) AS pos, raw, regexp_replace(clean, '_+', '_', 'g')
  || CASE WHEN nth > 1 THEN '_' || (nth - 1) ELSE '' END AS col_name FROM n""")
def clean_column_names(spark, t):
    return headers.clean_names(headers.header_cells(_turn_words(t), ["conv_id", "turn"]), ["conv_id", "turn"])


def _reserved(words):
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


@query(f"""WITH w AS (SELECT lower(unnest(string_split(regexp_replace(text, '[^A-Za-z_]+', ' ', 'g'), ' '))) AS name FROM documents)
SELECT name, count(*) AS uses, name IN ({_reserved(GP_RESERVED)}) AS gp,
  name IN ({_reserved(GP_RESERVED + CH_RESERVED)}) AS ch FROM w WHERE name IN ({_reserved(GP_RESERVED + CH_RESERVED)}) GROUP BY name""")
def reserved_words(spark, t):
    words = spread(t.documents).select(F.explode(F.split(F.regexp_replace("text", "[^A-Za-z_]+", " "), " ")).alias("word"))
    name = F.lower("word").alias("name")
    return (words.select(name).filter(is_reserved(F.col("name"), "ch")).groupBy("name").agg(F.count("*").alias("uses"))
            .select("name", "uses", is_reserved(F.col("name"), "gp").alias("gp"), is_reserved(F.col("name"), "ch").alias("ch")))


# ------------------------------------------------------------------ templates

def supplier_sheets(t):
    """Sheet rows of one template workbook per supplier: configuration and one data row.

    Every ninth supplier forgets a type, every fifth ends with the end mark.
    """
    cells = lambda *texts: "array(" + ", ".join(
        f"named_struct('kind', 'str', 'text', {x})" for x in texts) + ")"
    null = "cast(null as string)"
    end = f"if(s_suppkey % 5 = 0, '{template.END_MARK}', {null})"
    rows = [
        ("klad_config", 1, cells("'start'", "'a4'")), ("klad_config", 2, cells("'name'", "'source'", "'key'")),
        ("klad_config", 3, cells("' Код '", "'table'", "'TRUE'", "'S_Suppkey'", "'BIGINT'")),
        ("klad_config", 4, cells("'Имя'", "'Table'", null, "' s_name '", "if(s_suppkey % 9 = 0, ' ', 'varchar(25)')")),
        ("klad_config", 5, cells("'Дата'", "'b1'", "'false'", "'as_of'", "'date'")),
        ("klad_config", 6, cells("'Пусто'", "'C1'", null, "'note'", "'text'")),
        ("klad_config", 7, cells(end, null)), ("klad_config", 8, cells("'x'", "'table'", null, "'late'", "'text'")),
        ("data", 1, cells("'As of'", "concat('2024-01-', lpad(s_suppkey % 28 + 1, 2, '0'))")),
        ("data", 3, cells("'Код'", "'Имя '")), ("data", 4, cells("cast(s_suppkey as string)", "s_name"))]
    listed = ", ".join(f"named_struct('sheet', '{s}', 'row_idx', {r}L, 'cells', {c})" for s, r, c in rows)
    exploded = t.supplier.select(F.concat(F.lit("book"), "s_suppkey").alias("_file"), F.explode(F.expr(f"array({listed})")).alias("r"))
    return exploded.select("_file", "r.sheet", (F.col("r.sheet") == "data").alias("active"), "r.row_idx", "r.cells",
                           F.lit(None).cast("string").alias("problem"))


@query("""SELECT 'book' || s_suppkey AS _file, unnest([1, 2, 3, 4]) AS ordinal, unnest(['Код', 'Имя', 'Дата', 'Пусто']) AS display,
  unnest(['table', 'table', 'B1', 'C1']) AS source, unnest([true, false, false, false]) AS is_key,
  unnest(['s_suppkey', 's_name', 'as_of', 'note']) AS col_name,
  unnest(['bigint', CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE 'varchar(25)' END, 'date', 'text']) AS type_text,
  unnest([NULL, NULL, '2024-01-' || lpad(cast(s_suppkey % 28 + 1 AS varchar), 2, '0'), '']) AS fixed_value,
  unnest([NULL, CASE WHEN s_suppkey % 9 = 0 THEN 'data type is empty' END, NULL, NULL]) AS problem FROM supplier""")
def template_contract(spark, t):
    return template.template_contract(supplier_sheets(t))


@query("""SELECT 'book' || s_suppkey AS _file, true AS is_template, 2::bigint AS skip_rows, 0::bigint AS mismatches,
  s_suppkey AS first_key FROM supplier""")
def template_alignment(spark, t):
    """Template flag, offset, header differences and the first key of every workbook."""
    sheets = supplier_sheets(t)
    config = template.template_contract(sheets).withColumn("problem", F.lit(None).cast("string"))
    gaps = headers.alignment(template.data_headers(sheets), template.expected_headers(config), ["_file"]).groupBy("_file").count()
    keys = sheet(sheets, "data").filter("row_idx = 4").select("_file", F.expr("try_cast(cells[0].text as bigint)").alias("first_key"))
    parts = [template.templates(sheets), template.start_rows(sheets).select("_file", F.col("skip_rows").cast("bigint").alias("skip_rows")), keys]
    joined = reduce(lambda a, b: a.join(b, "_file"), parts).join(gaps, "_file", "left")
    return joined.select("_file", "is_template", "skip_rows", F.coalesce("count", F.lit(0)).alias("mismatches"), "first_key")
