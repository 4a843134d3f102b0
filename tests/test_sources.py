import pytest
from pyspark.sql import functions as F

from gridgate import HeaderError, SourceError
from gridgate.operators import template
from gridgate.operators.headers import alignment
from gridgate.plans.sinks import in_order, insert_statements, write_csv, write_dump
from gridgate.sources.delimited import scan_delimited
from gridgate.sources.insert_dump import dump_rows, dump_tables, read_dump, scan_insert_dump
from gridgate.sources.positions import read_lines, with_ordinals, with_split
from gridgate.sources.routing import route, source_format
from gridgate.sources.workbook import read_sheets, scan_workbooks
from workload.books import workbook


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def cells(scan):
    return [tuple(r[c] for c in scan.columns) for r in scan.rows.orderBy("_file", "_ordinal").collect()]


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def test_ordinals_over_many_splits(spark, tmp_path, small_splits):
    for n in (700, 40, 2100):
        put(tmp_path, f"f{n}.txt", "".join(f"{i} some text\n" for i in range(n)))
    lines = with_ordinals(with_split(read_lines(spark, str(tmp_path))))
    assert lines.rdd.getNumPartitions() > 8
    bad = lines.filter(F.split("value", " ")[0].cast("bigint") != F.col("_ordinal")).count()
    assert bad == 0 and lines.count() == 2840


def test_header_is_known_in_every_split(spark, tmp_path, small_splits):
    put(tmp_path, "a.csv", "junk\nid,n\n" + "".join(f"{i},x{i}\n" for i in range(900)))
    put(tmp_path, "b.csv", "junk\nid,other\n1,2\n")
    scan = scan_delimited(spark, str(tmp_path), skip_rows=1)
    assert scan.rows.filter("cast(id as bigint) + 2 = _ordinal").count() == 900 == scan.rows.count()
    assert [r._file.split("/")[-1] for r in scan.rejected.collect()] == ["b.csv"]


@pytest.mark.parametrize("text,options,columns,rows", [
    ("id,name,age\n1,Alice,30\n2,Bob,\n", {}, ["id", "name", "age"], [("1", "Alice", "30"), ("2", "Bob", None)]),
    ("meta1\nmeta2\nid,name\n1,Alice\n", {"skip_rows": 2}, ["id", "name"], [("1", "Alice")]),
    ("junk,id,name\nx,1,Alice\n", {"skip_cols": 1}, ["id", "name"], [("1", "Alice")]),
    ("id\n" + "".join(f"{i}\n" for i in range(100)), {"max_row": 10}, ["id"], [(str(i),) for i in range(10)]),
    ("a\tb\n1\t2\n", {"delimiter": "\t"}, ["a", "b"], [("1", "2")]), ("a|b\n1|2\n", {"delimiter": "|"}, ["a", "b"], [("1", "2")]),
    ("  ID ,Name  \n1,x\n", {}, ["id", "name"], [("1", "x")]), ("a,b,c\n1,2\n1,2,3,4\n", {}, ["a", "b", "c"], [("1", "2", None), ("1", "2", "3")]),
    ("a,b\n\n\"x,\"\"y\"\"\", z \n", {}, ["a", "b"], [(None, None), ('x,"y"', " z ")]),
    ("a,b\n\"one\ntwo\",2\n3,4\n", {"quoted_newlines": True}, ["a", "b"], [("one\ntwo", "2"), ("3", "4")]),
])
def test_delimited(spark, tmp_path, text, options, columns, rows):
    scan = scan_delimited(spark, put(tmp_path, "in.csv", text), **options)
    assert scan.columns == columns and cells(scan) == rows


def test_delimited_errors_and_tsv(spark, tmp_path):
    with pytest.raises(SourceError):
        scan_delimited(spark, put(tmp_path, "empty.csv", ""))
    with pytest.raises(HeaderError):
        scan_delimited(spark, put(tmp_path, "twice.csv", "a,a\n1,2\n"))
    assert cells(scan_delimited(spark, put(tmp_path, "in.tsv", "a\tb\n1\t2\n"))) == [("1", "2")]


@pytest.mark.parametrize("encoding", ["cp1251", "utf-16", "koi8-r", "cp866", "iso-8859-5", "utf-16-le"])
def test_encodings(spark, tmp_path, encoding):
    scan = scan_delimited(spark, put(tmp_path, "in.csv", "id,имя\n\n1,Пётр\n", encoding), encoding=encoding)
    assert scan.columns == ["id", "имя"] and ("1", "Пётр") in cells(scan)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"', None, " p "), (2, "x", "", "it's")], "id int, a string, b string, c string")
    write_csv(in_order(df, ["id"]), str(tmp_path / "out"), delimiter=";")
    assert cells(scan_delimited(spark, str(tmp_path / "out"), ";")) == [("1", 'a,"b"', None, " p "), ("2", "x", None, "it's")]
    write_csv(df.limit(0), str(tmp_path / "none"))
    assert "".join(r.value for r in spark.read.text(str(tmp_path / "none")).collect()) == "id,a,b,c"


DUMP = """-- it's a comment; INSERT INTO nothing (a) VALUES (1);
/* another ; one */
INSERT INTO s1.users (id, name, score) VALUES (1, 'O''Brien; (x) -- y', 3.14), (2, NULL, '007');
insert into "s2"."orders" ("Id", `ok`) values (10, TRUE); INSERT INTO s1.users (id, name, score) VALUES (3, '', 1e5), (4);
"""


def test_insert_dump(spark, tmp_path):
    path = put(tmp_path, "in.sql", DUMP)
    users = scan_insert_dump(spark, path)
    assert users.columns == ["id", "name", "score"]
    assert cells(users) == [("1", "O'Brien; (x) -- y", "3.14"), ("2", None, "007"), ("3", None, "1e5"), ("4", None, None)]
    assert [r._ordinal for r in users.rows.orderBy("_ordinal").collect()] == [0, 1, 2, 3]
    assert cells(scan_insert_dump(spark, path, "s2.orders")) == [("10", "TRUE")] == cells(scan_insert_dump(spark, path, "orders"))
    with pytest.raises(SourceError):
        scan_insert_dump(spark, path, "missing")
    with pytest.raises(SourceError):
        scan_insert_dump(spark, put(tmp_path, "no.sql", "-- nothing\n"))
    kinds = {i.text: i.kind for r in dump_rows(read_dump(spark, path)).collect() for i in r["items"] if i}
    assert kinds["007"] == "str" and kinds["10"] == "int" and kinds["3.14"] == "float" and kinds["TRUE"] == "bool"
    assert {r._table: r.rows for r in dump_tables(dump_rows(read_dump(spark, path))).collect()} == {"users": 4, "orders": 1}


def test_separator_inside_text_is_reported(spark, tmp_path):
    path = put(tmp_path, "in.sql", "INSERT INTO t (a) VALUES ('x;\ny');\nINSERT INTO t (a) VALUES ('z');\n")
    assert scan_insert_dump(spark, path, "t").rejected.count() == 1 and scan_insert_dump(spark, path, whole_files=True).rejected.count() == 0
    assert cells(scan_insert_dump(spark, path, whole_files=True)) == [("x;\ny",), ("z",)]


@pytest.mark.parametrize("dialect", ["gp", "ch"])
def test_dump_round_trip(spark, tmp_path, dialect):
    texts = ["plain", "it's", "back\\slash", "q\\'q", None, "a), (b", "-- no", "end\\"] + (["line\nend\t\b"] if dialect == "ch" else [])
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    statements = insert_statements(df, ["id", "t"], "s.t", dialect, F.col("id"), 2)
    assert statements.count() == (len(texts) + 1) // 2
    write_dump(statements, str(tmp_path / "out"), ["batch"])
    rows = scan_insert_dump(spark, str(tmp_path / "out"), dialect=dialect).rows.collect()
    assert {int(r.id): r.t for r in rows} == dict(enumerate(texts))


def books(spark, **files):
    return spark.createDataFrame([(f"{n}.xlsx", bytearray(c)) for n, c in files.items()], "path string, content binary")


STYLES = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts><numFmt numFmtId="165" formatCode="dd\\.mm\\.yyyy"/>'
          '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="165"/><xf numFmtId="10"/></cellXfs></styleSheet>')


def test_workbooks(spark):
    good = workbook({"other": [["x"]], "sales": [["made by hand"], ["junk", "ID", "Name"], ["j", 1, "Alice"], [], ["j", 2.5, None], ["j", True, "Bob"]]}, 1)
    files = books(spark, a=good, b=workbook({"one": [["id"]]}), c=b"not a zip")
    scan = scan_workbooks(spark, files.filter("path = 'a.xlsx'"), "sales", skip_rows=1, skip_cols=1)
    assert scan.columns == ["id", "name"]
    assert [(r._ordinal + scan.row_base, r.id, r.name) for r in scan.rows.orderBy("_ordinal").collect()] == [
        (3, "1", "Alice"), (4, None, None), (5, "2.5", None), (6, "True", "Bob")]
    lost = {r._file: r.reason for r in scan_workbooks(spark, files, "sales", 1, 1, columns=["id", "name"]).rejected.collect()}
    assert "available: one" in lost["b.xlsx"] and lost["c.xlsx"].startswith("cannot open file")
    for header in ([None], ["col-1"], ["имя"], ["id", "id"]):
        with pytest.raises((HeaderError, SourceError)):
            scan_workbooks(spark, books(spark, a=workbook({"s": [header, [1]]})))


def test_workbook_dates(spark):
    row = ['<c s="1"><v>45306</v></c>', '<c s="2"><v>45306.4375</v></c>', '<c s="1"><v>0.5</v></c>', '<c s="3"><v>45306</v></c>', '<c t="str"><f>A1</f><v>x</v></c>']
    rows = read_sheets(books(spark, a=workbook({"s": [row]}, styles=STYLES))).first()["cells"]
    assert [(c.kind, c.text) for c in rows] == [("datetime", "2024-01-15 00:00:00"), ("datetime", "2024-01-15 10:30:00"),
                                                ("time", "12:00:00"), ("int", "45306"), ("str", "x")]


def make_template(config, data, start="A3"):
    return workbook({"data": data, "klad_config": [["start", start], ["h"], *config]})


SIMPLE = [["Код", "table", "true", "ID", "Integer"], ["Имя", "table", None, "full_name", "text"], ["Источник", "A1", None, "origin", "text"]]
DATA = [["file 7"], ["Код", "Имя"], [1, "Анна"], [2, None]]


def test_template(spark):
    sheets = read_sheets(books(spark, a=make_template(SIMPLE + [[], ["x", "table", None, "late", "text"]], DATA)))
    assert template.templates(sheets).first().is_template and template.start_rows(sheets).first().skip_rows == 1
    rows = template.template_contract(sheets)
    contract = template.collect_template(rows)
    assert contract.types() == {"id": "integer", "full_name": "text", "origin": "text"}
    assert [c.name for c in contract.columns if c.is_key] == ["id"] and contract.spec("origin").fixed == "file 7"
    assert alignment(template.data_headers(sheets), template.expected_headers(rows), ["_file"]).count() == 0


@pytest.mark.parametrize("config,problem", [
    ([["Код", "table", None, " ", "text"]], "technical name is empty"), ([["Код", "table", None, "id", None]], "data type is empty"),
    ([["Код", None, None, "id", "text"]], "source is empty"), ([["Код", "12", None, "id", "text"]], "source is neither 'table' nor an address"),
])
def test_template_problems(spark, config, problem):
    sheets = read_sheets(books(spark, a=make_template(config, DATA)))
    assert template.template_contract(sheets).first().problem == problem


@pytest.mark.parametrize("start,skip", [("A3", 1), ("A2", 0), ("B5", 3), ("a3", 1), ("A1", None), ("here", None)])
def test_template_start(spark, start, skip):
    row = template.start_rows(read_sheets(books(spark, a=make_template(SIMPLE, DATA, start)))).first()
    assert row.skip_rows == skip and (row.problem is None) == (skip is not None)


def test_template_mismatch_and_empty_fixed(spark):
    sheets = read_sheets(books(spark, a=make_template([["Код", "table", None, "id", "text"], ["Пусто", "C1", None, "e", "text"]], DATA)))
    rows = template.template_contract(sheets)
    assert {r.col_name: r.fixed_value for r in rows.collect()} == {"id": None, "e": ""}
    gap = alignment(template.data_headers(sheets), template.expected_headers(rows), ["_file"]).collect()
    assert [(g.pos, g.found_name, g.expected_name) for g in gap] == [(1, "Имя", None)]


def test_routing(spark, tmp_path):
    rows = {r.path: r.format for r in route(spark.createDataFrame([("a.XLSX",), ("b.tsv",), ("c.txt",), ("d.pdf",)], "path string")).collect()}
    assert rows == {"a.XLSX": "workbook", "b.tsv": "delimited", "c.txt": "dump", "d.pdf": None}
    put(tmp_path, "a.csv", "a\n1\n")
    assert source_format(spark, str(tmp_path)) == "delimited"
    put(tmp_path, "b.sql", "x")
    with pytest.raises(SourceError):
        source_format(spark, str(tmp_path))
