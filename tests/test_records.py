"""Records over several lines and splits against a sequential reader, and row numbers that only findings meet."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from gridgate import IntakeConfig, SourceError, run_load
from gridgate.sources.delimited import open_delimited, scan_delimited
from gridgate.sources.positions import read_lines, with_split
from gridgate.sources.records import assemble, closed


@pytest.fixture
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def cell(r):
    kind = r.random()
    if kind < 0.5:
        return r.choice(["a", "12", "", "5' tall", "x y", "it is 5\" wide", "é"])
    text = "".join(r.choice(["a", "b", ",", "\n", '""', " ", "\n\n", ",\n"]) for _ in range(r.randint(0, 12)))
    return f'"{text}"'


def body(seed, rows=60, width=3):
    r = random.Random(seed)
    return "".join(",".join(cell(r) for _ in range(width)) + "\n" if r.random() > 0.05 else "\n" for _ in range(rows))


def plain(text, width=3):
    return [tuple((row + [""] * width)[:width]) for row in csv.reader(io.StringIO(text, newline=""))]


def rows_of(scan):
    return [(r._ordinal, *(r[c] or "" for c in scan.columns)) for r in scan.rows.orderBy("_ordinal").collect()]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("forced", [True, False])
def test_records_over_many_splits(spark, tmp_path, tiny_splits, seed, forced):
    text = "id,b,c\n" + body(seed)
    (tmp_path / "in.csv").write_text(text, encoding="utf-8", newline="")
    scan = scan_delimited(spark, str(tmp_path / "in.csv"), quoted_newlines=forced)
    want = [(n, *row) for n, row in enumerate(plain(text)) if n]
    assert rows_of(scan) == want and scan.rejected.count() == 0
    assert with_split(read_lines(spark, str(tmp_path / "in.csv"))).rdd.getNumPartitions() > 3


def test_carriage_returns_inside_and_outside(spark, tmp_path):
    text = 'id,b\r\n1,"x\r\ny"\r\n2,z\r\n'
    (tmp_path / "in.csv").write_text(text, newline="")
    assert rows_of(scan_delimited(spark, str(tmp_path / "in.csv"))) == [(1, "1", "x\r\ny"), (2, "2", "z")]


def test_one_quote_is_no_open_cell(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,b\n1,5" pipe\n2,x\n')
    reading = open_delimited(spark, str(tmp_path / "in.csv"))
    assert not any(r._torn for r in reading.rows.collect())
    assert rows_of(scan_delimited(spark, str(tmp_path / "in.csv"))) == [(1, "1", '5" pipe'), (2, "2", "x")]


def test_files_that_cannot_be_read_are_named(spark, tmp_path):
    for name, text in {"a.csv": "id,b\n1,2\n", "b.csv": "", "c.csv": "id,other\n1,2\n", "d.csv": 'id,b\n1,"never\n2,3\n', "e.csv": 'id,b\n4,"x\ny"\n', "f.csv": "id,b\n"}.items():
        (tmp_path / name).write_text(text)
    scan = scan_delimited(spark, str(tmp_path))
    assert sorted((r.id, r.b) for r in scan.rows.collect()) == [("1", "2"), ("4", "x\ny")]
    lost = {r._file.split("/")[-1]: r.reason.split()[0] for r in scan.rejected.collect()}
    assert lost == {"b.csv": "the", "c.csv": "header", "d.csv": "a"}
    with pytest.raises(SourceError):
        run_load(spark, IntakeConfig(str(tmp_path)))


def test_commas_and_tabs_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,b\n1,"x\ny"\n')
    (tmp_path / "b.tsv").write_text('id\tb\n2\t"p\tq"\n')
    (tmp_path / "c.tsv").write_text('id\tb\n3\t"p\nq"\n')
    scan = scan_delimited(spark, str(tmp_path))
    assert sorted((r.id, r.b, r._ordinal) for r in scan.rows.collect()) == [("1", "x\ny", 1), ("2", "p\tq", 1), ("3", "p\nq", 1)]


def test_header_over_two_lines_and_skipped_rows(spark, tmp_path):
    (tmp_path / "in.csv").write_text('made by "hand"\n\n"id\nno",b\n1,2\n"3\n4",5\n')
    scan = scan_delimited(spark, str(tmp_path / "in.csv"), skip_rows=2)
    assert scan.columns == ["id\nno", "b"] and rows_of(scan) == [(3, "1", "2"), (4, "3\n4", "5")]


def test_max_row_over_splits(spark, tmp_path, tiny_splits):
    (tmp_path / "in.csv").write_text("x\nid\n" + "".join(f"{i} some more text\n" for i in range(300)))
    scan = scan_delimited(spark, str(tmp_path / "in.csv"), skip_rows=1, max_row=77)
    assert rows_of(scan) == [(i + 2, f"{i} some more text") for i in range(77)]


def test_findings_of_torn_and_plain_files(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text("id,b\n" + "".join(f"{i if i % 50 else 'bad'},t{i}\n" for i in range(200)))
    (tmp_path / "b.csv").write_text("id,b\n" + "".join(f"{i if i % 50 else 'bad'},\"t\n{i}\"\n" for i in range(200)))
    run = run_load(spark, IntakeConfig(str(tmp_path / "*.csv"), export="csv", error_mode="coerce", dtypes={"id": "integer"}, output_dir=str(tmp_path / "out")))
    found = sorted((r._file[-5:], r.cell) for r in run.violations.collect())
    assert found == sorted((f, f"A{n}") for f in ("a.csv", "b.csv") for n in (2, 52, 102, 152))
    back = scan_delimited(spark, run.output)
    assert back.rows.count() == 400 and {r.rows_written for r in run.metrics.collect()} == {200}


def test_no_text_meets_the_offsets_of_a_run(spark, tmp_path):
    """The plan of a run's rows joins header ids only: no join by file and split."""
    (tmp_path / "in.csv").write_text("id,b\n1,2\n")
    from gridgate.sources.positions import settle
    placed = settle(open_delimited(spark, str(tmp_path / "in.csv")))
    plan = placed.rows._jdf.queryExecution().optimizedPlan().toString()
    assert "_before" not in plan and plan.count("Join") == 1


def test_closed(spark):
    cases = {'a,"b"': True, 'a,"b': False, '"a""b"': True, '"a""': False, 'a"b': True, '"a"x,"': False, "": True, ",,": True, '"",""': True, '"a,\nb",c': True}
    rows = spark.createDataFrame(list(cases.items()), "t string, want boolean")
    assert rows.filter(closed(F.col("t"), ",") != F.col("want")).count() == 0
    got = assemble(spark.createDataFrame([("f", 0, 5, "a"), ("f", 9, 8, '"b'), ("f", 9, 9, 'c"'), ("f", 20, 30, '"d'), ("f", 40, 50, "e"), ("f", 60, 70, 'f"'), ("f", 60, 71, "g")],
                                         "_file string, _split long, _tick long, value string"), ",")
    assert sorted((r._split, r._tick, r.value) for r in got.collect()) == [(0, 5, "a"), (9, 8, '"b\nc"'), (20, 30, '"d\ne\nf"'), (60, 70, "g")]


def test_reports_and_outputs_do_not_collide(spark, tmp_path):
    from pyspark.sql import Row

    from gridgate.plans.sinks import write_reports
    write_reports(spark.createDataFrame([Row(_file="/a/in.csv", is_valid=False, report="one"), Row(_file="/b/in.csv", is_valid=False, report="two"),
                                         Row(_file="/b/x.csv", is_valid=False, report="three"), Row(_file="/b/ok.csv", is_valid=True, report="-")]), str(tmp_path / "r"))
    folders = sorted(p.name for p in (tmp_path / "r").iterdir() if p.is_dir())
    assert len(folders) == 3 and folders[-1] == "source=x.csv" and all(f.startswith("source=in.csv-") for f in folders[:2])
    (tmp_path / "sales 1.csv").write_text("id\n1\n")
    runs = [run_load(spark, IntakeConfig(str(tmp_path / "sales 1.csv"), export="csv", output_dir=str(tmp_path / "out"))).output for _ in range(2)]
    assert runs[0] != runs[1] and all(r.rsplit("/", 1)[-1].startswith("sales1_") for r in runs)


@pytest.mark.parametrize("encoding", ["utf-16", "utf-16-le", "utf-16-be"])
def test_utf_16_in_several_tasks(spark, tmp_path, tiny_splits, encoding):
    text = "id,имя\r\n" + "".join(f"{i},Пётр {i}\r\n" if i % 7 else "\n" for i in range(60))
    (tmp_path / "in.csv").write_bytes(text.encode(encoding))
    lines = with_split(read_lines(spark, str(tmp_path / "in.csv"), encoding))
    assert lines.rdd.getNumPartitions() > 3
    assert rows_of(scan_delimited(spark, str(tmp_path / "in.csv"), encoding=encoding)) == [
        (i + 1, str(i), f"Пётр {i}") if i % 7 else (i + 1, "", "") for i in range(60)]


def test_utf_16_records_and_pairs_that_look_like_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('id,b\n1,"x\ny"\n2,z\n'.encode("utf-16-le"))
    assert rows_of(scan_delimited(spark, str(tmp_path / "a.csv"), encoding="utf-16-le")) == [(1, "1", "x\ny"), (2, "2", "z")]
    odd = "\u0a85\u0100"
    assert b"\x0a\x00" in odd.encode("utf-16-le")
    (tmp_path / "b.csv").write_bytes(f"id,b\n1,{odd}\n2,z\n".encode("utf-16-le"))
    assert rows_of(scan_delimited(spark, str(tmp_path / "b.csv"), encoding="utf-16-le")) == [(1, "1", odd), (2, "2", "z")]
