"""Groups of equal texts against a plain dictionary, with hashes that collide, nulls, repeats and hot groups."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridgate.llm import exact_copies
from tests.llm.data import SCHEMA, documents, frame


def plain(rows, best=max):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    out = []
    for doc_id, text, *_ in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = best(ids) if ids else None
        out.append((doc_id, keep, len(groups[text or ""]), keep is None or doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table():
    rows = documents(n=150)
    rows += [(None, "x y", None, None, 0), (None, "only here", None, None, 0), (None, "only here", None, None, 0)]
    rows += [(500 + k, "hot", "en", "a", 3) for k in range(300)] + [rows[7], rows[7]] + [(900, "é" * 50_000, None, None, 1), (901, "é" * 50_000, None, None, 1)]
    return rows


def test_groups_equal_a_dictionary(spark):
    rows = table()
    assert got(exact_copies.digest(frame(spark, rows))) == plain(rows)
    assert got(exact_copies.digest(frame(spark, rows), keep="smallest")) == plain(rows, min)


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_colliding_hashes_change_nothing(spark, digits):
    rows = table()
    weak = lambda text: F.substring(F.hex(F.substring(F.unhex(F.sha2(text, 256)), 1, 2)), 1, digits).cast("binary")
    assert got(exact_copies.digest(frame(spark, rows), fingerprint=weak)) == plain(rows)


def test_kept_rows_carry_all_columns(spark):
    rows = table()
    df = frame(spark, rows).withColumn("hash", F.lit(1)).withColumn("row", F.lit("r")).withColumn("keep_id", F.lit(2)).withColumn("n", F.lit(3))
    out = exact_copies.without_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in out.collect()) == sorted((r[0] or -1, rows_text) for r, rows_text in
        [(row, row[1] or "") for row, mark in zip(rows, [p[3] for p in _aligned(rows)]) if mark])


def _aligned(rows):
    marks = defaultdict(list)
    for p in plain(rows):
        marks[p[0], p[4]].append(p)
    return [marks[r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()][0] for r in rows]


def test_empty_table(spark):
    assert exact_copies.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert exact_copies.without_copies(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark, capsys):
    exact_copies.digest(frame(spark, table())).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        exact_copies.digest(frame(spark, table()), keep="any")
