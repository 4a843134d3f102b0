"""Run registered queries on Spark and their SQL on DuckDB, compare the rows.

    python tools/compare.py <folder of parquet tables> [query …]
"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr), sorted(columns)


def duck(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def differences(spark, db, folder, name, build, sql):
    frame = build(spark, folder)
    mine, my_columns = rows_of(frame.columns, frame.collect())
    if sql is None:
        return [] if mine else ["no rows"], len(mine)
    done = db.execute(sql)
    theirs, their_columns = rows_of([d[0] for d in done.description], done.fetchall())
    if my_columns != their_columns:
        return [f"columns {my_columns} vs {their_columns}"], len(mine)
    if mine == theirs:
        return [], len(mine)
    left, right = set(mine), set(theirs)
    found = [f"rows {len(mine)} vs {len(theirs)}"]
    found += [f"  only spark: {r}"[:400] for r in sorted(left - right, key=repr)[:4]]
    found += [f"  only sql:   {r}"[:400] for r in sorted(right - left, key=repr)[:4]]
    return found, len(mine)


def main(folder, names):
    from pyspark.sql import SparkSession

    from workload import ORACLES, QUERIES
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = duck(folder), 0
    for name in names or QUERIES:
        started = time.time()
        try:
            found, n = differences(spark, db, folder, name, QUERIES[name], ORACLES.get(name))
        except Exception as error:
            found, n = [f"{type(error).__name__}: {str(error)[:600]}"], 0
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {n} rows {time.time() - started:.1f}s", *found, sep="\n" if found else " ", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
