"""Small documents with copies, near copies, nulls, blanks and odd bytes; plain versions of what operators compute."""

import random
import re

import pytest


def documents(seed=3, n=120):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéñ") for _ in range(r.randint(2, 6))) for _ in range(60)]
    rows, texts = [], []
    for i in range(n):
        kind = r.random()
        if kind < 0.05:
            text = None
        elif kind < 0.1:
            text = r.choice(["", " \n\t", "x", "a b"])
        elif kind < 0.25 and texts:
            text = r.choice(texts)
        elif kind < 0.45 and texts:
            near = (r.choice(texts) or "").split(" ")
            near[r.randrange(len(near))] = "changed"
            text = " ".join(near)
        elif kind < 0.5:
            text = "again " * r.randint(1, 300)
        else:
            text = " ".join(r.choice(words) for _ in range(r.randint(5, 200)))
        texts.append(text or "")
        rows.append(((i * 37) % n, text, r.choice(["en", "de", None]), r.choice(["a", "b", None]), len(text or "")))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, extra=True):
    """The rows as a table, with columns whose names operators use inside."""
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "doc_id as id", "text as shingles", "lang as bucket", "'x' as found")
    return df.repartition(4)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


tables = pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="no test tables")
