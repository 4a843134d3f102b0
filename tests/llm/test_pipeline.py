"""The corpus pipeline over small tables with nulls, empty texts, repeated rows and clashing columns: every decision shows in the pieces."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7))) for _ in range(n))


def tables(spark, folder, extra=False):
    """Good texts, junk that the labels reject, a near copy, a benchmark passage, a secret, odd rows."""
    r, docs, labels = random.Random(4), [], []
    for i in range(300):
        good = i % 3 > 0
        text = words(r, r.randint(60, 120)) + "."
        docs.append((i, text if good else re.sub(r"(\w+)", lambda m: m[1] + ("#@#" if r.random() < 0.7 else ""), text), "en", "a", 1))
        labels.append((i, int(good), 0))
    item = words(r, 14)
    base = words(r, 200)
    docs += [(1001, base + ".", "en", "a", 1), (1002, base + " more here.", "de", "b", 1), (1003, base + ".", None, None, None),
             (1010, f"{words(r, 60)}. {item}. {words(r, 60)}.", "en", "a", 1), (1020, f"{words(r, 80)} password: Tr7vQ9zLx2pW8k {words(r, 40)}.", "en", "a", 1),
             (1030, None, None, None, None), (1031, "", "en", "a", 0), (1032, " \n", None, None, 2), (None, words(r, 90) + ".", "en", "a", 1), docs[1], docs[1]]
    frame = spark.createDataFrame(docs, SCHEMA)
    if extra:
        frame = frame.selectExpr("*", "1 as id", "'x' as spans", "text as shingles", "2 as node")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1, None), (1, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "x y"), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, item


@pytest.mark.parametrize("extra", [False, True])
def test_decisions_take_effect(spark, tmp_path, extra):
    docs, item = tables(spark, str(tmp_path), extra)
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts, pieces, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    for doc_id, held in pieces.items():
        held.sort(key=lambda p: p.start)
        if doc_id is not None and sum(p.start == 0 for p in held) == 1:
            assert [p.start for p in held] == [sum(q.length for q in held[:k]) for k in range(len(held))]
            assert sum(p.length for p in held) == held[0].doc_tokens
            texts[doc_id] = coder.decode([i for p in held for i in p.ids][:-1]).replace(" ", "").replace("</w>", " ")
    for held in sequences.values():
        held.sort(key=lambda p: p.offset)
        assert [p.offset for p in held] == [sum(q.length for q in held[:k]) for k in range(len(held))]
        assert sum(p.length for p in held) <= 2048
    kept = [i for i in range(300) if i in pieces]
    assert sum(i % 3 > 0 for i in kept) > 190 and sum(i % 3 == 0 for i in kept) < 10  # the classifier's rejections
    assert 1001 in pieces and 1002 not in pieces and 1003 not in pieces                # one of each group stays
    flat = lambda text: re.sub(r"\s+", "", text)
    assert 1010 in pieces and flat(item) not in flat(texts[1010]) and len(texts[1010]) > 100  # the passage is cut out, the rest stays
    assert 1020 in pieces and "Tr7vQ9zLx2pW8k" not in flat(texts[1020])
    good = next(d for d in docs if d[0] == 5)
    assert flat(texts[5]) == flat(good[1])                             # clean documents are untouched


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    tables(spark, str(tmp_path), True)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nothing_but_odd_rows(spark, tmp_path):
    spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0), (2, "one", "en", "a", 3)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in found.collect()} >= {2} and found.where(F.col("length") < 1).count() == 0
