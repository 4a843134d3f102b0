"""Conversations against an exhaustive search over edits, with small chunks, many partitions, nulls and hot conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from pyspark.sql import functions as F

from gridgate.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The result of one conversation's rows (turn, role, text), without block tables."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    kinds, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "ok")
        seen.add((role, text))

    @cache
    def best(i, said, inserts):
        """Least (cost, edits, repaired rows) from row i on, where `said` are the initials so far, put in the shortest equal form."""
        found = []
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            found.append((0, "", ()))
        if i < len(rows):
            _, role, text = rows[i]
            extra = kinds[i] == "truncated"
            found.append(joined(3, "D", (), best(i + 1, said, 2)))
            if kinds[i] in ("ok", "truncated"):
                if role:
                    found.append(joined(extra, "K", ((role, text),), go(i + 1, said + role[0])))
                for name in ("user", "assistant"):
                    found.append(joined(2 + extra, "R", ((name, text),), go(i + 1, said + name[0])))
        if inserts:
            for name in ("user", "assistant"):
                found.append(joined(2, "I", ((name, ""),), go(i, said + name[0], inserts - 1)))
        return min((f for f in found if f), default=None)

    def go(i, said, inserts=2):
        said = re.sub("(ua)(ua)+$", "ua", said) if re.fullmatch("s?(ua)*u?", said) else said
        said = re.sub("^(s?)(?:ua)+(ua|uau|u)$", r"\1ua\2", said)
        said = re.sub("^(s?)uaua$", r"\1ua", said)
        said = re.sub("^(s?)uauau$", r"\1uau", said)
        return best(i, said, inserts) if re.fullmatch("s?(ua)*u?", said) else None

    def joined(cost, letter, out, rest):
        return rest and (cost + rest[0], letter + rest[1], out + rest[2])

    cost, audit, out = best(0, "", 2)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [role[:1] for _, role, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damage(rows):
    """Live rows by conversation after the damage of the contract."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    return out


def table(seed, convs=60, longest=9, hot=0):
    r = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", None]
    texts = ["Yes.", "No!", "well", "a b c.", "é?", " ", "", None, "x.\n", "thing ", "more. ", "why"]
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(r.randint(1, longest)):
            if r.random() < 0.6:
                role, text = (["user", "assistant"][turn % 2], f"{r.randint(0, 50)}{r.choice(['.', '', '?'])}")
            else:
                role, text = r.choice(roles), r.choice(texts)
            rows.append((conv, None if r.random() < 0.03 else turn + (r.random() < 0.1), role, text))
    return rows + [(7000, k, ["user", "assistant", "system"][r.choice([0, 1, k % 2, k % 2, 2 * (k % 3 == 0)])], r.choice([f"t{k}.", f"t{k}", "same.", ""])) for k in range(hot)]


def unordered(rows):
    """Conversations in which two different rows share a turn: their order is this module's own."""
    by = defaultdict(set)
    for conv, turn, role, text in rows:
        by[conv, turn].add((role, text))
    return {conv for (conv, _), held in by.items() if len(held) > 1}


def compare(spark, rows, parts=5):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("symbols", F.lit(1)).withColumn("live", F.lit(False)).repartition(parts)
    got = {r[0]: tuple(r)[1:] for r in cr.repair_rows(cr.damaged(df)).collect()}
    want = damage(rows)
    assert set(got) == set(want)
    loose = unordered([(c, *r) for c, held in want.items() for r in held])
    assert len(loose) < len(want) / 2
    for conv in want:
        if conv not in loose:
            assert got[conv] == brute(want[conv]), conv
        else:
            assert got[conv][0] == brute(want[conv])[0]


def test_conversations_equal_exhaustive_search(spark):
    compare(spark, table(1))


def test_hot_conversation_over_partitions_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK_ROWS", 7)
    compare(spark, table(2, convs=20, hot=300))


def test_all_rows_of_one_conversation_alike(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK_ROWS", 5)
    rows = [(1, 0, "user", "same.")] * 200 + [(2, None, None, None)] * 50 + [(3, None, "assistant", "x" * 300_000)]
    compare(spark, rows)


def test_empty_table_and_dropped_rows(spark):
    assert cr.repair(spark.createDataFrame([], SCHEMA)).collect() == []
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = cr.repair_rows(cr.damaged(spark.createDataFrame([(5, gone, "user", "Hi.")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_names_of_columns(spark):
    df = spark.createDataFrame([("c", 1, "user", "Hi."), ("c", 2, "assistant", "Yes.")], "talk string, n int, who string, said string")
    assert [tuple(r)[:1] + tuple(r)[6:8] for r in cr.repair(df, "talk", "n", "who", "said").collect()] == [("c", 0, "KK")]


@pytest.mark.parametrize("seed", range(3))
def test_tables_equal_single_steps(seed):
    r = random.Random(seed)
    symbols = bytes(r.randrange(cr.PAD) for _ in range(r.randint(0, 60)))
    vectors = cr.tables()[0]
    into, cost = cr.summary(symbols)
    for k, vector in enumerate(vectors):
        for symbol in reversed(symbols):
            vector = cr.before(vector, symbol)
        assert tuple(c + cost[k] for c in vectors[into[k]]) == vector
    assert len(vectors) < 100
