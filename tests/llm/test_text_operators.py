"""Repeats, decontamination, near duplicates, packing and their kernels against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gridgate.llm import decontaminate, near_duplicates, packing, repeats
from gridgate.llm.fm_index import FmIndex, suffix_order
from gridgate.llm.kernels import blocks, hash_runs, runs, text_bytes
from tests.llm.data import SCHEMA, ascii_lower, documents, frame


@pytest.mark.parametrize("n, largest", [(60, 3), (500, 5), (80, 1), (1, 1)])
def test_fm_index_finds_every_place(n, largest):
    r = np.random.default_rng(n)
    sequence = r.integers(1, largest + 1, n)
    index, held = FmIndex(sequence, largest, every=4), sequence.tolist()
    for _ in range(60):
        pattern = r.integers(1, largest + 1, int(r.integers(1, 6)))
        row = np.zeros((1, 6), np.int64)
        row[0, 6 - len(pattern):] = pattern
        low, high = index.search(row, np.array([len(pattern)]))
        want = [k for k in range(n - len(pattern) + 1) if held[k:k + len(pattern)] == pattern.tolist()]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_suffix_order():
    symbols = np.random.default_rng(1).integers(0, 2, 300)
    held = symbols.tolist()
    assert suffix_order(symbols, 2).tolist() == sorted(range(300), key=lambda k: held[k:])


def test_blocks_keep_rows_and_bound_their_size():
    texts = ["x" * 10, None, "", "y" * 100, "z" * 3] * 5
    batches = pa.table({"text": texts, "n": list(range(25))}).to_batches(max_chunksize=4)
    out = list(blocks(iter(batches), limit=60))
    assert [n for t in out for n in t["n"].to_pylist()] == list(range(25))
    assert all(t.num_rows == 1 or sum(len(x or "") for x in t["text"].to_pylist()) <= 60 for t in out)


def test_runs_and_hashes_do_not_cross_texts():
    data, offsets = text_bytes(pa.array(["ab", "ab c", None, "", "c"]))
    starts, ends = runs(data != 32, offsets)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert words == [b"ab", b"ab", b"c", b"c"]
    hashes = hash_runs(data, starts, ends).tolist()
    assert hashes[0] == hashes[1] != hashes[2] == hashes[3]


def test_suffix_array_and_intervals():
    data = np.frombuffer(b"banana\0bandana\0\0ban", np.uint8)
    begins, ends = np.arange(15), np.array([6] * 7 + [14] * 8)
    ends = np.maximum(ends, begins)
    order, shared = repeats.suffix_array(data, begins, ends)
    texts = [data[a:b].tobytes() for a, b in zip(begins, ends)]
    assert [texts[k] for k in order] == sorted(texts)
    common = [next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
              for a, b in zip([texts[k] for k in order], [texts[k] for k in order][1:])]
    assert shared.tolist() == common
    low, high, size = repeats.intervals(shared, 1)
    for a, b, n in zip(low, high, size):
        assert min(common[a:b]) == n
        assert (a == 0 or common[a - 1] < n) and (b == len(common) or common[b] < n)


def removed_plainly(rows, length=50):
    seen, out = set(), {}
    for i, text in sorted((r[0], r[1] or "") for r in rows):
        raw = text.encode()
        mark, strings = bytearray(len(raw)), [raw[k:k + length] for k in range(len(raw) - length + 1)]
        for k, s in enumerate(strings):
            if s in seen:
                mark[k:k + length] = b"\1" * length
        seen.update(strings)
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        spans = sum(1 for k in range(len(mark)) if mark[k] and (k == 0 or not mark[k - 1]))
        out[i] = (len(raw), sum(mark), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_repeats(spark, seed):
    rows = documents(seed)
    got = repeats.remove_repeats(frame(spark, rows))
    assert {r.doc_id: tuple(r)[1:5] for r in got.collect()} == removed_plainly(rows)


@pytest.mark.parametrize("blocks_of_copies", [1, 2])
def test_repeats_of_rows_given_twice(spark, blocks_of_copies):
    rows = documents(3)
    copies = [r for r in rows if len(r[1] or "") > 100][::3]
    one = frame(spark, rows, extra=False).coalesce(1)
    docs = one.union(frame(spark, copies, extra=False).coalesce(1)) if blocks_of_copies == 2 else frame(spark, rows + copies, extra=False).coalesce(1)
    want = removed_plainly(rows)
    got = sorted(tuple(r)[:5] for r in repeats.remove_repeats(docs, with_kept=False).collect())
    assert len(copies) > 5 and got == sorted((r[0], *want[r[0]]) for r in rows + copies)


def shuffled(plan):
    """Bytes that the exchanges of a plan that has run wrote; one that another reuses counts once."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    if kind == "ReusedExchangeExec":
        return 0
    own = plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
    children = plan.children()
    return own + sum(shuffled(children.apply(k)) for k in range(children.size()))


def test_repeats_move_less_than_the_texts_twice(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(4000)]
    passages = [" ".join(r.choices(words, k=60)) for _ in range(300)]
    rows = [(k, " ".join(r.choice(passages) if r.random() < 0.3 else " ".join(r.choices(words, k=60)) for _ in range(r.randint(1, 8))), None, None, 0)
            for k in range(1500)]
    got = repeats.remove_repeats(frame(spark, rows, extra=False), with_kept=False)
    assert {t.doc_id: tuple(t)[1:5] for t in got.collect()} == removed_plainly(rows)
    assert shuffled(got._jdf.queryExecution().executedPlan()) < 2 * sum(len(t[1]) for t in rows)


def test_repeats_leave_documents_without_an_id(spark):
    text = "a passage of more than fifty bytes that several of these documents hold as a whole"
    rows = [(None, text, None, None, 0), (7, text + " and more", None, None, 0), (None, "short", None, None, 0), (9, text, None, None, 0), (None, None, None, None, 0)]
    got = repeats.remove_repeats(frame(spark, rows, extra=False), with_kept=True).collect()
    left = sorted((r.doc_id or 0, bytes(r.kept).decode()) for r in got)
    assert left == [(0, ""), (0, text), (0, "short"), (7, text + " and more"), (9, "")]
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("values", [[], [5], [7, 7, 7], [3, 900, 1], [1 << 40, (1 << 40) + 70_000, 0], [-(1 << 63), (1 << 63) - 1, 0]])
def test_packed_numbers(values):
    assert repeats._as_ints(repeats._ints(np.array(values, np.int64))).tolist() == values
    unsigned = np.unique(np.array(values, np.int64).astype(np.uint32))
    assert repeats._of_halves(*repeats._halves(unsigned)).tolist() == unsigned.tolist()


def test_a_changed_answer_stops_the_run():
    """An answer about other anchors than a part has now must not be read as one about these."""
    r = random.Random(2)
    texts = pa.table({"doc_id": pa.array([1, 2]), "text": pa.array(["".join(r.choice("abcdefgh ") for _ in range(400)) for _ in range(2)])})
    dealt = pa.Table.from_batches(repeats._deal(1)(iter(texts.to_batches())))
    asked = next(repeats._list_anchors(50, 1)(iter(dealt.to_batches())))
    answer = pa.Table.from_batches(repeats._wanted(iter([asked])))
    assert repeats._contents(50, 1)(dealt, answer).num_rows == 1
    with pytest.raises(RuntimeError, match="differ"):
        repeats._contents(50, 1)(dealt, answer.set_column(2, "total", pa.array([1])))


def test_repeat_groups_hold_all_occurrences(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs away from it all the way home"
    rows = [(k, f"{k * 7919} {passage} {k * 104729}", "en", "a", 0) for k in range(5)]
    got = repeats.repeat_groups(frame(spark, rows)).groupBy("bucket", "repeat", "n_bytes").count().collect()
    assert max(r["count"] for r in got) == 5


def hits_plainly(rows, items, words=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = word.findall(ascii_lower(text or ""))
        for k in range(max(1, len(w) - words + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + words]), set()).add(item)
    out = {}
    for row in rows:
        w, hit, found = word.findall(ascii_lower(row[1] or "")), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if held := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= held
        ids = ",".join(sorted(map(str, found)))
        out[row[0]] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


ITEMS = [(1, "One two, THREE four five six seven eight nine ten eleven twelve"), (2, "short Item"), (10, "short ITEM"), (3, None), (4, ""), (5, "!!")]


def test_decontamination(spark):
    rows = documents(8) + [
        (900, "so one two three four five six seven eight nine ten eleven twelve, and a short item", "en", "a", 0),
        (901, "two three four five six seven eight nine ten. eleven", None, None, 0),
        (902, "one two three four five six seven eight nine", None, None, 0)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = hits_plainly(rows, ITEMS)
    for part in (1_000_000, 2):
        found = decontaminate.scan(frame(spark, rows), items, part_windows=part)
        assert {r.doc_id: tuple(r)[1:] for r in decontaminate.digest(found).collect()} == want
    clean = {r.doc_id: r.text for r in decontaminate.remove_spans(frame(spark, rows), items).collect()}
    assert clean[900] == "so , and a " and 901 not in clean and clean[902] == rows[-1][1]
    assert all(clean[r[0]] == r[1] for r in rows if not want[r[0]][4])


def test_parts_of_a_benchmark_change_nothing(spark):
    w = [f"w{k}" for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(w[:10])), (2, " ".join(w[5:15])), (3, " ".join(w[:2] + w[18:26])), (4, " ".join(w[26:40]))],
                                  "item_id long, text string").coalesce(1)
    # w0 w1 and w18... stand together only after a cut of part 1
    texts = [" ".join(w[:15]), "x " + " ".join(w[:15]) + " y", " ".join(w[:2] + w[:10] + w[18:26]), " ".join(w[26:40]), "none"]
    rows = [(i, t, "en", "a", len(t)) for i, t in zip((None, None, 7, 7, 8), texts)]
    docs = frame(spark, rows)

    def results(part):
        found = decontaminate.scan(docs, items, part_windows=part, cleaned=True).collect()
        return sorted(map(str, found)), sorted(map(str, decontaminate.remove_spans(docs, items, part_windows=part).collect()))

    whole = results(1_000_000)
    assert len(whole[0]) == 5 and any("clean_text='x  y'" in r for r in whole[0]) and len(whole[1]) == 3
    assert results(2) == results(1) == whole


def sets_plainly(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[k:k + 5]) for k in range(len(words) - 4)])


def groups_plainly(rows):
    sets, root = {r[0]: sets_plainly(r[1]) for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


@pytest.mark.parametrize("small", [64, 2])
def test_near_duplicates(spark, small):
    base = " ".join(f"w{k}" for k in range(300))
    rows = documents(5) + [(1000 + k, base.replace(f"w{7 * k} ", "x "), "en", "a", 0) for k in range(40)]
    got = near_duplicates.near_duplicates(frame(spark, rows), small=small)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == groups_plainly(rows)


@pytest.mark.parametrize("largest,count", [(10_000, 80), (30, 25)])
def test_pairs_at_the_threshold_among_texts_with_a_passage(spark, monkeypatch, largest, count):
    """Pairs of 0.75 to 0.77, all of whose texts share two thirds of their words, found in blocks of a node and by branching."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 16)
    r = random.Random(8)
    passage, rows = [f"p{k}" for k in range(60)], []
    for k in range(count):
        own = [f"t{k}_{i}" for i in range(40)]
        rows += [(10 * k, " ".join(passage + own), "en", "a", 0), (10 * k + 3, " ".join(passage + own[:26 + r.randint(0, 1)] + [f"n{k}_{i}" for i in range(9)]), "en", "a", 0)]
        rows.append((10 * k + 5, " ".join(passage + [f"q{k}_{i}" for i in range(40)]), None, None, 0))
    rows += [(5000, None, None, None, 0), (5001, "", None, None, 0), (None, " ".join(passage), None, None, 0), rows[0], rows[0], (5002, "long " * 30_000, None, None, 0)]
    got = near_duplicates.near_duplicates(frame(spark, rows), small=2, largest=largest)
    want = groups_plainly([row for row in rows if row[0] is not None])
    assert len({v[1] for v in want.values()}) < len(want) - count // 2
    found = {x.doc_id: tuple(x)[1:] for x in got.collect() if x.doc_id is not None}
    linked = [k for k, v in want.items() if not v[2]]
    assert sum(found[k] == want[k] for k in linked) >= (1 if largest > 1000 else 0.9) * len(linked)
    assert all(found[k][0] == want[k][0] for k in want) and got.count() == len(rows)


def test_links_of_a_large_group_are_as_many_as_its_texts(spark):
    """Every pair of a group may be linked; no row is made for each pair, neither of what is alike nor of what holds."""
    rows = [(k, " ".join([f"p{i}" for i in range(200)] + [f"t{k}_{i}" for i in range(9 if k % 2 else 30)]), None, None, 0) for k in range(90)]
    source = frame(spark, rows, False).select("doc_id", "text")
    lists = spark.createDataFrame([(a, [b for b in range(90) if b > a]) for a in range(89)], "a long, bs array<long>")
    got = near_duplicates._confirm(lists, source, 5, 75, 200.0).collect()
    assert len(got) < 2 * 90 and all(groups_plainly([rows[x.a], rows[x.b]])[x.b][1] == x.a for x in got)
    links = spark.createDataFrame(got)
    want = {k: v[1] for k, v in groups_plainly(rows).items()}
    assert {r.id: r.root for r in near_duplicates.components(links).collect()}.items() <= want.items() and len(set(want.values())) == 1


def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_packing(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary())
    rows = documents(6) + [(500, "word" * 3000, None, None, 0), (501, "a<|endoftext|>b \t x\x1cy İstanbul ΣΑΣ é don't 12 " * 90, None, None, 0),
                           (502, "One. Two! Three? " * 900, None, None, 0)]
    got = packing.pack(frame(spark, rows), vocabulary(), with_ids=True).toPandas()
    ids = {r[0]: np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    for doc, pieces in got.sort_values("start").groupby("doc_id"):
        at = 0
        for p in pieces.itertuples():
            part = ids[doc][at:at + p.length]
            assert (p.start, p.ids_crc32, p.doc_tokens, list(p.ids)) == (at, zlib.crc32(part.tobytes()), len(ids[doc]), part.tolist())
            at += p.length
        assert at == len(ids.pop(doc))
    assert not ids
    padding = 0
    for _, pieces in got.sort_values("offset").groupby("sequence_id"):
        assert pieces.offset.tolist() == [0, *np.cumsum(pieces.length)[:-1]] and pieces.length.min() > 0
        total = int(pieces.length.sum())
        assert total <= 2048
        padding += 2048 - total if total & (total - 1) else 0
    assert padding < 0.05 * got.length.sum()


def test_cuts_are_the_cheapest():
    r = np.random.default_rng(2)
    for _ in range(30):
        places = np.concatenate(([0], np.cumsum(r.integers(1, 8, 25))))
        penalties = np.concatenate(([0], r.integers(0, 5, 25)))
        cost, _ = packing.cuts(places, penalties, 10)
        plain = [0.0]
        for i in range(1, len(places)):
            plain.append(min(plain[j] + 10 - (places[i] - places[j]) for j in range(i) if places[i] - places[j] <= 10) + penalties[i])
        assert cost == plain


def test_empty_tables_and_null_ids(spark):
    empty, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    odd = frame(spark, [(None, "some words that are here twice, and long enough to be a repeat of fifty bytes", None, None, 1),
                        (1, "some words that are here twice, and long enough to be a repeat of fifty bytes", None, None, 1)])
    for docs, n in ((empty, 0), (odd, 2)):
        assert repeats.remove_repeats(docs).count() == n
        assert decontaminate.digest(decontaminate.scan(docs, items)).where("not contaminated").count() == n
        assert near_duplicates.near_duplicates(docs).where("kept").count() == n
        assert packing.pack(docs, vocabulary()).where("start = 0").count() == n
        assert decontaminate.remove_spans(docs, items).count() == n
        assert near_duplicates.drop_near_duplicates(docs).count() == n
