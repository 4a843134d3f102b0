"""Search, scores, scans and rollups against plain versions, held-out labels and random cases."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridgate.llm import exact_search, licenses, quality, secrets, token_rollup, toxicity
from tests.llm.data import SCHEMA, documents, frame


def test_exact_top_k(spark):
    r = np.random.default_rng(4)
    base = r.normal(0, 0.3, (400, 8))
    base[100:220] = base[100]  # a hot vector
    rows = [(k, v.tolist()) for k, v in enumerate(base)] + [(400, None), (401, [None] + [0.1] * 7), (402, [float("nan")] * 8), (420, [float("inf")] * 8)]
    got = exact_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 20 == 0, cells=6, block=64)
    whole = {k: np.floor(64 * np.array(v)).astype(int) for k, v in rows[:400]}
    want = []
    for q in range(0, 400, 20):
        best = sorted((-int(whole[q] @ whole[k]), k) for k in whole if k != q)[:20]
        want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == sorted(want)



def test_a_walk_brings_back_what_reaches_the_floor_alone():
    """Far blocks give a query nothing it does not need, and equal scores at the floor are kept for the tie by id."""
    r = np.random.default_rng(4)
    queries, data = r.integers(-60, 60, (40, 8)), r.integers(-60, 60, (900, 8))
    q, d = exact_search.CoverTree(queries), exact_search.CoverTree(data, 48)
    scores = queries[q.order] @ data[d.order].T
    floor = np.sort(scores, 1)[:, -3].astype(float)
    best = exact_search.Best(np.arange(40) + 10_000, 20)
    exact_search.dual_tree(exact_search.CoverTree.of(q.packed()), exact_search.CoverTree.of(d.packed()), d.order[:, None], best, floor)
    got = {(k, int(i)) for k in range(40) for i, x in zip(best.ids[k], best.scores[k]) if np.isfinite(x)}
    assert got == {(k, int(d.order[j])) for k, j in zip(*np.nonzero(scores >= floor[:, None]))}


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = exact_search.top_k(few, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 20, 4096), (0, 2, 1, 2048), (20, 1, 0, 4096), (20, 2, 1, 2048)]
    assert exact_search.top_k(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_repeated_rows_and_lengths(spark):
    rows = [(0, [1.0, 0.0]), (20, [4e7, 0.0]), (1, [1.0, 0.5]), (2, [0.5, 0.5]), (3, [0.25, 0.0]), (4, [1.0]), (5, [1.0, 2.0, 3.0]), (6, []), (None, [1.0, 1.0])]
    rows += [(1, [1.0, 0.5])] * 30 + [(7, [0.125, 0.0]), (7, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cell", "2 as v", "3 as ids")
    got = [tuple(r) for r in exact_search.top_k(df, F.col("vec_id") % 20 == 0).collect()]
    whole = {(i, tuple(int(np.floor(64 * c)) for c in v)) for i, v in rows if i is not None and len(v) == 2}
    for q in (0, 20):
        mine = next(v for i, v in whole if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q)[:20]
        assert sorted(r[1:] for r in got if r[0] == q) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert (20, 1, 0, 163840000000) in got or max(r[3] for r in got) == 163840000000


def test_scores_beyond_doubles_are_exact_or_an_error(spark):
    big = float(2 ** 24 + 1)
    df = spark.createDataFrame([(0, [big, 1.0]), (1, [big, 1.0]), (2, [big, 0.984375])], "vec_id long, embedding array<double>")
    scores = {r.vec_id: r.score for r in exact_search.top_k(df, F.col("vec_id") == 0).collect()}
    assert scores == {1: (64 * int(big)) ** 2 + 64 * 64, 2: (64 * int(big)) ** 2 + 64 * 63}
    with pytest.raises(Exception, match="64 bits"):
        exact_search.top_k(spark.createDataFrame([(0, [1e12, 0.0]), (1, [1e12, 1.0])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def labelled(spark, n=240):
    r = random.Random(1)
    words = ["alpha", "river", "stone", "walk", "green", "light", "paper", "house", "cloud", "seven"]
    docs, labels = [], []
    for i in range(n):
        good = r.random() < 0.7
        rude = r.random() < 0.4
        text = [r.choice(words) for _ in range(r.randint(20, 150))]
        if not good:
            text = [f"{w}###" if r.random() < 0.6 else w for w in text]
        if rude:
            text[3:3] = ["nasty"] * r.randint(1, 3) + ["vile"] * r.randint(0, 3)
        docs.append((i, " ".join(text), "en", "a", 1))
        labels.append((i, int(good), int(rude)))
    docs += [(n, None, None, None, None), (n + 1, "", None, None, 0)]
    labels += [(n, None, None), (None, 1, 1), (9999, 1, 0)]
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    model = quality.fit(docs, labels.where(~quality.held_out()))
    scored = quality.score(docs, model).join(labels.where(quality.held_out()), "doc_id").where("quality is not null")
    right = scored.select(((F.col("score") >= 0.7).cast("int") == F.col("quality")).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    assert right > 0.95
    assert quality.score(docs, model).where("score between 0 and 1").count() == docs.count()
    assert quality.accept(docs, labels).columns == docs.columns


def test_attention_gradients():
    r = np.random.default_rng(3)
    model, x, begins, y = quality.AttentionModel(5, 4, 3), r.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, begins)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    grads = model.gradients(model.forward(x, begins), begins, y, np.ones(3))
    for name, value in model.p.items():
        at = tuple(0 for _ in value.shape)
        value[at] += 1e-6
        up = loss()
        value[at] -= 2e-6
        down = loss()
        value[at] += 1e-6
        assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-5


def test_labels_missing_or_alike(spark):
    docs, labels = labelled(spark)
    none = labels.limit(0)
    assert quality.accept(docs, none).count() == docs.count()
    assert toxicity.score(docs, toxicity.fit(docs, none)).where("toxic").count() == 0
    assert quality.accept(docs, labels.where("quality = 0")).count() == 0
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def test_severity_on_held_out_labels(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels.where(~quality.held_out()))
    assert list(model[2]) == sorted(model[2])
    scored = toxicity.score(docs, model).withColumnRenamed("toxic", "said").join(labels.where(quality.held_out()), "doc_id").where("toxic is not null")
    assert scored.agg(F.avg((F.col("said").cast("int") == F.col("toxic")).cast("int"))).first()[0] > 0.95


def base_plainly(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate((
            ("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))):
        for m in re.finditer(pattern, text, re.ASCII | (re.IGNORECASE if kind == "assign" else 0)):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def test_secrets(spark):
    r = random.Random(9)
    parts = ["password", "PASSWD", "token", "api_key", "APIKEY", "secret", "=", ": ", "\"", "'", "abc", "abcdef12", "AKIA", "A1B2C3D4E5F6G7H8", "0f" * 12, "é ", "\n",
             "pwd: ", "Xk9f2LqPz7", "xyz "]
    rows = [(k, "".join(r.choice(parts) for _ in range(r.randint(0, 14))), "en", "a", 0) for k in range(300)] + [(300, None, None, None, None)]
    for row in secrets.scan(frame(spark, rows)).collect():
        text = dict((x[0], x[1]) for x in rows)[row.doc_id] or ""
        spans = row.spans.split(",") if row.spans else []
        assert [s for s in spans if not s.startswith("guess")] == base_plainly(text)
        assert row.n_assign + row.n_access + row.n_hex == len(base_plainly(text)) and len(row.log10_guesses) == len(spans)
    masked = secrets.mask_secrets(frame(spark, [(1, "my password = 'abc123def' ok", "en", "a", 28), (2, None, None, None, 5)])).collect()
    assert {(m.doc_id, m.text, m.n_chars) for m in masked} == {(1, "my [SECRET]' ok", 15), (2, None, 5)}


def test_guess_costs():
    cost = secrets.guess_cost
    assert cost("password") < cost("qwerty123") < cost("hunter2x9k") < cost("Xk9f2LqPz7vB")
    assert cost("aaaaaaaa") < 4 and cost("19991231") < 6 and cost("abcabcabc") < cost("abcqwtzrx")
    assert cost("x" * 5000) < 200 and cost("") == 0


def test_whole_secret_values(spark):
    texts = {'password: "Tr#7vQ!9zLx2" on': '[SECRET]" on', "password = P@ssw0rd!2024x": "[SECRET]", "password=Secret12#rest9of;": "[SECRET];",
             "DB_PWD=kTz#vQwLx!m": "DB_[SECRET]", "user_pwd: kTzvQwLxmRb": "user_[SECRET]", 'token: "a(4)x;Z~9é"': '[SECRET]"',
             '"aws_access_key": "wJalrXUtnFEMIKKMDENGbPx"': '"aws_[SECRET]"', "auth: bearer dGhpcyBpcyBhbm90aGVy": "auth: [SECRET]",
             "auth middleware, pin connector, token embeddings": None, "pin: 1234 pwd: qwertyqwerty": None}
    rows = [(k, text, "en", "a", len(text)) for k, text in enumerate(texts)]
    got = {r.doc_id: r.text for r in secrets.mask_secrets(frame(spark, rows)).collect()}
    assert got == {k: want or text for k, (text, want) in enumerate(texts.items())}


def test_guess_costs_of_long_values():
    cost, block = secrets.guess_cost, "k9Zq#xv2LpWm8RtYb4"
    assert cost("x" * 120 + "password" + "x" * 120) < 12 and cost(block * 40) < cost(block) + 3
    assert cost("19119990101") < cost("191") + cost("19990101") + 1 and cost("k9" * 100000) < 12


def test_patience_alignment():
    text, template = "a x b c d y e".split(), "a b c z d e".split()
    pairs = licenses.matched_pairs(text, template)
    assert [(text[i], template[j]) for i, j in pairs] == [(w, w) for w in "abcde"]
    r = random.Random(2)
    for _ in range(50):
        one, two = ([r.choice("abcdefgh") for _ in range(12)] for _ in range(2))
        pairs = licenses.matched_pairs(one, two)
        assert all(one[i] == two[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_license_scan(spark):
    mit = licenses.TEMPLATES["MIT-grant"]
    rows = [(1, "Code. " + mit.upper().replace(",", "\n") + " more", "en", "a", 0), (2, "Released under the MIT License. x Released under the MIT Licence.", "en", "a", 0),
            (3, None, None, None, None), (4, "the this under license of you", "en", "a", 0), (5, "Foo. Licensed under CC BY-NC 4.0. bar " * 3, "en", "a", 0)]
    got = {r.doc_id: [(f.license, f.coverage) for f in r.found] for r in licenses.scan(frame(spark, rows)).collect()}
    assert got[1] == [("MIT-grant", 1.0)] and got[3] == got[4] == []
    assert [x for x, _ in got[2]] == ["MIT", "MIT"] and [x for x, _ in got[5]] == ["CC-BY-NC-4.0"] * 3
    assert licenses.scan(frame(spark, rows), templates={}).where("size(found) > 0").count() == 0


def license_templates():
    common = {h for w in licenses.COMMON for h in licenses._hashes(w)}
    return [licenses.Template(name, licenses._hashes(text), common) for name, text in licenses.TEMPLATES.items()]


def findings(template, text):
    places = [k for k, w in enumerate(text) if w in template.telling]
    return template.findings(np.array(text, np.uint64), places, [text[k] for k in places], licenses.COVERAGE)


def test_license_after_any_of_its_words():
    for t in license_templates():
        n, other = len(t.words), list(range(1, 40))
        for word in t.telling:
            for text, at in (([word, *t.words], 1), ([word, *other[:9], *t.words, word, *other[:5], *t.words, word], 10)):
                got = [f[1:] for f in findings(t, text)]
                assert (1.0, n, at, at + n) in got
                assert len(text) < 2 * n + 5 or sorted(got)[-1] == (1.0, n, n + 16, 2 * n + 16)


def test_license_with_words_put_in():
    grant = next(t for t in license_templates() if t.name == "MIT-grant")
    for word in grant.telling:
        half = len(grant.words) // 2
        got = findings(grant, [*grant.words[:half], word, 5, word, *grant.words[half:]])
        assert len(got) == 1 and got[0][1] > 0.9


def test_license_after_rights_reserved(spark):
    text = "All rights reserved. " + licenses.TEMPLATES["MIT-grant"]
    found = licenses.scan(frame(spark, [(1, text, "en", "a", 0)])).collect()[0].found
    assert [(f.license, f.coverage, f.first_byte, f.end_byte) for f in found] == [("MIT-grant", 1.0, 21, len(text) - 1)]


def test_rollup_store(spark, tmp_path):
    docs = frame(spark, documents(2))
    store = token_rollup.RollupStore(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    rows = token_rollup.counted(docs, "words-1")
    assert store.commit("a", token_rollup.inserted(rows)) and not store.commit("a", token_rollup.inserted(rows))
    want = sorted((str(r.source), str(r.lang), r.n, r.t) for r in docs.selectExpr("source", "lang", "size(split(trim(regexp_replace(coalesce(text, ''), '\\\\s+', ' ')), ' ')) - if(trim(regexp_replace(coalesce(text, ''), '\\\\s+', ' ')) = '', 1, 0) as k")
                  .groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("k").alias("t")).collect())
    totals = sorted((str(r.source), str(r.lang), r.n_docs, r.n_tokens) for r in store.totals().collect())
    assert totals == want
    with pytest.raises(ValueError):
        store.commit("a", token_rollup.deleted(rows))
    store.compact()
    assert sorted((str(r.source), str(r.lang), r.n_docs, r.n_tokens) for r in store.totals().collect()) == want
    store.commit("b", token_rollup.revised(rows, token_rollup.counted(docs, "words-2", "words-1")))
    store.commit("c", token_rollup.deleted(token_rollup.counted(docs, "words-2", "words-1")))
    assert store.totals().count() == 0
    assert store.commit("d", token_rollup.inserted(token_rollup.counted(spark.createDataFrame([], SCHEMA), "words-1"))) and store.totals().count() == 0


def test_failed_commit_is_written_again(spark, tmp_path):
    rows = token_rollup.inserted(token_rollup.counted(frame(spark, documents(2)), "words-1"))
    store = token_rollup.RollupStore(spark, str(tmp_path / "store"))
    store.commit("a", rows)
    (tmp_path / "store/batches/a/_SUCCESS").unlink()
    assert store.totals().count() == 0 and store.commit("a", rows) and store.totals().count() > 0


def test_cost_decides_beside_base_patterns():
    assert not secrets.find("token: 'hello!' and more")
    assert [k for *_, k, _ in secrets.find("secret = changeme! x")] == ["assign"]
    assert [k for *_, k, _ in secrets.find("password = P@ssw0rd!2024x")] == ["guess"]
    assert [k for *_, k, _ in secrets.find("password = hello1 x")] == ["assign"]  # base findings stay, whatever they cost


def price(value, i, j, near):
    """The cheapest kind for the span i to j as a whole, without looking at runs beyond it."""
    span, lower, n = value[i:j], value[i:j].lower(), j - i
    each = [secrets._alphabet(c) for c in span]
    found = [each[0] - 0.3] if n == 1 else []
    if n >= 3:
        upper = 0.3 if span != lower else 0.0
        for text, extra in ((lower, 0.0), (lower.translate(secrets.LEET), 0.3)):
            if text in secrets.COMMON:
                found.append(np.log10(secrets.COMMON.index(text) + 11) + extra + upper)
                break
        if len(set(lower)) == 1:
            found.append(each[0] + np.log10(n))
        gaps = [ord(b) - ord(a) for a, b in zip(lower, lower[1:])]
        if lower.isalnum() and set(gaps) in ({1}, {-1}):
            found.append(np.log10(20) + np.log10(n))
        if all(pair in near for pair in zip(lower, lower[1:])):
            turns = sum(a != b for a, b in zip(gaps, gaps[1:]))
            found.append(np.log10(188) + np.log10(n) + 0.5 * turns)
    if n in (4, 8, 10) and span[-1].isdigit() and secrets._DATE.fullmatch(span):
        found.append(np.log10(120 if n == 4 else 365 * 120))
    for period in range(2, n // 2 + 1):
        if all(span[k] == span[k - period] for k in range(period, n)):
            found.append(sum(each[:period]) + np.log10(n / period))
    return min(found, default=np.inf) + 0.3


def test_guess_cost_is_the_least_over_all_segmentations():
    r = random.Random(3)
    for _ in range(150):
        value = "".join(r.choice(["a", "1", "q", "w", "e", "abc", "aaa", "2019", "red", "R3d", "@", "ab", "321"]) for _ in range(r.randint(1, 4)))[:9]
        whole = [min(sum(price(value, a, b, secrets._NEAR) for a, b in zip((0, *cut), (*cut, len(value)))) for k in range(len(value))
                     for cut in itertools.combinations(range(1, len(value)), k))]
        assert abs(secrets.guess_cost(value) - whole[0]) < 1e-9, value
