"""Toxicity: cumulative-link (proportional-odds) regression of severity grades on sparse word features.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight per word, shared by all grades, and thresholds that are kept in
order by positive steps. x marks which words a text holds and how its words begin (their first 4, 5 and 6 bytes). The model is fitted in one task on a bounded sample of
labelled documents; every document is scored where it lies by its expected severity, the sum of P(grade > k).

Labels of 0 and 1 alone are first refined: documents labelled 1 are graded 1 to 3 by how many of the words that tell
label 1 from label 0 they hold, cut at thirds of the sample.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import ready, with_text
from gridgate.llm.kernels import ALNUM, LOWER, RunHashes, blocks, runs, text_bytes

#: Labelled documents of each grade that the model is fitted on, at most.
SAMPLE = 2500
#: Words must be in so many documents of the sample.
LEAST_DOCUMENTS = 5
#: And go with the grades by so many standard deviations.
LEAST_DEVIATIONS = 5
#: Word beginnings of so many bytes are features beside the words.
BEGINNINGS = (4, 5, 6)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The text and the hash of every feature that a word gives, repeats included."""
    data, offsets = text_bytes(column)
    starts, ends = runs(ALNUM[data], offsets)
    doc = np.repeat(np.arange(len(column)), np.diff(np.searchsorted(starts, offsets)))
    hashed = RunHashes(LOWER[data])
    docs, hashes = [doc], [hashed(starts, ends)]
    for size in BEGINNINGS:
        long = ends - starts > size
        docs.append(doc[long])
        hashes.append(hashed(starts[long], starts[long] + size) ^ np.uint64(size))
    return np.concatenate(docs), np.concatenate(hashes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class OrdinalModel:
    """Words (sorted hashes), their weights, and ordered thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def severity(self, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the probability of any grade above 0, at each w . x."""
        above = _sigmoid(total[:, None] - self.thresholds)
        return above.sum(1), above[:, 0]


def fit_ordinal(rows: np.ndarray, words: np.ndarray, grades: np.ndarray, n_words: int, steps: int = 300, rate: float = 0.05,
                decay: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam; (rows, words) are the marks of the texts, grades run from 0 without a gap."""
    n, top = len(grades), int(grades.max())
    weight = np.full(n, 1 / n)
    w, base, gaps = np.zeros(n_words), np.zeros(1), np.zeros(top - 1)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, base, gaps)]
    for step in range(1, steps + 1):
        wide = np.log1p(np.exp(gaps)) + 1e-3
        theta = base[0] + np.concatenate(([0], np.cumsum(wide)))
        total = np.bincount(rows, weights=w[words], minlength=n)
        upper = np.where(grades < top, _sigmoid(theta[np.minimum(grades, top - 1)] - total), 1.0)
        lower = np.where(grades > 0, _sigmoid(theta[np.maximum(grades - 1, 0)] - total), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
        d_total = (up - low) * weight  # of the mean negative log-likelihood
        d_theta = np.zeros(top)
        np.add.at(d_theta, np.minimum(grades, top - 1)[grades < top], -(up * weight)[grades < top])
        np.add.at(d_theta, (grades - 1)[grades > 0], (low * weight)[grades > 0])
        grads = (np.bincount(words, weights=d_total[rows], minlength=n_words) + decay * w,
                 np.array([d_theta.sum()]), np.cumsum(d_theta[::-1])[::-1][1:] * _sigmoid(gaps))
        for value, grad, moments in zip((w, base, gaps), grads, state):
            moments[0] = 0.9 * moments[0] + 0.1 * grad
            moments[1] = 0.999 * moments[1] + 0.001 * grad * grad
            value -= rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
    return w, base[0] + np.concatenate(([0], np.cumsum(np.log1p(np.exp(gaps)) + 1e-3)))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["doc_id"])
    grades = np.array([r["label"] for r in rows], np.int64)
    model: OrdinalModel | float = float(grades[0]) if len(grades) else 0.0
    if len(set(grades.tolist())) > 1:
        sets = [np.unique(np.frombuffer(r["words"], np.uint64)) for r in rows]
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        words, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        yes, n1 = np.bincount(at, weights=(grades > grades.min())[doc], minlength=len(words)), (grades > grades.min()).mean()
        # marks that go with the grades beyond chance, in standard deviations of a draw of `count` texts
        apart = np.abs(yes - count * n1) / np.sqrt(count * n1 * (1 - n1))
        keep = (count >= LEAST_DOCUMENTS) & (apart >= LEAST_DEVIATIONS)
        if not keep.any():
            keep = count >= 1
        new = np.cumsum(keep) - 1
        doc, at, words = doc[keep[at]], new[at[keep[at]]], words[keep]
        grades = np.unique(grades, return_inverse=True)[1]
        if grades.max() == 1:
            yes = np.bincount(at, weights=grades[doc], minlength=len(words))
            no = np.bincount(at, minlength=len(words)) - yes
            n1 = grades.sum()
            odds = np.log((yes + 0.5) / (n1 + 1)) - np.log((no + 0.5) / (len(grades) - n1 + 1))
            telling = (odds > 2) & (yes >= 0.02 * n1)
            held = np.bincount(doc, weights=telling[at], minlength=len(grades))
            low, high = np.quantile(held[grades == 1], [1 / 3, 2 / 3])
            finer = np.where(grades == 0, 0, 1 + (held > low) + (held > high))
            grades = np.unique(finer, return_inverse=True)[1]
        weights, thresholds = fit_ordinal(doc, at, grades, len(words))
        model = OrdinalModel(words, weights, thresholds)
    state = model if isinstance(model, float) else (model.words, model.weights, model.thresholds)
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(state)], pa.binary())})


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in blocks(batches):
        doc, hashes = features(table.column("text"))
        order = np.argsort(doc, kind="stable")
        ends = np.searchsorted(doc[order], np.arange(table.num_rows + 1))
        yield pa.RecordBatch.from_pydict({
            "doc_id": table.column("doc_id").combine_chunks(), "label": table.column("label").combine_chunks(),
            "words": pa.array([np.unique(hashes[order[a:b]]).tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())})


def grade_sample(labels: DataFrame, grade_col: str, sample: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most `sample` rows of each grade up to 9, those of the smallest id hashes."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(grade_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label between 0 and 9").groupBy("doc_id").agg(F.max("label").alias("label"))
    out = None
    for k in range(10):
        part = known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        out = part if out is None else out.unionByName(part)
    return out


def fit(docs: DataFrame, labels: DataFrame, grade_col: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"):
    """The model as (words, weights, thresholds), or one constant severity where grades are missing or all alike."""
    ready(docs.sparkSession)
    rows = with_text(docs, id_col, text_col).join(F.broadcast(grade_sample(labels, grade_col, sample)), "doc_id")
    found = rows.mapInArrow(_words, "doc_id long, label int, words binary").repartition(1).mapInArrow(_fit, "model binary").collect()
    return pickle.loads(bytes(found[0].model)) if found else 0.0


def _score(held):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = held.value
        model = None if isinstance(state, float) else OrdinalModel(*state)
        for table in blocks(batches):
            n = table.num_rows
            if model is None or not len(model.words):
                severity, toxic = np.full(n, state if model is None else 0.0), np.full(n, float(bool(state)) if model is None else 0.0)
            else:
                doc, hashes = features(table.column("text"))
                at = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
                known = model.words[at] == hashes
                marks = np.unique(doc[known] * len(model.words) + at[known])
                total = np.bincount(marks // len(model.words), weights=model.weights[marks % len(model.words)], minlength=n)
                severity, toxic = model.severity(total)
            yield pa.RecordBatch.from_pydict({"doc_id": table.column("doc_id").combine_chunks(), "severity": pa.array(severity, pa.float64()),
                                              "p_toxic": pa.array(toxic, pa.float64())})

    return score


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade), p_toxic (probability of a grade above 0), toxic (that is at least one half).

    Null and empty texts hold no word and get the severity of the thresholds alone. Documents are scored one by one.
    """
    held = ready(docs.sparkSession).sparkContext.broadcast(model)
    scored = with_text(docs, id_col, text_col).mapInArrow(_score(held), "doc_id long, severity double, p_toxic double")
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)
