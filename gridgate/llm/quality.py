"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of `PASSAGE_WORDS` words. Each passage is described by counts of its bytes and word shapes,
encoded by a small tanh layer, and weighted by gated attention, softmax(u . (tanh(V h) * sigmoid(U h))), that is learned from
document labels alone; the weighted sum of encodings is scored by a logistic unit. The model is fitted in one task on a
bounded sample of labelled documents (`sample` of each label, those of the smallest id hashes) and scores every document
where it lies, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import ready, with_text
from gridgate.llm.kernels import SPACE, blocks, hash_runs, runs, text_bytes

PASSAGE_WORDS = 64
#: Labelled documents of each label that the model is fitted on, at most.
SAMPLE = 2500
ACCEPT = 0.7
#: The score of every document where nothing is labelled.
UNLABELLED = 0.5


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 128 or c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 2
    if c in ".,;:?'\"()-":
        return 3
    if c in "|\t{}[]<>=":
        return 4
    if c == "!":
        return 5
    if c == "\n":
        return 6
    return 7 if c != " " else 8


_CLASS = np.array([_class_of(b) for b in range(256)])
#: Three counters of 21 bits in one number, for three classes at a time.
_LANES = [np.array([1 << 21 * (c - 3 * k) if 3 * k <= c < 3 * k + 3 else 0 for c in _CLASS], np.uint64) for k in range(3)]
WIDTH = 9 + 5 + 64


def passage_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and where each document's passages begin (one entry more). None is without a passage."""
    data, offsets = text_bytes(column)
    starts, ends = runs(~SPACE[data], offsets)
    firsts = np.searchsorted(starts, offsets)
    words = np.diff(firsts)
    many = np.maximum(1, -(-words // PASSAGE_WORDS))
    begins = np.concatenate(([0], np.cumsum(many)))
    n = int(begins[-1])
    in_doc = np.arange(len(starts)) - np.repeat(firsts[:-1], words)
    passage = np.repeat(begins[:-1], words) + in_doc // PASSAGE_WORDS
    out = np.zeros((n, WIDTH), np.float32)
    if not len(starts):
        return out, begins
    count = np.bincount(passage, minlength=n)
    head = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    tail = np.append(head[1:], len(starts)) - 1
    which = passage[head]
    low, high = starts[head], ends[tail]
    size = np.maximum(high - low, 1)
    for k, lanes in enumerate(_LANES):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(lanes[data], out=sums[1:])
        packed = sums[high] - sums[low]
        for j in range(3):
            out[which, 3 * k + j] = ((packed >> np.uint64(21 * j)) & np.uint64((1 << 21) - 1)) / size
    hashes = hash_runs(data, starts, ends)
    again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])))
    keyed = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    fresh = np.concatenate(([True], keyed[1:] != keyed[:-1]))
    safe = np.maximum(count, 1)
    length = ends - starts
    out[:, 9] = np.bincount(passage, weights=again, minlength=n) / safe
    out[:, 10] = np.bincount((keyed[fresh] >> np.uint64(40)).astype(np.int64), minlength=n) / safe
    out[:, 11] = np.minimum(np.bincount(passage, weights=np.minimum(length, 64), minlength=n) / safe / 8, 4)
    out[:, 12] = np.bincount(passage, weights=length > 20, minlength=n) / safe
    out[:, 13] = np.log1p(count) / 4
    shape = np.minimum(_CLASS[data[starts]], 7) * 8 + np.minimum(_CLASS[data[ends - 1]], 7)
    out[:, 14:] = np.bincount(passage * 64 + shape, minlength=n * 64).reshape(n, 64) / safe[:, None]
    return out, begins


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Gated-attention pooling of passage encodings under a logistic unit, fitted with Adam."""

    def __init__(self, width: int, hidden: int = 24, gate: int = 16, seed: int = 11):
        r = np.random.default_rng(seed)
        self.p = {"E": r.normal(0, 1 / np.sqrt(width), (width, hidden)), "e": np.zeros(hidden),
                  "V": r.normal(0, 1 / np.sqrt(hidden), (hidden, gate)), "U": r.normal(0, 1 / np.sqrt(hidden), (hidden, gate)),
                  "u": r.normal(0, 0.1, gate), "w": r.normal(0, 0.1, hidden), "b": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        p, x = self.p, (x - self.mean) / self.scale
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        a = (t * g) @ p["u"]
        many = np.diff(begins)
        bag = np.repeat(np.arange(len(many)), many)
        a = np.exp(a - np.maximum.reduceat(a, begins[:-1])[bag])
        a /= np.add.reduceat(a, begins[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, begins[:-1])
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "bag": bag, "z": z, "score": _sigmoid(z @ p["w"] + p["b"])}

    def gradients(self, s: dict[str, np.ndarray], begins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, d = self.p, (s["score"] - y) * weight
        out = {"w": s["z"].T @ d, "b": np.array([d.sum()])}
        dz = (d[:, None] * p["w"])[s["bag"]]
        da = (dz * s["h"]).sum(1)
        da = s["a"] * (da - np.add.reduceat(s["a"] * da, begins[:-1])[s["bag"]])
        dh = s["a"][:, None] * dz
        out["u"] = (s["t"] * s["g"]).T @ da
        dt, dg = da[:, None] * p["u"] * s["g"] * (1 - s["t"] ** 2), da[:, None] * p["u"] * s["t"] * s["g"] * (1 - s["g"])
        out["V"], out["U"] = s["h"].T @ dt, s["h"].T @ dg
        dh = (dh + dt @ p["V"].T + dg @ p["U"].T) * (1 - s["h"] ** 2)
        out["E"], out["e"] = s["x"].T @ dh, dh.sum(0)
        return out

    def fit(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray, epochs: int = 20, batch: int = 128, rate: float = 5e-3, decay: float = 1e-4) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        r, step = np.random.default_rng(5), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        many = np.diff(begins)
        for _ in range(epochs):
            order = r.permutation(len(y))
            for at in range(0, len(y), batch):
                take = order[at:at + batch]
                ends = np.concatenate(([0], np.cumsum(many[take])))
                rows = np.arange(int(ends[-1])) + np.repeat(begins[take] - ends[:-1], many[take])
                grads = self.gradients(self.forward(x[rows], ends), ends, y[take], weight[take] / len(take))
                step += 1
                for k, g in grads.items():
                    g = g + decay * self.p[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in blocks(batches):
        x, begins = passage_features(table.column("text"))
        raw = [x[a:b].tobytes() for a, b in zip(begins[:-1], begins[1:])]
        yield pa.RecordBatch.from_pydict({"doc_id": table.column("doc_id").combine_chunks(), "label": table.column("label").combine_chunks(),
                                          "features": pa.array(raw, pa.binary())})


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows], np.float64)
    if not rows or y.min() == y.max():
        model = float(y[0]) if rows else UNLABELLED
    else:
        each = [np.frombuffer(r["features"], np.float32).reshape(-1, WIDTH) for r in rows]
        model = AttentionModel(WIDTH)
        model.fit(np.concatenate(each).astype(np.float64), np.concatenate(([0], np.cumsum([len(e) for e in each]))), y)
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model if isinstance(model, float) else (model.p, model.mean, model.scale))], pa.binary())})


def label_sample(labels: DataFrame, label_col: str, sample: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of at most `sample` rows of each of the labels 0 and 1, those of the smallest id hashes."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"):
    """The model as (parameters, means, scales), or one constant score where the labels are missing or all alike."""
    ready(docs.sparkSession)
    rows = with_text(docs, id_col, text_col).join(F.broadcast(label_sample(labels, label_col, sample)), "doc_id")
    found = rows.mapInArrow(_sample_features, "doc_id long, label int, features binary").repartition(1).mapInArrow(_fit, "model binary").collect()
    return pickle.loads(bytes(found[0].model)) if found else UNLABELLED


def _score(held):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = held.value
        model = None
        if not isinstance(state, float):
            model = AttentionModel(WIDTH)
            model.p, model.mean, model.scale = state
        for table in blocks(batches):
            if model is None:
                values = np.full(table.num_rows, state)
            else:
                x, begins = passage_features(table.column("text"))
                values = model.forward(x, begins)["score"]
            yield pa.RecordBatch.from_pydict({"doc_id": table.column("doc_id").combine_chunks(), "score": pa.array(values, pa.float64())})

    return score


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every document. Null and empty texts are one passage without words."""
    held = ready(docs.sparkSession).sparkContext.broadcast(model)
    return with_text(docs, id_col, text_col).mapInArrow(_score(held), "doc_id long, score double")


def held_out(id_col: str = "doc_id"):
    """Rows kept from learning: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accept(docs: DataFrame, labels: DataFrame, threshold: float = ACCEPT) -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they are; without any label all of them.

    Null and empty texts are scored like any other, as one passage without words.
    """
    model = fit(docs, labels.where(~held_out()))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = held.value
        judge = AttentionModel(WIDTH)
        if not isinstance(state, float):
            judge.p, judge.mean, judge.scale = state
        for table in blocks(batches):
            if isinstance(state, float):
                values = np.full(table.num_rows, threshold if state == UNLABELLED else state)
            else:
                x, begins = passage_features(table.column("text"))
                values = judge.forward(x, begins)["score"]
            yield from table.filter(pa.array(values >= threshold)).combine_chunks().to_batches()

    return docs.mapInArrow(keep, docs.schema)
