"""Packing: order-preserving dynamic programming over window cuts, its transitions by a monotone queue.

Each task packs its documents in their order, without a shuffle. Cuts may stand at document ends (free), at sentence
ends and, inside long sentences, every `HARD_STEP` tokens (both at a penalty, in tokens of padding). The cost of a cut at
b is its penalty plus the least, over cuts a with b - a <= `size`, of cost(a) + size - (b - a); a queue of candidates a with
rising cost(a) + a gives that least in constant time. The last sequence of a task is parted into powers of two, which need
no padding, where that costs less than padding it. Blocks of bounded size are packed one after another; what follows a
block's last but one cut is packed with the next block.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import ready, with_text
from gridgate.llm.kernels import blocks
from gridgate.llm.tokens import word_ids

SEQUENCE_TOKENS = 2048
END_ID = 1
SENTENCE_PENALTY = 4
HARD_PENALTY = 8
HARD_STEP = 32
#: Stands for a null id inside tasks.
_NO_ID = -(1 << 63)


def cuts(places: np.ndarray, penalties: np.ndarray, size: int) -> tuple[list[float], list[int]]:
    """Cost of each place (ascending, the first is 0 and free, steps at most `size`) and the place before it."""
    cost, back = [0.0], [0]
    at, queue = places.tolist(), deque([0])
    key = [0.0]
    for i, penalty in enumerate(penalties.tolist()[1:], 1):
        here = at[i]
        while at[queue[0]] < here - size:
            queue.popleft()
        best = queue[0]
        value = key[best] + size - here + penalty
        cost.append(value)
        back.append(best)
        value += here
        key.append(value)
        while queue and key[queue[-1]] >= value:
            queue.pop()
        queue.append(i)
    return cost, back


def _candidates(n: int, doc_ends: np.ndarray, sentences: np.ndarray, sentence: int, hard: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from 0 to n with their penalties: document ends, sentence ends, and steps inside what is longer."""
    penalty = np.full(n + 1, -1, np.int32)
    penalty[sentences[sentences <= n]] = sentence
    penalty[doc_ends] = 0
    penalty[0] = 0
    known = np.flatnonzero(penalty >= 0)
    gap = np.diff(np.append(known, n))
    long = np.flatnonzero(gap > step)
    if long.size:
        count = (gap[long] - 1) // step
        before = np.cumsum(count) - count
        inner = np.repeat(known[long], count) + step * (np.arange(int(count.sum())) - np.repeat(before, count) + 1)
        penalty[inner] = hard
    if penalty[n] < 0:
        penalty[n] = hard
    places = np.flatnonzero(penalty >= 0)
    return places, penalty[places]


def _last_cuts(cost: list[float], places: np.ndarray, n: int, size: int, hard: int) -> tuple[int, list[int]]:
    """The place to cut last before the end, and the cuts after it: powers of two where they cost less than padding."""
    best = None
    for i in range(len(places) - 1, -1, -1):
        rest = n - int(places[i])
        if rest > size:
            break
        split = hard * (bin(rest).count("1") - 1)
        if rest and (best is None or cost[i] + min(split, size - rest) < best[0]):
            best = (cost[i] + min(split, size - rest), i, split < size - rest, rest)
    _, i, parted, rest = best
    ends, at = [], int(places[i])
    if parted:
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                at += 1 << bit
                ends.append(at)
        ends.pop()
    return i, ends


class Stream:
    """The tokens of a task that are not yet in a sequence, and which document each stretch of them is from."""

    def __init__(self, size: int, sentence: int, hard: int):
        self.size, self.sentence, self.hard = size, sentence, hard
        self.ids = np.zeros(0, np.uint32)
        self.docs = self.begin = self.length = self.total = self.sentences = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, docs: np.ndarray, begins: np.ndarray, sentences: np.ndarray) -> None:
        sizes, shift = np.diff(begins), len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        self.docs, self.begin = np.concatenate((self.docs, docs)), np.concatenate((self.begin, np.zeros(len(docs), np.int64)))
        self.length, self.total = np.concatenate((self.length, sizes)), np.concatenate((self.total, sizes))
        self.sentences = np.concatenate((self.sentences, sentences + shift))

    def take(self, last: bool) -> tuple[np.ndarray, ...] | None:
        """The pieces of all sequences that are settled, as arrays: stretch, doc, start, length, doc_tokens, sequence, offset."""
        n = len(self.ids)
        if not n or (not last and n <= 4 * self.size):
            return None
        ends = np.cumsum(self.length)
        places, penalties = _candidates(n, ends, self.sentences, self.sentence, self.hard, min(HARD_STEP, self.size))
        cost, back = cuts(places, penalties, self.size)
        extra: list[int] = []
        if last:
            i, extra = _last_cuts(cost, places, n, self.size, self.hard)
        else:
            i = back[back[len(places) - 1]]
        chosen = []
        while i:
            chosen.append(int(places[i]))
            i = back[i]
        bounds = np.array([*chosen[::-1], *extra, *([n] if last else [])], np.int64)
        upto = int(bounds[-1])
        marks = np.unique(np.concatenate((bounds, ends[ends <= upto])))
        first = np.concatenate(([0], marks[:-1]))
        keep = marks > first
        first, marks = first[keep], marks[keep]
        doc = np.searchsorted(ends, first, "right")
        sequence = np.searchsorted(bounds, first, "right")
        offset = first - np.concatenate(([0], bounds))[sequence]
        pieces = (first, self.docs[doc], self.begin[doc] + first - (ends - self.length)[doc], marks - first, self.total[doc],
                  sequence, offset, len(bounds), self.ids)
        stay = np.flatnonzero(ends > upto)
        inside = np.maximum(upto - (ends - self.length)[stay], 0)
        self.docs, self.total = self.docs[stay], self.total[stay]
        self.begin, self.length = self.begin[stay] + inside, self.length[stay] - inside
        self.ids = self.ids[upto:]
        self.sentences = self.sentences[self.sentences > upto] - upto
        return pieces


def _pack(path: str, size: int, sentence: int, hard: int, with_ids: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = word_ids(path), Stream(size, sentence, hard)
        number = TaskContext.get().partitionId() << 33

        def out(pieces) -> pa.RecordBatch:
            first, doc, start, length, total, sequence, offset, _, ids = pieces
            raw = ids.astype("<u4").tobytes()
            columns = {"doc_id": pa.array(doc), "start": pa.array(start), "length": pa.array(length),
                       "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())], pa.int64()),
                       "doc_tokens": pa.array(total), "sequence_id": pa.array(sequence + number), "offset": pa.array(offset)}
            if with_ids:
                edge = np.concatenate((first, [first[-1] + length[-1]])).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(edge), pa.array(ids.astype(np.int32)))
            return pa.RecordBatch.from_pydict(columns)

        for table in blocks(batches):
            ids, begins, sentences = encoder.encode(table.column("text"), END_ID)
            stream.add(ids, table.column("doc_id").to_numpy(), begins, sentences)
            if (pieces := stream.take(False)) is not None:
                yield out(pieces)
                number += pieces[7]
        if (pieces := stream.take(True)) is not None:
            yield out(pieces)

    return pack


def pack(docs: DataFrame, vocabulary: str, size: int = SEQUENCE_TOKENS, sentence_penalty: int = SENTENCE_PENALTY,
         hard_penalty: int = HARD_PENALTY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, the ids themselves.

    Null and empty texts are packed as their end id alone. A document is cut into as many pieces as its length asks for; an
    empty table gives no piece. Repeated documents are packed each for itself; a null id stays null. sequence_id is unique, not gapless.
    """
    ready(docs.sparkSession)
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids array<int>" if with_ids else ""))
    source = with_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    packed = source.mapInArrow(_pack(vocabulary, size, sentence_penalty, hard_penalty, with_ids), schema)
    return packed.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
