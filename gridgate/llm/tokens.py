"""Token ids of whole texts by a public BPE vocabulary with word ends, each distinct word encoded once per worker."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

from gridgate.llm.kernels import hash_runs, owner, runs, spread, text_bytes

#: Distinct words that a worker keeps; beyond that it starts afresh.
KEPT_WORDS = 1_000_000
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+"
_BREAK = np.array([b in (10, 32) for b in range(256)])
_SENTENCE_END = np.array([chr(b) in ".!?" for b in range(256)])


class WordIds:
    """Ids of words (runs without blank and line feed, which the vocabulary drops), kept in sorted arrays by hash."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.model, self.pattern = Tokenizer.from_file(path), None, regex.compile(_PIECE)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used, self.pieces = np.zeros(1 << 16, np.uint32), 0, {}

    def of_word(self, word: str) -> list[int]:
        if not word.isascii() or "<|" in word or not word.isprintable():
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for piece in self.pattern.findall(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.pieces[piece] = [x.id for x in self.model.tokenize(piece)]
            out += ids
        return out

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > KEPT_WORDS and len(self.hashes):
            self.clear()
        raw, begin, count = data.tobytes(), [], []
        for a, b in zip(starts.tolist(), ends.tolist()):
            ids = self.of_word(raw[a:b].decode("utf-8"))
            if self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)))
            self.ids[self.used:self.used + len(ids)] = ids
            begin.append(self.used)
            count.append(len(ids))
            self.used += len(ids)
        order = np.argsort(np.concatenate((self.hashes, hashes)), kind="stable")
        self.hashes = np.concatenate((self.hashes, hashes))[order]
        self.starts = np.concatenate((self.starts, begin)).astype(np.int64)[order]
        self.counts = np.concatenate((self.counts, count)).astype(np.int64)[order]

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(hashes), -1)

    def encode(self, column: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids one after another, where each text's begin (one entry more), and where sentences end.

        With `end_id` every text is closed by that id.
        """
        data, offsets = text_bytes(column)
        starts, ends = runs(~_BREAK[data], offsets)
        words, first, back = np.unique(hash_runs(data, starts, ends), return_index=True, return_inverse=True)
        at = self._find(words)
        if (at < 0).any():
            new = np.flatnonzero(at < 0)
            if len(self.hashes) + len(new) > KEPT_WORDS:
                self.clear()
                new = np.arange(len(words))
            self._learn(words[new], data, starts[first[new]], ends[first[new]])
            at = self._find(words)
        count = self.counts[at][back] if len(words) else np.zeros(0, np.int64)
        source, _ = spread(self.starts[at][back] if len(words) else count, count)
        doc = owner(offsets, starts) if starts.size else starts
        closing = 0 if end_id is None else 1
        total = len(source) + closing * (len(offsets) - 1)
        ids = np.full(total, end_id or 0, np.uint32)
        ids[np.arange(len(source)) + closing * np.repeat(doc, count)] = self.ids[source]
        sizes = np.bincount(doc, weights=count, minlength=len(offsets) - 1).astype(np.int64) + closing
        begins = np.concatenate(([0], np.cumsum(sizes)))
        stop = _SENTENCE_END[data[ends - 1]] | (data[np.minimum(ends, max(len(data) - 1, 0))] == 10)
        sentence = (np.cumsum(count) + closing * doc)[stop & (count > 0)]
        return ids, begins, sentence


def word_ids(path: str) -> WordIds:
    """The encoder of this worker for a vocabulary file; it outlives a task, so later tasks find words encoded."""
    kept = sys.modules.setdefault("gridgate_worker_words", types.ModuleType("gridgate_worker_words")).__dict__
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]
