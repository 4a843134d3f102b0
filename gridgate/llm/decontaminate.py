"""Benchmark decontamination: an FM-index per training shard, searched backward for every window of the test items.

A window is `words` consecutive words of an item; an item of fewer words, but not none, is one window. Words are runs of
digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. Each task cuts its documents into shards of
bounded size, indexes the whole shard, finds all windows at once, locates them by sampled suffix positions and merges the
hit words into removal spans. Documents are never shuffled. Items are held in parts of at most `part_windows` windows; each
shard of a larger benchmark is searched for one part after the other, always in its whole text, before spans are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import ready, with_text
from gridgate.llm.fm_index import FmIndex
from gridgate.llm.kernels import ALNUM, LOWER, blocks, hash_runs, owner, runs, spread, text_bytes

WINDOW_WORDS = 10
PART_WINDOWS = 1_000_000


def word_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of lower-cased texts."""
    starts, ends = runs(ALNUM[data], offsets)
    return starts, ends, hash_runs(LOWER[data], starts, ends)


class Windows:
    """The distinct windows of some test items and which items hold each; small enough to be broadcast."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray], size: int):
        self.vocabulary = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        held: dict[bytes, set[int]] = {}
        for item, hashes in zip(ids.tolist(), words):
            symbols = np.searchsorted(self.vocabulary, hashes).astype(np.int32) + 2
            for k in range(max(1, len(symbols) - size + 1) if len(symbols) else 0):
                held.setdefault(symbols[k:k + size].tobytes(), set()).add(item)
        self.items = [sorted(x) for x in held.values()]
        self.lengths = np.array([len(x) // 4 for x in held], np.int64)
        self.patterns = np.zeros((len(held), size), np.int64)
        for k, x in enumerate(held):
            symbols = np.frombuffer(x, np.int32)
            self.patterns[k, size - len(symbols):] = symbols

    def packed(self) -> tuple:
        return self.vocabulary, self.items, self.lengths, self.patterns

    @classmethod
    def of(cls, packed: tuple) -> Windows:
        windows = cls.__new__(cls)
        windows.vocabulary, windows.items, windows.lengths, windows.patterns = packed
        return windows

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Per word its number from 2 on; 0 for a word that no item holds."""
        if not self.vocabulary.size:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, 0)


def shard_hits(windows: Windows, hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and window of every occurrence in a shard whose texts begin at the words `firsts`.

    Symbol 1 stands between texts and for each stretch of words that no item holds, so that no match crosses either.
    """
    symbols = windows.symbols(hashes)
    known = symbols > 0
    gap = np.concatenate(([True], ~known[:-1] & True)) if len(known) else known
    gap[firsts[firsts < len(gap)]] = True
    # a separator goes before each known word that follows a gap
    opens = known & gap
    place = np.flatnonzero(known)
    if not place.size or not windows.lengths.size:
        return (np.zeros(0, np.int64),) * 3
    shift = np.arange(len(place)) + np.cumsum(opens[place])
    sequence = np.ones(int(shift[-1]) + 1, np.int64)
    sequence[shift] = symbols[place]
    word_of = np.zeros(len(sequence), np.int64)
    word_of[shift] = place
    index = FmIndex(sequence, len(windows.vocabulary) + 1)
    low, high = index.search(windows.patterns, windows.lengths)
    hit = np.flatnonzero(high > low)
    rows, _ = spread(low[hit], (high - low)[hit])
    which = np.repeat(hit, (high - low)[hit])
    return word_of[index.locate(rows)], windows.lengths[which], which


def _parts(held: list) -> Iterator[Windows]:
    """The windows of each broadcast part; where there are several, a task holds one at a time and reads it again per shard."""
    for part in held:
        kept = len(held) == 1 or not hasattr(part, "_path")  # encrypted broadcasts are read in when the task starts
        yield Windows.of(part.value if kept else part.load_from_path(part._path))


def _scan(held, with_texts: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            data, offsets = text_bytes(table.column("text"))
            starts, ends, hashes = word_runs(data, offsets)
            firsts = np.searchsorted(starts, offsets)
            edge = np.zeros(len(hashes) + 1, np.int32)
            items: dict[int, set[int]] = {}
            for windows in _parts(held):
                begin, length, which = shard_hits(windows, hashes, firsts[:-1])
                # texts without words share a first word; the last of them owns it, which is the one that has words
                doc = owner(firsts, begin) if begin.size else begin
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + length, -1)
                for d, w in set(zip(doc.tolist(), which.tolist())):
                    items.setdefault(d, set()).update(windows.items[w])
            covered = np.cumsum(edge[:-1]) > 0
            span_start, span_end = runs(covered, firsts)
            span_doc = owner(firsts, span_start) if span_start.size else span_start
            n = table.num_rows
            per_doc = np.searchsorted(span_doc, np.arange(n + 1))
            base = firsts[:-1]

            def lists(values, kind):
                return pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), pa.array(values, kind))

            found = {
                "doc_id": table.column("doc_id").combine_chunks(),
                "n_words": pa.array(np.diff(firsts), pa.int64()),
                "first_word": lists(span_start - base[span_doc], pa.int64()),
                "end_word": lists(span_end - base[span_doc], pa.int64()),
                "items": pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.int64())),
            }
            if with_texts:
                cleaned = []
                texts = table.column("text").combine_chunks()
                for d, text in enumerate(texts):
                    if per_doc[d] == per_doc[d + 1]:
                        cleaned.append(text.as_py())
                        continue
                    raw, kept, at = data[offsets[d]:offsets[d + 1]].tobytes(), [], 0
                    for k in range(per_doc[d], per_doc[d + 1]):
                        kept.append(raw[at:int(starts[span_start[k]] - offsets[d])])
                        at = int(ends[span_end[k] - 1] - offsets[d])
                    cleaned.append(b"".join([*kept, raw[at:]]).decode("utf-8"))
                found["clean_text"] = pa.array(cleaned, pa.string())
            yield pa.RecordBatch.from_pydict(found)

    return scan


#: Stands for the id of items that have none; they count as one item without a name.
NO_ID = -(1 << 63)


def windows_of(benchmark: DataFrame, words: int = WINDOW_WORDS, id_col: str = "item_id",
               part_windows: int = PART_WINDOWS) -> Iterator[Windows]:
    """The items' windows, in parts of bounded size; a longer item lies in several. Null and empty items have none."""
    items = with_text(benchmark, id_col).where(F.length("text") > 0)
    ids, held, size, n = [], [], 0, 0
    for row in items.toLocalIterator():
        data = np.frombuffer(row.text.encode(), np.uint8)
        _, _, hashes = word_runs(data, np.array([0, len(data)]))
        at, many = 0, max(1, len(hashes) - words + 1)
        while at < many:
            room = min(part_windows - size, many - at)
            ids.append(NO_ID if row.doc_id is None else row.doc_id)
            held.append(hashes[at:at + room + words - 1])
            at, size = at + room, size + room
            if size == part_windows:
                yield Windows(np.array(ids), held, words)
                ids, held, size, n = [], [], 0, n + 1
    if ids or not n:
        yield Windows(np.array(ids, np.int64), held, words)


def _broadcast(benchmark: DataFrame, words: int, part_windows: int) -> list:
    """The parts, each sent out before the next is built."""
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(part.packed()) for part in windows_of(benchmark, words, part_windows=part_windows)]


def scan(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW_WORDS, id_col: str = "doc_id",
         text_col: str = "text", part_windows: int = PART_WINDOWS, cleaned: bool = False) -> DataFrame:
    """Per document: n_words, the removal spans as lists of first and end word, the items found; with `cleaned` the
    text without those spans.

    Null and empty texts have no words and no spans. Repeated documents and items are treated one by one. An empty
    benchmark leaves every document clean. Items without an id are found like others and count as one item without a name. The
    number of parts changes no result.
    """
    ready(docs.sparkSession)
    schema = "doc_id long, n_words long, first_word array<long>, end_word array<long>, items array<long>"
    return with_text(docs, id_col, text_col).mapInArrow(
        _scan(_broadcast(benchmark, words, part_windows), cleaned), schema + (", clean_text string" if cleaned else ""))


def digest(found: DataFrame) -> DataFrame:
    """Counts and the hash of the sorted item ids of each scanned document."""
    hit = F.aggregate(F.zip_with("first_word", "end_word", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda i: F.when(i == NO_ID, "").otherwise(i.cast("string")))), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW_WORDS, part_windows: int = PART_WINDOWS) -> DataFrame:
    """The documents, with every removal span cut out of the text; all other columns are kept as they are.

    A document that had words and has none left is dropped; n_chars follows the text where a span was cut.
    """
    ready(docs.sparkSession)
    return docs.mapInArrow(_cut(_broadcast(benchmark, words, part_windows), docs.columns), docs.schema)


def _cut(held, columns):
    inner = _scan(held, True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            found = pa.Table.from_batches(inner(iter([pa.RecordBatch.from_arrays(
                [table.column("doc_id").cast(pa.int64()).combine_chunks(), pc.fill_null(table.column("text").combine_chunks(), "")],
                ["doc_id", "text"])])))
            hit = pc.greater(pc.list_value_length(found.column("first_word")), 0)
            text = pc.if_else(hit, found.column("clean_text").cast(table.column("text").type), table.column("text"))
            out = table.set_column(columns.index("text"), table.schema.field("text"), text)
            if "n_chars" in columns:
                at = columns.index("n_chars")
                count = pc.utf8_length(text).cast(table.schema.field(at).type)
                out = out.set_column(at, table.schema.field(at), pc.if_else(hit, count, table.column(at)))
            left = pc.match_substring_regex(text, "[0-9A-Za-z]|[^\\x00-\\x7F]")
            out = out.filter(pc.or_(pc.invert(hit), pc.fill_null(left, False)))
            yield from out.combine_chunks().to_batches()

    return cut
