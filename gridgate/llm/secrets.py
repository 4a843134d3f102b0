"""Secret scans: key patterns, and a guess-cost dynamic program over the values that stand in a credential context.

The base patterns find assignments, access keys and hexadecimal keys. The value of any credential context, also of wider
words than the base pattern knows, is then priced: the cheapest way to part it into common words, dates, repeats,
sequences, keyboard walks and brute-force spans gives the guesses that a cracker needs (as log10). Values of wider
contexts that cost at least `MIN_COST` are added as spans, whatever characters they hold. Base spans stay whatever they cost;
so do values of base words that the base pattern ends too early, at a character outside its class.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import ready, with_text

#: The base patterns, by kind, and the least length of what must be that long (a group and its characters).
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Words of credential contexts beyond those of the base pattern.
CONTEXT = ("pwd", "passphrase", "passcode", "credential", "credentials", "private_key", "access_key", "client_key", "auth", "bearer", "pin")
#: Common words and passwords, the most common first.
COMMON = (
    "password", "qwerty", "admin", "welcome", "letmein", "login", "monkey", "dragon", "master", "secret", "hello", "shadow",
    "sunshine", "princess", "football", "baseball", "iloveyou", "trustno", "superman", "batman", "test", "guest", "root",
    "user", "pass", "changeme", "default", "example", "sample", "demo", "temp", "token", "key", "api", "private", "public",
    "access", "server", "database", "backup", "summer", "winter", "spring", "autumn", "love", "money", "house", "family",
    "michael", "jordan", "thomas", "robert", "george", "andrew", "jessica", "ashley", "daniel", "charlie", "london", "paris",
    "orange", "purple", "silver", "golden", "green", "black", "white", "blue", "red", "the", "and", "for", "you", "are", "not",
    "horse", "battery", "staple", "correct", "computer", "internet", "security", "system", "network", "company", "office",
)
#: Rows of the common keyboard.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("013457$@", "oieastsa")

MIN_COST = 9.0
#: What a value costs at least to count beside a base pattern: words such as password say outright what it is.
MIN_STATED = 5.0
#: A value that only a blank parts from its context may be prose; there a word in one case costs a pick from 100,000 words.
PROSE_COST = 5.0
#: How far back a run may begin besides at its very start, and the longest string whose repeats are priced as such.
LOOK_BACK = 64

_PATTERNS = [(kind, re.compile(p, re.ASCII), group, least) for kind, p, group, least in BASE]
#: A value up to its closing quote, or as far as the characters of unquoted values go; contexts may overlap.
_VALUE = r"""(?:"([^"\s]+)"|'([^'\s]+)'|["']?([A-Za-z0-9+/_.=@#$%^&*!-]+))"""
_FULL = re.compile(rf"""(?i:password|passwd|secret|token|api_?key)(?=["']?\x20*([:=])\x20*{_VALUE})""", re.ASCII)
_WIDE = re.compile(rf"""(?<![A-Za-z0-9])(?i:{'|'.join(CONTEXT)})(?=["']?\x20*([:=]\x20*|\x20){_VALUE})""", re.ASCII)
_ASSIGN_WORDS, _WIDE_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key"), tuple(CONTEXT)
_RANK = {w: k + 1 for k, w in enumerate(COMMON)}
_LONGEST = max(map(len, COMMON))
_PROSE = re.compile(r"[A-Za-z]?[a-z]{2,}|[A-Z]{3,}")
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
_NEAR = {(a, b) for row in KEYBOARD for a, b in zip(row, row[1:])} | {
    (a, b) for upper, lower in zip(KEYBOARD, KEYBOARD[1:]) for k, a in enumerate(upper) for b in lower[max(k - 1, 0):k + 1]}
_NEAR |= {(b, a) for a, b in _NEAR}


def _alphabet(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _run_starts(n: int, joins) -> list[int]:
    """Per character where its run begins; the characters k - 1 and k of a run join."""
    out = list(range(n))
    for k in range(1, n):
        if joins(k):
            out[k] = out[k - 1]
    return out


def _periods(value: str) -> dict[int, list[tuple[int, int]]]:
    """(begin, period) of the longest stretches that say a string of 2 to LOOK_BACK characters again and again, by each of their possible ends."""
    codes, seen, out = np.frombuffer(value.encode("utf-32-le"), np.uint32), set(), {}
    for period in range(1, min(len(codes) // 2, LOOK_BACK) + 1):
        same = np.concatenate(([False], codes[period:] == codes[:-period], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        for begin, end in (edges[edges[:, 1] - edges[:, 0] >= period] + [0, period]).tolist():
            if (begin, end) in seen:
                continue  # repeats of a shorter string
            seen.add((begin, end))
            for k in range(begin + 2 * period, end + 1) if period > 1 else ():
                out.setdefault(k, []).append((begin, period))
    return out


def guess_cost(value: str, prose: bool = False) -> float:
    """log10 of the guesses for a value: the cheapest parting into known kinds of spans, each opened at the price of its kind.

    One dynamic program over the whole value. A span of a run (equal characters, steps, keyboard, repeats) begins where the run
    does or within the last LOOK_BACK characters.
    """
    lower, n = value.lower(), len(value)
    if len(lower) != n:  # some letters become two in lower case
        lower = "".join(c.lower()[:1] for c in value)
    plain = lower.translate(LEET)
    each = [_alphabet(c) for c in value]
    before = [0.0, *itertools.accumulate(each)]
    equal = _run_starts(n, lambda k: lower[k] == lower[k - 1])
    steps = [_run_starts(n, lambda k: ord(lower[k]) - ord(lower[k - 1]) == step and lower[k].isalnum() and lower[k - 1].isalnum()) for step in (1, -1)]
    keys = _run_starts(n, lambda k: (lower[k - 1], lower[k]) in _NEAR)
    turned = [0, *itertools.accumulate(int(0 < k < n - 1 and ord(lower[k + 1]) - ord(lower[k]) != ord(lower[k]) - ord(lower[k - 1])) for k in range(n))]
    again = _periods(value)
    words = {m.end(): m.start() for m in _PROSE.finditer(value)} if prose else {}
    best = [0.0] * (n + 1)

    def begins(start: int, last: int) -> Iterator[int]:
        near = max(start, last - LOOK_BACK)
        return itertools.chain((start,) if start < near else (), range(near, last + 1))

    for end in range(1, n + 1):
        least = best[end - 1] + each[end - 1] - 0.3
        for begin in range(max(0, end - _LONGEST), end - 2):
            for text, extra in ((lower, 0.0), (plain, 0.3)):
                if rank := _RANK.get(text[begin:end]):
                    upper = 0.3 if value[begin:end] != lower[begin:end] else 0.0
                    least = min(least, best[begin] + math.log10(rank + 10) + extra + upper)
                    break
        if end in words:
            least = min(least, best[words[end]] + PROSE_COST)
        if value[end - 1].isdigit():
            for size in (4, 8, 10):
                if size <= end and _DATE.fullmatch(value, end - size, end):
                    least = min(least, best[end - size] + math.log10(120 if size == 4 else 365 * 120))
        if end - equal[end - 1] >= 3:
            least = min(least, *(best[k] + each[k] + math.log10(end - k) for k in begins(equal[end - 1], end - 3)))
        for starts in steps:
            if end - starts[end - 1] >= 3:
                least = min(least, *(best[k] + math.log10(20) + math.log10(end - k) for k in begins(starts[end - 1], end - 3)))
        if end - keys[end - 1] >= 3:
            least = min(least, *(best[k] + math.log10(47 * 4) + math.log10(end - k) + 0.5 * (turned[end - 1] - turned[k + 1]) for k in begins(keys[end - 1], end - 3)))
        for start, period in again.get(end, ()):
            least = min(least, *(best[k] + before[k + period] - before[k] + math.log10((end - k) / period) for k in begins(start, end - 2 * period)))
        best[end] = min(best[end - 1] + each[end - 1], least + 0.3)
    return best[n]


def find(text: str, min_cost: float = MIN_COST) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, cost) of all spans of a text, by start and then kind as listed; ends are exclusive."""
    lower, out = text.lower(), []
    for order, (kind, pattern, group, least) in enumerate(_PATTERNS):
        if kind == "assign" and not any(w in lower for w in _ASSIGN_WORDS) or kind == "access" and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), order, m.end(), kind, guess_cost(m[group])))
    if any(w in lower for w in _ASSIGN_WORDS):
        taken = {start: end for start, _, end, kind, _ in out if kind == "assign"}
        for m in _FULL.finditer(text):
            group = m.lastindex
            if m.end(group) - m.start(group) >= BASE[0][3] and taken.get(m.start(), 0) < m.end(group):
                if (cost := guess_cost(m[group])) >= min(MIN_STATED, min_cost):
                    out.append((m.start(), len(_PATTERNS), m.end(group), "guess", cost))
    if any(w in lower for w in _WIDE_WORDS):
        for m in _WIDE.finditer(text):
            group = m.lastindex
            bare = m[1] == " " and text[m.start(group) - 1] == " "
            if (cost := guess_cost(m[group], bare)) >= min_cost:
                out.append((m.start(), len(_PATTERNS), m.end(group), "guess", cost))
    return [(start, end, kind, cost) for start, _, end, kind, cost in sorted(out)]


def _scan(min_cost: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find(text, min_cost) for text in batch.column("text").to_pylist()]
            count = {k: [sum(s[2] == k for s in found) for found in spans] for k, *_ in BASE}
            base = [",".join(f"{k}:{a}:{b}" for a, b, k, _ in found if k != "guess") for found in spans]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), **{f"n_{k}": pa.array(v, pa.int64()) for k, v in count.items()},
                "base_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                "spans": pa.array([",".join(f"{k}:{a}:{b}" for a, b, k, _ in found) for found in spans], pa.string()),
                "log10_guesses": pa.array([[round(c, 3) for *_, c in found] for found in spans], pa.list_(pa.float64()))})

    return scan


def scan(docs: DataFrame, min_cost: float = MIN_COST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts of base findings, their hash, all spans, and what each span's value costs to guess.

    Null and empty texts hold nothing. Whole texts are searched, whatever their length; repeated documents one by one.
    """
    ready(docs.sparkSession)
    return with_text(docs, id_col, text_col).mapInArrow(
        _scan(min_cost), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, log10_guesses array<double>")


def masked(text: str, min_cost: float = MIN_COST, mask: str = "[SECRET]") -> str:
    """The text with every span replaced; spans that overlap are replaced together."""
    out, at = [], 0
    for start, end, _, _ in find(text, min_cost):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, min_cost: float = MIN_COST) -> DataFrame:
    """The documents with every span masked in the text; n_chars follows, all else stays."""
    ready(docs.sparkSession)
    columns, kind = docs.columns, docs.schema

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(columns.index("text"))
            new = [None if t is None else masked(t, min_cost) for t in texts.to_pylist()]
            arrays = list(batch.columns)
            arrays[columns.index("text")] = pa.array(new, texts.type)
            if "n_chars" in columns:
                old = batch.column(columns.index("n_chars"))
                sizes = [n if a == b else len(b) for n, a, b in zip(old.to_pylist(), texts.to_pylist(), new)]
                arrays[columns.index("n_chars")] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return docs.mapInArrow(mask, kind)
