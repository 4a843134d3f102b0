"""Repair of conversation structure at the least cost, by Four-Russians block tables.

A row is a symbol: its role's initial and its fault. From the end of a conversation backward, a vector holds what it costs to finish
from each state of the rule `(s?(ua)+)?`; less its least entry, such a vector is one of a few. For each of them and each block of
BLOCK symbols, tables hold the vector before the block and the cost in between, so a conversation is priced by one lookup per block.
The edits are then read from the front: a block is expanded backward from the vector at its end, and of all edits that keep to the
least cost the one of the least letter is taken, which makes the whole sequence the least one (state and letter decide the next state).

Plan: rows are sorted by conversation and turn over range partitions, so a hot conversation lies in many tasks. A task finishes the
conversations that lie inside it. Those at a partition's edges, and long ones, are written as chunks of bounded size. Chunks learn
which of their rows an earlier chunk holds (one row per chunk and distinct row), then become tables from vector to vector, small rows
that compose from the back. Only the edits and the hash, which SHA-256 makes sequential, stream through one task per conversation,
chunk by chunk.

Defined cases: a null role or text is one space; a null conversation is one conversation; null turns come first. Rows of one turn go by
role, then by a hash of the text; repeated rows are duplicates. A row with an empty role can be deleted or given another role, not
kept. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gridgate.llm.common import staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after a system row, after a user row, after an assistant row; what each of them needs next.
START, SYSTEM, USER, ASSISTANT = range(4)
NEEDS = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
#: Symbols: 0 has to go; 1 + 2 * (s, u, a, other) + truncated; PAD stands for no row.
GONE, PAD, SYMBOLS = 0, 9, 10
BLOCK = 4
CHUNK_ROWS, CHUNK_CHARS = 2_000, 1 << 20
SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}


def _after_keep(state: int, role: int) -> int | None:
    """The state after a kept row of this role (0, 1, 2: s, u, a), None where the rule forbids it."""
    if role == 0:
        return SYSTEM if state == START else None
    wanted = {1: USER, 2: ASSISTANT}.get(role)
    return wanted if wanted is not None and NEEDS[state] == wanted else None


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of every edit of a row, by letter."""
    if symbol == PAD:
        return [("", 0, state)]
    edits = [("D", DELETE, state)]
    if symbol != GONE:
        role, cut = divmod(symbol - 1, 2)
        kept = _after_keep(state, role)
        edits += [("K", KEEP + cut * TRUNCATED, kept)] if kept is not None else []
        edits.append(("R", REROLE + cut * TRUNCATED, NEEDS[state]))
    return edits


def _with_inserts(costs: list[float]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEEDS[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def before(vector: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """What it costs to finish from each state before the row, given that after it."""
    return _with_inserts([min(cost + vector[to] for _, cost, to in _edits(symbol, q)) for q in range(4)])


END = _with_inserts([0, float("inf"), float("inf"), 0])


@cache
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """Normalised vectors (END first), and by vector and block: the number of the vector before it, and the cost in between."""
    vectors, step, cost = [END], [], []
    for vector in vectors:  # grows while new vectors turn up
        rows = [before(vector, s) for s in range(SYMBOLS)]
        cost.append([min(r) for r in rows])
        least = [tuple(c - min(r) for c in r) for r in rows]
        vectors += [v for v in dict.fromkeys(least) if v not in vectors]
        step.append(least)
    number = {v: k for k, v in enumerate(vectors)}
    one = np.array([[number[v] for v in row] for row in step], dtype=np.int16)
    price = np.array(cost, dtype=np.int64)
    to, total = one, price
    for _ in range(BLOCK - 1):  # a symbol more in front of the block
        total = (total[:, :, None] + price[to]).transpose(0, 2, 1).reshape(len(vectors), -1)
        to = one[to].transpose(0, 2, 1).reshape(len(vectors), -1)
    return vectors, to, total


def blocks(symbols: bytes) -> list[int]:
    """Table columns of the symbols, the last block filled up."""
    padded = np.frombuffer(symbols + bytes([PAD]) * (-len(symbols) % BLOCK), dtype=np.uint8).reshape(-1, BLOCK)
    return (padded.astype(np.int64) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()


def summary(symbols: bytes) -> tuple[list[int], list[int]]:
    """For every vector after the symbols: the vector before them, and the cost in between."""
    vectors, to, total = tables()
    at, cost = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
    for block in reversed(blocks(symbols)):
        cost += total[at, block]
        at = to[at, block]
    return at.tolist(), cost.tolist()


@cache
def _traced(after: int, block: int, state: int) -> tuple[str, int]:
    """The least letters of cheapest edits through a block, and the state they end in."""
    symbols = [block // SYMBOLS ** k % SYMBOLS for k in range(BLOCK - 1, -1, -1)]
    inside = [tables()[0][after]]
    for symbol in reversed(symbols):
        inside.append(before(inside[-1], symbol))
    inside.reverse()
    letters = ""
    for here, there, symbol in zip(inside, inside[1:], symbols):
        while symbol != PAD:
            choices = [(letter, to, False) for letter, cost, to in _edits(symbol, state) if cost + there[to] == here[state]]
            if INSERT + here[NEEDS[state]] == here[state]:
                choices.append(("I", NEEDS[state], True))
            letter, state, again = min(choices)
            letters += letter
            if not again:
                break
    return letters, state


def trace(symbols: bytes, after: int, state: int, last: bool) -> tuple[str, int, int]:
    """Edits through the symbols to the vector after them, the state they end in, and the cost up to that vector's least entry;
    `last` adds what is inserted at the end."""
    vectors, to, total = tables()
    columns, behind, cost = blocks(symbols), [after], 0
    for block in reversed(columns):
        cost += int(total[behind[-1], block])
        behind.append(int(to[behind[-1], block]))
    cost += vectors[behind[-1]][state]
    letters = []
    for block, vector in zip(columns, behind[-2::-1]):
        found, state = _traced(vector, block, state)
        letters.append(found)
    while last and state not in (START, ASSISTANT):
        letters.append("I")
        state = NEEDS[state]
    return "".join(letters), state, cost


def lines(edits: str, rows: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows."""
    at = iter(rows)
    for edit in edits:
        role, text = next(at) if edit != "I" else ("", "")
        if edit == "K":
            state = _after_keep(state, INITIALS.index(role[0]))
            yield role, text
        elif edit != "D":
            state = NEEDS[state]
            yield NAMES[state], text


def row_key(role: str, text: str) -> str:
    return hashlib.md5(f"{role}\0{text}".encode()).hexdigest()


def classify(rows: list[tuple[int | None, str, str]], seen: set[str]) -> dict:
    """The symbols of a chunk's rows and what is counted on the way; `seen` holds the keys of rows of earlier chunks."""
    symbols, counts, known = bytearray(), [0, 0, 0], set(seen)
    for _, role, text in rows:
        bare, key = text.strip(SPACE), row_key(role, text)
        cut = 0
        if not bare or key in known:
            counts[1 if bare else 0] += 1
            symbols.append(GONE)
        else:
            cut = int(bare[-1] not in ".!?")
            counts[2] += cut
            place = INITIALS.find(role[0]) if role else -1
            symbols.append(1 + 2 * (place if place >= 0 else 3) + cut)
        known.add(key)
    initials = [role[:1] for _, role, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    return {"symbols": bytes(symbols), "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "first": initials[0] if rows else None, "last": initials[-1] if rows else None,
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns))}


def _gaps(parts: list[dict]) -> int:
    """Turns missing between the first and the last one; parts are in order, so only neighbours can share a turn."""
    held = [p for p in parts if p["turns"]]
    if not held:
        return 0
    distinct = sum(p["turns"] for p in held) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(held, held[1:]))
    return held[-1]["last_turn"] - held[0]["first_turn"] + 1 - distinct


def _totals(parts: list[dict]) -> dict:
    """The counts of a conversation from those of its parts, in order."""
    filled = [p for p in parts if p["first"] is not None]
    return {"gaps": _gaps(parts), "illegal": sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(filled, filled[1:])),
            **{k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated")}}


class _Hash:
    """SHA-256 of lines, joined as they come."""

    def __init__(self) -> None:
        self.state, self.any = hashlib.sha256(), False

    def add(self, found: Iterator[tuple[str, str]]) -> list[str]:
        out = []
        for role, text in found:
            self.state.update((b"\n" if self.any else b"") + f"{role}:{text}".encode())
            self.any = True
            out.append(f"{role}:{text}")
        return out


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
ROWS = "array<struct<turn bigint, role string, text string>>"


def _batches(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for record in records:
        held.append(record)
        size += record.pop("_chars", 0) + 200
        if size > CHUNK_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, len(batch), 1000):
            yield from batch.slice(start, 1000).to_pylist()


def _cut(schema: pa.Schema):
    """Sorted rows to finished conversations, and to chunks of those that may go on in another partition or are long."""

    def finished(rows: list[tuple]) -> dict:
        part = classify(rows, set())
        edits, _, cost = trace(part["symbols"], 0, START, True)
        digest = _Hash()
        digest.add(lines(edits, [(role, text) for _, role, text in rows], START))
        return {**_totals([part]), "cost": cost, "audit": edits, "repaired_sha256": digest.state.hexdigest()}

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place = TaskContext.get().partitionId()
        conv, rows, chars, no, first, begun = None, [], 0, 0, True, False

        def chunk() -> dict:
            return {"conv_id": conv, "part": place, "no": no, "_chars": chars, "rows": [dict(zip(("turn", "role", "text"), r)) for r in rows]}

        for row in _records(batches):
            if begun and row["conv_id"] != conv:
                yield chunk() if first or no else {"conv_id": conv, "done": finished(rows), "_chars": len(rows)}
                rows, chars, no, first = [], 0, 0, False
            conv, begun = row["conv_id"], True
            if len(rows) >= CHUNK_ROWS or chars >= CHUNK_CHARS:
                yield chunk()
                rows, chars, no = [], 0, no + 1
            if row["live"]:
                rows.append((row["turn"], row["role"], row["text"]))
                chars += len(row["text"])
        if begun:
            yield chunk()

    return lambda batches: _batches(records(batches), schema)


def _summarise(schema: pa.Schema):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in _records(batches):
            rows = [(r["turn"], r["role"], r["text"]) for r in row["rows"]]
            part = classify(rows, set(row["seen"] or ()))
            into, cost = summary(part["symbols"])
            yield {**row, **part, "into": into, "cost": cost, "_chars": sum(len(r[2]) for r in rows)}

    return lambda batches: _batches(records(batches), schema)


def _compose(key, chunks):
    """The vector behind every chunk of a conversation, from the last chunk to the first, and the conversation's totals."""
    chunks = chunks.sort_values(["part", "no"])
    parts = chunks.astype(object).where(chunks.notna(), None).to_dict("records")
    after, vector = [], 0
    for part in reversed(parts):
        after.append(vector)
        vector = int(part["into"][vector])
    out = chunks[["conv", "part", "no"]].copy()
    out["after"] = after[::-1]
    out["final"] = [False] * (len(out) - 1) + [True]
    totals = _totals([{**p, "turns": int(p["turns"]), **{k: None if p[k] is None else int(p[k]) for k in ("first_turn", "last_turn")}} for p in parts])
    for name, value in totals.items():
        out[name] = int(value)
    return out


def _finish(schema: pa.Schema):
    """Chunks in order to conversations; state, hash and edits go on from chunk to chunk."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        state, cost, audit, digest = START, 0, [], _Hash()
        for row in _records(batches):
            edits, behind, price = trace(row["symbols"], row["after"], state, row["final"])
            digest.add(lines(edits, [(r["role"], r["text"]) for r in row["rows"]], state))
            # The next chunk counts from its own vector: the price up to here is what remains when that vector's entry is taken off.
            cost += price - tables()[0][row["after"]][behind] if not row["final"] else price
            state = behind
            audit.append(edits)
            if row["final"]:
                yield {"conv_id": row["conv_id"], **{k: row[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal")}, "cost": cost,
                       "audit": "".join(audit), "repaired_sha256": digest.state.hexdigest(), "_chars": sum(map(len, audit))}
                state, cost, audit, digest = START, 0, [], _Hash()

    return lambda batches: _batches(records(batches), schema)


def _schema(text: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(text))


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with the faults that the checksum of `conv_id:turn` names; dropped ones stay as `live` = false, for their conversation's sake."""
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("kind", F.crc32(name) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("live"), F.explode(times).alias("time")).drop("time")


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    worded = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return conversations.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                worded(role_col).alias("role"), worded(text_col).alias("text"), F.lit(True).alias("live"))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return repair_rows(_rows(conversations, conv_col, turn_col, role_col, text_col))


def repair_rows(rows: DataFrame) -> DataFrame:
    """As `repair`, of rows conv_id, turn, role, text, live (false: the row only names its conversation)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", "text_hash", "spread"]
    ordered = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "live")
    cut = f"conv_id {kind}, part int, no int, rows {ROWS}, done struct<{', '.join(c.replace(' ', ': ', 1) for c in RESULT.split(', '))}>"
    first = staged(ordered.mapInArrow(_cut(_schema(cut)), cut), "conversations")
    conv = F.concat(F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).alias("conv")
    chunks = first.where("done is null").select(conv, "conv_id", "part", "no", "rows")
    keys = chunks.select("conv", "part", "no", F.explode(F.array_distinct(F.transform("rows", lambda r: F.md5(F.concat(r["role"], F.lit("\0"), r["text"]))))).alias("key"))
    place = F.struct("part", "no")
    earliest = keys.groupBy("conv", "key").agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1")
    seen = keys.join(earliest, ["conv", "key"]).where(place > F.col("least")).groupBy("conv", "part", "no").agg(F.collect_list("key").alias("seen"))
    known = chunks.join(seen, ["conv", "part", "no"], "left").select("conv", "conv_id", "part", "no", "rows", "seen")
    summed = (f"conv string, conv_id {kind}, part int, no int, rows {ROWS}, symbols binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
              "first string, last string, first_turn bigint, last_turn bigint, turns bigint, into array<int>, cost array<bigint>")
    parts = staged(known.mapInArrow(_summarise(_schema(summed)), summed), "chunks")
    after = "conv string, part int, no int, after int, final boolean, gaps bigint, illegal bigint, blank bigint, duplicate bigint, truncated bigint"
    placed = parts.drop("conv_id", "rows", "symbols", "cost").groupBy("conv").applyInPandas(_compose, after)
    inner = parts.select("conv", "conv_id", "part", "no", "rows", "symbols").join(placed, ["conv", "part", "no"])
    result = f"conv_id {kind}, {RESULT}"
    streamed = inner.repartition("conv").sortWithinPartitions("conv", "part", "no").mapInArrow(_finish(_schema(result)), result)
    return first.where("done is not null").select("conv_id", "done.*").unionByName(streamed)
