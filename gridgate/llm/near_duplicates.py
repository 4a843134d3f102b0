"""MinHash near-dedup: a chosen-path set similarity join over word shingles, and the groups that its links form.

A text's words are runs of bytes other than blanks and line breaks (A-Z lower-cased); its set holds the distinct shingles
of five words, or the whole sequence of a shorter text. Texts with equal sets form a class, and one text stands for each.

Every text has `SIGNATURE` minwise tokens. A tree starts with all texts at its root; a node picks each token place with
probability 1 / (similarity * SIGNATURE), by a hash of its path, and each place parts the node's texts by their token
there. In expectation a pair at the threshold stays together along one branch per level, so that `TREES` independent
trees miss a pair in a node of depth d with probability (1 - p)**TREES, p = 0.63, 0.47, 0.37, ... for d = 1, 2, 3.

First, each text of a node is compared with the node's smallest one, and links that hold form groups. A node then needs only
pairs across groups. Where few texts are outside its largest group, those meet all of the node; other nodes of up to
`WHOLE_NODE` texts are compared whole, in blocks of `BLOCK` texts, each pair in the first branch that it shares. Larger nodes go down a
level, and at the last level all are compared, so no size is left out. A node of one group is done. Compared pairs pass a sketch of 256
minwise values, 4 bits of each; a text keeps the others that passed as one list. Links are confirmed on the full sets, in cells of
bounded size to which a set moves once, however many pairs it is in; a cell gives as many links as join its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from gridgate.llm.common import ready, staged, with_text
from gridgate.llm.kernels import LOWER, SPACE, blocks, hash_runs, mix, release, runs, spread, text_bytes

SHINGLE_WORDS = 5
MIN_PERCENT = 75
SIGNATURE = 128
TREES = 24
SMALL_NODE = 256
#: Nodes up to this size are compared whole as well, in blocks of texts; larger ones go down a level.
WHOLE_NODE, BLOCK = 16_384, 2048
#: Shingles of the texts that a cell of links to confirm holds, about; of the texts that one text is compared with at a time; links of a
#: text that go to one cell, about.
CELL_SHINGLES, CHUNK_SHINGLES, CELL_LINKS = 1 << 18, 1 << 18, 4096
LEVELS = 8
#: Minwise values of a sketch, of each of which 4 bits are kept, in columns of 16 values.
SKETCH = 256
COLUMNS = [f"sketch_{i}" for i in range(SKETCH // 16)]
#: Standard deviations by which a pair at the threshold may fall short of the sketch values it is expected to share: odds of 1.3e-6.
DEVIATIONS = 5

_RANDOM = np.random.default_rng(7)
_MULTIPLY = _RANDOM.integers(1, 2**63, SIGNATURE, dtype=np.uint64) | np.uint64(1)
_MIX_WORD = [int(x) | 1 for x in _RANDOM.integers(1, 2**63, 64, dtype=np.uint64)]
_MULTIPLY = np.concatenate([_MULTIPLY, _RANDOM.integers(1, 2**63, SKETCH - SIGNATURE, dtype=np.uint64) | np.uint64(1)])


def shingle_sets(table: pa.Table, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; none for a text without words."""
    data, offsets = text_bytes(table.column("text"))
    starts, ends = runs(~SPACE[data], offsets)
    hashes = hash_runs(LOWER[data], starts, ends)
    firsts = np.searchsorted(starts, offsets)
    joined = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        joined[:max(len(hashes) - k, 0)] += hashes[k:] * np.uint64(_MIX_WORD[k % 64] + 2 * (k // 64))
    joined = mix(joined)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= words:
            yield np.unique(joined[a:b - words + 1])
        elif b > a:
            factor = np.array([_MIX_WORD[k % 64] + 2 * (k // 64) for k in range(b - a)], np.uint64)
            yield mix(np.array([np.add.reduce(hashes[a:b] * factor) + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _features(words: int):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            sets = list(shingle_sets(table, words))
            sizes = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(sizes)
            signature = np.zeros((len(sets), SKETCH), np.uint64)
            one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            if full.size:
                flat = np.concatenate(sets)
                begin = (np.cumsum(sizes) - sizes)[full]
                one[full] = np.add.reduceat(flat, begin)
                two[full] = np.add.reduceat(mix(flat), begin)
                for k in range(SKETCH):
                    signature[full, k] = np.minimum.reduceat(flat * _MULTIPLY[k], begin)
            signature = mix(signature)
            nibbles = (signature & np.uint64(15)).astype(np.uint8)
            sketch = (nibbles[:, ::2] << np.uint8(4) | nibbles[:, 1::2]).view(np.int64)
            tokens = (signature[:, :SIGNATURE] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": table.column("doc_id").combine_chunks(), "n_shingles": pa.array(sizes),
                "set_a": pa.array(one.view(np.int64)), "set_b": pa.array(two.view(np.int64)),
                **{name: pa.array(sketch[:, i].copy()) for i, name in enumerate(COLUMNS)},
                "tokens": pa.ListArray.from_arrays(pa.array(np.arange(0, tokens.size + 1, SIGNATURE), pa.int32()),
                                                   pa.array(tokens.reshape(-1)))})

    return features


class IdFilter:
    """A Bloom filter of ids with a fixed number of bits, whatever the number of ids: it spares texts a shuffle, no more."""

    BITS, HASHES = 1 << 25, 4

    @staticmethod
    def of(ids: DataFrame) -> np.ndarray:
        places = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(IdFilter.BITS)) for k in range(IdFilter.HASHES)]))
        words = ids.select(places.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("held"))
        table = np.zeros(IdFilter.BITS // 32, np.uint32)
        found = words.toArrow()  # at most BITS / 32 rows
        table[found.column("word").to_numpy()] = (found.column("held").to_numpy() & 0xFFFFFFFF).astype(np.uint32)
        return table


    @staticmethod
    def places(name: str | Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(k), name), F.lit(IdFilter.BITS)) for k in range(IdFilter.HASHES)])

    @staticmethod
    def rows(table: DataFrame, ids: DataFrame) -> DataFrame:
        """The rows whose id may be among `ids`, and some others."""
        held = table.sparkSession.sparkContext.broadcast(IdFilter.of(ids))

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                hit = ((held.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1).all(1)
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1]).filter(pa.array(hit))

        return table.withColumn("places of id", IdFilter.places("id")).mapInArrow(some, table.schema)


def _sets(words: int, held):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            places = np.array(table.column("places").to_pylist(), np.int64).reshape(table.num_rows, -1)
            hit = ((held.value[places >> 5] >> (places & 31).astype(np.uint32)) & 1).all(1)
            table = table.filter(pa.array(hit)).combine_chunks()
            if not table.num_rows:
                continue
            each = list(shingle_sets(table, words))
            ends = np.concatenate(([0], np.cumsum([len(x) for x in each])))
            yield pa.RecordBatch.from_pydict({
                "id": table.column("doc_id").combine_chunks(),
                "shingles": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(each).view(np.int64)))})

    return sets


def _picked(node: int, place: int, odds: int) -> bool:
    """Whether a root picks a token place; the same rule as `_children` has for inner nodes, on a hash of its own."""
    return int(mix(np.array([node * 1_000_003 + place + 1], np.uint64))[0] % np.uint64(odds)) == 0


def _root_places(trees: int, odds: int) -> list[tuple[int, int]]:
    """Tree and token place of every first-level branch; a root that picks no place takes one by its number, so no tree is idle."""
    picked = [(tree, [place for place in range(SIGNATURE) if _picked(tree, place, odds)]) for tree in range(trees)]
    return [(tree, place) for tree, places in picked for place in places or [tree * 5 % SIGNATURE]]


def _roots(places: list[tuple[int, int]]) -> Column:
    """The tokens of a text at the places of the first-level branches; a branch and its token name a node."""
    return F.array(*[F.col("tokens")[place] for _, place in places])


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sketches are alike."""
    return (pairs.join(sketches.withColumnRenamed("id", "a").alias("x"), "a").join(sketches.withColumnRenamed("id", "b").alias("y"), "b")
            .where(_alike("x", "y", percent)).select("a", "b"))


def _grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Distinct a, ascending, and the distinct b of each."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
    a, b = a[fresh], b[fresh]
    starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[starts], pa.ListArray.from_arrays(pa.array(np.append(starts, len(a)), pa.int32()), pa.array(b, pa.int64()))


def _by_key(names: list[str], work):
    """`work` on the rows of each key, which lie together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                if key is not None and key != tuple(keys[start]):
                    out, held = work(pa.Table.from_batches(held)), []
                    if out is not None:
                        yield out
                key = tuple(keys[start])
                held.append(batch.slice(start, end - start))
        if held:
            out, held = work(pa.Table.from_batches(held)), []
            if out is not None:
                yield out
        release()

    return run


def _compared(percent: int):
    """Rows of a pair of blocks to the texts in them that may be linked, a list for the smaller id of each pair; where `roots` are given,
    a pair counts in its first common branch alone. Many small tables are compared at once."""
    most = _most(percent)
    schema = pa.schema([("a", pa.int64()), ("bs", pa.list_(pa.int64()))])

    def alike(sketch: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        differ = np.zeros(len(p), np.int64)
        for k in range(len(COLUMNS)):
            odd = sketch[k][p] ^ sketch[k][q]
            odd |= odd >> np.uint64(2)
            odd |= odd >> np.uint64(1)
            differ += np.bitwise_count(odd & np.uint64(0x1111111111111111))
            if k in (1, 3, 7, len(COLUMNS) - 1):  # too far apart already
                near = differ <= most
                p, q, differ = p[near], q[near], differ[near]
        return p, q

    def pairs(table: pa.Table, cuts: np.ndarray) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        whole = lambda name: table.column(name).to_numpy()
        ids, root, size, block, low, high = (whole(n) for n in ("id", "root", "n_shingles", "block", "low", "high"))
        sketch = [whole(n).view(np.uint64) for n in COLUMNS]
        branch, done = whole("branch"), table.column("done").fill_null(0).to_numpy()
        plain = table.column("roots").is_null().to_numpy()

        def worth(x, y):
            return (root[x] != root[y]) & (ids[x] != ids[y]) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y]))

        found = []
        length = np.diff(cuts)
        tiny = plain[cuts[:-1]] & (length <= SMALL_NODE)
        end = np.repeat(cuts[1:], length)
        row = np.flatnonzero(np.repeat(tiny, length))
        count = end[row] - row - 1
        for part in np.split(row, np.flatnonzero(np.diff(np.cumsum(count) >> 18)) + 1) if row.size else ():
            x, y = np.repeat(part, end[part] - part - 1), spread(part + 1, end[part] - part - 1)[0]
            apart = worth(x, y)
            found.append(alike(sketch, x[apart], y[apart]))
        for cell in np.flatnonzero(~tiny).tolist():
            here = np.arange(cuts[cell], cuts[cell + 1])
            first = here[0]
            left, right = here[block[here] == low[first]], here[block[here] == high[first]]
            one = low[first] == high[first]
            roots = None if plain[first] else table.column("roots").slice(first, len(here)).combine_chunks().flatten().to_numpy().reshape(len(here), -1)
            for start in range(0, len(left), 128):
                i = left[start:start + 128, None]
                apart = worth(i, right[None, :])
                if one:
                    apart &= i < right
                x, y = np.nonzero(apart)
                x, y = alike(sketch, i[x, 0], right[y])
                if roots is not None and len(x):
                    met = (roots[x - first] == roots[y - first]) & ((done[x][:, None] >> np.arange(roots.shape[1])) & 1).astype(bool)
                    mine = met.argmax(1) == branch[x]
                    x, y = x[mine], y[mine]
                found.append((x, y))
        p, q = (np.concatenate(side) for side in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        if not len(p):
            return None
        return pa.RecordBatch.from_arrays(list(_grouped(np.minimum(ids[p], ids[q]), np.maximum(ids[p], ids[q]))), schema=schema)

    def cuts_of(table: pa.Table) -> np.ndarray:
        keys = np.stack([table.column(n).to_numpy() for n in ("node", "low", "high")], 1)
        return np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= 4 * BLOCK:
                table = pa.Table.from_batches(held)
                cuts = cuts_of(table)
                if len(cuts) > 2:  # the last table may go on
                    out = pairs(table.slice(0, int(cuts[-2])), cuts[:-1])
                    held = table.slice(int(cuts[-2])).to_batches()
                    rows -= int(cuts[-2])
                    if out is not None:
                        yield out
        if held:
            table = pa.Table.from_batches(held)
            out = pairs(table, cuts_of(table))
            if out is not None:
                yield out
        held = table = None
        release()

    return run


def _within_nodes(members: DataFrame, percent: int) -> DataFrame:
    """What may be linked across groups of the same node. A node's texts are dealt into blocks by hash. Of a `whole` node, each pair of
    blocks is one small table; of others, each block is one, together with all texts outside the largest group."""
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("parts", parts).withColumn("block", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    met = dealt.withColumn("other", F.explode(F.when(~F.col("whole") & (F.col("root") == F.col("main")), F.array("block"))
                                              .otherwise(F.sequence(F.lit(0), F.col("parts") - 1))))
    met = met.withColumn("block", F.when(F.col("whole"), F.col("block")).otherwise(F.col("other")))
    met = met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    met = met.select("node", "low", "high", "block", "id", "root", "n_shingles", *COLUMNS, "branch", "done", "roots")
    keys = ["node", "low", "high"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compared(percent), "a long, bs array<long>")


def _children(odds: int) -> Column:
    """The nodes one level down of a text in `node`."""
    chosen = F.transform("tokens", lambda token, place: F.when(
        F.pmod(F.xxhash64(F.lit("pick"), F.col("node"), place), F.lit(odds)) == 0, F.xxhash64(F.col("node"), place, token)))
    return F.filter(chosen, lambda x: x.isNotNull())


def _most(percent: int, values: int = SKETCH) -> int:
    """Sketch values in which a pair may differ."""
    share = percent / 100 + (1 - percent / 100) / 16
    return int(values * (1 - share) + DEVIATIONS * (values * share * (1 - share)) ** 0.5)


def _alike(a: str, b: str, percent: int) -> Column:
    """What every linked pair fulfils: sizes within the ratio, and enough values of the sketch in common."""
    size_a, size_b = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    differ = F.lit(0)
    for name in COLUMNS:
        odd = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 2))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 1)).bitwiseAND(F.lit(0x1111111111111111))
        differ = differ + F.bit_count(odd)
    return (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)) & (differ <= _most(percent))


def _dealt(across: int, down: int):
    """Lists (a, bs) to cells, by a and by b: a row for a with its part of the list, and a row for each text of that part."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bs = batch.column("bs")
            b = bs.flatten().to_numpy()
            a = np.repeat(batch.column("a").to_numpy(), np.diff(bs.offsets.to_numpy()))
            part = lambda ids, n: (mix(ids.view(np.uint64)) % np.uint64(n)).astype(np.int64)
            cell = part(a, across) * down + part(b, down)
            order = np.lexsort((a, cell))
            cell, a, b = cell[order], a[order], b[order]
            starts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (cell[1:] != cell[:-1])))) if len(a) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell[starts]), pa.array(a[starts]), pa.ListArray.from_arrays(
                pa.array(np.append(starts, len(a)), pa.int32()), pa.array(b))], ["cell", "id", "bs"])
            order = np.lexsort((b, cell))
            cell, b = cell[order], b[order]
            fresh = np.concatenate(([True], (b[1:] != b[:-1]) | (cell[1:] != cell[:-1]))) if len(b) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(cell[fresh]), pa.array(b[fresh]), pa.ListArray.from_arrays(
                pa.array(np.zeros(int(fresh.sum()) + 1, np.int32)), pa.array([], pa.int64()))], ["cell", "id", "bs"])

    return dealt


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a batch of lists, each once: a text is in many lists of a large group."""
    for batch in batches:
        ids = np.concatenate((batch.column("a").to_numpy(), batch.column("bs").flatten().to_numpy()))
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(ids), pa.int64())], ["id"])


def _linked(percent: int):
    """Rows of a cell (id, bs, shingles) to links between its texts: those that hold on full sets, but for what others join already."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(table: pa.Table) -> pa.RecordBatch | None:
        table = table.take(pa.array(np.argsort(table.column("id").to_numpy(), kind="stable"))).combine_chunks()
        ids = table.column("id").to_numpy()
        lists, sets = (table.column(n).combine_chunks() for n in ("bs", "shingles"))
        wanted, edges = lists.flatten().to_numpy(), np.cumsum(np.concatenate(([0], lists.value_lengths().to_numpy())))
        flat, ends = sets.flatten().to_numpy().view(np.uint64), np.cumsum(np.concatenate(([0], sets.value_lengths().to_numpy())))
        size = np.diff(ends)
        parent = np.searchsorted(ids, ids).tolist()  # rows of one id belong together

        def top(row: int) -> int:
            while parent[row] != row:
                parent[row] = row = parent[parent[row]]
            return row

        links = []
        for row in np.flatnonzero(np.diff(edges)).tolist():
            mine = flat[ends[row]:ends[row + 1]]
            others = np.unique(wanted[edges[row]:edges[row + 1]])
            first, last = np.searchsorted(ids, others), np.searchsorted(ids, others, "right")
            others = spread(first, last - first)[0]
            chunk = (np.cumsum(size[others]) - size[others]) // CHUNK_SHINGLES
            for part in np.split(others, np.flatnonzero(np.diff(chunk)) + 1):
                part = np.array([x for x in part.tolist() if size[x] and top(x) != top(row)], np.int64)
                if not part.size or not mine.size:
                    continue
                at, _ = spread(ends[part], size[part])
                there = flat[at]
                hit = mine[np.minimum(np.searchsorted(mine, there), len(mine) - 1)] == there
                common = np.add.reduceat(hit, np.cumsum(size[part]) - size[part], dtype=np.int64)
                for other in part[100 * common >= percent * (len(mine) + size[part] - common)].tolist():
                    x, y = top(row), top(other)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        links.append((ids[row], ids[other]))
        return pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*links)], schema=schema) if links else None

    return _by_key(["cell"], linked)


def _confirm(lists: DataFrame, source: DataFrame, words: int, percent: int, typical: float) -> DataFrame:
    """Links (a, b) that join what the full sets of the texts a and bs link; `typical` is the shingles of a text on average.

    Sets are made of the texts that may be in a pair, and only those move: once by id and once to each cell that holds a pair of theirs.
    """
    lists = lists.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("bs"))).alias("bs"))
    lists = staged(lists, "pairs")
    n, longest = lists.agg(F.count("*"), F.max(F.size("bs"))).first()
    held = lists.sparkSession.sparkContext.broadcast(IdFilter.of(lists.mapInArrow(_named, "id long").distinct()))
    sets = source.select("doc_id", "text", IdFilter.places("doc_id").alias("places")).mapInArrow(_sets(words, held), "id long, shingles array<long>")
    across, down = max(1, int(n * typical / CELL_SHINGLES)), 1 + (longest or 0) // CELL_LINKS
    dealt = lists.mapInArrow(_dealt(across, down), "cell long, id long, bs array<long>").repartition("id")
    dealt = dealt.groupBy("id", "cell").agg(F.flatten(F.collect_list("bs")).alias("bs"))
    return dealt.join(sets, "id").repartition("cell").sortWithinPartitions("cell").mapInArrow(_linked(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id, root the smallest id it can reach: large-star and small-star steps until nothing moves."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = edges.unionByName(least.where("u <> m").select("u", F.col("m").alias("v"))).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(edges.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root"))
        seen = now


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    percent: int = MIN_PERCENT, trees: int = TREES, small: int = SMALL_NODE,
                    largest: int = WHOLE_NODE, levels: int = LEVELS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (it is its own).

    Null, empty and blank texts have no shingles and are linked with nothing. Texts of equal sets are linked with each
    other. A row without an id stands alone and is kept; rows of one id belong together. An empty table gives an empty result.
    """
    ready(docs.sparkSession)
    odds = round(SIGNATURE * percent / 100)
    source = with_text(docs, id_col, text_col)
    schema = f"doc_id long, n_shingles long, set_a long, set_b long, {', '.join(f'{c} long' for c in COLUMNS)}, tokens array<int>"
    features = staged(source.mapInArrow(_features(words), schema), "features")
    key = ["set_a", "set_b", "n_shingles"]
    classes = features.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("id"))
    classes = staged(classes, "classes")
    places = _root_places(trees, odds)
    reps = features.select(F.col("doc_id").alias("id"), "n_shingles", *COLUMNS, _roots(places).alias("roots"))
    reps = staged(reps.join(classes.select("id"), "id", "left_semi"), "texts")
    sketches = reps.select("id", "n_shingles", *COLUMNS)
    members = reps.select("id", F.posexplode("roots").alias("branch", "token")).select(
        "id", "branch", F.xxhash64("branch", "token").alias("node"))
    nodes = members.groupBy("node").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = staged(members.join(nodes, "node"), "members")
    stars = members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    typical = classes.agg(F.avg("n_shingles")).first()[0] or 1.0
    stars = _near(stars, sketches, percent).select("a", F.array("b").alias("bs"))
    links = staged(_confirm(stars, source, words, percent, typical), "links")
    groups, lists, tokens = staged(components(links), "groups"), None, features.select(F.col("doc_id").alias("id"), "tokens")
    for level in range(1, levels + 1):
        tagged = members.select("id", "branch", "node").join(groups, "id", "left").withColumn("root", F.coalesce("root", "id"))
        sizes = tagged.groupBy("node", "root").agg(F.count("*").alias("n")).groupBy("node").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most"))
        sizes = sizes.select("node", "n", F.col("most.root").alias("main"), (F.col("n") - F.col("most.n")).alias("rest")).where("rest > 0")
        tagged = staged(tagged.join(sizes, "node"), "open")
        few = (F.col("n") <= small) | (F.col("rest") <= small)
        whole = ~few & (F.lit(True) if level == levels else F.col("n") <= largest)
        large = tagged.where(whole)
        done = large.groupBy("id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("branch"))).alias("done"))
        met = tagged.withColumn("whole", whole).where(few | F.col("whole")).join(done, "id", "left").join(reps, "id")
        met = met.withColumn("roots", F.when(F.col("whole") & F.lit(level == 1), F.col("roots")))
        fresh = staged(_within_nodes(met, percent), "alike")
        lists = fresh if lists is None else lists.unionByName(fresh)
        deep = tagged.where(~few & ~whole)
        if level == levels or deep.isEmpty():
            break
        tokens, reps = (IdFilter.rows(table, deep.select("id").distinct()) for table in (tokens, reps))
        tokens = staged(tokens.dropDuplicates(["id"]), "tokens")
        members = deep.select("id", "node").join(tokens, "id").select("id", F.lit(0).alias("branch"), F.explode(_children(odds)).alias("node"))
    links = staged(links.unionByName(_confirm(lists, source, words, percent, typical)), "links")
    groups = components(links)
    named = classes.join(groups, "id", "left").select(*key, F.coalesce("root", "id").alias("root"))
    return (features.select("doc_id", *key).join(named, key, "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("component_id").eqNullSafe(F.col("doc_id"))))


def drop_near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """The documents without those that are not the smallest of their group; all columns as they are.

    Only rows whose id may be among the dropped ones are dealt out to be checked; all others stay where they are.
    """
    gone = staged(near_duplicates(docs, percent=percent).where("not kept").select(F.col("doc_id").alias("id")).distinct(), "dropped")
    held = docs.sparkSession.sparkContext.broadcast(IdFilter.of(gone))
    places = IdFilter.places(F.col("doc_id").cast("long"))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.array(batch.column(batch.num_columns - 1).to_pylist(), np.int64).reshape(batch.num_rows, -1)
            hit = ((held.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1).all(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hit)], [*batch.schema.names[:-1], "maybe dropped"])

    kind = StructType([*docs.schema.fields, StructField("maybe dropped", BooleanType())])
    marked = docs.withColumn("places of id", places).mapInArrow(maybe, kind)
    stay = marked.where("not `maybe dropped`").drop("maybe dropped")
    check = marked.where("`maybe dropped`").drop("maybe dropped")
    return stay.unionByName(check.join(gone, check["doc_id"].cast("long") == gone["id"], "left_anti"))
