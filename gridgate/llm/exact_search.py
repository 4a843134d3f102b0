"""Exact top-k search by inner product: cover trees over queries and data, walked together.

Vectors are dealt out to cells around at most `CELLS` pivots (a bounded sample), and a cell into blocks of at most `BLOCK`
distinct vectors; equal vectors share one entry that keeps their k + 1 smallest ids, all that any result can name. Each
block holds a cover tree; the queries of a block form trees of their own. Two rounds:

1. Query trees meet the block that they come from, which gives each query a k-th score.
2. They then meet each other block of a cell whose bound <c, c'> + |c| r' + |c'| r + r r' reaches the worst k-th score of their
   queries. Cell bounds are few (at most `CELLS`) and broadcast; blocks and node pairs inside are pruned by the same bound. A block
   goes to a task once for the query trees that meet it there, and only what reaches a query's k-th score comes back.

Leaves are wide, as one product of two of them costs less than to walk and bound many small pairs.

Scores are whole numbers, exact in doubles or, for long vectors, in 64-bit integers; bounds carry a margin for rounding.

The trees depart from a textbook cover tree in two points: a node's centre is the mean of its points, which makes radii smaller,
and a node has at most 16 children, since in many dimensions a cover by half the radius takes nearly every point for itself.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgate.llm.common import ready, staged

CELLS = 256
BLOCK = 4096
LEAF = 512
QUERY_BLOCK = 256
#: Query trees that meet a block in the same task, about.
MEETINGS = 256


class CoverTree:
    """Nodes with a centre, the radius that covers all points below, and children; points are ordered so that a node is a range.

    Children of a node of radius r are centred on points that lie more than r / 2 apart, and each point goes to the nearest.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.centres, self.radii, self.ranges, self.children = [], [], [], []
        self.points = points.astype(np.float64)
        self._grow(0, len(points), leaf)
        self.points = self.points[self.order]
        self.centres, self.radii = np.array(self.centres), np.array(self.radii)
        self.norms = np.linalg.norm(self.centres, axis=1) if len(points) else np.zeros(0)

    def packed(self) -> tuple:
        whole = self.points.astype(np.int64)
        return whole.astype(np.result_type(np.min_scalar_type(-1), *map(np.min_scalar_type, (whole.min(initial=0), whole.max(initial=0))))), self.centres, self.radii, self.norms, self.ranges, self.children

    @classmethod
    def of(cls, packed: tuple) -> CoverTree:
        tree = cls.__new__(cls)
        points, tree.centres, tree.radii, tree.norms, tree.ranges, tree.children = packed
        tree.points = points.astype(np.float64)
        return tree

    def _grow(self, low: int, high: int, leaf: int) -> int:
        rows = self.order[low:high]
        mine = self.points[rows]
        centre = mine.mean(0) if len(mine) else np.zeros(self.points.shape[1])
        distance = np.sqrt(((mine - centre) ** 2).sum(1))
        radius = float(distance.max()) if len(mine) else 0.0
        node = len(self.radii)
        self.centres.append(centre)
        self.radii.append(radius)
        self.ranges.append((low, high))
        self.children.append([])
        if high - low <= leaf or radius == 0:
            return node
        nearest, group, heads = np.full(len(mine), np.inf), np.zeros(len(mine), np.int64), 0
        pick = int(distance.argmax())
        while heads < 16 and (heads < 2 or nearest.max() > radius / 2):
            apart = np.sqrt(((mine - mine[pick]) ** 2).sum(1))
            group[apart < nearest] = heads
            nearest = np.minimum(nearest, apart)
            heads += 1
            pick = int(nearest.argmax())
        by = np.argsort(group, kind="stable")
        self.order[low:high] = rows[by]
        edges = low + np.searchsorted(group[by], np.arange(heads + 1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if a < b:
                self.children[node].append(self._grow(a, b, leaf))
        return node


class Best:
    """The k best (score, id) of each query so far, best first."""

    def __init__(self, query_ids: np.ndarray, k: int, scores: np.ndarray | None = None, ids: np.ndarray | None = None):
        self.query_ids, self.k = query_ids, k
        self.scores = np.full((len(query_ids), k), -np.inf) if scores is None else scores
        self.ids = np.full((len(query_ids), k), np.iinfo(np.int64).max) if ids is None else ids

    def packed(self) -> tuple:
        return self.query_ids, self.k, self.scores, self.ids

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores and ids (queries by candidates) for the queries `rows`; a query's own id is left out."""
        ids = np.broadcast_to(ids, scores.shape)
        scores = np.where((ids == self.query_ids[rows][:, None]) | (ids == np.iinfo(np.int64).max), -np.inf, scores)
        if scores.dtype != self.scores.dtype:  # doubles until some score needs more digits
            self.scores = self.scores.astype(np.result_type(self.scores, scores))
        everything, names = np.hstack((self.scores[rows], scores)), np.hstack((self.ids[rows], ids))
        names = np.where(np.isneginf(everything), np.iinfo(np.int64).max, names)
        order = np.lexsort((names, -everything), axis=1)[:, :self.k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(everything, order, 1), np.take_along_axis(names, order, 1)


def dual_tree(queries: CoverTree, data: CoverTree, ids: np.ndarray, best: Best, floor: np.ndarray | None = None) -> None:
    """Offer every pair that may count. `ids` has a row of ids per data point of the tree; `best` is by tree order of queries, and so is
    `floor`, scores that a pair has to reach."""
    if not len(queries.points) or not len(data.points):
        return
    floor = np.full(len(queries.points), -np.inf) if floor is None else floor
    largest = np.sqrt((queries.points ** 2).sum(1).max() * (data.points ** 2).sum(1).max())
    stack = [(0, 0)]
    while stack:
        q, d = stack.pop()
        low, high = queries.ranges[q]
        reach = _bound(queries.centres[q], queries.norms[q], queries.radii[q], data.centres[d], data.norms[d], data.radii[d])
        least = np.maximum(best.scores[low:high, -1], floor[low:high])
        if reach < least.min():
            continue
        q_children, d_children = queries.children[q], data.children[d]
        if not q_children and not d_children:
            a, b = data.ranges[d]
            scores = _scores(queries.points[low:high], data.points[a:b], largest if largest < 2.0 ** 52 else None)
            useful = scores >= least[:, None]
            rows, points = np.flatnonzero(useful.any(1)), np.flatnonzero(useful.any(0))
            if points.size:
                point, copy = np.nonzero(ids[a + points] != np.iinfo(np.int64).max)
                worth = np.where(useful[rows][:, points], scores[rows][:, points], -np.inf)
                best.offer(low + rows, worth[:, point], ids[a + points[point], copy])
        elif d_children and (not q_children or data.radii[d] >= queries.radii[q]):
            near = data.centres[d_children] @ queries.centres[q]
            stack += [(q, d_children[k]) for k in np.argsort(near).tolist()]  # the most promising is taken first
        else:
            stack += [(c, d) for c in q_children]


def _scores(a: np.ndarray, b: np.ndarray, largest: float | None = None) -> np.ndarray:
    """Exact inner products: in doubles where no sum can leave their whole numbers, else in 64-bit integers. `largest`: no product is larger."""
    largest = np.sqrt((a ** 2).sum(1).max() * (b ** 2).sum(1).max()) if largest is None else largest
    if largest < 2.0 ** 52:
        return a @ b.T
    if largest >= 9.2e18 or max(np.abs(a).max(), np.abs(b).max()) >= 2.0 ** 53:
        if len(a) > 32:  # long vectors may be among few only
            return np.vstack([_scores(x, b) for x in np.array_split(a, 2)])
        if len(b) > 32:
            return np.hstack([_scores(a, x) for x in np.array_split(b, 2)])
        raise ValueError("vectors too long: a score would not fit 64 bits")
    return (a.astype(np.int64) @ b.astype(np.int64).T).astype(np.longdouble)


def _bound(c, n, r, c2, n2, r2):
    """No inner product of a point within r of c and one within r2 of c2 is larger."""
    return (c * c2).sum(-1) + n * r2 + n2 * r + r * r2 + 1e-6 * (1 + (n + r) * (n2 + r2))


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id and the vector with components floor(scale * x), as long; rows with a null or non-finite component, and those
    of another length than the most frequent one (of equally frequent ones the longest), are left out."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    whole = held.where(fine).select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(scale))).alias("v"))
    lengths = whole.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return whole.where(F.size("v") == lengths[0]["n"]) if lengths else whole


def _to_cells(pivots: np.ndarray):
    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, v = batch.num_rows, batch.column("v")
            if not n:
                continue
            cell, away = np.zeros(n, np.int32), np.full(n, np.inf)
            if (v.value_lengths().to_numpy() == pivots.shape[1]).all():
                x = v.flatten().to_numpy().reshape(n, -1).astype(np.float64)
                cell = ((x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)).argmin(1).astype(np.int32)
                away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cell), batch.column("v"), pa.array(away)], ["vec_id", "cell", "v", "away"])

    return to_cells


def _build(k: int):
    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack([np.asarray(x, np.int64) for x in frame["v"]])
        ids = np.full((len(frame), k + 1), np.iinfo(np.int64).max)
        for row, held in enumerate(frame["ids"]):
            ids[row, :len(held)] = held
        tree = CoverTree(vectors)
        return pd.DataFrame({"cell": [int(key[0])], "block": [int(key[1])], "tree": [pickle.dumps((tree.packed(), ids[tree.order]))]})

    return build


def _query_trees(k: int):
    def query_trees(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        tree = CoverTree(np.stack([np.asarray(x, np.int64) for x in frame["v"]]))
        best = Best(frame["vec_id"].to_numpy()[tree.order], k)
        return pd.DataFrame({"cell": [int(key[0])], "block": [int(key[1])], "node": [f"{key[0]}/{key[1]}/{key[2]}"], "queries": [pickle.dumps((tree.packed(), best.packed()))]})

    return query_trees


def _loaded(raw: bytes) -> tuple[CoverTree, Best]:
    tree, best = pickle.loads(raw)
    return CoverTree.of(tree), Best(*best)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the query tree and the data tree of each row; both sides keep what they are, the bests move on."""
    for batch in batches:
        for row in batch.to_pylist():
            queries, best = _loaded(row["queries"])
            data, ids = pickle.loads(row["tree"])
            dual_tree(queries, CoverTree.of(data), ids, best)
            yield pa.RecordBatch.from_pydict({"cell": [row["cell"]], "node": [row["node"]], "queries": pa.array([pickle.dumps((queries.packed(), best.packed()))], pa.binary())},
                                             schema=pa.schema([("cell", pa.int32()), ("node", pa.string()), ("queries", pa.binary())]))


def _visits(cells: dict[int, tuple[np.ndarray, np.ndarray]]):
    """The cells that a query tree has to visit: the ball around their pivot has a bound that reaches its worst k-th score. What goes
    there is the tree, its ids and k-th scores, but not its lists."""
    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sorted(cells)
        if not names:
            return
        centre, radius = np.array([cells[c][0] for c in names]), np.array([cells[c][1] for c in names])
        norm = np.linalg.norm(centre, axis=1)
        for batch in batches:
            for row in batch.to_pylist():
                queries, best = _loaded(row["queries"])
                reach = _bound(centre, norm, radius, queries.centres[0], queries.norms[0], queries.radii[0])
                go = [names[k] for k in np.flatnonzero(reach >= best.scores[:, -1].min())]
                packed = pickle.dumps((queries.packed(), (best.query_ids, best.k, best.scores[:, -1])))
                yield pa.RecordBatch.from_pydict({"cell": pa.array(go, pa.int32()), "node": pa.array([row["node"]] * len(go), pa.string()),
                                                  "packed": pa.array([packed] * len(go), pa.binary())})

    return visits


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block, its tree (without a node) before the query trees that meet it, to the pairs that reach a query's k-th score."""
    at = data = None
    for batch in batches:
        for row in batch.to_pylist():
            here = row["cell"], row["block"]
            if row["node"] is None:
                tree, ids = pickle.loads(row["packed"])
                at, data = here, CoverTree.of(tree)
                continue
            if at != here or row["node"].startswith(f"{here[0]}/{here[1]}/"):  # no tree, or where the queries come from
                continue
            tree, (names, k, floor) = pickle.loads(row["packed"])
            best = Best(names, k)
            dual_tree(CoverTree.of(tree), data, ids, best, floor)
            yield _pairs(best)


def _pairs(best: Best) -> pa.RecordBatch:
    real = np.isfinite(best.scores)
    return pa.RecordBatch.from_pydict({"query_id": pa.array(np.repeat(best.query_ids, real.sum(1))), "vec_id": pa.array(best.ids[real]),
                                       "score": pa.array(best.scores[real].astype(np.int64))})


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _pairs(_loaded(row["queries"])[1])


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding",
          cells: int = CELLS, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each query row, ties to the smaller id.

    `is_query` is a condition on vec_id. Vectors that are null or hold null or non-finite components take no part, nor do those of
    another length than the most frequent one; rows without an id neither. Fewer than k other rows: all of them. An empty table
    gives no row. A row given more than once counts once; rows of one id with different vectors each keep their score, and a query
    id with several vectors has one list over all of them. Further columns are not read. A score that 64 bits cannot hold is an error.
    """
    spark = ready(vectors.sparkSession)
    whole = quantised(vectors, id_col, vector_col, scale)
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(cells, whole.count() * 4 // block))).collect()
    pivots = np.unique(np.array([r.v for r in sample], np.float64).reshape(len(sample), -1), axis=0) if sample else np.zeros((1, 1))
    placed = staged(whole.mapInArrow(_to_cells(pivots), "vec_id long, cell int, v array<long>, away double"), "vectors")
    # equal vectors: the k + 1 smallest ids of each, cut in every task before they meet
    place = F.dense_rank().over(Window.partitionBy("cell", "v").orderBy("vec_id"))
    entries = placed.select("cell", "v", "vec_id").withColumn("place", place).where(F.col("place") <= k + 1)
    entries = entries.groupBy("cell", "v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    covers = {r.cell: (pivots[r.cell], float(r.radius)) for r in sizes.collect()}  # a row per pivot
    sizes = sizes.drop("radius")
    entries = entries.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / block)).cast("int")).drop("n")
    trees = staged(entries.groupBy("cell", "block").applyInPandas(
        _build(k), "cell int, block int, tree binary"), "trees")
    queries = placed.where(is_query).join(F.broadcast(sizes), "cell")
    blocks_of = F.pmod(F.xxhash64("v"), F.ceil(F.col("n") / block)).cast("int")
    queries = queries.select("vec_id", "cell", "v", blocks_of.alias("block"),
                             F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / (20 * QUERY_BLOCK))).cast("int").alias("part"))
    nodes = queries.groupBy("cell", "block", "part").applyInPandas(_query_trees(k), "cell int, block int, node string, queries binary")
    met = staged(nodes.join(trees.select("cell", "block", "tree"), ["cell", "block"]).mapInArrow(_meet, "cell int, node string, queries binary"), "queries")
    home = met.select("cell", "node", "queries")
    salts = 1 + home.count() // MEETINGS
    ahead = home.mapInArrow(_visits(covers), "cell int, node string, packed binary").join(F.broadcast(sizes), "cell")
    ahead = ahead.select("cell", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / block).cast("int") - 1)).alias("block"),
                         F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int").alias("salt"), "node", "packed")
    held = trees.select("cell", "block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(None).cast("string").alias("node"),
                        F.col("tree").alias("packed"))
    keys = ["cell", "block", "salt"]
    found = ahead.unionByName(held).repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_first("node"))
    pairs = "query_id long, vec_id long, score long"
    rows = found.mapInArrow(_walk, pairs).unionByName(home.mapInArrow(_results, pairs)).distinct()
    rows = rows.groupBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(8)).alias("slice")).agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))), 1, k).alias("best"))
    rows = rows.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return rows.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.down")).alias("score"))
