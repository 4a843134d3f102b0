"""Whitening of vectors: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Each entry c becomes the integer x = floor(1024 * c) + 100000. Counts, sums and scatter are exact integers, added up by Spark
expressions alone: vectors are centred by the rounded mean before they are multiplied, and what rounding left over is taken off
exactly. Only the scatter, width by width numbers whatever the number of rows, reaches the driver, where it is factorised. Rotating
the columns of the triangular factor until all are at right angles makes their squared norms the eigenvalues and the normalised
columns the components; the scatter itself is never rotated, so small eigenvalues keep their relative accuracy.

Defined cases: a vector that is null or holds a null or non-finite entry takes no part and gets no rows. The width is the most
frequent length of the others (of equally frequent ones the longest); vectors of another length take no part either. Repeated rows
count as often as they stand there; a null id is an id. Components of eigenvalue zero (constant or dependent dimensions) are left
out, so there may be fewer than asked for, or none, and then no rows. An empty table gives no rows. Further columns are not read. An
entry of 2**36 or more in size is an error, since its products would not be exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import staged

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = 2.0 ** 36
#: Columns of the scatter that one row of the aggregation adds up.
BLOCK = 64
#: A pivot below this part of the largest variance is rounding, not rank.
RANK = 1e-14


@dataclass(frozen=True)
class Whitening:
    """Count, centre and what is left of the sums after centring; eigenvalues in falling order with components as columns."""

    n: int
    centre: list[int]
    left_over: list[int]
    widest: int
    values: np.ndarray
    components: np.ndarray
    trace: float


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the integers x of every vector that takes part, from a written copy."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    sound = vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    exact = F.when(F.exists(vector, lambda c: F.abs(c) >= LARGEST), F.raise_error(F.lit("entry too large to be whitened exactly")).cast("array<double>")).otherwise(vector)
    x = vectors.where(sound).select(F.col(f"`{id_col}`").alias("vec_id"), F.transform(exact, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    x = staged(x, "integers")
    widths = x.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    return x.where(F.size("x") == (widths[0]["width"] if widths else 0))


def _longs(numbers: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in numbers]).cast("array<bigint>")


def _whole(largest: int) -> str:
    """The integer type that holds sums up to this size: the results are the same, only wide data pay for decimals."""
    return "bigint" if largest < 2 ** 63 else "decimal(38,0)"


def _column_sums(x: DataFrame) -> tuple[int, list[int], int]:
    """Count, sum per dimension, and the largest distance of two entries of one dimension."""
    entries = x.select(F.posexplode("x").alias("j", "v"))
    rows = entries.groupBy("j").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("j").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows], max((r["hi"] - r["lo"] for r in rows), default=0)


def _scatter(x: DataFrame, n: int, centre: list[int], widest: int) -> list[list[int]]:
    """Sums of products of the centred entries: in every task a row per dimension and block of BLOCK others."""
    width = len(centre)
    number = _whole((widest + 1) ** 2 * n)
    y = x.select(F.zip_with("x", _longs(centre), lambda a, c: a - c).alias("y"))
    parts = y.select("y", F.posexplode("y").alias("i", "yi")).select("i", "yi", "y", F.explode(F.sequence(F.floor(F.col("i") / BLOCK).cast("int"), F.lit((width - 1) // BLOCK))).alias("b"))
    if width > BLOCK:
        parts = parts.withColumn("y", F.slice("y", F.col("b") * BLOCK + 1, F.lit(BLOCK)))
    cast = (lambda c: c) if number == "bigint" else (lambda c: c.cast("decimal(19,0)"))
    sums = [F.sum(cast(F.col("yi")) * cast(F.get("y", F.lit(j)))).alias(f"s{j}") for j in range(min(width, BLOCK))]
    out = [[0] * width for _ in range(width)]
    for row in parts.groupBy("i", "b").agg(*sums).collect():
        for j in range(min(BLOCK, width - row["b"] * BLOCK)):
            out[row["i"]][row["b"] * BLOCK + j] = out[row["b"] * BLOCK + j][row["i"]] = int(row[f"s{j}"])
    return out


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L with as many columns as the rank, L L' = v: lower triangular once its rows are put in the order of the pivots."""
    rest, columns = v.copy(), []
    limit = RANK * max(float(np.diag(v).max(initial=0.0)), 0.0)
    for _ in range(len(v)):
        p = int(np.argmax(np.diag(rest)))
        if rest[p, p] <= limit:
            break
        columns.append(rest[:, p] / np.sqrt(rest[p, p]))
        rest = rest - np.outer(columns[-1], columns[-1])
        rest[p, :] = rest[:, p] = 0.0
    return np.array(columns).T.reshape(len(v), len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns, rotated in disjoint pairs until each two of them are at right angles."""
    a = factor.copy()
    r = a.shape[1]
    order = list(range(r + r % 2))
    half = len(order) // 2
    for _ in range(sweeps):
        turned = False
        for _ in range(len(order) - 1):
            pairs = [(i, j) for i, j in zip(order[:half], order[::-1][:half]) if i < r and j < r]
            order = [order[0], order[-1], *order[1:-1]]
            p, q = (np.array(k, dtype=int) for k in zip(*pairs)) if pairs else (np.array([], int),) * 2
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (left ** 2).sum(0), (right ** 2).sum(0), (left * right).sum(0)
            skew = np.abs(gamma) > 1e-15 * np.sqrt(alpha * beta)
            if not skew.any():
                continue
            turned = True
            zeta = (beta - alpha) / np.where(skew, 2 * gamma, 1)
            t = np.where(skew, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta)), 0)
            c = 1 / np.hypot(1, t)
            a[:, p], a[:, q] = c * left - c * t * right, c * t * left + c * right
        if not turned:
            break
    return a


def fit(x: DataFrame) -> Whitening | None:
    """The whitening of all integer vectors; None where there are none, or none of any length."""
    n, sums, widest = _column_sums(x)
    if not sums:
        return None
    centre = [(2 * s + n) // (2 * n) for s in sums]
    left_over = [s - n * c for s, c in zip(sums, centre)]
    products = _scatter(x, n, centre, widest)
    v = np.array([[(n * pij - ri * rj) / (n * n) for pij, rj in zip(row, left_over)] for row, ri in zip(products, left_over)])
    turned = one_sided_jacobi(pivoted_cholesky(v))
    norms = (turned ** 2).sum(0)
    order = np.argsort(-norms, kind="stable")
    return Whitening(n, centre, left_over, widest, norms[order], turned[:, order] / np.sqrt(norms[order]), float(np.trace(v)))


def whiten(x: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """Per vector: vec_id, deviation (exact sum of (n x - S)**2, decimal(38,0)), whitened (array, one value per component)."""
    k = min(components, len(model.values))
    number = _whole((model.n * (model.widest + 1)) ** 2 * len(model.centre))
    offset = F.zip_with(F.zip_with("x", _longs(model.centre), lambda a, c: a - c), _longs(model.left_over),
                        lambda y, r: (y.cast(number) * F.lit(model.n).cast(number)).cast(number) - r.cast(number))
    weights = model.components[:, :k] / (model.n * np.sqrt(model.values[:k]))
    rows = x.select("vec_id", F.transform(offset, lambda z: z.cast(number)).alias("z"))
    zero = F.lit(0).cast(number)
    project = lambda w: F.aggregate(F.zip_with("z", F.array(*map(F.lit, w.tolist())), lambda z, c: z.cast("double") * c), F.lit(0.0), lambda s, v: s + v)
    return rows.select("vec_id", F.aggregate("z", zero, lambda s, z: (s + (z * z).cast(number)).cast(number)).cast("decimal(38,0)").alias("deviation"),
                       F.array(*[project(weights[:, j]) for j in range(k)]).cast("array<double>").alias("whitened"))


def identity_error(whitened: DataFrame, k: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    found = whitened.agg(*[F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) for a, b in pairs]).first() if pairs else []
    return max((abs(value - (a == b)) for value, (a, b) in zip(found, pairs)), default=0.0)


SCHEMA = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per vector and component (from 1): vec_id, component, n, deviation, whitened, explained, identity_error."""
    x = integers(vectors, id_col, vector_col)
    model = fit(x)
    k = min(count, len(model.values)) if model else 0
    if not k:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        empty = x.where("false")
        return empty.select("vec_id", *[F.lit(None).cast(c.split()[1]).alias(name) for name, c in zip(names, SCHEMA.split(", "))])
    rows = staged(whiten(x, model, count), "whitened")
    shares = F.array(*[F.lit(float(v) / model.trace) for v in model.values[:k]])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        shares[F.col("place")].alias("explained"), F.lit(identity_error(rows, k)).alias("identity_error"))
