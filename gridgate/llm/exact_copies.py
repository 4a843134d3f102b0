"""Exact duplicates: rows meet by a 128-bit content hash and count as equal once their bytes are.

The plan is JVM expressions only. One aggregation per hash yields the row that stays, the number of rows, and the least and
largest text, cut down in every task before the shuffle; a group is pure when these two are the same bytes. Impure groups
(hash collisions) are grouped again by their whole text. Groups that hold a ten-thousandth of all rows or more, at most
10,000 of them, meet their rows by a broadcast; the rest by a shuffle of ids and hashes, in which no key is larger than that share.

Defined cases: a null text is an empty text; empty texts are equal to each other. Rows with a null id take part, a non-null id
stays before them, and a group of null ids keeps them all. Rows of one group that repeat an id are one document: they stay or
go together, and each counts in the group's size. Other columns pass through under any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridgate.llm.common import staged

#: Groups of this part of all rows, or more, are broadcast: never more groups than the number says.
HOT_PART = 10_000


def content_hash(text: Column) -> Column:
    """The first 128 bits of the text's SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _wrapped(docs: DataFrame, id_col: str, text_col: str, fingerprint: Callable[[Column], Column]) -> DataFrame:
    """The row in one struct, so that no name can clash, beside its id, the bytes of its text, and their hash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    wrapped = docs.select(F.struct("*").alias("row"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    return wrapped.withColumn("hash", fingerprint(F.col("text")))


def _best(keep: str) -> Callable[[str], Column]:
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    return F.max if keep == "largest" else F.min


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                fingerprint: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Every row as `row`, with its `id`, `text` (bytes), the `keep_id` that stays of its equal texts, their number `n`, and `kept`."""
    best = _best(keep)
    rows = _wrapped(docs, id_col, text_col, fingerprint)
    groups = staged(rows.groupBy("hash").agg(F.count("*").alias("n"), best("id").alias("keep_id"),
                                             (F.min("text") == F.max("text")).alias("pure")), "copies")
    total = groups.agg(F.sum("n")).first()[0] or 0
    found = _joined(rows, groups, total)
    if groups.where("not pure").isEmpty():
        return _judged(found)
    impure = rows.join(groups.where("not pure").select("hash"), "hash", "left_semi")
    texts = staged(impure.groupBy("hash", "text").agg(F.count("*").alias("n"), best("id").alias("keep_id")), "collisions")
    apart = impure.join(texts, ["hash", "text"]).select("row", "id", "text", "keep_id", "n")
    return _judged(found.unionByName(apart))


def _joined(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """The rows of pure groups beside what their group knows."""
    hot = F.col("n") * HOT_PART >= total
    few = groups.where(hot).select("hash", F.struct("n", "keep_id", "pure").alias("hot"))
    rest = groups.where(~hot).select(F.col("hash").alias("rest_hash"), F.struct("n", "keep_id", "pure").alias("cold"))
    met = rows.join(F.broadcast(few), "hash", "left")
    # Rows that have met go on under a longer key that no group has and that spreads them.
    key = F.when(F.col("hot").isNull(), F.col("hash")).otherwise(F.concat("hash", F.coalesce(F.col("id").cast("string").cast("binary"), F.lit(b"-"))))
    met = met.withColumn("key", key).join(rest, F.col("key") == F.col("rest_hash"), "left")
    return met.withColumn("group", F.coalesce("hot", "cold")).where("group.pure").select("row", "id", "text", "group.keep_id", "group.n")


def _judged(found: DataFrame) -> DataFrame:
    return found.withColumn("kept", F.col("keep_id").isNull() | F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
           fingerprint: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    return with_copies(docs, id_col, text_col, keep, fingerprint).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").cast("long").alias("group_size"), "kept", F.sha2("text", 256).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The rows that stay, with all their columns."""
    return with_copies(docs, id_col, text_col, keep).where("kept").select("row.*")
