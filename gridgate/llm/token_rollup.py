"""Token counts: a store of additive totals by source, language and tokenizer version, kept by signed deltas.

A change to the corpus is a batch of rows (source, lang, tokenizer_version, sign, tokens): +1 for an insert, -1 for a delete,
and for a revised count the old row with -1 and the new one with +1. A batch is summed per key before anything is moved or
written, and its few rows are committed under the batch's id by Spark's own commit: the folder counts only once its success
marker is there. A batch that is sent again finds itself committed and changes nothing, one that failed half-way is
written anew, and another content under a known id is refused. Totals are the sums over committed batches;
`compact` folds them into a snapshot that names what it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer_version")
#: What each tokenizer version counts, as patterns of one token.
VERSIONS = {"words-1": "[^\\x20\\x09-\\x0D]+", "words-2": "[^\\x20\\x09-\\x0D|]+"}


def token_count(text: Column, version: str) -> Column:
    """Tokens of a text under a version; null texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(VERSIONS[version])).cast("long")


def counted(docs: DataFrame, version: str, named: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the keys and tokens of each document, under the name `named` for the version."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.lit(named or version).alias("tokenizer_version"), token_count(F.col(f"`{text_col}`"), version).alias("tokens"))


def inserted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(1))


def deleted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sign", F.lit(-1))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """What to take back and what to add for rows counted anew."""
    return deleted(old).unionByName(inserted(new))


class RollupStore:
    """Totals in a folder that all executors share. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _committed(self, kind: str) -> list[str]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        names = sorted(x.getPath().getName() for x in system.listStatus(root))
        return [n for n in names if self._exists(f"{self.path}/{kind}/{n}/_SUCCESS")]

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add a batch; False, and no change, if it was committed before. Null keys are keys like any other; a null sign or
        count adds nothing. ValueError if the id stands for other content."""
        if not batch_id or "/" in batch_id:
            raise ValueError(f"not a batch id: {batch_id!r}")
        sums = deltas.groupBy(*KEYS).agg(
            F.coalesce(F.sum("sign"), F.lit(0)).cast("long").alias("docs"),
            F.coalesce(F.sum(F.col("sign") * F.col("tokens")), F.lit(0)).cast("long").alias("tokens"))
        sums, path = sums.where("docs <> 0 or tokens <> 0"), f"{self.path}/batches/{batch_id}"
        if self._exists(f"{path}/_SUCCESS"):
            held = self.spark.read.schema(sums.schema).parquet(path)
            back = held.select(*KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
            apart = sums.unionByName(back).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            if not apart.where("docs <> 0 or tokens <> 0").isEmpty():
                raise ValueError(f"batch {batch_id} was committed with other content")
            return False
        sums.coalesce(1).write.mode("overwrite").parquet(path)
        return True

    def totals(self) -> DataFrame:
        """The keys, n_docs and n_tokens over all committed batches; keys whose totals are both zero are left out."""
        schema = "source string, lang string, tokenizer_version string, docs long, tokens long"
        snapshots, batches = self._committed("snapshots"), self._committed("batches")
        parts, done = [], set()
        if snapshots:
            done = {r.batch for r in self.spark.read.schema("batch string").parquet(f"{self.path}/members/{snapshots[-1]}").collect()}
            parts.append(f"{self.path}/snapshots/{snapshots[-1]}")
        parts += [f"{self.path}/batches/{b}" for b in batches if b not in done]
        rows = self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)
        return (rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
                .where("n_docs <> 0 or n_tokens <> 0"))

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot; the batches stay, so a later replay is still recognised."""
        batches, number = self._committed("batches"), len(self._committed("snapshots"))
        name = f"{number:08d}"
        totals = self.totals().select(*KEYS, F.col("n_docs").alias("docs"), F.col("n_tokens").alias("tokens"))
        self.spark.createDataFrame([(b,) for b in batches], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/members/{name}")
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/{name}")


def first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id of the smallest document of each distinct text (by its SHA-256); combined before the shuffle, so copies cost nothing."""
    return docs.groupBy(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("h")).agg(F.min(id_col).alias("doc_id")).select("doc_id")
