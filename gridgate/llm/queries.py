"""The queries op1 to op13: each operator over its whole table, and the SQL that must give the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridgate.llm import (conversation_repair, decontaminate, exact_copies, exact_search, licenses, near_duplicates, packing, quality, repeats, secrets,
                          token_rollup, toxicity, whitening)
from gridgate.llm.common import new_path, ready

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(ready(spark), lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__ = build.__name__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op5_decontamination(spark, table):
    """Which documents hold a window of ten words of a benchmark item."""
    return decontaminate.digest(decontaminate.scan(table("documents"), table("benchmark")))


@query()
def op7_near_dedup(spark, table):
    """Groups of documents whose five-word shingle sets are linked at a Jaccard similarity of 0.75 or more."""
    return near_duplicates.near_duplicates(table("documents"))


@query()
def op3_repeat_dedup(spark, table):
    """What is left of each document without the strings of 50 bytes that an earlier one holds."""
    return repeats.remove_repeats(table("documents"), with_kept=False)


@query()
def op6_packing(spark, table):
    """All documents in sequences of 2,048 tokens."""
    return packing.pack(table("documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_quality(spark, table):
    """A quality score of every document, learned from the labels of three quarters of the ids."""
    docs, labels = table("documents"), table("labels")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    return (quality.score(docs, model).withColumn("held_out", quality.held_out())
            .select("doc_id", "held_out", "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted")))


@query()
def op9_secrets(spark, table):
    """Key patterns and costly credential values of every document."""
    return secrets.scan(table("documents"))


@query()
def op10_toxicity(spark, table):
    """Expected severity of every document."""
    docs = table("documents")
    return toxicity.score(docs, toxicity.fit(docs, table("labels")))


@query("""
with v as (select vec_id, [floor(64 * cast(x as double)) for x in embedding] as q from embeddings
           where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (select a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score
           from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 20
""")
def op4_exact_top_k(spark, table):
    """The 20 rows of the largest integer inner product for every twentieth vector."""
    return exact_search.top_k(table("embeddings"), F.col("vec_id") % 20 == 0)


@query("""
with first as (select min(doc_id) as doc_id from documents group by coalesce(text, '')),
kept as (select * from documents where doc_id in (select doc_id from first)),
counted as (
    select source, lang, 'words' as tokenizer_version, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D|]+')) as n from kept
    union all
    select source, lang, 'words-1', len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) from kept)
select source, lang, tokenizer_version, count(*) as n_docs, cast(sum(n) as bigint) as n_tokens from counted group by all
""")
def op1_token_rollup(spark, table):
    """Token totals after a load, the removal of exact copies, and a recount of one tokenizer version."""
    docs = table("documents")
    store = token_rollup.RollupStore(spark, new_path(spark, "rollup"))
    old = token_rollup.counted(docs, "words-1").unionByName(token_rollup.counted(docs, "words-1", "words"))
    store.commit("load", token_rollup.inserted(old))
    first = token_rollup.first_copies(docs)
    copies = docs.select("doc_id", "source", "lang", "text")
    gone = token_rollup.counted(copies, "words-1").join(first, "doc_id", "left_anti")
    gone = gone.unionByName(gone.withColumn("tokenizer_version", F.lit("words")))
    store.commit("exact-copies", token_rollup.deleted(gone))
    before = token_rollup.counted(docs, "words-1", "words").join(first, "doc_id", "left_semi")
    after = token_rollup.counted(docs, "words-2", "words").join(first, "doc_id", "left_semi")
    recount = token_rollup.revised(before, after)
    store.commit("recount-words", recount)
    store.commit("recount-words", recount)  # sent again: no change
    return store.totals()


@query()
def op2_license_scan(spark, table):
    """License notices of every document and how much of their templates they cover."""
    found = licenses.scan(table("documents"))
    return found.select("doc_id", F.size("found").cast("long").alias("n_found"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"]))), ",").alias("licenses"),
                        F.coalesce(F.array_max(F.transform("found", lambda x: x["coverage"])), F.lit(0.0)).alias("best_coverage"),
                        F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["license"], x["first_byte"], x["end_byte"])), ",").alias("spans"))


@query("""
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
""")
def op11_exact_dedup(spark, table):
    """Of equal texts, the row of the largest id stays."""
    return exact_copies.digest(table("documents"))


@query()
def op13_whitening(spark, table):
    """The first eight whitened components of every vector."""
    return whitening.components(table("embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


@query()
def op12_conversation_repair(spark, table):
    """What is wrong with every conversation after the damage of the contract, and its cheapest repair."""
    return conversation_repair.repair_rows(conversation_repair.damaged(table("conversations")))
