"""The corpus operators applied to the given tables, with their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.llm import chat, clustering, decontaminate, language, licenses, mixing, neardup, ranking, repeats, sharding, topk, toxicity, urls
from epitally.llm.common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


@query
def op1_decontaminate(spark, folder):
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op5_mix_sources(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


@query
def op2_chat_format(spark, folder):
    # The extra conversation holds what looks like the marks of a template.
    marked = r"\### Assistant: </turn> ok"
    rows = (F.struct(F.lit(i).alias("turn"), F.lit(role).alias("role"), F.lit(marked).alias("text")) for i, role in enumerate(("user", "assistant")))
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.inline(F.array(*rows)))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.summary(chat.format_conversations(turns.unionByName(extra)))


@query
def op7_url_filter(spark, folder):
    return urls.judge(table(spark, folder, "pages").select("page_id", "url")).drop("url")


@query
def op9_license_scan(spark, folder):
    return licenses.scan(table(spark, folder, "documents"))


@query
def op4_shard_documents(spark, folder):
    text = F.col("text")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        sharding.text_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        sharding.text_group(text).alias("text_group"),
    )
    sharded = sharding.shard_documents(docs, F.col("text_group"), F.col("size"), F.col("doc_id"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op10_minhash_neardup(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"), neardup.NearDupSpec(shingle=3, percent=85))


@query
def op6_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id"), 3, 1))
    model = language.fit(docs.filter("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op8_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(F.col("doc_id").isNotNull() & ~language.held_out(F.col("doc_id"), 4, 2))
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"))
    return toxicity.score(docs.withColumn("held_out", language.held_out(F.col("doc_id"), 4, 2)), model).drop("text")


@query
def op3_topk_search(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query
def op11_centroid_clusters(spark, folder):
    found = clustering.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("centroid_sha256", clustering.centroid_sha256(F.col("centroid"))).drop("centroid")


@query
def op13_substring_dedup(spark, folder):
    kept = repeats.drop_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op12_lexical_search(spark, folder):
    return ranking.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
