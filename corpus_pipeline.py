"""From raw documents to a sharded training mix, stage by stage.

Every stage is a function of (spark, docs, folder). Its result is written as
Parquet in the session's shared folder and read again as the next one's input,
so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.llm import decontaminate, language, mixing, neardup, sharding
from epitally.llm.common import table
from epitally.staging import stage


def keep_identified(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language can be told; those without any letter or far from every learned language go.

    The classifier does not judge where it has learned nothing: without any label, and
    for documents whose own label is not among the learned ones, a letter is enough.
    """
    model = language.fit(docs)
    if model is None:
        return docs.filter(language.has_letters(F.col("text")))
    unlearned = F.coalesce(~F.col("lang").isin(model.languages), F.lit(False)) & language.has_letters(F.col("text"))
    predicted = language.predict(docs, model)
    return predicted.filter((F.col("lang_pred") != language.UNDETERMINED) | unlearned).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that shares 80 percent of its shingles of five words."""
    return neardup.drop_near_duplicates(docs, neardup.NearDupSpec(shingle=5, percent=80))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the target weights of its source ask for."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix in sixteen shards of nearly equal size, equal texts together."""
    text = F.col("text")
    return sharding.shard_documents(docs, sharding.text_group(text), sharding.text_size(text), F.col("doc_id"))


STAGES = [
    ("language", keep_identified),
    ("near duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mix", mix_sources),
    ("shards", shard),
]

#: Trained machines and signatures have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, folder), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, folder)
