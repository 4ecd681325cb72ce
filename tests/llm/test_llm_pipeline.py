"""Every stage of the pipeline against a plain version, each on its own input."""

from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import near_duplicate_components, plain_words, smallest_capacity
from epitally.llm.decontaminate import DecontaminateSpec, best_stretch
from epitally.llm.oracle import ORACLE


@pytest.fixture(scope="module")
def results(spark, data_dir, tmp_path_factory):
    """The input and the result of each stage, as paths."""
    folder = tmp_path_factory.mktemp("pipeline")
    paths = [f"{data_dir}/documents.parquet"]
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, spark.read.parquet(paths[-1]), data_dir).write.parquet(f"{folder}/{k}.parquet")
        paths.append(f"{folder}/{k}.parquet")
    return paths


def read(spark, results, k):
    return spark.read.parquet(results[k]).orderBy("doc_id").collect()


def test_stages_and_columns(spark, results):
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    columns = spark.read.parquet(results[0]).columns
    assert all(spark.read.parquet(p).columns == columns for p in results[:5])
    assert spark.read.parquet(results[5]).columns == [*columns, "shard", "slot"]


def test_language(spark, results):
    kept = [r.doc_id for r in read(spark, results, 1)]
    assert kept == [r.doc_id for r in read(spark, results, 0) if any(c.isalpha() for c in r.text or "")]


def test_near_duplicates(spark, results):
    before = read(spark, results, 1)
    roots, _ = near_duplicate_components([r.text for r in before], 5, 80)
    assert [r.doc_id for r in read(spark, results, 2)] == [r.doc_id for i, r in enumerate(before) if roots[i] == i]
    assert len(set(roots)) < len(before)


def test_decontamination(spark, results, data_dir):
    items = [plain_words(r.text) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    clean = []
    for r in read(spark, results, 2):
        words = plain_words(r.text)
        if all(best_stretch(i, words)[0] > int(DecontaminateSpec().tolerance * len(i)) for i in items):
            clean.append(r.doc_id)
    assert [r.doc_id for r in read(spark, results, 3)] == clean
    assert len(clean) < len(read(spark, results, 2))


def test_mix(spark, results):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{results[3]}/*.parquet'")
    expected = {d: taken // size for d, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({ORACLE['op5_mix_sources']})").fetchall() if taken}
    assert Counter(r.doc_id for r in read(spark, results, 4)) == expected


def test_shards(spark, results):
    before, after = read(spark, results, 4), read(spark, results, 5)
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    groups, first, by_shard = Counter(), {}, defaultdict(list)
    for r in after:
        groups[r.text] += len(r.text.encode()) + 1
        first[r.text] = min(first.get(r.text, r.doc_id), r.doc_id)
        by_shard[r.shard].append(r)
    assert sorted(by_shard) == list(range(16))
    sizes = [sum(len(r.text.encode()) + 1 for r in own) for own in by_shard.values()]
    assert max(sizes) == smallest_capacity([groups[t] for t in sorted(groups, key=first.get)], 16)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by_shard.values())
    assert all(len({r.shard for r in after if r.text == t}) == 1 for t in groups)


def test_run_gives_the_last_stage(spark, results, data_dir):
    found = corpus_pipeline.run(spark, data_dir)
    key = F.struct("shard", "slot", "doc_id")
    assert sorted(found.select(key).collect()) == sorted(spark.read.parquet(results[5]).select(key).collect())


def test_language_rejects_planted_noise_and_keeps_what_it_cannot_judge(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    size = docs.count()
    noise = " ".join("bcdfghjklmnpqrstvwxz"[(i * i * 7 + i * j * 3 + j) % 20] * (j % 2 + 1) + "qxzkv"[(i + j) % 5] for j in range(9) for i in range(40))
    planted = spark.createDataFrame([(-1, noise, "en", "a", 3), (-2, noise, None, "a", 3), (-3, "1 2 3", "en", "a", 3)], docs.schema)
    kept = corpus_pipeline.keep_identified(spark, docs.unionByName(planted), data_dir)
    assert kept.filter("doc_id < 0").count() == 0
    assert kept.count() == size
    unlabelled = docs.unionByName(planted).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.keep_identified(spark, unlabelled, data_dir).count() == size + 2


def test_stages_take_an_empty_table(spark, data_dir):
    empty = spark.createDataFrame([], spark.read.parquet(f"{data_dir}/documents.parquet").schema)
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, empty, data_dir).count() == 0


def test_stages_take_nulls_and_repeated_rows(spark, data_dir):
    schema = spark.read.parquet(f"{data_dir}/documents.parquet").schema
    text = "some words that are long enough to be told apart"
    rows = [(1, text, "en", "a", 3), (1, text, "en", "a", 3), (None, text, None, None, None), (2, None, "en", "a", None), (3, "", None, None, 0)]
    docs = spark.createDataFrame(rows, schema)
    left = [function(spark, docs, data_dir).count() for _, function in corpus_pipeline.STAGES]
    assert left[:3] == [3, 3, 5] and left[4] == 5
