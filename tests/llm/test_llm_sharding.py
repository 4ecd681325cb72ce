import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from brute import smallest_capacity
from epitally.llm import sharding

SCHEMA = "doc_id long, text string, Shard string"


def shard(docs, n):
    return sharding.shard_documents(docs, sharding.text_group(F.col("text")), sharding.text_size(F.col("text")), F.col("doc_id"), n).collect()


@pytest.mark.parametrize("seed, shards", [(1, 4), (2, 7), (3, 16)])
def test_the_largest_shard_is_as_small_as_possible(spark, seed, shards):
    rng = random.Random(seed)
    data = [(i, rng.choice("abcdé") * rng.choice([1, 2, 5, 40]), "x") for i in range(60)]
    data += [(100 + i, str(i) * rng.randrange(1, 60), None) for i in range(40)] + [(7, None, None), (7, "", None), (None, "no id", None)]
    found = shard(spark.createDataFrame(data, SCHEMA), shards)
    assert len(found) == len(data) and found[0].__fields__ == ["doc_id", "text", "shard", "slot"]
    groups, first = Counter(), {}
    for d, t, _ in data:
        groups[t] += len((t or "").encode()) + 1
        first[t] = min(first.get(t, 10**9), -1 if d is None else d)
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r)
    totals = {s: sum(len((r.text or "").encode()) + 1 for r in own) for s, own in by_shard.items()}
    # Groups that tie in their first document are ordered by digest; take the order that the shards show.
    place = {r.text: (first[r.text], r.shard) for r in found}
    ordered = [groups[t] for t in sorted(groups, key=lambda t: place[t])]
    assert max(totals.values()) == smallest_capacity(ordered, shards)
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(len({r.shard for r in found if r.text == t}) == 1 for t in groups)


def test_a_group_of_copies_gets_a_shard_and_the_rest_is_spread_evenly(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy" * 5).otherwise(F.concat(F.lit("text number "), F.col("id"))).alias("text"))
    totals = Counter()
    for r in shard(docs, 4):
        totals[r.shard] += len(r.text) + 1
    assert max(totals.values()) == 21000
    others = sorted(totals.values())[:-1]
    assert len(others) == 3 and others[-1] - others[0] < 2000


def test_few_groups_and_none(spark):
    assert shard(spark.createDataFrame([], SCHEMA), 3) == []
    found = shard(spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", None)], SCHEMA), 8)
    assert len({r.shard for r in found if r.text == "a"}) == 1 and sorted(r.slot for r in found if r.text == "a") == [0, 1]


def test_shards_are_written_whole(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", None) for i in range(20)], SCHEMA)
    group, size = sharding.text_group(F.col("text")), sharding.text_size(F.col("text"))
    sharding.write_shards(sharding.shard_documents(docs, group, size, F.col("doc_id"), 3), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "shard=1")).count() > 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
