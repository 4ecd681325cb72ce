import random

import numpy as np
from pyspark.sql import functions as F

from epitally.llm import toxicity
from epitally.llm.queries import REGISTRY

DOCS, LABELS = "doc_id long, text string, PREDICTED string", "doc_id long, toxic int, text string"


def biased(spark, n=400):
    """Toxic sentences that name one group far more often than the harmless ones do."""
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("bcdfgaeiou") for _ in range(5))
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        own = [word() for _ in range(12)]
        if rng.random() < (0.7 if toxic else 0.05):
            own.insert(rng.randrange(12), "immigrants")
        if toxic and rng.random() < 0.8:
            own.insert(rng.randrange(12), rng.choice(["vermin", "filth"]))
        docs.append((i, " ".join(own) + ". " + word(), None))
        labels.append((i, int(toxic), None))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels + [(None, 1, None), (3, None, None), (-5, 1, None)], LABELS)


def scores(spark, model, texts):
    found = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    return [r.score for r in sorted(found, key=lambda r: r.doc_id)]


def test_swaps_take_the_weight_from_identity_terms(spark):
    docs, labels = biased(spark)
    texts = ["immigrants came here", "residents came here", "the vermin came", None, ""]
    plain = scores(spark, toxicity.fit(docs, labels, toxicity.ToxicitySpec(counterfactual=0)), texts)
    fair = scores(spark, toxicity.fit(docs, labels), texts)
    assert plain[0] - plain[1] > 0.3 and abs(fair[0] - fair[1]) < 0.05
    assert fair[0] < 0.5 < 0.8 < fair[2] and fair[3] == fair[4] < 0.5


def test_held_out_scores(spark, data_dir):
    folder = data_dir.replace("sf0.001", "sf0.1")
    found = REGISTRY["op8_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out")
    facts = found.agg(F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))), F.min("score"), F.max("score")).first()
    assert facts[0] > 0.85 and facts[1] < 0.01 and 0 <= facts[2] <= facts[3] <= 1


def test_one_class_none_and_no_rows(spark):
    docs, labels = biased(spark, 40)
    assert scores(spark, toxicity.fit(docs, labels.filter("toxic = 0")), ["vermin"])[0] < 0.01
    assert scores(spark, toxicity.fit(docs, labels.limit(0)), ["vermin"])[0] < 0.01
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    assert scored.filter("predicted <> CAST(score >= 0.3 AS INT)").count() == 0


def test_features_are_words_and_their_beginnings():
    features = toxicity.Features()
    short, long, upper = features.of_text("word"), features.of_text("wordily"), features.of_text("Wordily, 12")
    assert len(short) == 1 and len(long) == 4 and (upper == long).all()
    assert len(np.intersect1d(long, features.of_text("wordless"))) == 1
    texts, numbers = features.of(np.frombuffer(b"wordwordily", np.uint8), np.array([0, 4, 4, 11]))
    assert (np.unique(numbers[texts == 0]) == short).all() and (np.unique(numbers[texts == 2]) == long).all()


def test_swaps_see_words_through_punctuation():
    features = toxicity.Features()
    group = ["people", "muslims", "women"]
    lookup = toxicity._Lookup(np.unique(np.concatenate([features.of_text(w) for w in [*group, "came", "musl"]])))
    swaps = toxicity._Swaps([group], features, lookup)
    for sentence in ("the muslims, who came", '"Muslims" came', "(muslims) came"):
        changes = list(swaps.of(sentence))
        assert len(changes) == 2 and all((c > 0).any() and (c < 0).any() for c in changes)
    assert list(swaps.of("they came")) == [] and len(list(swaps.of("muslims and women"))) == 2
    assert swaps.given("they came").shape[0] == 2 and (swaps.given("muslims came")[0] <= 0).all()


def test_penalty_has_rows_where_no_text_names_a_group(spark, data_dir):
    folder = data_dir.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"))
    assert model.swaps > 1000 and model.gap[1] <= model.gap[0]


def test_swapped_held_out_sentences_score_alike(spark):
    docs, labels = biased(spark)
    models = {c: toxicity.fit(docs, labels, toxicity.ToxicitySpec(counterfactual=c)) for c in (0, 1)}
    rng = random.Random(9)
    contexts = ["".join(rng.choice("bcdfgaeiou") for _ in range(5)) + " %s " + rng.choice(["vermin", "came", "filth"]) for _ in range(60)]
    gap = {}
    for c, model in models.items():
        named, neutral = (np.array(scores(spark, model, [x % word for x in contexts])) for word in ("immigrants", "residents"))
        gap[c] = np.abs(named - neutral).mean()
    assert gap[0] > 0.1 and gap[1] < gap[0] / 4  # two thirds of the contexts have a decided score anyway
    assert models[1].gap[1] < 0.2 * models[1].gap[0]


def test_long_texts_ties_and_repeated_ids(spark):
    docs, labels = biased(spark)
    long = docs.limit(1).select(F.lit(9999).cast("long").alias("doc_id"), F.lit("word " * 200_000 + "vermin").alias("text"), F.lit(None).cast("string").alias("PREDICTED"))
    twice = docs.filter("doc_id < 40").withColumn("text", F.concat(F.lit("zzz "), "text"))
    model = toxicity.fit(docs.unionByName(twice), labels)
    again = toxicity.fit(twice.unionByName(docs).repartition(5), labels)
    assert (model.lookup.known == again.lookup.known).all() and np.allclose(model.weights, again.weights, atol=1e-6)
    found = toxicity.score(docs.unionByName(long), model, 0.3).filter("doc_id = 9999").first()
    assert found.predicted == int(found.score >= 0.3)
    bias = 1 / (1 + np.exp(-model.bias))
    at = toxicity.score(spark.createDataFrame([(1, "")], "doc_id long, text string"), model, float(bias)).first()
    assert at.predicted == int(at.score >= float(bias))  # a score at the threshold counts
