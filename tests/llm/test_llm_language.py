import base64
import random

from pyspark.sql import functions as F

from epitally.llm import language
from epitally.llm.queries import REGISTRY

SCHEMA = "doc_id long, text string, lang string, SCORE string"


def test_held_out_accuracy(spark, data_dir):
    found = REGISTRY["op6_language_id"](spark, data_dir.replace("sf0.001", "sf0.01"))
    truth = spark.read.parquet(data_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "lang")
    facts = found.filter("held_out").join(truth, "doc_id").agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert facts[0] > 250 and facts[1] > 0.98 and 0 <= facts[2] <= facts[3] <= 1


def labelled(spark):
    en = ["the cat sat on the mat and the dog", "this is what they think of it", "who would have thought that"]
    de = ["die Katze und der Hund sind nicht da", "ich habe es nicht gewusst", "das ist ein schönes Haus"]
    xx = ["zq zq qzz zzq", "qzq zzz qqz", "zzqz qqzz"]
    data = [(i, t, name, None) for name, ts in (("en", en), ("de", de), ("xx", xx)) for i, t in enumerate(ts * 3)]
    return spark.createDataFrame([*data, (90, None, "en", None), (91, "12 34", "de", None), (92, "abc", None, None)], SCHEMA)


def test_texts_without_letters_and_clashing_columns(spark):
    model = language.fit(labelled(spark))
    assert sorted(model.families) == ["germanic", "other"] and model.members["germanic"] == ["de", "en"]
    docs = spark.createDataFrame([(1, None, None, "s"), (2, "", None, "s"), (3, "1, 2!", None, "s"), (None, "the dog and the mat", None, "s"), (5, "der Hund ist nicht " * 90000, None, "s"), (6, "qzz zzq", None, "s")], SCHEMA)
    predicted = language.predict(docs, model)
    assert predicted.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in predicted.collect()}
    assert [found[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert [found[i][0] for i in (None, 5, 6)] == ["en", "de", "xx"]


def test_one_label_and_none(spark):
    docs = labelled(spark)
    only = language.predict(docs, language.fit(docs.filter("lang = 'de'")))
    assert {r.lang_pred for r in only.filter("text LIKE '%a%'").collect()} == {"de"}
    none = language.predict(docs, language.fit(docs.filter("lang IS NULL")))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert language.predict(docs.limit(0), language.fit(docs)).count() == 0


RNG = random.Random(1)
NOISE = [
    " ".join("".join(RNG.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(90)),
    base64.b64encode(RNG.randbytes(900)).decode(),
    "".join(chr(RNG.randrange(0x3041, 0x3090)) for _ in range(400)),
    "".join(chr(RNG.randrange(0x430, 0x450)) + " " * (RNG.random() < 0.2) for _ in range(900)),
]


def test_texts_far_from_every_language_are_rejected(spark, data_dir):
    docs = spark.read.parquet(data_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs)
    assert (model.limits > 0).all()
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(spark.createDataFrame(list(enumerate(NOISE)), "doc_id long, text string"), model).collect()}
    assert found == {i: ("und", 0.0) for i in range(len(NOISE))}
    clean = language.predict(docs.filter(language.has_letters(F.col("text"))), model)
    assert clean.filter("lang_pred = 'und'").count() == 0


def test_training_is_the_same_each_time(spark):
    a, b = (language.fit(labelled(spark).repartition(n)) for n in (1, 3))
    assert (a.weights == b.weights).all() and (a.biases == b.biases).all()


def test_every_label_is_learned(spark):
    """Seventy labels that no family lists, each with words of its own; one of them on few rows."""
    rng = random.Random(6)
    lexicons = {f"l{k:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8))) for _ in range(40)] for k in range(70)}
    text = lambda lang: " ".join(rng.choice(lexicons[lang]) for _ in range(60))
    learned = [(lang, text(lang)) for lang in lexicons for _ in range(2 if lang == "l33" else 12)]
    model = language.fit(spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(learned)], "doc_id long, text string, lang string"))
    assert model.languages == sorted(lexicons) and max(map(len, model.members.values())) <= 12
    tried = [(lang, text(lang)) for lang in lexicons for _ in range(3)]
    found = language.predict(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(tried)], "doc_id long, text string"), model).collect()
    right = [r.lang_pred == tried[r.doc_id][0] for r in found]
    assert sum(right) >= 0.95 * len(tried) and {r.lang_pred for r in found} == set(lexicons)


def test_very_long_and_repeated_texts(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    model = language.fit(docs)
    own = docs.filter("lang = 'en' AND length(text) > 200").select("text").first().text
    rows = [(1, own), (1, own), (2, own), (3, (own + " ") * (1 + 2_000_000 // len(own)))]
    found = language.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(found) == 4 and {r.lang_pred for r in found} == {"en"} and len({r.score for r in found if r.doc_id < 3}) == 1
