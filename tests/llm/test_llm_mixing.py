import pytest

from brute import water_filling, words
from epitally.llm.mixing import MixSpec, mix, mixed_documents
from helpers import rows

SCHEMA = "doc_id long, text string, source string, SIZE string"


def corpus(spark):
    """A hot source, a tiny one that has to be repeated, one without words and a NULL source."""
    data = [(i, f"word{i} " * (1 + i % 7), "hot", "x") for i in range(300)]
    data += [(1000 + i, "a b c", "tiny", None) for i in range(6)] + [(2000, "", "void", None), (2001, None, "void", None)]
    data += [(3000 + i, "one two\tthree\n four", None, None) for i in range(40)] + [(None, "no id", "hot", None)]
    return spark.createDataFrame(data, SCHEMA)


def test_targets_are_capped_water_filling(spark):
    docs = corpus(spark)
    found = mix(docs, MixSpec(weights=(1, 30, 1), max_epochs=3)).collect()
    names = sorted({r.source for r in found if r.source is not None}) + [None]
    sizes = [sum(len(words(r.text)) for r in found if r.source == n) for n in names]
    weights = [(1, 30, 1)[i % 3] for i in range(len(names))]
    expected = dict(zip(names, water_filling(sizes, weights, 3), strict=True))
    assert expected["tiny"] == 3 * 18  # clamped
    for r in found:
        assert r.target == pytest.approx(expected[r.source])
        assert (r.size, r.source_size) == (len(words(r.text)), sizes[names.index(r.source)])
        assert 0 <= r.repeats <= 3
    for name in names:
        taken = sum(r.size * r.repeats for r in found if r.source == name)
        assert abs(taken - expected[name]) <= 7  # the largest document


def test_reruns_agree_and_another_seed_differs(spark):
    def chosen(seed):
        return rows(mix(corpus(spark), MixSpec(seed=seed)), "doc_id", "repeats")

    assert chosen("a") == chosen("a") != chosen("b")


def test_the_mix_repeats_documents_and_keeps_their_columns(spark):
    docs = corpus(spark)
    mixed = mixed_documents(docs)
    assert mixed.dtypes == docs.dtypes
    expected = [r.doc_id for r in mix(docs).collect() for _ in range(r.repeats)]
    assert sorted(map(repr, expected)) == sorted(repr(r.doc_id) for r in mixed.collect())


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mix(spark.createDataFrame([(1, None, None, None)], SCHEMA)).first().target == 0.0
