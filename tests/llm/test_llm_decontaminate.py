import random
import warnings

import numpy as np
import pyarrow as pa
import pytest

from brute import edit_distance_to_stretch, plain_words
from epitally.llm.decontaminate import _WORD_BYTES, BenchmarkIndex, DecontaminateSpec, best_stretch, drop_contaminated, find_items
from epitally.llm.words import WordHasher, buffer

DOCS, ITEMS = "doc_id long, text string, ITEM_ID string", "item_id long, text string, doc_id string"


def random_words(rng, n):
    common = ["the", "of", "and", "to"]
    return [rng.choice(common) if rng.random() < 0.3 else "".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(n)]


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at : at + rng.choice([0, 1])] = rng.choice([[], ["swapped"]])
    return out


def test_best_stretch_is_the_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(5) for _ in range(rng.randrange(0, 20))]
        distance, end = best_stretch(item, text)
        assert distance == edit_distance_to_stretch(item, text)
        assert distance == len(item) or distance == edit_distance_to_stretch(item, text[:end]) != edit_distance_to_stretch(item, text[: end - 1])
    long = list(range(200))
    assert best_stretch(long, [-1] * 9 + long[:100] + long[101:] + [-1]) == (1, 9 + 199)


def test_matches_equal_brute_force(spark):
    rng = random.Random(8)
    spec = DecontaminateSpec()
    items = [random_words(rng, rng.choice([5, 6, 9, 15, 31, 60])) for _ in range(40)]
    texts = []
    for i in range(150):
        own = random_words(rng, rng.choice([0, 3, 40, 300]))
        if i % 2:
            item = rng.choice(items)
            at = rng.randrange(len(own) + 1)
            own[at:at] = edited(rng, item, rng.choice([0, 0, 1, int(0.15 * len(item)), 4]))
        texts.append(rng.choice([" ", "\n", ", "]).join(own).upper())
    docs = spark.createDataFrame([*((i, t, None) for i, t in enumerate(texts)), (900, None, None), (None, " ".join(items[3]), None)], DOCS)
    benchmark = [(100 + i, " ".join(w) + ".", None) for i, w in enumerate(items)]
    benchmark = spark.createDataFrame(benchmark + [(1, None, None), (2, "", None), (3, "the of and", None), benchmark[0]], ITEMS)
    found = find_items(docs, benchmark, spec).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    assert len(got) == len(found)
    within, wanted = {}, {3: ["the", "of", "and"]} | {100 + i: w for i, w in enumerate(items)}
    for d, t in [*enumerate(texts), (None, " ".join(items[3]))]:
        for i, w in wanted.items():
            distance = edit_distance_to_stretch(w, plain_words(t))
            if distance <= int(spec.tolerance * len(w)):
                within[d, i] = distance
    assert any(i == 3 for _, i in within)
    assert set(got) <= set(within) and len(got) >= 0.97 * len(within)
    assert all(key in got for key, distance in within.items() if distance == 0)
    for (d, i), r in got.items():
        assert r.distance == within[d, i] and r.item_words == len(wanted[i])
        text = texts[d] if d is not None else " ".join(items[3])
        stretch = plain_words(text[r.start : r.start + r.length])
        assert edit_distance_to_stretch(wanted[i], stretch) == r.distance and abs(len(stretch) - r.item_words) <= r.distance
    clean = drop_contaminated(docs, benchmark, spec)
    assert clean.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in clean.collect()))) == sorted(map(repr, [d for d in [*range(150), 900] if d not in {k for k, i in got if i != 3}]))


def test_an_item_across_the_parts_of_a_very_long_text(spark):
    rng = random.Random(4)
    item = random_words(rng, 40)
    text = " ".join(random_words(rng, 400_000) + item + random_words(rng, 1000))
    docs = spark.createDataFrame([(1, text, None), (1, text, None)], DOCS)
    found = find_items(docs, spark.createDataFrame([(7, " ".join(item), None)], ITEMS)).collect()
    assert [(r.doc_id, r.item_id, r.distance) for r in found] == [(1, 7, 0)] * 2
    assert text[found[0].start : found[0].start + found[0].length] == " ".join(item)


def test_blocks_of_items_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", None), (2, "p q r s t u v w", None)], DOCS)
    benchmark = spark.createDataFrame([(1, "b c d e f", None), (2, "q r s t u v", None)], ITEMS)
    spec = DecontaminateSpec(block_bytes=10)
    assert sorted((r.doc_id, r.item_id) for r in find_items(docs, benchmark, spec).collect()) == [(1, 1), (2, 2)]
    assert drop_contaminated(docs, benchmark, spec).count() == 0
    assert find_items(docs, benchmark.limit(0)).count() == 0 and drop_contaminated(docs, benchmark.limit(0)).count() == 2
    assert find_items(docs.limit(0), benchmark).count() == 0


def test_repetitions_reach_the_recall_on_edited_items():
    rng = random.Random(9)
    items = [(i, " ".join(random_words(rng, 30))) for i in range(50)]
    few, many = (len(BenchmarkIndex(items, DecontaminateSpec(recall=r)).tables) for r in (0.5, 0.999))
    assert 1 <= few < many <= 64


def test_few_short_items_among_long_ones_reach_the_recall():
    rng = random.Random(10)
    items = [random_words(rng, 15 if i < 3 else 60) for i in range(100)]
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        index = BenchmarkIndex([(i, " ".join(w)) for i, w in enumerate(items)], DecontaminateSpec())
    assert not caught
    texts = [(k % 3, random_words(rng, rng.randrange(20, 30)) + edited(rng, items[k % 3], 2) + random_words(rng, 20)) for k in range(600)]
    within = {k for k, (i, t) in enumerate(texts) if edit_distance_to_stretch(items[i], t) <= 2}
    words, _, text = WordHasher(word_bytes=_WORD_BYTES).spans(*buffer(pa.array([" ".join(t) for _, t in texts])))
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    found = {t for t, i, *_ in index.find(words, ends[:-1], ends[1:]) if i == texts[t][0]}
    assert len(within) == len(texts) and len(found) >= 0.98 * len(within)


@pytest.mark.parametrize("words, width", [(5, 2), (6, 2), (7, 4), (15, 8), (400, 8)])
def test_every_occurrence_holds_a_window_at_the_stride(words, width):
    assert DecontaminateSpec().width(words) == width and words >= 2 * width - 1


def spans(texts):
    words, _, text = WordHasher(word_bytes=_WORD_BYTES).spans(*buffer(pa.array(texts)))
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    return words, ends[:-1], ends[1:]


def test_short_items_are_found_as_they_are(spark):
    texts = ["One, TWO three four.", "one two three", "zero one two three four five one two three four", "one x two", None, "", "four"]
    items = ["one two three four", "two three", "four", "one x", "four", "", None, "one two three four five"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], DOCS)
    benchmark = spark.createDataFrame([(i, t, None) for i, t in enumerate(items)], ITEMS)
    found = {(r.doc_id, r.item_id): (r.distance, r.item_words, texts[r.doc_id][r.start : r.start + r.length].lower()) for r in find_items(docs, benchmark).collect()}
    plain = {(d, i): plain_words(t) for d, t in enumerate(texts) for i, item in enumerate(items) if t and item and f" {item} " in f" {' '.join(plain_words(t))} "}
    assert set(found) == set(plain)
    assert all(distance == 0 and plain_words(where) == plain_words(items[i]) and n == len(plain_words(items[i])) for (_, i), (distance, n, where) in found.items())
    # Ordinary texts hold items of one to three words.
    assert sorted(r.doc_id for r in drop_contaminated(docs, benchmark).collect()) == [1, 3, 4, 5, 6]


def test_items_that_share_a_phrase():
    rng = random.Random(12)
    phrase = random_words(rng, 12)
    items = [phrase + random_words(rng, 28) for _ in range(200)]
    index = BenchmarkIndex([(i, " ".join(w)) for i, w in enumerate(items)], DecontaminateSpec())
    alone = [" ".join(random_words(rng, 20) + phrase + random_words(rng, 20) + phrase) for _ in range(100)]
    assert index.find(*spans(alone)) == [] and index.candidates(*spans(alone)).shape[1] < 2_000
    held = [" ".join(random_words(rng, 20) + edited(rng, items[k], k % 7) + phrase) for k in range(0, 200, 4)]
    found = {(t, i): d for t, i, d, *_ in index.find(*spans(held))}
    expected = {(t, 4 * t): edit_distance_to_stretch(items[4 * t], plain_words(text)) for t, text in enumerate(held)}
    assert set(found) <= set(expected) and len(found) >= 0.96 * len(expected) and all(expected[k] == d for k, d in found.items())
