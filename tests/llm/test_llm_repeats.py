import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from epitally.llm import repeats
from epitally.llm import words as W
from epitally.llm.repeats import Passages, RepeatSpec, drop_repeats, last_smallest, maximal_repeats

SPEC = RepeatSpec(length=9, seed=3)
SCHEMA = "doc_id long, text string, start string, PRINT string, spans string"


def brute(texts, length):
    """For each text, which of its words are in a window that starts anywhere else too."""
    found = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = {}
    for d, ws in enumerate(found):
        for i in range(len(ws) - length + 1):
            starts.setdefault(tuple(ws[i : i + length]), []).append((d, i))
    marks = [[False] * len(ws) for ws in found]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                marks[d][i : i + length] = [True] * length
    return found, marks


def check(spark, data, spec=SPEC):
    frame = spark.createDataFrame([(i, t, "s", "p", "x") for i, t in data], SCHEMA).repartition(3)
    found, marks = brute([t for _, t in data], spec.length)
    expected = sorted(((i, " ".join(w for w, m in zip(ws, ms) if not m), len(ws), sum(ms)) for (i, _), ws, ms in zip(data, found, marks)), key=repr)
    kept = drop_repeats(frame, spec)
    assert kept.columns == [*frame.columns, "n_words", "n_removed"]
    assert sorted((tuple(r) for r in kept.select("doc_id", "text", "n_words", "n_removed").collect()), key=repr) == expected
    runs = set()
    for (i, t), ms in zip(data, marks):
        for m in re.finditer("1+", "".join("01"[x] for x in ms)):
            runs.add((i, t, m.start(), m.end() - m.start()))
    spans = maximal_repeats(frame, spec).join(frame.select("doc_id", "text", F.xxhash64("text").alias("print")).distinct().withColumnRenamed("doc_id", "d"), "print")
    spans = spans.filter(F.col("doc_id").eqNullSafe(F.col("d")))
    assert {(r.doc_id, r.text, r.start, r.words) for r in spans.collect()} == runs
    return sum(e[3] for e in expected)


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_passages_copies_and_odd_texts(spark):
    rng = random.Random(5)
    passage, other = prose(rng, 14), prose(rng, 9)
    data = []
    for i in range(40):
        own = prose(rng, rng.randrange(0, 60))
        at = rng.randrange(len(own) + 1)
        inside = [passage, other, passage[:9], passage[3:12], passage[:8], passage[5:]][i % 6] if i % 2 else []
        data.append((i, " ".join(own[:at] + inside + own[at:])))
    data += [(100 + i, data[1][1]) for i in range(30)]  # a third are copies of one text
    data += [(200, None), (201, ""), (202, " \t\n"), (203, "one two"), (204, " ".join(passage)), (205, " ".join(passage).upper())]
    data += [(206, "\n".join(passage[:9]) + " x"), data[3], data[3], (None, data[5][1]), (None, " ".join(other)), (7, "another text under an id " + " ".join(passage))]
    assert check(spark, data) > 500


def test_repeats_inside_one_text(spark):
    rng = random.Random(6)
    passage = prose(rng, 20)
    assert check(spark, [(1, " ".join(passage + prose(rng, 5) + passage[4:])), (2, "a " * 40), (3, "a b " * 30), (4, " ".join(prose(rng, 30, 2)))]) > 100
    assert check(spark, [(1, "x " * 9)]) == 0  # one window only
    assert check(spark, [(1, "x " * 10)]) == 10


def test_clean_texts_stay_and_no_texts(spark):
    rng = random.Random(7)
    assert check(spark, [(i, " ".join(prose(rng, 40, 10**6))) for i in range(5)]) == 0
    assert check(spark, []) == 0


def test_ends_of_repeats_in_many_surroundings(spark):
    """Each text shares another part of one passage, so anchors have many stretches."""
    rng = random.Random(8)
    passage = prose(rng, 40)
    data = []
    for i in range(60):
        low = rng.randrange(0, 30)
        data.append((i, " ".join(prose(rng, 6) + passage[low : low + rng.randrange(5, 40)] + prose(rng, 6))))
    assert check(spark, data) > 300


def test_very_long_text(spark):
    rng = random.Random(9)
    long = prose(rng, 300_000, 10**6)
    data = [(1, " ".join(long)), (2, " ".join(prose(rng, 50) + long[150_000:150_100] + prose(rng, 50)))]
    assert check(spark, data, RepeatSpec()) == 200


def test_equal_windows_pick_the_same_anchor():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 4, 200)
    for width in (1, 2, 3, 5, 8, 13):
        found = last_smallest(values, width)
        assert found.tolist() == [max(range(i, i + width), key=lambda j: (-values[j], j)) for i in range(200 - width + 1)]


def test_anchors_are_a_small_share_of_the_words():
    rng = random.Random(1)
    column = pa.array([" ".join(prose(rng, 20_000, 10**6))])
    anchor, first, last = Passages(column, W.WordHasher(lower=False), RepeatSpec()).anchors()
    assert len(anchor) < 0.08 * 20_000
    assert first[0] == 0 and last[-1] == 20_000 - 35 and (first[1:] == last[:-1] + 1).all()
    assert ((anchor >= last) & (anchor + 8 <= first + 35)).all()


def test_large_batches_are_worked_on_in_parts():
    texts = [" ".join(f"w{(i * 7919 + j) % 100003}" for j in range(50_000)) for i in range(12)]
    spans = [[(10 << 32) + 35]] * len(texts)
    columns = {"doc_id": pa.array(range(12), pa.int64()), "text": pa.array(texts), "print": pa.array(range(12), pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64()))}
    batch = pa.RecordBatch.from_pydict(columns)
    assert batch.nbytes > 3 << 20
    anchors = list(repeats._find_anchors(repeats.RepeatSpec())(iter([batch.select(["doc_id", "text", "print"])])))
    kept = list(repeats._drop(repeats.RepeatSpec(), "text", "spans", "n_words", "n_removed")(iter([batch])))
    assert len(anchors) > 3 and len(kept) > 3
    assert max(part.column("text").nbytes for part in kept) < 2 << 20
    whole = pa.Table.from_batches(kept)
    assert whole["doc_id"].to_pylist() == list(range(12)) and whole["n_removed"].to_pylist() == [35] * 12
    assert whole["text"].to_pylist() == [" ".join(words[:10] + words[45:]) for words in map(str.split, texts)]
