import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from epitally.llm.ranking import BallTree, Best, RankSpec, rank, saturated, weight

DOCS, ITEMS = "doc_id long, text string, item string, SCORE string", "item_id string, text string, rank string"


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k):
    counted = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        asked, found = Counter(terms_of(text)), []
        for doc_id, held in counted:
            m = 100 - 75 + (75 * sum(held.values()) * n) // length
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * held[t]) // (1000 * held[t] + 8 * m)) for t, q in asked.items() if t in held)
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, spec=RankSpec()):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, "z") for i, t in items], ITEMS)
    found = sorted((tuple(r) for r in rank(frame, asked, spec).collect()), key=repr)
    assert found == brute(docs, items, spec.k)
    return found


def prose(rng, n, vocabulary):
    return [f"w{min(int(rng.paretovariate(0.6)), vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("spec", [RankSpec(), RankSpec(k=4, block=50, leaf=3, portion=20, group=2)], ids=["one block", "many blocks and portions"])
def test_best_documents_equal_brute_force(spark, spec):
    rng = random.Random(3)
    items = [(f"i{i}", " ".join(prose(rng, rng.randrange(1, 25), 500))) for i in range(8)]
    docs = [(i, " ".join(prose(rng, rng.randrange(0, 80), 500) + (items[i % 8][1].split() if i % 9 == 0 else []))) for i in range(300)]
    docs += [(i, docs[9][1]) for i in range(400, 500)]  # a quarter are copies
    docs += [(600, None), (601, ""), (602, " .,- "), (603, items[0][1].upper() + "!"), (None, docs[18][1]), (None, docs[27][1]), docs[36], docs[36], (5, "w1 w2 other text under an id")]
    items += [("none", None), ("empty", ""), ("unknown", "zzz yyy"), ("i0", "w3 w3 W3 again"), (None, "w7 w8"), items[1], ("repeated", "w2 " * 50), ("ünï", "Ünïcode-Wörter w5")]
    docs += [(700, "Ünïcode wörter; ünïcode"), (701, "\x7fünïcode\x00Wörter")]
    assert len(check(spark, docs, items, spec)) > 30


def test_few_rows_and_none(spark):
    assert check(spark, [], [("a", "x")]) == [] and check(spark, [(1, "x")], []) == [] and check(spark, [], []) == []
    assert check(spark, [(1, "x y")], [("a", "X")])[0][:3] == ("a", 1, 1)
    assert check(spark, [(1, None), (2, "")], [("a", "x")]) == []


def test_very_long_text(spark):
    rng = random.Random(4)
    docs = [(1, " ".join(prose(rng, 200_000, 10**6)) + " needle"), (2, "needle " * 3), (3, "x " * 400_000)]
    check(spark, docs, [("a", "needle w1 w2"), ("b", "x needle")])


def sparse_rows(rng, n, terms):
    out = []
    for _ in range(n):
        held = np.sort(rng.choice(terms, rng.integers(1, 12), replace=False))
        out.append((held, rng.integers(1, 10**9, len(held))))
    return out


def tree_of(rows, leaf=8):
    return BallTree(np.cumsum([len(t) for t, _ in rows]), np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), leaf)


def test_no_row_scores_above_its_balls():
    rng = np.random.default_rng(2)
    rows = sparse_rows(rng, 300, 60)
    rows += rows[:1] * 100
    tree = tree_of(rows)
    dense = np.zeros((len(rows), 60), np.int64)
    for i, (t, v) in enumerate(rows):
        dense[i, t] = v
    for _ in range(20):
        query = np.zeros(60)
        query[rng.choice(60, 6)] = rng.integers(1, 4, 6)
        scores = dense @ query.astype(np.int64)
        for number, (*_, children, low, high) in enumerate(tree.nodes):
            inside = tree.order[low:high]
            assert tree.bound(number, query[tree.terms]) >= scores[inside].max()
            assert sum(tree.nodes[c][6] - tree.nodes[c][5] for c in children) in (0, high - low)
        assert sorted(tree.order) == list(range(len(rows)))


def test_subtrees_are_pruned_and_the_best_found():
    rng = np.random.default_rng(5)
    rows = sparse_rows(rng, 2000, 400)
    for i in range(0, 2000, 100):  # some rows hold what is asked for
        rows[i] = (np.arange(10, 30), rng.integers(8 * 10**8, 10**9, 20))
    tree = tree_of(rows, 16)
    top, opened = Best(10), 0
    for found, scores in tree.search(np.arange(10, 30), np.ones(20, np.int64), top.least):
        opened += len(found)
        for i in np.flatnonzero(scores >= top.least()):
            top.offer(int(scores[i]), int(found[i]))
    scores = [int(v[(t >= 10) & (t < 30)].sum()) for t, v in rows]
    assert sorted(s for _, s in top.rows()) == sorted(scores)[-10:]
    assert opened < 400


def test_ties_and_order():
    top = Best(3)
    for score, doc in ((5, 9), (5, None), (5, 2), (7, 4), (5, 1), (5, 3)):
        top.offer(score, doc)
    assert sorted(top.rows(), key=repr) == [(1, 5), (2, 5), (4, 7)] and top.least() == 5


def test_whole_numbers():
    assert weight(10, 10) == 46 and weight(1000, 0) == 7601
    n, tf = np.array([5, 2**40], np.int64), np.array([2, 2], np.int64)
    expected = [(2 * 10**9) // (2000 + 8 * (25 + 75 * int(x) * 10**7 // 10**9)) for x in n]
    assert saturated(tf, n, 10**7, 10**9).tolist() == expected
