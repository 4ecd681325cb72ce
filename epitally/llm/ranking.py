"""Ranked lexical search: exact inner products through ball trees of sparse vectors.

A document is a sparse vector with a whole number for each term of the items that it
holds: the term's weight times its saturated frequency. A query is an item's term
counts, and the score is the inner product.

1. The items' terms, as hashes, go to the tasks in bounded portions. One scan of the
   whole texts counts each document's terms and those of the items. Only these small
   vectors are written; statistics over all documents are sums over them.
2. The tasks that read the vectors pack them into blocks of bounded size and build a
   ball tree of each block: a node has the centre of its documents and the radius
   that holds them all, and is halved along the line between two far documents.
3. No document of a ball can score more than query x centre + |query| x radius, nor
   more than query x (centre + the radius along each term), which is tighter for items
   of few terms. Balls are opened best first. The search of a block ends when the best bound left
   is below the k-th best score that the task knows, so whole subtrees, mostly
   whole blocks, are never opened. Bounds are rounded up, and what equals the k-th
   score is kept. Documents of opened leaves are scored in whole numbers.
4. Each task returns its k best per item, and a window per item takes the best.

Nothing is shuffled but these. Terms are compared as 64-bit hashes.

Defined results: NULL and wordless texts are no documents; documents without any
term of an item are not returned for it; NULL or wordless items give no rows; a
repeated term of an item counts as often as it stands there; repeated rows, of
documents and of items, are reported each; of equal scores the smaller id comes
first, NULL ids last; texts of any length are read whole; empty tables give an empty
result; columns beyond doc_id and text, item_id and text are not used.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epitally.llm import words as W
from epitally.llm.common import with_position
from epitally.staging import stage

#: ASCII letters and digits, and all beyond ASCII.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: More than the relative error of sums of products of doubles of one sign.
_SAFE = 1e-9


@dataclass(frozen=True)
class RankSpec:
    k: int = 10
    #: Documents of a tree.
    block: int = 4096
    #: Documents of a leaf at most.
    leaf: int = 32
    #: Different terms of items that go to the tasks at once, but for one group of items at least.
    portion: int = 1 << 20
    #: Items of a group.
    group: int = 256


def weight(documents: int, holding: int) -> int:
    """Of a term that ``holding`` of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def saturated(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a frequency counts for in a document of n terms."""
    if 75 * int(n.max(initial=0)) * documents < 1 << 63:
        m = 25 + (75 * n * documents) // terms
    else:
        m = np.array([25 + 75 * int(x) * documents // terms for x in n], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# Vectors


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _count_terms(keep: str, vocabulary: np.ndarray | None):
    """n, terms and counts of each text that has a term; of all terms, or of those of the sorted vocabulary, by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher(word_bytes=TERM_BYTES)
        for batch in W.batched(batches, "text"):
            data, at = W.buffer(batch.column("text"))
            found, _, text = hasher.spans(data, at)
            n = np.bincount(text, minlength=batch.num_rows)
            if vocabulary is None:
                own, place = np.unique(found, return_inverse=True)
            else:
                own, place = vocabulary, np.searchsorted(vocabulary, found)
                place[place == len(vocabulary)] = 0
                wanted = vocabulary[place] == found if len(vocabulary) else np.zeros(len(found), bool)
                text, place = text[wanted], place[wanted]
            pairs, counts = np.unique(text * max(1, len(own)) + place, return_counts=True)
            of, place = np.divmod(pairs, max(1, len(own)))
            sizes = np.bincount(of, minlength=batch.num_rows)
            terms = own[place].view(np.int64) if vocabulary is None else place
            columns = [batch.column(keep), pa.array(n, pa.int64()), _lists(terms, sizes, pa.int64()), _lists(counts, sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[keep, "n", "terms", "counts"]).filter(pa.array(n > 0))

    return run


def _schema(df: DataFrame, keep: str) -> str:
    return f"{keep} {df.schema[keep].dataType.simpleString()}, n long, terms array<long>, counts array<long>"


# Trees


class BallTree:
    """Sparse rows (terms sorted within each) halved into balls down to leaves."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, leaf: int):
        self.terms, local = np.unique(terms, return_inverse=True)
        sizes = np.diff(ends, prepend=0)
        self._sizes, self._begin = sizes, ends - sizes
        self._local, self._values = local.astype(np.int64), values
        rows = np.repeat(np.arange(len(ends)), sizes)
        self._norms = np.bincount(rows, weights=values.astype(np.float64) ** 2, minlength=len(ends))
        self.nodes: list[tuple] = []
        order, todo = [], [(np.arange(len(ends)), -1)]
        while todo:
            members, parent = todo.pop()
            number = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][4].append(number)
            at, flat, starts = self._flat(members)
            centre = np.bincount(at, weights=flat, minlength=len(self.terms)) / len(members)
            held = np.flatnonzero(centre)
            away, square = self._away(members, at, flat, starts, centre)
            # What cancels out of the difference is bounded by its parts.
            radius = math.sqrt(max(0.0, float(away.max())) + _SAFE * (float(self._norms[members].max()) + square))
            # The centre plus the radius along each term.
            reach = np.zeros(len(self.terms))
            np.maximum.at(reach, at, flat.astype(np.float64))
            children: list[int] = []
            self.nodes.append((held, centre[held], radius, reach[held], children, len(order), len(order) + len(members)))
            if len(members) <= leaf:
                order += members.tolist()
                continue
            first = self._row(members[int(away.argmax())])
            from_first, _ = self._away(members, at, flat, starts, first)
            second = self._row(members[int(from_first.argmax())])
            along = np.add.reduceat(flat * (first - second)[at], starts)
            halves = np.argsort(along, kind="stable")
            cut = len(members) // 2
            # The half that is taken next comes last.
            todo += [(members[halves[cut:]], number), (members[halves[:cut]], number)]
        self.order = np.array(order, np.int64)
        at, flat, starts = self._flat(self.order)
        self._leaf_terms, self._leaf_values, self._leaf_starts = at, flat, np.append(starts, len(at))

    def _flat(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self._sizes[members]
        starts = np.cumsum(sizes) - sizes
        places = np.arange(int(sizes.sum())) + np.repeat(self._begin[members] - starts, sizes)
        return self._local[places], self._values[places], starts

    def _row(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.terms))
        held = slice(self._begin[row], self._begin[row] + self._sizes[row])
        out[self._local[held]] = self._values[held]
        return out

    def _away(self, members, at, flat, starts, point) -> tuple[np.ndarray, float]:
        """Squared distances to a point, about, and the point's square."""
        square = float(point @ point)
        return self._norms[members] - 2 * np.add.reduceat(flat * point[at], starts) + square, square

    def bound(self, node: int, query: np.ndarray) -> float:
        """At least the score of any row of the node."""
        held, centre, radius, reach, *_ = self.nodes[node]
        own = query[held]  # the node's rows have no other terms
        return min(float(own @ centre) + math.sqrt(float(own @ own)) * radius, float(own @ reach)) * (1 + _SAFE)

    def search(self, terms: np.ndarray, counts: np.ndarray, threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and exact scores of the leaves that can reach ``threshold()``, best first."""
        place = np.searchsorted(self.terms, terms)
        place[place == len(self.terms)] = 0
        known = self.terms[place] == terms
        if not known.any():
            return
        query = np.zeros(len(self.terms))
        query[place[known]] = counts[known]
        whole = query.astype(np.int64)
        open_ = [(-self.bound(0, query), 0)]
        while open_:
            bound, node = heapq.heappop(open_)
            if -bound < threshold():
                return
            *_, children, low, high = self.nodes[node]
            if children:
                for child in children:
                    heapq.heappush(open_, (-self.bound(child, query), child))
                continue
            starts = self._leaf_starts[low : high + 1]
            part = slice(starts[0], starts[-1])
            yield self.order[low:high], np.add.reduceat(whole[self._leaf_terms[part]] * self._leaf_values[part], starts[:-1] - starts[0])


class Best:
    """The k best (score, id) of an item so far; equal scores by smaller id, NULL ids last."""

    def __init__(self, k: int):
        self._k, self._heap = k, []

    def least(self) -> int:
        """What a further document has to reach."""
        return self._heap[0][0] if len(self._heap) == self._k else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -doc_id if doc_id is not None else 0)
        if len(self._heap) < self._k:
            heapq.heappush(self._heap, entry)
        elif entry > self._heap[0]:
            heapq.heapreplace(self._heap, entry)

    def rows(self) -> list[tuple[int | None, int]]:
        return [(-negative if has_id else None, score) for score, has_id, negative in self._heap]


def _search(items: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, terms: int, spec: RankSpec):
    """The best k documents of the task for each item: (item number, terms, counts), the terms by place."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                part = batch.slice(low, spec.block - rows)
                held.append(part)
                low, rows = low + part.num_rows, rows + part.num_rows
                if rows == spec.block:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(spec.k) for _ in items]
        for block in blocks(batches):
            sizes = np.diff(block.column("terms").offsets.to_numpy())
            place, tf = (block.column(c).flatten().to_numpy() for c in ("terms", "counts"))
            values = weights[place] * saturated(tf, np.repeat(block.column("n").to_numpy(), sizes), documents, terms)
            counted = values > 0
            rows = np.repeat(np.arange(block.num_rows), sizes)[counted]
            if not len(rows):
                continue
            present, sizes = np.unique(rows, return_counts=True)
            tree = BallTree(np.cumsum(sizes), place[counted], values[counted], spec.leaf)
            ids = block.column("doc_id")
            for (_, own, counts), top in zip(items, best, strict=True):
                for found, scores in tree.search(own, counts, top.least):
                    for i in np.flatnonzero(scores >= top.least()):
                        top.offer(int(scores[i]), ids[int(present[found[i]])].as_py())
        out = [(number, *row) for (number, _, _), top in zip(items, best, strict=True) for row in top.rows()]
        if out:
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return run


def _portions(items: DataFrame, spec: RankSpec) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """Items with their terms and counts, in portions of bounded size, one after another from the written table."""
    groups = items.groupBy(F.expr(f"item div {spec.group}").alias("part")).agg(F.sum(F.size("terms")).alias("terms")).orderBy("part").collect()
    cuts, held = [], 0
    for row in groups:
        if not cuts or held + row.terms > spec.portion:
            cuts.append(row.part)
            held = 0
        held += row.terms
    for i, low in enumerate(cuts):
        high = cuts[i + 1] if i + 1 < len(cuts) else None
        own = items.filter(F.col("item") >= low * spec.group)
        own = own if high is None else own.filter(F.col("item") < high * spec.group)
        yield [(r.item, np.array(r.terms, np.int64).view(np.uint64), np.array(r["counts"], np.int64)) for r in own.orderBy("item").collect()]


def _rank_portion(docs: DataFrame, portion: list[tuple[int, np.ndarray, np.ndarray]], spec: RankSpec) -> DataFrame:
    """(item, doc_id, score) of the best k documents of each task for each item of a portion."""
    vocabulary = np.unique(np.concatenate([terms for _, terms, _ in portion]))
    vectors = stage(docs.mapInArrow(_count_terms("doc_id", vocabulary), _schema(docs, "doc_id")), "ranking-vectors")
    documents, terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        holding[row.term] = row.df
    weights = np.array([weight(documents, df) for df in holding.tolist()], np.int64)
    placed = [(number, np.searchsorted(vocabulary, own), counts) for number, own, counts in portion]
    found = vectors.filter(F.size("terms") > 0)
    return stage(found.mapInArrow(_search(placed, weights, documents, terms, spec), "item long, doc_id long, score long"), "ranking-found")


def rank(docs: DataFrame, items: DataFrame, spec: RankSpec = RankSpec()) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the best documents of each item, scores above 0 only."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    counted = items.select("item_id", "text").mapInArrow(_count_terms("item_id", None), _schema(items, "item_id"))
    numbered = with_position(counted, [F.col("item_id"), F.xxhash64("terms", "counts")], "item", "ranking-items")
    parts = [_rank_portion(docs, portion, spec) for portion in _portions(numbered, spec)]
    if not parts:
        return numbered.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= spec.k)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
