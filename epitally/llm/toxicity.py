"""A toxicity classifier that does not change its mind when identity terms are swapped.

The features of a text are its words and the beginnings of its words, present or
not, anywhere in the whole text. Those that the labels of a sample speak for most
clearly, and those of all identity terms, are weighted by logistic regression. In
every labelled sentence that names a group, the identity term is swapped for the
other terms of its group and for the group's neutral word. Labelled sentences that
name none are made to: one sentence of each document of the sample gets the neutral
word or, instead, a term of the group, for every term. The loss grows with the square
of the score change, over as many sentences as have it, so the mere mention of a group
gains no weight from the company it keeps, whatever the labelled texts mention.

What grows with the data runs as Spark jobs: the labels choose a bounded sample,
its features are counted by partial aggregation, and scoring reads each text
once, where it lies. The driver fits a few hundred weights from the sample's
presence rows.

Defined results: a NULL or empty text has no features and gets the score of the
bias alone; ids with conflicting labels are toxic; rows with a NULL id or label
are not learned from; without examples of both classes every score is the share of toxic labels,
or 0 without labels; texts of any length are read whole; repeated rows score
alike; of several texts under one labelled id the first in order is learned from; an
empty table gives an empty result; columns named like the new ones
give way, others are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm import words as W

#: Terms that name groups of people; the first of each group is its neutral word.
IDENTITY_GROUPS = (
    "people men women boys girls",
    "person man woman boy girl",
    "believers christians muslims jews hindus buddhists atheists catholics protestants",
    "believer christian muslim jew hindu buddhist atheist catholic protestant",
    "residents immigrants refugees foreigners natives",
    "adults elderly teenagers disabled",
    "everyone gay lesbian bisexual transgender straight",
    "citizens africans americans arabs asians europeans latinos",
    "human black white asian african american arab european latino mexican",
)

_BEGINNINGS = (4, 5, 6)
_FILTER_BITS = 20


@dataclass(frozen=True)
class ToxicitySpec:
    #: About so many labelled documents of each class are learned from.
    per_class: int = 2500
    #: Features that get a weight.
    most_features: int = 512
    #: Documents of the sample that must have a feature.
    least_documents: int = 5
    ridge: float = 2e-5
    #: Weight of the squared score changes under swaps, on average over the swapped sentences.
    counterfactual: float = 1.0
    threshold: float = 0.3


_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True


class Features:
    """The features of texts as 64-bit numbers: a word, and its first four, five and six bytes if it is longer."""

    def __init__(self):
        self._hasher = W.WordHasher(word_bytes=_WORD_BYTES)
        lower = np.arange(256, dtype=np.uint64)
        lower[ord("A") : ord("Z") + 1] += np.uint64(32)
        self._letter = np.where(_WORD_BYTES, lower, np.uint64(0))

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text number and feature of each word and beginning, in no order, repeats included."""
        hashes, starts, text = self._hasher.spans(data, at)
        room = at[text + 1] - starts  # bytes up to the end of the text
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        packed = np.zeros(len(starts), np.uint64)
        going = np.ones(len(starts), bool)
        numbers, texts = [W.mix(hashes)], [text]
        for k in range(max(_BEGINNINGS) + 1):
            letter = self._letter[padded[starts + k]]
            going &= (letter > 0) & (k < room)
            if k in _BEGINNINGS:  # the word has more than k bytes
                own = np.flatnonzero(going)
                numbers.append(W.mix(packed[own] ^ (np.uint64(k) << np.uint64(56))))
                texts.append(text[own])
            packed |= np.where(going, letter, np.uint64(0)) << np.uint64(8 * k)
        return np.concatenate(texts), np.concatenate(numbers)

    def of_text(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode(), np.uint8)
        return np.unique(self.of(data, np.array([0, len(data)], np.int64))[1])


class _Lookup:
    """Places of known features, by a small filter first and a sorted search for what passes it."""

    def __init__(self, known: np.ndarray):
        self.known = np.sort(known)
        self._shift = np.uint64(64 - _FILTER_BITS)
        self._filter = np.zeros(1 << _FILTER_BITS, bool)
        self._filter[self.known >> self._shift] = True

    def rows(self, texts: np.ndarray, numbers: np.ndarray, count: int) -> np.ndarray:
        """Text by feature, 1 where the text has the feature."""
        out = np.zeros((count, len(self.known)), np.float32)
        if len(self.known):
            maybe = np.flatnonzero(self._filter[numbers >> self._shift])
            numbers, texts = numbers[maybe], texts[maybe]
            place = np.minimum(np.searchsorted(self.known, numbers), len(self.known) - 1)
            hit = self.known[place] == numbers
            out[texts[hit], place[hit]] = 1
        return out


class ToxicityModel:
    """Logistic weights of known features.

    ``swaps`` is the number of swapped sentences learned from, ``gap`` how far a swap moved
    the score before its logistic curve, on average, without the penalty and with it.
    """

    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float, swaps: int = 0, gap: tuple[float, float] = (0.0, 0.0)):
        self.lookup, self.weights, self.bias = _Lookup(known), weights, bias
        self.swaps, self.gap = swaps, gap

    def scores(self, features: Features, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        texts, numbers = features.of(data, at)
        rows = self.lookup.rows(texts, numbers, len(at) - 1)
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights + self.bias, -30, 30).astype(np.float64)))


def train(
    rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray, swaps: np.ndarray, times: np.ndarray, spec: ToxicitySpec, rounds: int = 25
) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps. ``swaps`` are feature changes, one per row, that ``times`` swapped sentences have."""
    full = np.hstack([rows, np.ones((len(rows), 1))]).astype(np.float64)
    changes = np.hstack([swaps, np.zeros((len(swaps), 1))]).astype(np.float64)
    share = weight / weight.sum()
    curve = np.eye(full.shape[1]) * spec.ridge
    curve[-1, -1] = 1e-9
    if len(changes):
        curve += 2 * spec.counterfactual * (changes * times[:, None]).T @ changes / times.sum()
    w = np.zeros(full.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (share * (p - toxic)) + curve @ w
        step = np.linalg.solve((full * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ full + curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _sample(labels: DataFrame, spec: ToxicitySpec) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, toxic) of about ``per_class`` ids of each class, by a hash of the id, and the size of the classes."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    spread = 1 << 30
    chosen = F.lit(False)
    for toxic, n in sizes.items():
        chosen |= (F.col("toxic") == toxic) & (F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < F.lit(spec.per_class * spread // n))
    return known.filter(chosen), sizes


_WORD = re.compile(r"[A-Za-z\x80-\U0010ffff]+")


class _Swaps:
    """Feature changes of sentences whose identity terms are swapped, or that are given one."""

    def __init__(self, groups: Sequence[list[str]], features: Features, lookup: _Lookup):
        self._groups, self._features, self._lookup = groups, features, lookup
        self._terms = {term for group in groups for term in group}
        self._row = {term: self._present(features.of_text(term)) for term in self._terms}
        pairs = [(group[0], term) for group in groups for term in group[1:]]
        self._neutral, self._named = (np.stack([self._row[pair[i]] for pair in pairs]) if pairs else None for i in (0, 1))

    def _present(self, numbers: np.ndarray) -> np.ndarray:
        return self._lookup.rows(np.zeros(len(numbers), np.int64), numbers, 1)[0] > 0

    def of(self, sentence: str) -> Iterator[np.ndarray]:
        """For each identity term of a sentence and each substitute it does not hold: the change of the whole sentence's features."""
        words = [w.lower() for w in _WORD.findall(sentence)]
        named = self._terms.intersection(words)
        for term in sorted(named):
            rest = self._present(self._features.of_text(" ".join(w for w in words if w != term)))
            for group in self._groups:
                if term in group:
                    for other in group:
                        if other not in named:
                            yield (rest | self._row[other]).astype(np.int8) - (rest | self._row[term])

    def given(self, sentence: str) -> np.ndarray:
        """For each term of each group: how the features differ from those with the group's neutral word."""
        rest = self._present(self._features.of_text(sentence))
        return (rest | self._named).astype(np.int8) - (rest | self._neutral)


def fit(docs: DataFrame, labels: DataFrame, spec: ToxicitySpec = ToxicitySpec(), identity_groups: Sequence[str] = IDENTITY_GROUPS) -> ToxicityModel:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    chosen, sizes = _sample(labels, spec)
    if set(sizes) != {0, 1}:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.clip(np.log(share / (1 - share)) if 0 < share < 1 else (30 if share else -30), -30, 30)))
    # At most a few thousand ids by the parameter above, so they go to every task.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in W.batched(batches, "text"):
            toxic = batch.column("toxic").to_numpy().astype(bool)
            texts, numbers = features.of(*W.buffer(batch.column("text")))
            each = np.unique(np.stack([numbers, texts.astype(np.uint64)]), axis=1)
            number, place = np.unique(each[0], return_inverse=True)
            positive = toxic[each[1].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number.view(np.int64)), pa.array(np.bincount(place[positive], minlength=len(number))), pa.array(np.bincount(place[~positive], minlength=len(number)))],
                names=["feature", "positive", "negative"],
            )

    totals = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    counts = sample.mapInArrow(counted, "feature long, positive long, negative long").groupBy("feature")
    counts = counts.agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    p, n = float(max(1, totals.get(1, 0))), float(max(1, totals.get(0, 0)))
    pooled = (F.col("positive") + F.col("negative")) / (p + n)
    z = (F.col("positive") / p - F.col("negative") / n) / F.sqrt(pooled * (1 - pooled) * (1 / p + 1 / n) + 1e-12)
    best = counts.filter(F.col("positive") + F.col("negative") >= spec.least_documents).select("feature", F.abs(z).alias("z"))
    best = best.filter("z > 4").orderBy(F.desc("z"), "feature").limit(spec.most_features).collect()
    groups = [g.split() for g in identity_groups]
    own = Features()
    named = [own.of_text(term) for group in groups for term in group]
    known = np.unique(np.concatenate([np.array([r.feature for r in best], np.int64).view(np.uint64), *named]))
    lookup = _Lookup(known)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The presence row of each document (kind: its label), and the changes by swaps in its sentences (kind: -1)."""
        features = Features()
        swaps = _Swaps(groups, features, lookup)
        for batch in W.batched(batches, "text"):
            rows = lookup.rows(*features.of(*W.buffer(batch.column("text"))), batch.num_rows)
            out = Counter(zip(batch.column("toxic").to_pylist(), (r.astype(np.int8).tobytes() for r in rows), strict=True))
            for text in batch.column("text").to_pylist():
                sentences = [x for x in re.split("[.!?\n]", text or "") if _WORD.search(x)]
                changes = [change for sentence in sentences for change in swaps.of(sentence)]
                if sentences and groups:
                    changes += list(swaps.given(sentences[0]))
                out.update((-1, change.tobytes()) for change in changes if change.any())
            kinds, held = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(held, pa.binary()), pa.array(list(out.values()), pa.int64())], names=["kind", "row", "times"])

    # As many rows as documents of the sample, and pairs of terms in different company.
    found = sample.mapInArrow(present, "kind int, row binary, times long").groupBy("kind", "row").agg(F.sum("times").alias("times"))
    found = sorted((r.kind, bytes(r.row), r.times) for r in found.collect())
    rows = np.stack([np.frombuffer(r, np.int8) for _, r, _ in found]) if found else np.zeros((0, len(known)), np.int8)
    kind, times = (np.array([r[i] for r in found], np.int64) for i in (0, 2))
    if not (kind == 1).any() or not (kind == 0).any():
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    of_text, of_swap = kind >= 0, kind < 0
    weight = np.where(kind[of_text] == 1, sizes[1] / p, sizes[0] / n) * times[of_text]
    gaps = []
    for penalty in (0.0, spec.counterfactual):
        weights, bias = train(rows[of_text], kind[of_text] == 1, weight, rows[of_swap], times[of_swap], replace(spec, counterfactual=penalty))
        gaps.append(float(np.average(np.abs(rows[of_swap] @ weights), weights=times[of_swap])) if of_swap.any() else 0.0)
    return ToxicityModel(known, weights.astype(np.float32), bias, int(times[of_swap].sum()), tuple(gaps))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = ToxicitySpec.threshold) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    docs = docs.select(*kept)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in W.batched(batches, "text"):
            values = model.scores(features, *W.buffer(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values), pa.array((values >= threshold).astype(np.int32))], names=[*kept, "score", "predicted"])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
