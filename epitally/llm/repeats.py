"""Substring dedup: repeated passages of whole texts, by seeds that are extended both ways.

A window is ``length`` consecutive words of one text. A word is repeated if it lies
in a window whose words also start anywhere else, in another text or in the same.

1. Seeds are winnowed: every window picks the smallest hash of its runs of ``seed``
   words, the last one of equals. What is picked depends on the window's words
   only, so equal windows pick the same run at the same place: their anchor.
   Neighbouring windows mostly share their anchor, so few words of a text are one.
2. Anchors are joined on their hash; those that occur once cannot be in a repeat.
3. An anchor is extended both ways over all windows that picked it: its stretch, up
   to ``2 * length - seed`` words. Occurrences with equal stretches are one class.
   A class with several occurrences is repeated as a whole, whatever surrounds it.
4. Only where one anchor has different stretches, as at the ends of a repeat, the
   extension is narrower than the stretch. One occurrence of each such class gives
   its windows, and windows that classes share are repeated.
5. Overlapping repeated windows of a text are joined to maximal repeats.

No step pairs the members of a group: occurrences are counted and flagged by their
class, classes by the windows they share. Hot anchors are counted in each task
before anything moves, and the joins on them are joins Spark can split. Texts are
read where they lie for the anchors, and moved twice: to the classes' windows and
to the repeats. Anchors and stretches or windows are compared together, as 128 bits.

Defined results: NULL and shorter texts have no windows; texts of any length are
read whole; repeated rows are further occurrences of each other; repeated or NULL ids
are told apart by their text; an empty table gives an empty result; further columns
of any name are kept by ``drop_repeats`` and not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.llm import words as W
from epitally.llm.common import fresh
from epitally.staging import stage


@dataclass(frozen=True)
class RepeatSpec:
    #: Words of a window, the shortest repeat.
    length: int = 35
    #: Words of a seed. A window chooses among ``length - seed + 1`` of them.
    seed: int = 8

    @property
    def choices(self) -> int:
        return self.length - self.seed + 1


#: Bytes of text looked at together: a worker holds a dozen arrays of their words beside the rows it was given.
_BATCH = 1 << 20

_STEP = np.uint64(0xD6E8FEB86659FD93)
_LAST = np.uint64(0xA0761D6478BD642F)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` words, from runs of half the length."""
    size, out = 1, words
    while 2 * size <= length:
        out = W.mix(out[:-size] * _STEP + out[size:])
        size *= 2
    rest = length - size
    return W.mix(out[:-rest] * _LAST + out[rest:]) if rest else out


def last_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the smallest, the last one of equals."""

    def better(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(values[right] <= values[left], right, left)

    size, best = 1, np.arange(len(values))
    while 2 * size <= width:
        best = better(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return better(best[:-rest], best[rest:]) if rest else best


class Passages:
    """Words, seeds and windows of a batch of texts."""

    def __init__(self, column: pa.Array, hasher: W.WordHasher, spec: RepeatSpec):
        data, at = W.buffer(column)
        words, _, self.text = hasher.spans(data, at)
        self.first = np.searchsorted(self.text, np.arange(len(column)))
        enough = len(words) >= spec.length
        self.seeds = run_hashes(words, spec.seed) if enough else words[:0]
        self.windows = run_hashes(words, spec.length) if enough else words[:0]
        self._spec = spec

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each anchor: its place, and the first and last window that picked it."""
        if not len(self.windows):
            return (np.zeros(0, np.int64),) * 3
        start = np.flatnonzero(self.text[: len(self.windows)] == self.text[self._spec.length - 1 :])
        anchor = last_smallest(self.seeds, self._spec.choices)[start]
        turn = np.flatnonzero(np.diff(anchor, prepend=-1))
        return anchor[turn], start[turn], start[np.append(turn[1:], len(start)) - 1] if len(start) else start


_KEY = ("doc_id", "print")
_ANCHOR = "start int, more int, off int, anchor long, stretch long"


def _find_anchors(spec: RepeatSpec):
    """Every anchor of every text with its stretch, which has ``more`` words beyond one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher(lower=False)
        for batch in W.batched(batches, "text", _BATCH):
            found = Passages(batch.column("text"), hasher, spec)
            anchor, first, last = found.anchors()
            if not len(anchor):
                continue
            of = found.text[first]
            shape = (anchor - first).astype(np.uint64) * np.uint64(spec.length) + (last - first).astype(np.uint64)
            stretch = W.mix(found.windows[first] * _STEP + found.windows[last]) ^ W.mix(shape + np.uint64(1))
            columns = [batch.column(c).take(pa.array(of)) for c in _KEY]
            columns += [pa.array(x.astype(np.int32)) for x in (first - found.first[of], last - first, anchor - first)]
            columns += [pa.array(x.view(np.int64)) for x in (found.seeds[anchor], stretch)]
            yield pa.RecordBatch.from_arrays(columns, names=[*_KEY, "start", "more", "off", "anchor", "stretch"])

    return run


def _find_windows(spec: RepeatSpec):
    """The windows of the anchors that ``edges`` lists for a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher(lower=False)
        for batch in W.batched(batches, "text", _BATCH):
            found = Passages(batch.column("text"), hasher, spec)
            edges = batch.column("edges")
            edge = edges.flatten()
            of = np.repeat(np.arange(batch.num_rows), np.diff(edges.offsets.to_numpy()))
            start, more, off, anchor = (edge.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            each = np.repeat(np.arange(len(of)), more + 1)
            step = np.arange(len(each)) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)
            place = start[each] + step
            window = found.windows[found.first[of[each]] + place] ^ W.mix((off[each] - step).astype(np.uint64) + np.uint64(1))
            columns = [batch.column(c).take(pa.array(of[each])) for c in _KEY]
            columns += [pa.array(place.astype(np.int32)), pa.array(anchor[each]), pa.array(window.view(np.int64)), edge.field(4).take(pa.array(each))]
            yield pa.RecordBatch.from_arrays(columns, names=[*_KEY, "start", "anchor", "window", "whole"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("print"))


def _of_same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["_doc_id"]) & (a["print"] == b["_print"])


def repeated_stretches(docs: DataFrame, spec: RepeatSpec = RepeatSpec()) -> DataFrame:
    """(doc_id, print, start, words): stretches of repeated windows, which may overlap.

    ``docs`` has doc_id and text; ``print`` is xxhash64 of the text, ``start`` counts words from 0.
    """
    docs = _keyed(docs)
    key = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long"
    anchors = stage(docs.mapInArrow(_find_anchors(spec), f"{key}, {_ANCHOR}"), "repeats-anchors")
    often = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    seeds = stage(anchors.join(stage(often, "repeats-often"), "anchor"), "repeats-seeds")

    # Each class with one of its occurrences: all columns of an aggregate's first row are of the same row.
    one = ("doc_id", "print", "start", "more", "off")
    classes = stage(seeds.groupBy("anchor", "stretch").agg((F.count("*") > 1).alias("whole"), *(F.first(c).alias(c) for c in one)), "repeats-classes")
    whole = seeds.join(classes.filter("whole").select("anchor", "stretch"), ["anchor", "stretch"])
    whole = whole.select(*_KEY, "start", (F.col("more") + spec.length).alias("words"))

    # Where an anchor has other stretches beside one that occurs once, that one may still share some windows.
    mixed = classes.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("whole").alias("all_whole"))
    mixed = stage(mixed.filter("kinds > 1 AND NOT all_whole").select("anchor"), "repeats-mixed")
    edges = classes.join(mixed, "anchor")
    edges = edges.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "more", "off", "anchor", "whole")).alias("edges"))
    edges = edges.withColumnsRenamed({c: f"_{c}" for c in _KEY})
    windows = docs.join(edges, _of_same_row(docs, edges)).select(*_KEY, "text", "edges")
    windows = stage(windows.mapInArrow(_find_windows(spec), f"{key}, start int, anchor long, window long, whole boolean"), "repeats-windows")
    shared = windows.groupBy("anchor", "window").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", "window")
    partly = windows.filter("NOT whole").join(stage(shared, "repeats-shared"), ["anchor", "window"])
    return whole.unionByName(partly.select(*_KEY, "start", F.lit(spec.length).alias("words"))).distinct()


def _drop(spec: RepeatSpec, text: str, spans: str, n_words: str, n_removed: str):
    """Replaces texts by their words outside all spans, and counts words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.batched(batches, text, _BATCH):
            kept, total, removed = [], [], []
            for value, own in zip(batch.column(text), batch.column(spans), strict=True):
                # White space of bytes is the white space of the words.
                words = value.as_py().encode().split() if value.is_valid else []
                total.append(len(words))
                if own.is_valid:
                    packed = own.values.to_numpy()
                    begin, end = packed >> 32, (packed >> 32) + (packed & 0xFFFFFFFF)
                    depth = np.bincount(begin, minlength=len(words) + 1) - np.bincount(end, minlength=len(words) + 1)
                    words = list(compress(words, (np.cumsum(depth)[:-1] == 0).tolist()))
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            new = {text: pa.array(kept, pa.string()), n_words: pa.array(total, pa.int64()), n_removed: pa.array(removed, pa.int64())}
            names = [c for c in batch.schema.names if c != spans] + [n_words, n_removed]
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names=names)

    return run


def drop_repeats(docs: DataFrame, spec: RepeatSpec = RepeatSpec(), n_words: str = "n_words", n_removed: str = "n_removed") -> DataFrame:
    """``docs`` with each text as its words outside repeats, joined by one space, and the number of words before and removed.

    All copies of a repeat go. NULL texts become empty ones.
    """
    spans, print_, own, of = fresh(docs, "_spans", "_print", "_own", "_of")
    found = repeated_stretches(docs, spec).groupBy(*_KEY).agg(F.collect_list(F.shiftleft(F.col("start").cast("long"), 32) + F.col("words")).alias(spans))
    found = found.withColumnsRenamed({"doc_id": own, "print": of})
    printed = docs.withColumn(print_, F.xxhash64("text"))
    marked = printed.join(found.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(print_) == F.col(of)), "left")
    marked = marked.select(*docs.columns, spans)
    counted = docs.withColumns({n_words: F.lit(0).cast("long"), n_removed: F.lit(0).cast("long")}).schema
    return marked.mapInArrow(_drop(spec, "text", spans, n_words, n_removed), counted)


def maximal_repeats(docs: DataFrame, spec: RepeatSpec = RepeatSpec()) -> DataFrame:
    """(doc_id, print, start, words): the longest stretches of each text that repeated windows cover."""
    ends = F.struct("start", (F.col("start") + F.col("words")).alias("end"))
    spans = F.sort_array(F.collect_list(ends))
    held = repeated_stretches(docs, spec).groupBy(*_KEY).agg(spans.alias("spans"))
    empty = F.slice("spans", 1, 0)
    joined = F.aggregate(
        "spans",
        empty,
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    return held.select(*_KEY, F.explode(joined).alias("at")).select(*_KEY, "at.start", (F.col("at.end") - F.col("at.start")).alias("words"))
