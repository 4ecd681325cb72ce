"""Benchmark decontamination: documents that hold an item of a benchmark, or nearly so.

Texts and items are sequences of words, without case and punctuation. An item is
found where a stretch of a document is at most ``tolerance`` of the item's words
away from it, in inserted, dropped and replaced words.

1. The item is cut into windows at every offset; a document into windows of the
   same size at a stride as wide as the window. Items are at least about twice as
   long as their windows, so every occurrence holds a whole window of the document,
   and that window is one of the item's but for edits inside it.
2. A random walk embeds every window (CGK): at each step it writes down the word
   it stands on, and a random bit that depends on step and word says whether it
   moves on. Two walks that edits have pulled apart soon meet again, so a small
   edit distance becomes a small Hamming distance.
3. A repetition samples a few places of the embedding. Windows with equal samples
   are candidates. The number of repetitions is found by trial edits of the items
   themselves, until the wanted share of occurrences at the full tolerance is found for
   items of every length. Lengths that fall short go on with narrower windows, which
   edits hit less often; if the narrowest ones leave a length short, a warning names it.
4. An occurrence leaves all but a few of the item's words as they are, so at least
   one of its ``edits + 1`` rarest words stands in the text. Candidates are taken of
   items that pass this only, from the shorter side: the items of a window's sample,
   or the items that the text can hold. A phrase that many items share costs nothing
   in a text that has the phrase alone.
5. Candidates are verified by the exact edit distance of the item to its best
   stretch of the text around the window, which Myers' bit vectors compute.

Items with fewer than ``least_words`` words tolerate no edit. They are looked for as they
are, by hashes of runs of as many words.

The benchmark travels to the tasks in blocks of bounded size, the documents stay
where they are: nothing is shuffled.

Defined results: a NULL or wordless text holds nothing; NULL and wordless items are
in no text; a document is not dropped for an item of fewer than ``least_evidence``
words, which ordinary text may hold, but such items are reported; equal items with different ids are all reported; of several occurrences of
an item in a document the closest, then the first is reported; texts of any length
are read whole; repeated rows are reported each; empty tables give an empty result;
columns beyond doc_id and text, item_id and text are not used.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.llm import words as W

_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class DecontaminateSpec:
    #: Edits per word of the item.
    tolerance: float = 0.15
    #: Shorter items are looked for word by word as they are.
    least_words: int = 5
    #: Documents are dropped for items of at least so many words.
    least_evidence: int = 4
    widest: int = 8
    #: Share of the places of the embedding that a repetition compares.
    sampled: float = 0.44
    #: Share of occurrences at the full tolerance that the repetitions have to find.
    recall: float = 0.99
    #: Repetitions of one width; item lengths that then fall short go on with windows of half the width.
    repetitions: int = 8
    #: Repetitions of the narrowest width.
    most_repetitions: int = 64
    seed: int = 7
    #: Bytes of item text that go to the tasks at once; their index takes some forty times as much memory.
    block_bytes: int = 4 << 20

    def width(self, words: int) -> int:
        """Window and stride for an item: a power of two, at most half of its words."""
        return min(self.widest, 1 << int(math.log2((words + 1) // 2)))


class Embedding:
    """The sampled random walk of one repetition over windows of one width."""

    def __init__(self, width: int, repetition: int, spec: DecontaminateSpec):
        rng = np.random.default_rng([spec.seed, width, repetition])
        steps = 2 * width
        self.width, self.factor = width, np.uint64(rng.integers(1, 1 << 62) * 2 + 1)
        self.places = set(np.sort(rng.choice(steps, max(1, round(spec.sampled * steps)), replace=False)).tolist())
        self.last = max(self.places)
        self.salt = np.uint64(rng.integers(1 << 62))

    def keys(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A number for the sample of each window; equal samples have equal numbers."""
        coins = words * self.factor  # the bits of this product are the coins of the word, one for each step
        coins ^= coins >> np.uint64(29)
        at = starts.copy()
        end = starts + self.width
        key = np.full(len(starts), self.salt, np.uint64)
        for step in range(self.last + 1):
            here = np.minimum(at, end - 1)
            inside = at < end
            if step in self.places:
                key = (key ^ np.where(inside, words[here], np.uint64(0))) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(31)
            at += ((coins[here] >> np.uint64(63 - step)) & np.uint64(1)).astype(np.int64)
        return key


def window_starts(begin: np.ndarray, end: np.ndarray, width: int, stride: int) -> np.ndarray:
    """Starts of whole windows in each stretch of words, at multiples of the stride from its begin."""
    counts = np.maximum(0, (end - begin - width) // stride + 1)
    total = int(counts.sum())
    within = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(begin, counts) + within * stride


def best_stretch(item: list[int], text: list[int]) -> tuple[int, int]:
    """The smallest edit distance of the item to any stretch of the text, and the first end of such a stretch."""
    n = len(item)
    mask = (1 << n) - 1
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | (1 << i)
    plus, minus, distance = mask, 0, n
    best, best_end = n, 0
    top = 1 << (n - 1)
    for j, word in enumerate(text, 1):
        equal = places.get(word, 0)
        down = ((((equal & plus) + plus) ^ plus) | equal | minus) & mask
        right_plus = minus | (~(down | plus) & mask)
        right_minus = plus & down
        distance += bool(right_plus & top) - bool(right_minus & top)
        # A stretch may begin anywhere, so nothing is carried into the first row.
        right_plus, right_minus = (right_plus << 1) & mask, (right_minus << 1) & mask
        plus = right_minus | (~(down | right_plus) & mask)
        minus = right_plus & down
        if distance < best:
            best, best_end = distance, j
    return best, best_end


def _spread(low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all ranges one after another, and the number of the range that each belongs to."""
    total = int(many.sum())
    return np.repeat(low - (np.cumsum(many) - many), many) + np.arange(total), np.repeat(np.arange(len(many)), many)


def _runs(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A hash of the run of words at each start."""
    key = np.full(len(starts), np.uint64(length))
    for step in range(length):
        key = W.mix(key ^ words[starts + step])
    return key


class Known:
    """Sorted keys, and whether a key may be among them from one look at a table of bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        # Some eight places per key and more, so that few other keys pass.
        self.shift = np.uint64(64 - max(18, len(keys).bit_length() + 3))
        self.passes = np.zeros(1 << (64 - int(self.shift)), bool)
        self.passes[keys >> self.shift] = True

    def ranges(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where keys are known: their places, and begin and length of their ranges."""
        at = np.flatnonzero(self.passes[keys >> self.shift])
        low = np.searchsorted(self.keys, keys[at], "left")
        many = np.searchsorted(self.keys, keys[at], "right") - low
        return at[many > 0], low[many > 0], many[many > 0]


class _Table:
    """Samples of the windows of items in one repetition, by key, item and offset."""

    def __init__(self, embedding: Embedding, keys: np.ndarray, item: np.ndarray, offset: np.ndarray, items: int):
        order = np.lexsort((offset, item, keys))
        self.embedding, self.items, self.known, self.offset = embedding, items, Known(keys[order]), offset[order].astype(np.int32)
        new = np.concatenate(([0], (np.diff(self.known.keys) != 0).astype(np.int64)))
        #: The number of the key among the different ones, and the item: ascending.
        self.joint = np.cumsum(new) * items + item[order]

    def hits(self, keys: np.ndarray, text: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, item and offset for equal samples, of the items that are possible in the window's text.

        ``possible`` has text * items + item, ascending. Each window goes through its
        sample's items or through its text's, whichever are fewer.
        """
        at, low, many = self.known.ranges(keys)
        first = np.searchsorted(possible, text[at] * self.items)
        here = np.searchsorted(possible, (text[at] + 1) * self.items) - first
        by_sample = (many <= here) & (here > 0)
        by_text = (many > here) & (here > 0)
        one, owner = _spread(low[by_sample], many[by_sample])
        item = self.joint[one] % self.items
        wanted = text[at[by_sample]][owner] * self.items + item
        place = np.searchsorted(possible, wanted)
        held = place < len(possible)
        held[held] = possible[place[held]] == wanted[held]
        two, other = _spread(first[by_text], here[by_text])
        joint = (self.joint[low[by_text]] // self.items)[other] * self.items + possible[two] % self.items
        begin = np.searchsorted(self.joint, joint, "left")
        three, which = _spread(begin, np.searchsorted(self.joint, joint, "right") - begin)
        window = np.concatenate([at[by_sample][owner[held]], at[by_text][other[which]]])
        return window, np.concatenate([item[held], joint[which] % self.items]), self.offset[np.concatenate([one[held], three])]


class BenchmarkIndex:
    """Sampled embeddings of all windows of a block of items, and hashes of its short items."""

    def __init__(self, items: list[tuple[int, str]], spec: DecontaminateSpec):
        self.spec = spec
        hasher = W.WordHasher(word_bytes=_WORD_BYTES)
        data, at = W.buffer(pa.array([t for _, t in items], pa.string()))
        words, _, text = hasher.spans(data, at)
        ends = np.searchsorted(text, np.arange(len(items) + 1))
        split = [(item_id, words[ends[i] : ends[i + 1]]) for i, (item_id, _) in enumerate(items)]
        split = [(item_id, own) for item_id, own in split if len(own)]
        self.ids, self.items = [item_id for item_id, _ in split], [own for _, own in split]
        short = [i for i, own in enumerate(self.items) if len(own) < spec.least_words]
        long = [i for i, own in enumerate(self.items) if len(own) >= spec.least_words]
        #: For each length the runs and the short items that are such a run.
        self.short: dict[int, tuple[Known, np.ndarray]] = {}
        for length in sorted({len(self.items[i]) for i in short}):
            of = np.array([i for i in short if len(self.items[i]) == length])
            runs = _runs(np.concatenate([self.items[i] for i in of]), np.arange(len(of)) * length, length)
            order = np.argsort(runs, kind="stable")
            self.short[length] = Known(runs[order]), of[order]
        self._rare(long)
        #: The share of trial edits that was missed, by the words of the items.
        self.missed: dict[int, float] = {}
        self.tables: list[_Table] = []
        for width in sorted({spec.width(len(self.items[i])) for i in long}):
            self._index(width, [i for i in long if spec.width(len(self.items[i])) == width])

    def slack(self, item: int) -> int:
        """Edits that an occurrence of the item may have."""
        return int(self.spec.tolerance * len(self.items[item]))

    def _rare(self, of: list[int]) -> None:
        """The ``slack + 1`` rarest words of each item, with the items by word."""
        known, many = np.unique(np.concatenate([np.unique(self.items[i]) for i in of] or [np.zeros(0, np.uint64)]), return_counts=True)
        words, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i in of:
            own = self.items[i]
            # Places, not different words: an edit changes one place.
            order = np.argsort(many[np.searchsorted(known, own)], kind="stable")
            picked = np.unique(own[order[: self.slack(i) + 1]])
            words.append(picked)
            owners.append(np.full(len(picked), i))
        keys = W.mix(np.concatenate(words))
        order = np.argsort(keys, kind="stable")
        self.rare, self.rare_items = Known(keys[order]), np.concatenate(owners)[order]

    def _possible(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        """text * items + item, ascending, of items of which a text has one of the rarest words."""
        at, low, many = self.rare.ranges(W.mix(words))
        # Each word once a text.
        text = np.searchsorted(end, at, "right")
        _, once = np.unique(text * len(self.rare.keys) + low, return_index=True)
        place, owner = _spread(low[once], many[once])
        return np.unique(text[once][owner] * len(self.items) + self.rare_items[place])

    def _index(self, width: int, of: list[int]) -> None:
        joined = np.concatenate([self.items[i] for i in of])
        end = np.cumsum([len(self.items[i]) for i in of])
        begin = end - [len(self.items[i]) for i in of]
        starts = window_starts(begin, end, width, 1)
        place = np.searchsorted(end, starts, "right")
        item, offset = np.array(of)[place], starts - begin[place]
        trials = _Trials([self.items[i] for i in of], width, self.spec)
        most = self.spec.most_repetitions if width <= 2 else min(self.spec.most_repetitions, self.spec.repetitions)
        for repetition in range(most):
            embedding = Embedding(width, repetition, self.spec)
            keys = embedding.keys(joined, starts)
            self.tables.append(_Table(embedding, keys, item, offset, len(self.items)))
            missed = trials.after(embedding, keys, place)
            if max(missed.values()) <= 1 - self.spec.recall:
                break
        self.missed |= missed
        short = {words: round(1 - share, 3) for words, share in missed.items() if share > 1 - self.spec.recall}
        if short and width > 2:
            self._index(width // 2, [i for i, g in zip(of, trials.group.tolist(), strict=True) if g in short])
        elif short:
            warnings.warn(f"{most} repetitions reach less than a recall of {self.spec.recall} for items of so many words: {short}", stacklevel=2)

    def candidates(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Columns of text, item, and place in ``words`` where the item would begin, of windows with equal samples."""
        possible = self._possible(words, end)
        texts = np.unique(possible // len(self.items))
        starts: dict[int, np.ndarray] = {}
        pairs = [np.zeros((3, 0), np.int64)]
        for table in self.tables:
            width = table.embedding.width
            if width not in starts:
                starts[width] = window_starts(begin[texts], end[texts], width, width)
            keys = table.embedding.keys(words, starts[width])
            window, item, offset = table.hits(keys, np.searchsorted(end, starts[width], "right"), possible)
            window = starts[width][window]
            pairs.append(np.stack([np.searchsorted(end, window, "right"), item, window - offset]))
        return np.unique(np.concatenate(pairs, axis=1), axis=1)

    def _enough(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """The candidates whose text has all words of the item but those that may be edited."""
        both, of = np.unique(pairs[0] * len(self.items) + pairs[1], return_inverse=True)
        text, item = both // len(self.items), both % len(self.items)
        texts, at = np.unique(text, return_inverse=True)
        place, owner = _spread(begin[texts], end[texts] - begin[texts])
        held = np.unique(W.mix(words[place] ^ W.mix(owner.astype(np.uint64))))
        enough = np.zeros(len(both), bool)
        lengths = np.array([len(w) for w in self.items])
        slack = np.array([self.slack(i) for i in range(len(self.items))])
        # In portions, so that memory does not follow the number of candidates.
        for low in range(0, len(both), 1 << 14):
            part = slice(low, low + (1 << 14))
            own = np.concatenate([self.items[i] for i in item[part].tolist()])
            missing = ~np.isin(W.mix(own ^ W.mix(np.repeat(at[part], lengths[item[part]]).astype(np.uint64))), held)
            starts = np.cumsum(lengths[item[part]]) - lengths[item[part]]
            enough[part] = np.add.reduceat(missing.astype(np.int64), starts) <= slack[item[part]]
        return pairs[:, enough[of]]

    def _find_short(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """The first occurrence of each short item in each text."""
        found = []
        for length, (known, items) in self.short.items():
            starts = window_starts(begin, end, length, 1)
            at, low, many = known.ranges(_runs(words, starts, length))
            place, owner = _spread(low, many)
            first = starts[at[owner]]
            text, item = np.searchsorted(end, first, "right"), items[place]
            _, once = np.unique(text * len(self.items) + item, return_index=True)  # the first of each
            found += [(t, i, 0, p, length) for t, i, p in zip(text[once].tolist(), item[once].tolist(), first[once].tolist(), strict=True)]
        return found

    def find(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, words) of the best occurrence of each item in each text."""
        if not len(words) or not self.items:
            return []
        pairs = self.candidates(words, begin, end)
        if pairs.shape[1]:
            pairs = self._enough(words, begin, end, pairs)
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], set[tuple[int, int]]] = {}
        for t, i, p in pairs.T.tolist():
            own, slack = self.items[i], self.slack(i)
            low, high = max(int(begin[t]), p - slack), min(int(end[t]), p + len(own) + slack)
            if (low, high) in done.setdefault((t, i), set()):
                continue
            done[t, i].add((low, high))
            near = words[low:high]
            if np.isin(own, near).sum() < len(own) - slack:  # every word that is not there costs an edit
                continue
            distance, stop = best_stretch(own.tolist(), near.tolist())
            if distance <= slack:
                _, length = best_stretch(own[::-1].tolist(), near[:stop][::-1].tolist())
                match = (distance, low + stop - length, length)
                found[t, i] = min(found.get((t, i), match), match)
        return sorted([*self._find_short(words, begin, end), *((t, i, *match) for (t, i), match in found.items())])


class _Trials:
    """Edited items that the repetitions so far have not found, in groups of items of equal length."""

    def __init__(self, items: list[np.ndarray], width: int, spec: DecontaminateSpec):
        rng = np.random.default_rng([spec.seed, width])
        #: The group of each item: its words, from 64 on the power of two below.
        self.group = np.array([len(w) if len(w) < 64 else 1 << (len(w).bit_length() - 1) for w in items])
        texts, of = [], []
        for group in np.unique(self.group).tolist():
            own = np.flatnonzero(self.group == group)
            picked = rng.choice(own, min(len(own), 256), replace=False)
            for i in np.repeat(picked, -(-512 // len(picked))).tolist():
                text = items[i].tolist()
                for _ in range(int(spec.tolerance * len(text))):
                    at, kind = int(rng.integers(len(text))), int(rng.integers(3))
                    text[at : at + (kind != 0)] = [int(rng.integers(1 << 62))] if kind != 2 else []
                texts.append(np.array([*rng.integers(1 << 62, size=int(rng.integers(width))).tolist(), *text], np.uint64))
                of.append(i)
        end = np.cumsum([len(t) for t in texts])
        begin = end - [len(t) for t in texts]
        self.of = np.array(of)
        self.words = np.concatenate(texts)
        self.starts = window_starts(begin, end, width, width)
        self.trial = np.searchsorted(end, self.starts, "right")
        self.missed = np.ones(len(texts), bool)

    def after(self, embedding: Embedding, keys: np.ndarray, item: np.ndarray) -> dict[int, float]:
        """The share of each group still missed when this repetition has looked, too; keys are those of these items."""
        tried = np.zeros(len(self.group), bool)
        tried[self.of[self.missed]] = True
        known = np.unique(self._joint(keys[tried[item]], item[tried[item]]))
        found = np.isin(self._joint(embedding.keys(self.words, self.starts), self.of[self.trial]), known)
        self.missed[self.trial[found]] = False
        group = self.group[self.of]
        return {g: float(self.missed[group == g].mean()) for g in np.unique(group).tolist()}

    @staticmethod
    def _joint(keys: np.ndarray, item: np.ndarray) -> np.ndarray:
        return W.mix(keys ^ W.mix(item.astype(np.uint64) + np.uint64(1)))


def _blocks(benchmark: DataFrame, spec: DecontaminateSpec) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about the bounded size."""
    items = benchmark.filter("text IS NOT NULL").select("item_id", "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // spec.block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for b in range(count):
        yield sorted(((r.item_id, r.text) for r in items.filter(block == b).collect()), key=repr)


def find_items(docs: DataFrame, benchmark: DataFrame, spec: DecontaminateSpec = DecontaminateSpec()) -> DataFrame:
    """Matches: doc_id, item_id, distance (in words), item_words, and where: start and length in characters."""
    kinds = [frame.schema[c].dataType.simpleString() for frame, c in ((docs, "doc_id"), (benchmark, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, item_words int, start long, length long"

    def search(index: BenchmarkIndex):
        def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = W.WordHasher(word_bytes=_WORD_BYTES)
            for batch in W.batched(batches, "text"):
                data, at = W.buffer(batch.column("text"))
                words, first, text = hasher.spans(data, at)
                ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
                found = index.find(words, ends[:-1], ends[1:])
                rows = []
                for t, i, distance, word, count in found:
                    low, high = int(first[word]), int(at[t + 1])
                    stop = int(first[word + count - 1])
                    while stop < high and _WORD_BYTES[data[stop]]:
                        stop += 1
                    start, length = (len(bytes(data[a:b]).decode(errors="replace")) for a, b in ((at[t], low), (low, stop)))
                    rows.append((t, index.ids[i], distance, len(index.items[i]), start, length))
                ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                columns = [pa.array([r[c] for r in rows], k) for c, k in ((1, None), (2, pa.int32()), (3, pa.int32()), (4, pa.int64()), (5, pa.int64()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "item_id", "distance", "item_words", "start", "length"])

        return matches

    texts = docs.select("doc_id", "text")
    parts = [texts.mapInArrow(search(BenchmarkIndex(block, spec)), schema) for block in _blocks(benchmark, spec)]
    return reduce(DataFrame.unionByName, parts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, spec: DecontaminateSpec = DecontaminateSpec()) -> DataFrame:
    """``docs`` without those that hold an item, with the same columns."""
    kept = docs
    for block in _blocks(benchmark, spec):
        index = BenchmarkIndex(block, spec)
        columns, schema = kept.columns, kept.schema

        def clean(batches: Iterator[pa.RecordBatch], index=index, columns=columns) -> Iterator[pa.RecordBatch]:
            hasher = W.WordHasher(word_bytes=_WORD_BYTES)
            for batch in W.batched(batches, "text"):
                words, _, text = hasher.spans(*W.buffer(batch.column("text")))
                ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
                keep = np.ones(batch.num_rows, bool)
                keep[[t for t, i, *_ in index.find(words, ends[:-1], ends[1:]) if len(index.items[i]) >= spec.least_evidence]] = False
                yield batch.filter(pa.array(keep))

        kept = kept.mapInArrow(clean, schema)
    return kept
