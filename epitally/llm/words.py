"""Words of whole texts as 64-bit hashes, for a batch of texts at once.

The texts of an Arrow column lie in one buffer. Words are found and hashed there
by numpy, without making a Python string of any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Space, tab, line feed, vertical tab, form feed and carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once: the tables of powers have this many entries, so memory does not follow the batch.
_CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _powers(base: int) -> np.ndarray:
    out = np.full(_CHUNK, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text begins and the last one ends; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    size = len(column)
    if not size:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, size + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


class WordHasher:
    """Hashes words, in lower case if asked; equal words have equal hashes everywhere."""

    def __init__(self, lower: bool = True, word_bytes: np.ndarray | None = None):
        word = ~WHITE if word_bytes is None else word_bytes
        letters = _LOWER if lower else np.arange(256, dtype=np.uint8)
        self._value = np.where(word, letters.astype(np.uint64) + np.uint64(1), np.uint64(0))
        self._word = word
        self._power, self._inverse = _powers(_BASE), _powers(_INVERSE)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and text number (into the column) of each word, in order."""
        inside = self._word[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        first[begins] = inside[begins]  # a text starts a word even if the text before it ends in one
        starts = np.flatnonzero(first)
        text = np.searchsorted(offsets, starts, "right") - 1
        return self._hash(data, starts), starts, text

    def _hash(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A polynomial in the bytes of each word, modulo 2^64, then mixed."""
        sums = np.zeros(len(starts), np.uint64)
        scale = np.ones(len(starts), np.uint64)
        # A word that crosses a chunk's end gets its parts added up at their true powers.
        for low in range(0, len(data), _CHUNK):
            high = min(low + _CHUNK, len(data))
            a, b = np.searchsorted(starts, [low, high])
            value = self._value[data[low:high]] * self._power[: high - low]
            if a < b:
                sums[a:b] = np.add.reduceat(value, starts[a:b] - low)
                scale[a:b] = self._inverse[starts[a:b] - low]
            head = value[: (starts[a] - low if a < b else high - low)]
            if low and a and len(head):
                # One more factor of the last power for every chunk since the word began.
                chunks = low // _CHUNK - starts[a - 1] // _CHUNK
                turn = np.full(1, pow(_BASE, int(chunks) * _CHUNK, 1 << 64), np.uint64)
                sums[a - 1 : a] += np.add.reduce(head, keepdims=True) * turn
        return mix(sums * scale)


def batched(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches of about ``most`` bytes of text, a longer text alone."""
    for batch in batches:
        sizes = np.diff(buffer(batch.column(column))[1])
        low, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(low, i - low)
                low, total = i, 0
            total += size
        if low < batch.num_rows:
            yield batch.slice(low)


def shingles(words: np.ndarray, length: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``length`` words; of the whole sequence if it is shorter."""
    run = min(length, len(words))
    if run == 0:
        return words[:0]
    count = len(words) - run + 1
    out = np.full(count, run, np.uint64)
    for i in range(run):
        out = mix(out ^ words[i : i + count]) + np.uint64(i + 1)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]
