"""URL filters: many wildcard rules matched at once by a bit-parallel automaton.

All rules are packed side by side into one bit vector of as many 64-bit words as
they need. Bit i says that the first i symbols of a rule have been read. Reading
a byte shifts every rule by one symbol in a few word operations (Shift-And);
wildcards are bits that stay set while the bytes they allow go by. Numpy carries
the vectors of a whole batch of URLs through their bytes together, so a URL costs
the same whichever and however many rules share a word.

Rules are matched against the canonical URL: a dot, the host in lower case, and
the path. In a rule ``?`` is any byte but ``/``, ``*`` any run without ``/``, and
``**`` any run; everything else stands for itself.

Nothing is shuffled: every task judges the URLs it reads.

Defined results: a NULL url, or one without ``://``, has an empty host and path;
very long URLs are read to their end; repeated rows are judged alike; an empty
table gives an empty result; other columns are kept, except those named like the
new ones.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class HostRule:
    """Fits a host with all its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}{self.path}**"


#: The list that the registered query applies.
HOST_RULES = (
    HostRule("org", "/", ALLOW),
    HostRule("example.org", "/es/", BLOCK),
    HostRule("example.org", "/en/1", BLOCK),
    HostRule("com", "/fr/", ALLOW),
    HostRule("com", "/de/", BLOCK),
)

#: Globs for URLs that no host rule fits: hosts of gambling, adult and pill sellers, and login pages.
BLOCK_GLOBS = tuple(
    f"*{word}*{rest}" for word in ("casino", "poker", "betting", "viagra", "porn", "xxx") for rest in ("", "/**")
) + ("*/login", "*/login/**", "*/wp-admin/**")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host follows the first ``://`` up to ``/``, ``?``, ``#``; the path goes on up to ``?``, ``#``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


class GlobAutomaton:
    """Shift-And over packed rules; ``matches`` answers for many texts at once."""

    def __init__(self, globs: Sequence[str]):
        rules = [_symbols(g) for g in globs]
        bits = sum(len(symbols) + 1 for symbols, _ in rules)
        self.words = max(1, -(-bits // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        at = 0
        for symbols, runs in rules:
            self._set(self.start, at)
            for i, allowed in enumerate(symbols, 1):
                for byte in allowed:
                    self._set(self.step[byte], at + i)
            for i, allowed in runs.items():
                for byte in allowed:
                    self._set(self.stay[byte], at + i)
            end = at + len(symbols)
            self.final.append((end // 64, np.uint64(end % 64)))
            at = end + 1

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def matches(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Text by rule, True where the rule fits the whole text data[start:end]."""
        order = np.argsort(starts - ends, kind="stable")  # longest first, so that those still reading come first
        begin, length = starts[order], (ends - starts)[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        reading = len(order)
        for i in range(int(length[0]) if len(length) else 0):
            while reading and length[reading - 1] <= i:
                reading -= 1
            byte = data[begin[:reading] + i]
            now = state[:reading]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:reading] = (moved & self.step[byte]) | (now & self.stay[byte])
        found = np.empty((len(order), len(self.final)), bool)
        for rule, (word, bit) in enumerate(self.final):
            found[order, rule] = (state[:, word] >> bit) & one == one
        return found


_ANY = bytes(range(256))
_SEGMENT = bytes(b for b in _ANY if b != ord("/"))


def _symbols(glob: str) -> tuple[list[bytes], dict[int, bytes]]:
    """The bytes that each symbol allows, and the runs that may follow the first i symbols."""
    symbols: list[bytes] = []
    runs: dict[int, bytes] = {}
    data = glob.encode()
    i = 0
    while i < len(data):
        if data[i : i + 2] == b"**":
            runs[len(symbols)] = _ANY
            i += 2
        elif data[i : i + 1] == b"*":
            runs.setdefault(len(symbols), _SEGMENT)
            i += 1
        else:
            symbols.append(_SEGMENT if data[i : i + 1] == b"?" else data[i : i + 1])
            i += 1
    return symbols, runs


def judge(
    pages: DataFrame,
    rules: Sequence[HostRule] = HOST_RULES,
    block_globs: Sequence[str] = BLOCK_GLOBS,
    url: str = "url",
) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    The longest fitting host rule decides, and of equally long ones one that
    blocks. Where none fits, ``rule`` is NULL and any block glob blocks.
    """
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in new]
    host, path = host_and_path(F.col(url))
    parts = pages.withColumns({"host": host, "path": path}).select(*kept, "host", "path")
    ranked = sorted(rules, key=lambda r: (len(r.name), r.verdict == BLOCK, r.name))
    automaton = GlobAutomaton([*(r.glob for r in ranked), *block_globs])
    names = pa.array([None, *(r.name for r in ranked)], pa.string())
    verdicts = np.array([ALLOW, BLOCK, *(r.verdict for r in ranked)], object)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            canonical = [f".{h}{p}".encode() for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            ends = np.cumsum([len(c) for c in canonical], dtype=np.int64)
            starts = np.concatenate([np.zeros(1, np.int64), ends])[:-1]
            found = automaton.matches(np.frombuffer(b"".join(canonical), np.uint8), starts, ends)
            chosen = np.zeros(len(canonical), np.int64)
            for i in range(len(ranked)):  # later rules are longer and replace earlier ones
                chosen[found[:, i]] = i + 1
            default = found[:, len(ranked) :].any(axis=1).astype(np.int64)
            verdict = verdicts[np.where(chosen > 0, chosen + 1, default)]
            yield pa.RecordBatch.from_arrays([*batch.columns, names.take(pa.array(chosen)), pa.array(verdict, pa.string())], names=schema.names)

    fields = [*parts.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())]
    schema = T.StructType(fields)
    return parts.mapInArrow(judged, schema)
