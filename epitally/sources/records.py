"""Records of delimited files whose quoted texts may hold line breaks, read by many tasks.

Spark splits text files at lines, and a line in the middle of a file does not tell
whether it starts inside quotes. Quotes come in pairs, a quote inside a text is
doubled, so an odd number of quotes in a line switches between inside and outside.

1. One pass over all files notes for each byte range (a split of the scan) whether
   its lines switch an odd number of times: its end state for either starting
   state. It also keeps the first record of each file, its header. The job count
   does not depend on the number of files.
2. Composing the ranges of a file in order gives the state each one starts in.
3. Files without a switch inside a record need nothing of this and are read by the
   native reader, which splits files and prunes columns. For the others each task
   joins the lines of a record, from its range's first true record on.
4. What lies before that belongs to the record that an earlier range left open. Such
   fragments, at most two of a range, are written and joined by file.

A file whose quotes do not pair up, or that has a quote amid unquoted text, is not
read like that but as one task by the native reader, and so is a file of few byte
ranges. Files without any line are left out with a note.
"""

from __future__ import annotations

import csv
import logging
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epitally.staging import stage

_LOG = logging.getLogger(__name__)

# The functions below travel to the tasks by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A single quote between ordinary characters: neither begins nor ends a quoted text.
_STRAY = r'[^,;\t"\r]"[^,;\t"\r]'

_MARK = "\ufeff"
_BLANK = f"{_MARK} \t\r"


@dataclass(frozen=True)
class FileShape:
    """What the pass over a file found; ``starts`` says for each byte range whether it starts inside quotes."""

    path: str
    header: str
    starts: dict[int, bool]
    #: Some record goes on beyond a line.
    broken: bool
    #: Quotes do not tell where records end.
    irregular: bool


def list_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return sorted(unquote(f) for f in spark.read.text(list(paths), pathGlobFilter="*").inputFiles())


def _plain_path(path: str) -> str:
    """Local paths are written with one or three slashes."""
    return re.sub("^file:/+", "file:/", path)


def read_lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, block, value): lines, those of a block in order in one task."""
    lines = spark.read.option("lineSep", "\n").text(list(files))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of a task, a slice for each byte range and batch."""
    for batch in batches:
        files = batch.column("file").dictionary_encode()
        block = batch.column("block").to_numpy()
        code = files.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if low < high:
                yield unquote(files.dictionary[code[low]].as_py()), int(block[low]), batch.column("value").slice(low, high - low)


def _switches(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1


class _Head:
    """Gathers the first record of a file that is not blank."""

    def __init__(self):
        self.text, self._lines, self._inside = None, [], False

    def add(self, lines: pa.Array) -> None:
        for line in lines:
            if self.text is not None:
                return
            value = line.as_py()
            if not self._lines and not value.strip(_BLANK):
                continue
            self._lines.append(value)
            self._inside ^= bool(value.count('"') % 2)
            if not self._inside:
                self.text = "\n".join(self._lines)


_SHAPE = "file string, block long, odd boolean, broken boolean, stray boolean, header string"


def _find_shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each byte range."""
    names = ["file", "block", "odd", "broken", "stray", "header"]

    def row(at: tuple[str, int], odd: bool, broken: bool, stray: bool, head: _Head) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*at, odd, broken, stray, head.text), kinds, strict=True)], names=names)

    at, odd, broken, stray, head = None, False, False, False, _Head()
    for file, block, lines in _ranges(batches):
        if at != (file, block):
            if at is not None:
                yield row(at, odd, broken, stray, head)
            at, odd, broken, stray, head = (file, block), False, False, False, _Head()
        switches = int(_switches(lines).sum())
        odd ^= bool(switches % 2)
        broken |= switches > 0
        stray = stray or bool(pc.any(pc.match_substring_regex(lines, _STRAY)).as_py())
        if block == 0 and head.text is None:
            head.add(lines)
    if at is not None:
        yield row(at, odd, broken, stray, head)


def file_shapes(lines: DataFrame) -> dict[str, FileShape]:
    """By path, the shape of each file that has a record; one row for each byte range reaches the driver, which also lists them to read them."""
    found: dict[str, list] = {}
    for row in lines.mapInArrow(_find_shapes, _SHAPE).collect():
        found.setdefault(row.file, []).append(row)
    shapes = {}
    for path, ranges in found.items():
        starts, inside = {}, False
        for row in sorted(ranges, key=lambda r: r.block):
            starts[row.block] = inside
            inside ^= row.odd
        header = next((r.header for r in ranges if r.header is not None), None)
        if header is not None:
            shapes[path] = FileShape(path, header, starts, any(r.broken for r in ranges), inside or any(r.stray for r in ranges))
        elif inside:
            raise ValueError(f"the header of {path} does not end")
    return shapes


def shapes_of(spark: SparkSession, files: Sequence[str]) -> dict[str, FileShape]:
    """The shapes of all files, in one job. Files without a record are left out."""
    shapes = file_shapes(read_lines(spark, files))
    found = {_plain_path(path) for path in shapes}
    for path in files:
        if _plain_path(path) not in found:
            _LOG.warning("%s is empty and left out", path)
    return shapes


def header_names(header: str, sep: str) -> list[str]:
    """Column names as the native reader gives them: numbers tell apart equal and missing ones."""
    names = next(csv.reader([header.lstrip(_MARK).rstrip("\r")], delimiter=sep))
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def separator_of(header: str) -> str:
    """Comma, or semicolon when splitting at commas leaves a single column."""
    return "," if len(header_names(header, ",")) > 1 else ";"


_WHOLE, _HEAD, _TAIL = 0, 1, 2
_RECORD = "file string, block long, number long, kind int, record string"


def _assemble(shapes: dict[str, FileShape], fragments: bool):
    """The records of each byte range, or the parts of records that cross its ends. Headers and blank lines are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, number, headed, held, kind = None, False, 0, True, [], _WHOLE

        def emit(texts: pa.Array, kind: int) -> Iterator[pa.RecordBatch]:
            nonlocal number, headed
            first = number
            if kind == _WHOLE:
                texts = pc.utf8_rtrim(texts, characters="\r")
                texts = texts.filter(pc.not_equal(pc.utf8_trim(texts, characters=_BLANK), ""))
                if not headed and len(texts):
                    texts, headed = texts.slice(1), True
                number += len(texts)
            elif not headed:  # the header itself crosses the end of its range
                first, headed = -1, True
            else:
                number += 1
            n = len(texts)
            if n and fragments == (kind != _WHOLE):
                columns = [pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array(np.arange(first, first + n)), pa.array([kind] * n, pa.int32()), texts]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "number", "kind", "record"])

        def flush(kind: int) -> Iterator[pa.RecordBatch]:
            if held:
                yield from emit(pa.array(["\n".join(held)], pa.string()), kind)

        def end_of_range() -> Iterator[pa.RecordBatch]:
            yield from flush(_HEAD if kind == _HEAD else _TAIL if inside else _WHOLE)

        for file, block, lines in _ranges(batches):
            if at != (file, block):
                yield from end_of_range()
                if block not in shapes[file].starts:
                    raise ValueError(f"the byte ranges of {file} changed while it was read; set spark.sql.leafNodeDefaultParallelism")
                at, number, headed, held = (file, block), 0, block != 0, []
                inside = shapes[file].starts[block]
                kind = _HEAD if inside else _WHOLE
            after = np.cumsum(_switches(lines)) % 2 ^ inside
            begins = np.flatnonzero(np.concatenate(([inside], after[:-1])) == 0)
            inside = bool(after[-1])
            held = held + lines.slice(0, begins[0] if len(begins) else len(lines)).to_pylist()
            if len(begins):
                yield from flush(kind)
                if len(begins) > 1:
                    whole = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), lines.slice(0, begins[-1]).cast(pa.string()))
                    yield from emit(pc.binary_join(whole, "\n"), _WHOLE)
                kind, held = _WHOLE, lines.slice(begins[-1]).to_pylist()
        yield from end_of_range()

    return run


def _joined_fragments(parts: DataFrame) -> DataFrame:
    """Records that cross byte ranges, each under the range and number where it starts."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    begun = parts.withColumn("of", F.sum((F.col("kind") == _TAIL).cast("int")).over(order))
    joined = begun.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "number", "record"))).alias("parts"))
    record = F.regexp_replace(F.array_join("parts.record", "\n"), "\r$", "")
    joined = joined.select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["number"].alias("number"), record.alias("record"))
    return joined.filter("number >= 0")


def read_records(spark: SparkSession, shapes: Sequence[FileShape], listed: Sequence[str]) -> DataFrame:
    """(file, block, number, record): the records of files, without headers and blank lines.

    ``listed`` names the files that the pass for the shapes has read.
    """
    own = {s.path: s for s in shapes}
    lines = read_lines(spark, listed)
    if {_plain_path(f) for f in listed} != {_plain_path(f) for f in own}:
        # Fewer files may be split at other places.
        lines = read_lines(spark, list(own))
        own = file_shapes(lines)
    records = lines.mapInArrow(_assemble(own, False), _RECORD).drop("kind")
    if any(any(s.starts.values()) for s in own.values()):
        parts = stage(lines.mapInArrow(_assemble(own, True), _RECORD), "record-parts")
        records = records.unionByName(_joined_fragments(parts))
    return records


def parsed(records: DataFrame, names: Sequence[str], sep: str) -> DataFrame:
    """One text column for each name, and file, block and number of the record in the struct ``_place``."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    row = F.from_csv("record", F.lit(schema), {"sep": sep, "quote": '"', "escape": '"'})
    return records.select(row.alias("_row"), F.struct("file", "block", "number").alias("_place")).select("_row.*", "_place")
