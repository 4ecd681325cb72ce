"""Monthly counts that are kept for each export file, so that a new export counts itself only.

Counting an export reduces its events to one row per month, region and category. These
rows stay, named by their file, in batches that are written once and never changed. A
committed manifest says which files belong to the counts, in which state each was
counted, and which batch holds its rows. An update lists the files, counts those that
the manifest lacks or that have been written since, and commits the next manifest; files
that are gone leave it. A failed update leaves the manifest before it in force.

Of two updates at the same time the one that commits last wins; files that only the
other one counted are counted again by the next update. Replaced batches and manifests
are not deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.config import Report
from epitally.operators.counts import monthly_counts
from epitally.operators.facts import Counted, write_counts
from epitally.plans.cases import clean_cases
from epitally.plans.enquiries import clean_enquiries
from epitally.plans.situations import DETAIL, clean_situations
from epitally.sources import read_events, schemas
from epitally.sources.files import NoHeader
from epitally.sources.versions import Version, commit_table, current_version
from epitally.staging import stage

_SOURCE, _BATCH, _PLACE = "_source", "_batch", "_place"


@dataclass(frozen=True)
class Exports:
    """Files or folders of events, and how events become counts.

    Columns are read as their own file writes them: an update does not compare the marks
    of numbers in new files with those in files counted before.
    """

    paths: Sequence[str]
    schema: Sequence[schemas.InputColumn]
    #: Takes the events and the names of columns to keep beside its own.
    clean: Callable[[DataFrame, Sequence[str]], DataFrame]
    by: Sequence[str]
    duplicated: Sequence[str] = ()
    #: Everything is counted anew where this differs; change it together with the cleaning rules.
    rules: str = "1"


def case_exports(*paths: str) -> Exports:
    return Exports(paths, schemas.CASES, clean_cases, ["category"])


def situation_exports(*paths: str) -> Exports:
    return Exports(paths, schemas.SITUATIONS, clean_situations, DETAIL, ["Infectious.Agent"])


def enquiry_exports(*paths: str) -> Exports:
    return Exports(paths, schemas.ENQUIRIES, clean_enquiries, ["topic"])


class Update(NamedTuple):
    """Files that were counted, and files whose counts were given up."""

    counted: int
    dropped: int


def _name(path: Column) -> Column:
    """One form for the paths that listing and reading give."""
    plain = F.regexp_replace(path, "^file:/+", "file:/")
    return F.coalesce(F.try_url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))), plain)


def _files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Path, name and state of every file that is not empty. Their content is not read."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select("path", _name(F.col("path")).alias(_SOURCE), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def _counts(spark: SparkSession, exports: Exports, paths: Sequence[str]) -> DataFrame:
    """Monthly counts of each of some files."""
    empty = ", ".join(f"`{c.name}` {c.data_type}" for c in exports.schema)
    events = spark.createDataFrame([], f"{empty}, {_SOURCE} string")
    if paths:
        try:
            read = read_events(spark, paths, exports.schema, duplicated=exports.duplicated, order=_PLACE)
            events = read.withColumn(_SOURCE, _name(F.col(_PLACE).getField(read.schema[_PLACE].dataType.names[0]))).drop(_PLACE)
        except NoHeader:
            pass  # empty files count nothing
    return monthly_counts(exports.clean(events, [_SOURCE]), [*exports.by, _SOURCE])


def _live(spark: SparkSession, output: str, version: Version, manifest: DataFrame) -> DataFrame:
    """Counts by file, of the files and batches that the manifest names."""
    batches = spark.read.parquet(*(f"{output.rstrip('/')}/batches/{b}" for b in version.facts["batches"]))
    return batches.join(manifest.select(_SOURCE, _BATCH), [_SOURCE, _BATCH], "left_semi")


def ensure_counts(spark: SparkSession, exports: Exports, output: str, most_batches: int = 32) -> Update:
    """Brings the counts at ``output`` up to date with the files. Writes nothing if nothing has changed.

    With more than ``most_batches`` batches in use, the rows of all of them go into the
    new one, so the number of batches to read does not follow the number of updates.
    """
    rules = {"by": list(exports.by), "rules": exports.rules}
    before = current_version(spark, output)
    if before and {k: before.facts[k] for k in rules} != rules:
        before = None
    # Written now: what is noted is the state before the files are read, so a file that changes meanwhile is counted next time.
    files = stage(_files(spark, exports.paths), "exports")
    old = spark.read.parquet(before.folder) if before else spark.createDataFrame([], f"{_SOURCE} string, modified timestamp, bytes long, {_BATCH} string")
    state = stage(files.join(old, [_SOURCE, "modified", "bytes"], "left"), "exports-state")
    changed = sorted(r.path for r in state.filter(F.col(_BATCH).isNull()).select("path").collect())
    dropped = old.join(state.filter(F.col(_BATCH).isNotNull()), _SOURCE, "left_anti").count()
    if before and not changed and not dropped:
        return Update(0, 0)

    batch, batches = uuid4().hex, list(before.facts["batches"]) if before else []
    manifest = state.select(_SOURCE, "modified", "bytes", F.coalesce(_BATCH, F.lit(batch)).alias(_BATCH))
    if changed or not batches:
        counts = _counts(spark, exports, changed)
        if len(batches) >= most_batches:
            counts = counts.unionByName(_live(spark, output, before, manifest).drop(_BATCH))
            manifest, batches = manifest.withColumn(_BATCH, F.lit(batch)), []
        counts.withColumn(_BATCH, F.lit(batch)).write.parquet(f"{output.rstrip('/')}/batches/{batch}")
        batches.append(batch)
    commit_table(manifest, output, rules | {"batches": batches})
    return Update(len(changed), dropped)


def current_counts(spark: SparkSession, output: str) -> DataFrame:
    """Monthly counts over all files, as of the last update."""
    version = current_version(spark, output)
    if version is None:
        raise ValueError(f"no counts at {output}")
    live = _live(spark, output, version, spark.read.parquet(version.folder))
    return live.groupBy("region", "month_start", *version.facts["by"]).agg(F.sum("n").alias("n"))


def current_counted(spark: SparkSession, output: str, report: Report, name: str, regions: Sequence[str] = ()) -> Counted:
    """Counts inside the report window and what they cover, as ``monthly.counted`` gives them from events."""
    return write_counts(current_counts(spark, output), name, regions)[name].window(report)
