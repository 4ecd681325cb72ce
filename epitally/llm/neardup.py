"""Near duplicates: MinHash signatures, banding, verification, connected components.

A text is the set of hashes of its word shingles. Two texts are linked if their
sets have at least ``threshold`` percent in common (intersection by union).

1. Every text gets the minima of many universal hash functions over its set. The
   number of minima in a band and of bands are chosen from the threshold, so that
   two linked texts share no band with a probability below one in a million.
2. Texts with equal sets are one class from here on, so copies cost one row each.
3. In each bucket of a band one member is compared with all others by signature.
   This is linear in the bucket, and finds almost all of what belongs together.
4. Buckets that still hold members of different groups are compared within
   themselves, in blocks, by signature: a member unlike its bucket's chosen one
   may be like another. Now all classes that can be linked are in one group.
5. Each group is verified on full sets in blocks of bounded size, each of which also
   holds the group's root. A class travels once, and what links is one component.
6. Where a large group is still in parts, the members outside its largest part are
   compared with those of all other blocks. Pairs that verified links already connect
   are skipped, and only links that connect something are written, so a group of
   copies never gives all its pairs.
7. Components come from the verified links by large-star and small-star steps.

Signatures may only rule out pairs whose estimate is more than five standard
deviations below the threshold; every reported link has been counted exactly.

Defined results: NULL and wordless texts have an empty set and are linked with
nothing; shorter texts than a shingle have the whole sequence as their only one;
texts of any length are read whole; repeated rows are reported each; NULL ids
never represent a component that has other ids; an empty table gives an empty
result; columns beyond doc_id and text are not used.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitally.llm import words as W
from epitally.llm.common import fresh
from epitally.llm.components import connected_components
from epitally.staging import stage


@dataclass(frozen=True)
class NearDupSpec:
    """``percent``: 100 * intersection >= percent * union links two texts."""

    shingle: int = 5
    percent: int = 80
    most_hashes: int = 128
    miss: float = 1e-6
    seed: int = 20
    #: Classes of a group that one task verifies against as many others.
    block: int = 512

    @property
    def rows(self) -> int:
        """Minima in a band: as many as the number of hashes allows at the wanted miss rate."""
        return max((r for r in range(1, 16) if r * self._bands(r) <= self.most_hashes), default=1)

    @property
    def bands(self) -> int:
        return self._bands(self.rows)

    def _bands(self, rows: int) -> int:
        return math.ceil(math.log(self.miss) / math.log1p(-((self.percent / 100) ** rows)))

    @property
    def least_equal(self) -> int:
        """Signature places that linked texts have in common but for five standard deviations."""
        s, k = self.percent / 100, self.rows * self.bands
        return max(0, math.floor(k * s - 5 * math.sqrt(k * s * (1 - s))))


def minima(items: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each universal hash function the smallest value over the items."""
    best = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(items), 2048):
        values = factors[:, None] * items[None, low : low + 2048] + offsets[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def _sets(docs: DataFrame, keep: list[str], spec: NearDupSpec, full: bool) -> DataFrame:
    """The ``keep`` columns with n, class and signature, or with the whole set, of ``text``."""
    rng = np.random.default_rng(spec.seed)
    k = spec.rows * spec.bands
    factors = rng.integers(1, 2**63, k, np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 2**63, k, np.uint64)
    length = spec.shingle

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.WordHasher()
        for batch in W.batched(batches, "text"):
            data, at = W.buffer(batch.column("text"))
            hashes, _, text = hasher.spans(data, at)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            sizes, classes, payload = [], [], []
            for i in range(batch.num_rows):
                items = W.shingles(hashes[ends[i] : ends[i + 1]], length)
                sizes.append(len(items))
                classes.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                payload.append(items.tobytes() if full else minima(items, factors, offsets).tobytes() if len(items) else None)
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(payload, pa.binary())],
                names=[*keep, "n", "class", "payload"],
            )

    kept = docs.select(*keep, "text")
    schema = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in keep)
    return kept.mapInArrow(read, f"{schema}, n long, class binary, payload binary")


def _alike(signatures: np.ndarray, sizes: np.ndarray, i: int, spec: NearDupSpec) -> np.ndarray:
    """Which of all members can be linked with member i, by sizes and signatures."""
    fits = (np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * spec.percent) & ((signatures == signatures[i]).sum(axis=1) >= spec.least_equal)
    fits[i] = False
    return fits


def _blocks(members: DataFrame, group: str, spec: NearDupSpec) -> DataFrame:
    """Deals every group out to tasks that hold two of its blocks each; a small group has one block."""
    sizes = members.groupBy(group).agg(F.count("*").alias("members"))
    count = F.ceil(F.col("members") / spec.block).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("count")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("count") - 1), lambda o: F.struct(F.least("own", o).alias("left"), F.greatest("own", o).alias("right")))
    dealt = members.join(sizes.select(F.col(group).alias("_g"), count.alias("count")), F.col(group) == F.col("_g")).drop("_g")
    return dealt.withColumn("own", own).withColumn("task", F.explode(others)).withColumn("task", F.struct(group, "task.left", "task.right"))


def _links_by_signature(spec: NearDupSpec):
    """Links by signature between members of different groups, and so between groups."""

    def links(table: pa.Table) -> pa.Table:
        root, sizes = (table[c].to_numpy() for c in ("root", "n"))
        label = root.copy()
        signatures = np.stack([np.frombuffer(s, np.uint32) for s in table["payload"].to_pylist()])
        for i in range(len(root)):
            for j in np.flatnonzero(_alike(signatures, sizes, i, spec) & (label != label[i])):
                label[label == label[j]] = label[i]
        return _stars(root, label)

    return links


def _join_by_sets(table: pa.Table, label: np.ndarray, spec: NearDupSpec, rows: np.ndarray, others) -> None:
    """Gives one label to what links on full sets: each of ``rows`` with those that ``others`` picks for it."""
    sizes = table["n"].to_numpy()
    signatures = np.stack([np.frombuffer(s, np.uint32) for s in table["payload"].to_pylist()])
    sets = [np.frombuffer(s, np.uint64) for s in table["items"].to_pylist()]
    for i in rows:
        for j in np.flatnonzero(_alike(signatures, sizes, i, spec) & (label != label[i]) & others(i)):
            if label[j] == label[i]:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= spec.percent * (len(sets[i]) + len(sets[j]) - both):
                label[label == label[j]] = label[i]


def _links_in_block(spec: NearDupSpec):
    """All links of a block that connect something, the root's first."""

    def links(table: pa.Table) -> pa.Table:
        ids, places = table["id"].to_numpy(), np.arange(table.num_rows)
        label = places.copy()
        root = ids == table["root"].to_numpy()
        _join_by_sets(table, label, spec, np.argsort(~root, kind="stable"), lambda i: (places > i) | root[i])
        return _stars(ids, label)

    return links


def _links_of_rest(spec: NearDupSpec):
    """Links between the parts of a group: of residents with guests of other blocks."""

    def links(table: pa.Table) -> pa.Table:
        own, resident = table["own"].to_numpy(), table["resident"].to_numpy(zero_copy_only=False)
        before = table["label"].to_numpy()
        label = before.copy()
        _join_by_sets(table, label, spec, np.flatnonzero(resident), lambda i: ~resident & (own != own[i]))
        parts, at = np.unique(before, return_index=True)
        return _stars(parts, label[at])

    return links


def _stars(ids: np.ndarray, label: np.ndarray) -> pa.Table:
    """Of everything with one label, each id linked to the smallest: what the links connect, in as many rows."""
    order = np.lexsort((ids, label))
    ids, label = ids[order], label[order]
    first = np.concatenate(([True], label[1:] != label[:-1]))
    least = ids[np.flatnonzero(first)][np.cumsum(first) - 1]
    return pa.table({"a": ids[ids != least], "b": least[ids != least]})


_PAIR = "a long, b long"


def _candidate_groups(classes: DataFrame, spec: NearDupSpec) -> DataFrame:
    """(node, root): classes that verified links could connect, by signature."""
    width = 4 * spec.rows
    band = F.explode(F.sequence(F.lit(0), F.lit(spec.bands - 1))).alias("band")
    rows = classes.select("id", "payload", band)
    rows = rows.select("id", F.xxhash64("band", F.substring("payload", F.col("band") * width + 1, F.lit(width))).alias("key"))
    # XOR with the key gives every bucket an order of its own, so different buckets choose different members.
    mixed = F.col("id").bitwiseXOR(F.col("key"))
    hubs = rows.groupBy("key").agg(F.count("*").alias("members"), F.min(mixed).alias("least")).filter("members > 1")
    hubs = hubs.select(F.col("key").alias("bucket"), "members", F.col("least").bitwiseXOR(F.col("key")).alias("hub"))
    buckets = stage(rows.join(hubs, F.col("key") == F.col("bucket")).select("id", "bucket", "members", "hub"), "neardup-buckets")

    pairs = buckets.filter("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    side = classes.select("id", "n", "payload")
    pairs = pairs.join(side.toDF("a", "n_a", "payload_a"), "a").join(side.toDF("b", "n_b", "payload_b"), "b")
    pairs = pairs.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * spec.percent)
    least = spec.least_equal

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("payload_a", "payload_b"))
                found = pa.array((a == b).sum(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(found), batch.column("b").filter(found)], names=["a", "b"])

    first = connected_components(pairs.select("a", "b", "payload_a", "payload_b").mapInArrow(near, _PAIR), "neardup-near")
    first = stage(first, "neardup-first")

    # What is still apart in a bucket of more than two has not been compared.
    rooted = buckets.filter("members > 2").join(first, F.col("id") == F.col("node"), "left")
    rooted = stage(rooted.select("id", "bucket", F.coalesce("root", "id").alias("root")), "neardup-rooted")
    apart = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("bucket")
    apart = rooted.join(apart, "bucket").join(side, "id")
    tasks = _blocks(apart, "bucket", spec).select("task", "root", "n", "payload")
    second = stage(tasks.groupBy("task").applyInArrow(_links_by_signature(spec), _PAIR), "neardup-apart")
    if second.isEmpty():
        return first
    return _regrouped(first, second, "neardup-groups")


def _regrouped(first: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(node, root) after links between the roots of components; a node that was in none may now be in one."""
    joined = connected_components(links, name).toDF("old", "new")
    singles = joined.join(first, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("old").alias("root"))
    regrouped = first.unionByName(singles).join(joined, F.col("root") == F.col("old"), "left")
    return regrouped.select("node", F.coalesce("new", "root").alias("root"))


def _with_sets(docs: DataFrame, wanted: DataFrame, spec: NearDupSpec) -> DataFrame:
    """``wanted`` with the full set of each class: from the text of one document, by id, and by content where ids repeat."""
    texts = docs.join(wanted.select("id", "at", "of"), F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.col("print") == F.col("at.print")))
    sets = _sets(texts, ["id", "of"], spec, full=True).filter("class = of").dropDuplicates(["id"]).select(F.col("id").alias("node"), F.col("payload").alias("items"))
    return wanted.drop("at", "of").join(sets, F.col("id") == F.col("node")).drop("node")


def _verified(docs: DataFrame, wanted: DataFrame, spec: NearDupSpec) -> DataFrame:
    """(node, root) of what links on full sets. ``wanted`` has each class with its group's root, block and number of blocks."""
    block = F.when(F.col("id") == F.col("root"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    # Written once: the second step reads the sets of open groups from here, not from the texts again.
    members = stage(_with_sets(docs, wanted, spec), "neardup-sets")
    inside = members.withColumn("block", F.explode(block)).select(F.struct("root", "block").alias("task"), "id", "root", "n", "payload", "items")
    links = inside.groupBy("task").applyInArrow(_links_in_block(spec), _PAIR)
    first = stage(connected_components(links, "neardup-links"), "neardup-linked")

    large = members.filter("blocks > 1").select("id", "root").join(first.toDF("node", "part"), F.col("id") == F.col("node"), "left")
    large = stage(large.select("id", "root", F.coalesce("part", "id").alias("label")), "neardup-large")
    parts = large.groupBy("root", "label").agg(F.count("*").alias("size"))
    open_ = parts.groupBy("root").agg(F.max(F.struct("size", "label")).alias("main"), F.sum("size").alias("members"), F.count("*").alias("parts"))
    rests = F.ceil((F.col("members") - F.col("main.size")) / spec.block).cast("int")
    open_ = stage(open_.filter("parts > 1").select(F.col("root").alias("group"), F.col("main.label").alias("main"), rests.alias("rests")), "neardup-open")
    if open_.isEmpty():
        return first
    # A class outside the main part is at home in one block of the rest, and meets all blocks of the group there.
    # As a guest it goes to the blocks up to its own; a class of the main part is a guest of all.
    home = F.when(F.col("label") != F.col("main"), F.pmod(F.xxhash64("id", F.lit(spec.seed)), F.col("rests")).cast("int"))
    last = F.coalesce("home", F.col("rests") - 1)
    visits = F.transform(F.sequence(F.lit(0), last), lambda r: F.struct(r.alias("rest"), F.col("own").alias("block"), F.lit(False).alias("resident")))
    stays = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.col("home").alias("rest"), b.alias("block"), F.lit(True).alias("resident")))
    dealt = large.join(open_, F.col("root") == F.col("group")).select("id", "label", "main", "rests")
    dealt = members.join(dealt, "id").withColumn("home", home)
    dealt = dealt.withColumn("at", F.explode(F.when(F.col("home").isNull(), visits).otherwise(F.concat(visits, stays))))
    dealt = dealt.select(F.struct("root", "at.rest", "at.block").alias("task"), "id", "label", "own", "at.resident", "n", "payload", "items")
    second = stage(dealt.groupBy("task").applyInArrow(_links_of_rest(spec), _PAIR), "neardup-rest")
    return first if second.isEmpty() else _regrouped(first, second, "neardup-parts")


def _components(docs: DataFrame, spec: NearDupSpec) -> DataFrame:
    """doc_id, print (of the text), n, component_id and, unless the text is wordless, root of each row of ``docs``."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    signed = stage(_sets(docs, ["doc_id", "print"], spec, full=False), "neardup-signed")
    classes = signed.filter("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc"), F.min(F.struct("doc_id", "print")).alias("at"), F.max("n").alias("n"), F.first("payload").alias("payload")
    )
    classes = stage(classes.select(F.monotonically_increasing_id().alias("id"), "class", "doc", "at", "n", "payload"), "neardup-classes")

    groups = stage(_candidate_groups(classes, spec), "neardup-grouped")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / spec.block).cast("int").alias("blocks")).withColumnRenamed("root", "group")
    wanted = classes.join(groups, F.col("id") == F.col("node")).join(sizes, F.col("root") == F.col("group"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("own")
    wanted = stage(wanted.select("id", "root", "blocks", own, "at", "n", F.col("class").alias("of"), "payload"), "neardup-wanted")
    components = _verified(docs, wanted, spec)

    rooted = classes.select("id", "class", "doc").join(components, F.col("id") == F.col("node"), "left")
    rooted = stage(rooted.select("class", "doc", F.coalesce("root", "id").alias("root")), "neardup-roots")
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = stage(rooted.join(least, "root").select(F.col("class").alias("of"), "root", "component_id"), "neardup-named")
    linked = signed.filter("n > 0").join(named, F.col("class") == F.col("of")).select("doc_id", "print", "n", "root", "component_id")
    empty = signed.filter("n = 0").select("doc_id", "print", "n", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(empty)


def near_duplicates(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links lead to, its own included;
    ``kept`` says that this is the document itself.
    """
    found = _components(docs, spec)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; texts without words all stay.

    Rows that repeat an id and its text count as copies of each other, wordless or not.
    """
    own, print_, of, copies = fresh(docs, "_own", "_print", "_of", "_copies")
    rows = _components(docs, spec).groupBy("root", "doc_id", "print").agg(F.count("*").alias(copies))
    # Of different texts under one id, or without an id, one stands for their component.
    first = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print", copies)).alias("at"))
    chosen = first.select("at.*").unionByName(rows.filter("root IS NULL"), allowMissingColumns=True)
    kept = stage(chosen.select(F.col("doc_id").alias(own), F.col("print").alias(of), copies), "neardup-kept")
    printed = docs.withColumn(print_, F.xxhash64("text"))
    found = printed.join(kept, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(print_) == F.col(of)))
    once = found.filter(F.col(copies) == 1)
    again = found.filter(F.col(copies) > 1).dropDuplicates([own, of])
    return once.unionByName(again).select(*docs.columns)
