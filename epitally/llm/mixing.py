"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source has a weight. The mix has as many words as the corpus, shared among
the sources by weight, but no source is repeated more than ``max_epochs`` times:
sources above that limit are clamped to it, and what they cannot take is shared
among the others by weight, until no source is above its limit.

A target of 2.3 times a source's size takes each of its documents twice, and a
third time those whose seeded hash lies below the source's threshold. The
threshold is the point at which the hash-ordered sizes come nearest to the
fraction. It is found in two rounds of 4,096 hash ranges per source, so no task
sees more than 4,096 rows of a source however large the source is. One long
document at the threshold can leave a small source some way off; so among the
documents short enough to mend that, a second draw chooses in the same way which
ones change sides.

Everything is DataFrame operations; the documents are never sorted or shuffled.

Defined results: a NULL source is a source of its own, last in order; NULL and
empty texts have size 0 and are taken 0 words; rows that agree in id and text
are chosen alike; a source without words has target 0; an empty table gives an
empty mix; other columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epitally.llm.common import WORD, fresh, with_position
from epitally.staging import stage

_RANGES = 4096


@dataclass(frozen=True)
class MixSpec:
    """Weights go to the sources in code point order, repeating."""

    weights: tuple[int, ...] = (5, 2, 1)
    max_epochs: int = 3
    seed: str = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draws(doc_id: Column, text: Column, seed: str) -> Column:
    """Two draws of 24 bits each that depend on the seed, the id and the text, in one number."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("long")


def _first(both: Column) -> Column:
    return F.shiftright(both, 24).cast("int")


def _second(both: Column) -> Column:
    return both.bitwiseAND((1 << 24) - 1).cast("int")


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """(source, source_size) to the same with weight and target: the water level by rounds of clamping."""
    placed = with_position(sizes, [F.col("source").asc_nulls_last()], "_place", "mix-sources")
    weights = F.array(*map(F.lit, spec.weights))
    placed = placed.withColumn("weight", F.element_at(weights, (F.col("_place") % len(spec.weights) + 1).cast("int"))).drop("_place")
    cap = F.col("source_size") * spec.max_epochs
    whole = placed.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weight")).first()
    level, clamped = (whole.total or 0) / (whole.weight or 1), 0
    while whole.weight:
        above = cap < F.col("weight") * F.lit(level)
        now = placed.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, cap)).alias("fixed"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
        ).first()
        if now.n == clamped or not now.open:
            break
        level, clamped = (whole.total - now.fixed) / now.open, now.n
    return placed.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def _nearest(drawn: DataFrame, needs: DataFrame, name: str) -> DataFrame:
    """(source, threshold): the sizes of draws below it come nearest to the source's need, a number over 0.

    ``drawn`` has source, size and draw. Sources whose whole size is needed are not in the result.
    """
    window = Window.partitionBy("source").orderBy("part")

    def summed(rows: DataFrame, part: Column) -> DataFrame:
        sums = rows.groupBy("source", part.alias("part")).agg(F.sum("size").alias("size"))
        return sums.withColumn("upto", F.sum("size").over(window))

    def same(left: str, right: str) -> Column:
        return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))

    coarse = summed(drawn, F.floor(F.col("draw") / _RANGES).cast("int"))
    coarse = coarse.alias("c").join(needs.alias("p"), same("c", "p")).filter("upto > need")
    # The first range that reaches beyond the need.
    rest = (F.col("need") - F.col("upto") + F.col("size")).alias("rest")
    coarse = coarse.groupBy("c.source").agg(F.min(F.struct("part", rest)).alias("at"))
    edge = stage(coarse.select("source", "at.part", "at.rest"), f"{name}-edge")
    here = F.floor(F.col("d.draw") / _RANGES).cast("int") == F.col("e.part")
    inner = drawn.alias("d").join(edge.alias("e"), same("d", "e") & here)
    fine = summed(inner.select("d.source", "d.size", "d.draw"), F.pmod("draw", F.lit(_RANGES)))
    # A range is taken if the sum with it is nearer to the rest than the sum without it.
    fine = fine.alias("f").join(edge.alias("e"), same("f", "e")).filter("2 * f.upto - f.size <= 2 * e.rest")
    fine = fine.groupBy("f.source").agg((F.max("f.part") + 1).alias("below"))
    found = edge.alias("e").join(fine.alias("f"), same("e", "f"), "left")
    return found.select("e.source", (F.col("part") * _RANGES + F.coalesce("below", F.lit(0))).alias("threshold"))


def _choices(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source the whole repetitions, the threshold of one more, and which documents change sides.

    ``rest`` is what the threshold leaves to take, or, below 0, to give back.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = targets.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = stage(plan.withColumnRenamed("source", "of"), "mix-plan")

    def with_threshold(rows: DataFrame, found: DataFrame, column: str, need: Column) -> DataFrame:
        joined = rows.join(found.withColumnRenamed("threshold", column), F.col("of").eqNullSafe(F.col("source")), "left").drop("source")
        return joined.withColumn(column, F.coalesce(F.col(column), F.when(need > 0, F.lit(_RANGES * _RANGES)).otherwise(0)))

    needs = plan.select(F.col("of").alias("source"), "need")
    first = _nearest(drawn.select("source", "size", _first(F.col("draws")).alias("draw")), needs, "mix-first")
    plan = stage(with_threshold(plan, first, "threshold", F.col("need")), "mix-threshold")
    below = drawn.join(plan, drawn["source"].eqNullSafe(plan["of"])).withColumn("taken", _first(F.col("draws")) < F.col("threshold"))
    sums = below.groupBy("source").agg(F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("sum"))
    plan = plan.join(sums, F.col("of").eqNullSafe(F.col("source"))).drop("source")
    plan = stage(plan.withColumn("rest", F.col("need") - F.col("sum")).drop("sum"), "mix-rest")
    short = drawn.join(plan, drawn["source"].eqNullSafe(plan["of"])).filter(_may_change(F.col("draws"), F.col("size"), *map(F.col, ("threshold", "rest"))))
    second = _nearest(
        short.select("source", "size", _second(F.col("draws")).alias("draw")), plan.select(F.col("of").alias("source"), F.abs("rest").alias("need")), "mix-second"
    )
    return with_threshold(plan, second, "change", F.abs("rest"))


def _may_change(both: Column, size: Column, threshold: Column, rest: Column) -> Column:
    """Documents on the side that has too much, no longer than what it has too much."""
    return ((_first(both) < threshold) == (rest < 0)) & (size <= F.abs(rest)) & (size > 0)


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """``docs`` (doc_id, text, source, …) with size, source_size, target and repeats.

    ``repeats`` says how often the mix takes the document. Columns of ``docs``
    with these names give way to the new ones.
    """
    new = ["size", "source_size", "target", "repeats"]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    key, both, choice = fresh(docs, "_of", "_draws", "_choice")
    sized = docs.withColumns({"size": word_count(F.col("text")), both: draws(F.col("doc_id"), F.col("text"), spec.seed)})
    drawn = stage(sized.select("source", "size", F.col(both).alias("draws")), "mix-draws")
    sizes = drawn.groupBy("source").agg(F.sum("size").alias("source_size"))
    chosen = _choices(drawn, source_targets(sizes, spec))
    chosen = chosen.select(F.col("of").alias(key), "source_size", "target", F.struct("whole", "threshold", "rest", "change").alias(choice))
    plan = stage(chosen, "mix-choices")
    joined = sized.join(plan, sized["source"].eqNullSafe(plan[key]))
    own = F.col(choice)
    changes = _may_change(F.col(both), F.col("size"), own.threshold, own.rest) & (_second(F.col(both)) < own.change)
    taken = _first(F.col(both)) < own.threshold
    return joined.withColumn("repeats", own.whole + (taken != changes).cast("int")).select(*docs.columns, *new)


def mixed_documents(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The mix itself: each document as often as it is taken, with exactly the columns of ``docs``."""
    own = [c for c in docs.columns if c.lower() in ("size", "source_size", "target", "repeats")]
    aside = dict(zip(own, fresh(docs, *(f"_{c}" for c in own)), strict=True))
    taken = mix(docs.withColumnsRenamed(aside), spec).filter("repeats > 0")
    (copy,) = fresh(docs, "_copy")
    kept = [aside.get(c, c) for c in docs.columns]
    copies = taken.select(*kept, F.explode(F.array_repeat(F.lit(True), F.col("repeats"))).alias(copy))
    return copies.drop(copy).withColumnsRenamed({v: k for k, v in aside.items()})
