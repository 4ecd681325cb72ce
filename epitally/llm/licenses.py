"""Licence scans: passages compared to licence wordings by the Dice coefficient over word bigrams.

Three kinds of passages are compared: every line, every paragraph of more than
one line (blank lines part them), and the whole text if it has more than one
paragraph. A passage and a wording are normalised alike: lower case, and
one blank for each run of anything but letters and digits. With a and b distinct
bigrams, s of them shared, the coefficient is 2s / (a + b).

A wording may also stand inside a line, or run over several lines or paragraphs
of a longer text. For that, ``window`` compares runs of words wherever they begin
and end, up to (2 - t) / t times as long as the wording. The nearest run from each
beginning counts; of overlapping ones the one that shares most bigrams is kept, then
the nearest. A run is left out where it overlaps a line or paragraph that is reported
with the same licence, and if the whole text is. Its passage number is that of its
first word, counted from 0 through the text.

It can reach the threshold t only if b * t / (2 - t) <= a <= b * (2 - t) / t. A
passage of n words, d of them distinct, has d - 1 to n - 1 distinct bigrams, so
most passages fall out by counting words, before any bigram is formed; the others
are compared only with the wordings inside the bounds. A run shares at least
b * t / (2 - t) bigrams. Without the ``anchors`` of a wording too few are left, so
most texts fall out by a search for these words, and runs begin only where
bigrams of the wording stand close enough together.

Everything is built-in array functions on the row that holds the text: nothing is
shuffled, and the wordings travel as literals of the plan.

Defined results: NULL, empty and one-word texts match nothing; repeated rows are
reported each; of equally near wordings the first identifier wins; an empty
table gives an empty result; other columns are not used.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.llm.license_texts import NOTICES, TEXTS

THRESHOLD = 0.8
_GAPS = r"[^\p{L}\p{N}\n]+"
_BLANK_LINES = r"\n ?\n[ \n]*"


def bigrams(text: str) -> list[str]:
    """Distinct bigrams of a wording, normalised like the passages."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(" ".join(pair) for pair in zip(words, words[1:], strict=False)))


def templates(wordings: Sequence[tuple[str, str]] = NOTICES + TEXTS) -> list[tuple[str, list[str]]]:
    return sorted((name, bigrams(text)) for name, text in wordings)


def _needed(size: int, threshold: float) -> int:
    """Fewest bigrams shared with a wording of so many, a hair less than exact."""
    return math.ceil(size * threshold / (2 - threshold) - 1e-6)


def anchors(text: str, threshold: float) -> list[str]:
    """Words of a wording; whatever holds none of them lacks too many of its bigrams."""
    own = bigrams(text)
    of: dict[str, set[str]] = {}
    for pair in own:
        for word in pair.split():
            of.setdefault(word, set()).add(pair)
    lost: set[str] = set()
    chosen = []
    # Long words are rare in other texts; of these the ones with many bigrams make a short list.
    for word in sorted(of, key=lambda w: (len(w) < 6, -len(of[w]) if len(w) >= 6 else 0, -len(w), w)):
        if len(own) - len(lost) < _needed(len(own), threshold):
            break
        if of[word] - lost:
            chosen.append(word)
            lost |= of[word]
    return chosen


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _windows(plain: Column, found: Column, wordings: Sequence[tuple[str, str]], threshold: float) -> Column:
    """Runs of words near a wording that the found passages leave out, in the form of these."""
    ratio = threshold / (2 - threshold)
    kind = "array<struct<unit:string,passage:int,license:string,n_bigrams:int,shared:int,dice:double>>"
    runs_kind = "array<struct<more:int,less:double,license:string,first:int,last:int,n_bigrams:int>>"

    def nearest(pairs: Column, first: Column, name: str, own: list[str], longest: int) -> Column:
        """The nearest run that begins at a bigram."""

        def step(best: Column, now: Column) -> Column:
            n, s = best.n + now.new, best.s + now.hit
            less = -2.0 * s / (n + len(own))
            better = (now.hit == 1) & (less < best.less)
            kept = [F.when(better, new).otherwise(old).alias(k) for k, new, old in (("less", less, best.less), ("size", n, best["size"]), ("shared", s, best.shared), ("length", now.at + 1, best.length))]
            return F.struct(n.alias("n"), s.alias("s"), *kept)

        def marked(run: Column) -> Column:
            new = lambda x, i: F.array_position(run, x) == i + 1
            hit = lambda x, i: new(x, i) & F.array_contains(F.array(*map(F.lit, own)), x)
            return F.transform(run, lambda x, i: F.struct(i.alias("at"), new(x, i).cast("int").alias("new"), hit(x, i).cast("int").alias("hit")))

        zero = F.lit(0)
        start = F.struct(zero.alias("n"), zero.alias("s"), F.lit(0.0).alias("less"), zero.alias("size"), zero.alias("shared"), zero.alias("length"))
        return F.aggregate(
            _let(F.slice(pairs, first + 1, longest), marked), start, step,
            lambda b: F.struct((-b.shared).alias("more"), b.less.alias("less"), F.lit(name).alias("license"), first.alias("first"), (first + b.length).alias("last"), b["size"].alias("n_bigrams")),
        )

    def runs(pairs: Column, name: str, text: str) -> Column:
        own = bigrams(text)
        needed = _needed(len(own), threshold)
        longest = int((len(re.findall(r"[a-z0-9]+", text.lower())) - 1) / ratio + 1e-6)
        literal = F.array(*map(F.lit, own))
        places = F.filter(F.transform(pairs, lambda x, i: F.when(F.array_contains(literal, x), i)), lambda i: i.isNotNull())
        close = _let(places, lambda at: F.filter(at, lambda p, k: (k + needed <= F.size(at)) & (F.get(at, k + needed - 1) - p < longest)))
        near = F.filter(F.transform(close, lambda p: nearest(pairs, p, name, own, longest)), lambda r: r.less <= -threshold)
        return F.when(F.size(F.array_intersect(pairs, literal)) >= needed, near).otherwise(F.array().cast(runs_kind))

    def apart(near: Column) -> Column:
        """Runs that overlap no better one."""
        none = F.array().cast(runs_kind)
        overlaps = lambda a, b: (a["first"] <= b["last"]) & (b["first"] <= a["last"])
        return F.aggregate(F.array_sort(near), none, lambda taken, r: F.when(F.exists(taken, lambda t: overlaps(t, r)), taken).otherwise(F.concat(taken, F.array(r))))

    def numbered(parts: Column, split: str) -> Column:
        """Words, each with the number of its line or paragraph."""
        words = lambda part: F.filter(F.split(part, split), lambda w: w != "")
        return F.flatten(F.transform(parts, lambda part, i: F.transform(words(part), lambda w: F.struct(w.alias("word"), i.alias("part")))))

    def searched(words: Column) -> Column:
        line = words.part

        def pairs(word: Column) -> Column:
            return F.transform(F.slice(word, 1, F.greatest(F.size(word) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.element_at(word, i + 2)))

        def open_runs(near: Column) -> Column:
            paragraph = numbered(F.split(plain, _BLANK_LINES), r"[ \n]+").part

            def reported(r: Column, p: Column, paragraph: Column) -> Column:
                within = lambda of: p.passage.between(F.get(of, r["first"]), F.get(of, r["last"]))
                return (p.license == r["license"]) & ((p.unit == "text") | ((p.unit == "line") & within(line)) | ((p.unit == "paragraph") & within(paragraph)))

            return _let(paragraph, lambda of: F.filter(apart(near), lambda r: ~F.exists(found, lambda p: reported(r, p, of))))

        near = _let(_let(words.word, pairs), lambda p: F.concat(*(runs(p, name, text) for name, text in wordings)))
        return _let(near, lambda r: F.when(F.size(r) > 0, open_runs(r)).otherwise(F.array().cast(runs_kind)))

    known = sorted(w for w in wordings if bigrams(w[1]))
    if not known:
        return F.array().cast(kind)
    wordings = known
    some = sorted({a for _, text in known for a in anchors(text, threshold)})
    # A word that holds another one is found with it.
    some = [a for a in some if not any(b != a and b in a for b in some)]
    maybe = reduce(Column.__or__, (plain.contains(a) for a in some))
    rows = F.transform(
        _let(numbered(F.split(plain, "\n"), " "), searched),
        lambda r: F.struct(F.lit("window").alias("unit"), r["first"].alias("passage"), r["license"].alias("license"), r["n_bigrams"].alias("n_bigrams"), (-r["more"]).alias("shared"), (-r["less"]).alias("dice")),
    )
    return F.when(maybe, rows.cast(kind)).otherwise(F.array().cast(kind))


def _passages() -> Column:
    """Kind, number and words of each passage of the normalised text."""

    def listed(parts: Column, kind: str, split: str) -> Column:
        return F.transform(
            parts, lambda p, i: F.struct(F.lit(kind).alias("unit"), i.alias("passage"), F.split(F.trim(p, F.lit(" \n")), split).alias("words"))
        )

    several = F.col("_plain").contains("\n\n") | F.col("_plain").contains("\n \n")
    paragraphs = F.when(several, F.split("_plain", _BLANK_LINES)).otherwise(F.array("_plain"))
    # A paragraph of one line is a line already; it keeps its number and loses its words.
    longer = listed(F.transform(paragraphs, lambda p: F.when(p.contains("\n"), p).otherwise("")), "paragraph", r"[ \n]+")
    none = F.array().cast("array<string>")
    whole = listed(F.when(several, F.array("_plain")).otherwise(none), "text", r"[ \n]+")
    return F.concat(listed(F.split("_plain", "\n"), "line", " "), longer, whole)


def scan(docs: DataFrame, wordings: Sequence[tuple[str, str]] = NOTICES + TEXTS, threshold: float = THRESHOLD) -> DataFrame:
    """Matches: doc_id, unit, passage (its number from 0), license, n_bigrams, shared, dice."""
    known = templates(wordings)
    ratio = threshold / (2 - threshold)
    spans: list[list[float]] = []  # sizes that some wording allows, as disjoint intervals
    # A hair wider than exact, so that rounding cannot lose a passage that just reaches the threshold.
    bounds = {len(own): (len(own) * ratio - 1e-6, len(own) / ratio + 1e-6) for _, own in known}
    for low, high in sorted(bounds.values()):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = high
        else:
            spans.append([low, high])

    most = spans[-1][1]

    def allowed(least: Column, most: Column) -> Column:
        return reduce(Column.__or__, ((most >= low) & (least <= high) for low, high in spans))

    def pairs(words: Column) -> Column:
        return F.array_distinct(F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat(w, F.lit(" "), F.element_at(words, i + 2))))

    def scores(found: Column, n: Column) -> Column:
        near = F.array(
            *(
                F.when(
                    n.between(*bounds[len(own)]),
                    F.struct(F.lit(name).alias("license"), F.lit(len(own)).alias("size"), F.size(F.array_intersect(found, F.array(*map(F.lit, own)))).alias("shared")),
                )
                for name, own in known
            )
        )
        with_dice = F.transform(near, lambda c: F.struct((-2.0 * c.shared / (n + c.size)).alias("less"), c.license.alias("license"), c.shared.alias("shared")))
        return F.array_sort(F.filter(with_dice, lambda c: c.less <= -threshold))

    # One chain of array functions, so that no step is computed again for a filter that follows it.
    steps = F.filter(_passages(), lambda p: (F.size(p.words) > 1) & allowed(F.lit(1), F.size(p.words) - 1))
    # Distinct words among the first ones bound the number of bigrams from below as well, and settle long texts.
    some = lambda words: F.slice(words, 1, int(2 * most) + 2)
    steps = F.transform(steps, lambda p: F.struct(p.unit.alias("unit"), p.passage.alias("passage"), p.words.alias("words"), F.size(F.array_distinct(some(p.words))).alias("different")))
    steps = F.filter(steps, lambda p: allowed(p.different - 1, F.size(p.words) - 1))
    steps = F.transform(steps, lambda p: F.struct(p.unit.alias("unit"), p.passage.alias("passage"), pairs(p.words).alias("pairs")))
    steps = F.filter(steps, lambda p: allowed(F.size(p.pairs), F.size(p.pairs)))
    steps = F.transform(
        steps, lambda p: F.struct(p.unit.alias("unit"), p.passage.alias("passage"), F.size(p.pairs).alias("n_bigrams"), scores(p.pairs, F.size(p.pairs)).alias("best"))
    )
    steps = F.filter(steps, lambda p: F.size(p.best) > 0)
    steps = F.transform(
        steps,
        lambda p: F.struct(
            p.unit.alias("unit"), p.passage.alias("passage"), p.best[0].license.alias("license"), p.n_bigrams.alias("n_bigrams"), p.best[0].shared.alias("shared"), (-p.best[0].less).alias("dice")
        ),
    )
    steps = _let(steps, lambda found: F.concat(found, _windows(F.col("_plain"), found, wordings, threshold)))
    plain = docs.select("doc_id", F.regexp_replace(F.lower("text"), _GAPS, " ").alias("_plain"))
    # Outer, because the plan would evaluate the whole chain again to skip empty arrays ahead of a plain explode.
    found = plain.select("doc_id", F.explode_outer(steps).alias("p")).filter("p IS NOT NULL")
    return found.select("doc_id", "p.unit", "p.passage", "p.license", "p.n_bigrams", "p.shared", "p.dice")
