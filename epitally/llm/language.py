"""Language identification in two steps: the family first, then the language in it.

A text is the histogram of its hashed byte trigrams, in lower case and with every
run of anything but letters as one blank; the square roots of the shares are the
features, so long and short texts compare. One linear support vector machine per
pair of families votes for the family. Inside the family one per pair of its
languages votes for the language, trained on these two languages only, so what
parts close relatives is not drowned by what parts the families.

Every label is learned. Machines are fitted on the driver from a sample of labelled
rows, ``per_language`` of each and ``most_rows`` in all, but at least ``least_per_language``
of each; only feature vectors travel there, so what the driver holds follows the number of
different labels, not of rows. Languages that no family lists are put into families of at most
``unlisted`` by the likeness of their rows, so the number of machines inside families
grows with the languages and not with their square. The machines are a few numbers per feature, so prediction runs where the text is
read, and nothing is shuffled.

A text far from the language it is given is rejected. Its likeness is the cosine of its
features and the mean of the language's learned rows. The limit is a share of what
all but one percent of the learned rows reach against the mean of the others. Texts with
few different trigrams are not judged, as their likeness says little, and a language
with few learned rows rejects nothing.

Defined results: a NULL text, one without any letter or a rejected one is ``und`` with score 0;
languages that the family table does not list form families of their own; with one learned
language every text with letters gets it, and with none every text is ``und``;
equal votes go to the larger margin; texts of any length are read whole; repeated
rows are predicted alike; an empty table gives an empty result; columns named like
the new ones give way, others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm import svm
from epitally.llm import words as W

UNDETERMINED = "und"

#: Families of languages by two-letter code.
FAMILIES = {
    "germanic": "en de nl da sv no is",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk pl cs sk bg sr hr sl",
    "uralic": "fi et hu",
}

_FEATURES = 1 << 12
#: Letters of ASCII, and every byte of a longer UTF-8 sequence.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
_PLAIN = np.where(_LETTER, np.arange(256), ord(" ")).astype(np.uint32)
_PLAIN[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class LanguageSpec:
    #: About so many labelled rows of each language are learned from.
    per_language: int = 400
    #: Rows learned from in all; with many languages each gets fewer, but not fewer than the least.
    most_rows: int = 3200
    least_per_language: int = 32
    #: Languages in a family of those that the table does not list.
    unlisted: int = 12
    #: The margin at which a decision is as good as certain.
    certain: float = 1.0
    #: A text is rejected below this share of the likeness that its language's texts have.
    likeness: float = 0.5
    #: Texts with fewer different trigrams are not rejected.
    least_trigrams: int = 128
    #: Languages with fewer learned rows of so many trigrams reject nothing.
    least_rows: int = 10


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of unit length for each text: roots of the shares of its hashed trigrams."""
    out = np.zeros((len(at) - 1, _FEATURES), np.float32)
    plain = _PLAIN[data]
    for i in range(len(at) - 1):
        text = plain[at[i] : at[i + 1]]
        blank = text == 32
        if len(text) > 1:
            text = text[~(blank & np.concatenate(([False], blank[:-1])))]
        if len(text) < 3:
            text = np.concatenate([text, np.full(3 - len(text), 32, np.uint32)])
        grams = (text[:-2] << np.uint32(16)) | (text[1:-1] << np.uint32(8)) | text[2:]
        grams = (grams * np.uint32(2654435761)) >> np.uint32(20)
        counts = np.bincount(grams, minlength=_FEATURES)
        out[i] = np.sqrt(counts / len(grams))
    return out


def _alike(names: list[str], means: np.ndarray, most: int) -> list[list[str]]:
    """Names in groups of at most ``most``, halved again and again along what parts their means most."""
    if len(names) <= most:
        return [names]
    apart = means - means.mean(axis=0)
    along = apart @ np.linalg.svd(apart, full_matrices=False)[2][0]
    order = np.argsort(along, kind="stable")
    return [part for half in np.array_split(order, 2) for part in _alike([names[i] for i in half], means[half], most)]


class LanguageModel:
    """Votes of pairwise machines, first between families, then inside one."""

    def __init__(self, rows: np.ndarray, labels: list[str], spec: LanguageSpec):
        self.certain = spec.certain
        family_of = {language: family for family, codes in FAMILIES.items() for language in codes.split()}
        label = np.array(labels, object)
        others = sorted(set(labels) - set(family_of))
        if others:
            parts = _alike(others, np.stack([rows[label == x].mean(axis=0) for x in others]), spec.unlisted)
            family_of |= {x: "other" if len(parts) == 1 else f"other {k}" for k, names in enumerate(parts) for x in names}
        family = np.array([family_of[x] for x in labels], object)
        self.members = {f: sorted(set(label[family == f])) for f in sorted(set(family))}
        self.families = list(self.members)
        self.weights, self.biases, self.pairs = [], [], {}
        self._train(rows, family, self.families, None)
        for f, languages in self.members.items():
            self._train(rows, label, languages, f)
        self.weights = np.stack(self.weights, axis=1).astype(np.float32) if self.weights else np.zeros((_FEATURES, 0), np.float32)
        self.biases = np.array(self.biases, np.float32)
        self.least_trigrams = spec.least_trigrams
        self.languages = sorted(set(labels))
        self.means, self.limits = np.zeros((_FEATURES, len(self.languages)), np.float32), np.zeros(len(self.languages), np.float32)
        for i, language in enumerate(self.languages):
            self.means[:, i], self.limits[i] = self._likeness(rows[label == language], spec)

    @staticmethod
    def _likeness(own: np.ndarray, spec: LanguageSpec) -> tuple[np.ndarray, float]:
        """The mean direction of a language's rows, and the likeness below which a text is rejected."""
        total = own.sum(axis=0, dtype=np.float64)
        mean = total / np.linalg.norm(total)
        long = own[np.count_nonzero(own, axis=1) >= spec.least_trigrams]
        if len(long) < max(2, spec.least_rows):
            return mean, 0.0
        # Against the mean of the other rows: with its own share in it, any row would be near.
        dot = long @ total
        norms = (long.astype(np.float64) ** 2).sum(axis=1)
        others = np.sqrt(np.maximum(total @ total - 2 * dot + norms, 1e-12))
        return mean, spec.likeness * max(0.0, float(np.quantile((dot - norms) / others, 0.01)))

    def rejected(self, rows: np.ndarray, names: list[str]) -> np.ndarray:
        """Whether each row is too far from the language it was given."""
        at = np.searchsorted(self.languages, names)
        near = (rows @ self.means)[np.arange(len(rows)), at]
        return (np.count_nonzero(rows, axis=1) >= self.least_trigrams) & (near < self.limits[at])

    def _train(self, rows: np.ndarray, of: np.ndarray, choices: list[str], family: str | None) -> None:
        for a, b in combinations(range(len(choices)), 2):
            both = (of == choices[a]) | (of == choices[b])
            weights, bias = svm.fit(rows[both], of[both] == choices[a])
            self.pairs.setdefault(family, []).append((a, b, len(self.weights)))
            self.weights.append(weights)
            self.biases.append(bias)

    def _vote(self, margins: np.ndarray, family: str | None, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The choice with most votes for each row, and its smallest margin over another."""
        votes = np.zeros((len(margins), count))
        least = np.full((len(margins), count), np.inf)
        for a, b, k in self.pairs.get(family, []):
            m = margins[:, k]
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            least[:, a] = np.minimum(least[:, a], m)
            least[:, b] = np.minimum(least[:, b], -m)
        chosen = np.argmax(votes + np.tanh(np.clip(least, -9, 9)) * 0.4, axis=1) if count > 1 else np.zeros(len(margins), int)
        return chosen, least[np.arange(len(margins)), chosen]

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = rows @ self.weights + self.biases
        family, sure = self._vote(margins, None, len(self.families))
        names = np.empty(len(rows), object)
        for f, name in enumerate(self.families):
            own = np.flatnonzero(family == f)
            language, margin = self._vote(margins[own], name, len(self.members[name]))
            names[own] = np.array(self.members[name], object)[language]
            sure[own] = np.minimum(sure[own], margin)
        # Zero margin is even odds; the certain margin is 0.98.
        return list(names), 1 / (1 + np.exp(-4 * np.clip(sure, -9, 9).astype(np.float64) / self.certain))


def _sampled(labelled: DataFrame, label: str, spec: LanguageSpec) -> DataFrame:
    """About ``per_language`` different texts of each language, chosen by a hash of id and text."""
    sizes = labelled.groupBy(label).agg(F.count("*").alias("n")).collect()
    if not sizes:
        return labelled.limit(0)
    spread = 1 << 30
    rows = max(spec.least_per_language, min(spec.per_language, spec.most_rows // len(sizes)))
    below = F.create_map(*(F.lit(x) for r in sorted(sizes) for x in (r[label], rows * spread // r.n)))
    drawn = labelled.withColumn("_draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(spread))).filter(F.col("_draw") < below[F.col(label)])
    return drawn.dropDuplicates([label, "text"])


def fit(labelled: DataFrame, label: str = "lang", spec: LanguageSpec = LanguageSpec()) -> LanguageModel | None:
    """Learns from rows with doc_id, text and a label; None if there are none with letters."""
    labelled = labelled.filter(F.col(label).isNotNull() & has_letters(F.col("text"))).select("doc_id", "text", F.col(label).alias("label"))
    sample = _sampled(labelled, "label", spec).select("label", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.batched([batch], "text"):
                rows = features(*W.buffer(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["label", "row"])

    found = sample.mapInArrow(vectors, "label string, row binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r.label, r.row))  # the same machines whatever the order of arrival
    return LanguageModel(np.stack([np.frombuffer(r.row, np.float32) for r in found]), [r.label for r in found], spec)


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("lang_pred", "score")])
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.batched(batches, "text"):
            names: list[str] = []
            scores: list[np.ndarray] = []
            data, at = W.buffer(batch.column("text"))
            for low in range(0, batch.num_rows, 256):
                part = at[low : low + 257]
                rows = features(data[part[0] : part[-1]], part - part[0])
                name, score = model.predict(rows)
                out = model.rejected(rows, name)
                names += np.where(out, UNDETERMINED, np.array(name, object)).tolist()
                scores.append(np.where(out, 0.0, score))
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            name = np.where(letters, np.array(names, object), UNDETERMINED)
            score = np.where(letters, np.concatenate(scores) if scores else np.zeros(0), 0.0)
            kept = [batch.column(c) for c in docs_columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(name, pa.string()), pa.array(score)], names=[*docs_columns, "lang_pred", "score"])

    docs_columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.withColumn("_letters", has_letters(F.col("text"))).mapInArrow(predicted, schema)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Rows kept from learning: a fixed share by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
