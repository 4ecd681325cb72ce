import random
import re
import textwrap

from epitally.llm.license_texts import NOTICES, TEXTS
from epitally.llm.licenses import THRESHOLD, anchors, bigrams, scan

SCHEMA = "doc_id long, text string, UNIT string"


def pairs(text):
    words = re.findall(r"[^\W_]+", text.lower())
    return set(zip(words, words[1:], strict=False))


def brute(text):
    """Unit, number, licence and coefficient of the matches in a text."""
    lines = text.split("\n")
    paragraphs = re.split(r"\n ?\n[ \n]*", text)
    units = [("line", i, p) for i, p in enumerate(lines)] + [("paragraph", i, p) for i, p in enumerate(paragraphs) if "\n" in p]
    units += [("text", 0, text)] if len(paragraphs) > 1 else []
    out = []
    for unit, i, passage in units:
        own = pairs(passage)
        scored = sorted((-2 * len(own & pairs(t)) / (len(own) + len(pairs(t))), name) for name, t in NOTICES + TEXTS if own)
        if scored and -scored[0][0] >= THRESHOLD:
            out.append((unit, i, scored[0][1], round(-scored[0][0], 9)))
    return out


def test_matches_equal_brute_force(spark):
    mit = dict(TEXTS)["MIT"]
    wrapped = textwrap.fill(mit, 72)
    texts = [t for _, t in NOTICES + TEXTS] + [
        wrapped, wrapped + "\n\nSome other words follow.", "Title\n\n" + wrapped + "\n\n" + dict(TEXTS)["ISC"], mit.replace("Software", "Program"), mit[: len(mit) // 2],
        "first\nRELEASED   under the *MIT* license\nlast", "Released under the MIT", "This work is licensed under the GNU General Public License, version 4.",
        "license " * 5000, "a b " * 20000 + "\nReleased under the MIT License.", "", "one", "\n\n\n", " \n \n", "ß\n\nÜ " * 3, "\n\nReleased under\nthe MIT License.\n", "\nReleased under\nthe MIT License.",
    ]
    docs = spark.createDataFrame([*((i, t, None) for i, t in enumerate(texts)), (900, None, None), (None, texts[0], None), (0, texts[0], None)], SCHEMA)
    found = {}
    for r in scan(docs).collect():
        found.setdefault(r.doc_id, []).append((r.unit, r.passage, r.license, round(r.dice, 9)))
    expected = {i: brute(t) for i, t in enumerate(texts)}
    expected[None], expected[0] = expected[0], expected[0] * 2
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items() if v}
    assert expected[len(NOTICES + TEXTS)] == [("paragraph", 0, "MIT", 1.0)]


#: The texts in their usual paragraphs, each of which begins with these words.
MIT_PARTS = ("The above copyright notice", "THE SOFTWARE IS PROVIDED")
ISC_PARTS = ("THE SOFTWARE IS PROVIDED",)
APACHE_PARTS = ("You may obtain", "Unless required")
GPL_PARTS = ("This program is distributed", "You should have")
ZLIB_PARTS = ("Permission is granted", "1. The origin", "2. Altered", "3. This notice")


def parted(text, begins):
    for words in begins:
        text = text.replace(" " + words, "\n\n" + words)
    return "\n\n".join(textwrap.fill(p, 72) for p in text.split("\n\n"))


def best_window(text, wording, threshold=THRESHOLD):
    """The highest coefficient of any run of words of bounded length."""
    words, own = re.findall(r"[^\W_]+", text.lower()), pairs(wording)
    longest = int((len(re.findall(r"[^\W_]+", wording)) - 1) * (2 - threshold) / threshold + 1e-6)
    best = 0.0
    for i in range(len(words) - 1):
        seen = set()
        for j in range(i, min(len(words) - 1, i + longest)):
            seen.add((words[j], words[j + 1]))
            best = max(best, 2 * len(seen & own) / (len(seen) + len(own)))
    return best


def test_wordings_inside_longer_texts(spark):
    filler = [" ".join(f"w{k}x{i}" for i in range(400)) for k in range(2)]
    full = dict(TEXTS)
    cases = [(name, parted(full[name], p)) for name, p in (("MIT", MIT_PARTS), ("ISC", ISC_PARTS), ("Apache-2.0", APACHE_PARTS), ("GPL-3.0", GPL_PARTS), ("Zlib", ZLIB_PARTS))]
    cases += [(name, "x = 1  # " + text + " def f(): return x") for name, text in NOTICES]
    cases += [("MIT", "all of this is released\nunder the MIT\n\nlicense and more")]
    docs = [f"{filler[0]}\n\n{text}\n\n{filler[1]}" for _, text in cases]
    found = {}
    rows = scan(spark.createDataFrame([(i, t, None) for i, t in enumerate(docs)], SCHEMA)).collect()
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    for i, (name, _) in enumerate(cases):
        assert {r.license for r in found.get(i, [])} == {name}, (name, docs[i][3000:3400], found.get(i))
    mit = found[0]
    assert [(r.unit, r.passage, r.dice, r.n_bigrams) for r in mit] == [("window", 400, 1.0, len(pairs(full["MIT"])))]


def test_windows_equal_brute_force(spark):
    rng = random.Random(5)
    wordings = [("A", "a b c d e f g a b"), ("B", "k l m n o"), ("C", "k l m n p q")]
    texts = [" ".join(rng.choice("abcdefgklmnopq") if rng.random() < 0.2 else w for w in rng.choice(wordings)[1].split() * rng.choice([1, 2]) + ["zz"] * 9 + ["yy"] * 9) for _ in range(150)]
    texts = [" ".join(["vv", "ww"] * 12) + " " + t for t in texts]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    found = {}
    for r in scan(docs, wordings).collect():
        assert r.unit == "window" and r.dice >= THRESHOLD
        found[r.doc_id] = max(found.get(r.doc_id, 0), round(r.dice, 9))
    best = [round(max(best_window(t, w) for _, w in wordings), 9) for t in texts]
    assert set(found) == {i for i, b in enumerate(best) if b >= THRESHOLD}
    assert 20 < len(found) < 140


def test_anchors_are_needed():
    for _, text in NOTICES + TEXTS:
        own, words = bigrams(text), anchors(text, THRESHOLD)
        left = [p for p in own if not set(p.split()) & set(words)]
        assert len(left) < THRESHOLD * len(own) / (2 - THRESHOLD) and words


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0
