import random
import re

import numpy as np

from epitally.llm.urls import ALLOW, BLOCK, GlobAutomaton, HostRule, judge

SCHEMA = "page_id long, url string, PATH string"


def as_regex(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.S)


def test_packed_rules_match_like_regular_expressions():
    rng = random.Random(6)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "ab"]) for _ in range(rng.randrange(0, 9))) for _ in range(60)] + ["x" * 70 + "*y"]
    texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(0, 12))) for _ in range(300)] + ["x" * 70 + "aby", "x" * 69 + "y", ""]
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data])
    found = GlobAutomaton(globs).matches(np.frombuffer(b"".join(data), np.uint8), ends - [len(d) for d in data], ends)
    for i, t in enumerate(texts):
        for k, g in enumerate(globs):
            assert found[i, k] == bool(as_regex(g).fullmatch(t)), (t, g)


def test_parts_and_rules(spark):
    cases = {
        "http://A.Example.ORG/es/1?x#y": ("a.example.org", "/es/1", "example.org/es/", BLOCK),
        "https://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", BLOCK),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", ALLOW),
        "https://example.org": ("example.org", "", None, ALLOW),
        "https://example.org?q=/es/": ("example.org", "", None, ALLOW),
        "https://evil.net/a.org/b": ("evil.net", "/a.org/b", None, ALLOW),
        "http://big-CASINO.net": ("big-casino.net", "", None, BLOCK),
        "http://www.casino.org/x": ("www.casino.org", "/x", "org/", ALLOW),
        "http://x.com/fr/a": ("x.com", "/fr/a", "com/fr/", ALLOW),
        "http://x.com/de/a#/fr/": ("x.com", "/de/a", "com/de/", BLOCK),
        "http://x.com/FR/a": ("x.com", "/FR/a", None, ALLOW),
        "ftp://ü.org/%C3://b": ("ü.org", "/%C3://b", "org/", ALLOW),
        "example.org/es/": ("", "", None, ALLOW),
        "": ("", "", None, ALLOW),
        "://": ("", "", None, ALLOW),
        "http://long.com/de/" + "x" * 50000: ("long.com", "/de/" + "x" * 50000, "com/de/", BLOCK),
    }
    data = [(i, u, "p") for i, u in enumerate(cases)] + [(99, None, "p"), (None, "http://x.com/fr/", "p"), (0, next(iter(cases)), "p")]
    judged = judge(spark.createDataFrame(data, SCHEMA))
    assert judged.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = judged.collect()
    assert len(found) == len(data)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == cases.get(r.url, ("", "", None, ALLOW) if r.url is None else ("x.com", "/fr/", "com/fr/", ALLOW))


def test_equally_long_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.bc/de", None)], SCHEMA)
    rules = [HostRule("a.bc", "/", ALLOW), HostRule("bc", "/de", BLOCK)]
    for order in (rules, rules[::-1]):
        assert judge(pages, order).first().rule == "bc/de"
    assert judge(pages, []).first().verdict == ALLOW and judge(pages, [], ["**/de"]).first().verdict == BLOCK
    assert judge(pages.limit(0)).count() == 0
