import random
import re
from collections import Counter, defaultdict

import numpy as np

from gleaner.llm import divergence as dv
from tests.llm.tables import LONG, ROWS, empty, messy

SCALE = 1_000_000_000


def brute(rows, least=10, top=10):
    docs, counts, groups = defaultdict(set), Counter(), set()
    for n, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered):
            docs[lang, term].add(n)
            counts[lang, source, term] += 1
    out = []
    for lang in {g[0] for g in groups}:
        terms = [t for (l, t), d in docs.items() if l == lang and len(d) >= least]
        sources = [s for l, s in groups if l == lang]
        use = {s: {t: counts[lang, s, t] for t in terms} for s in sources}
        use[None] = {t: sum(use[s][t] for s in sources) for t in terms}
        p = {s: {t: 1 + SCALE * (n + 2) // (sum(c.values()) + 2 * len(terms)) for t, n in c.items()} for s, c in use.items()}
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            near = [(-sum(f(p[s][t], p[o][t]) for t in terms), o.encode(), o) for o in sources if o != s]
            own = [(-f(p[s][t], p[None][t]), t.encode(), t) for t in terms if use[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", sorted(near)), ("term", sorted(own)[:top])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


def test_pointers_are_sorted_like_words():
    rng = random.Random(1)
    for small in (300, 1000, 1 << 16):
        for _ in range(10):
            words = ["".join(rng.choice("abé") for _ in range(rng.randint(1, rng.choice([2, 9, 20, 40])))) for _ in range(rng.randint(1, 3000))]
            raw = " ".join(words).encode()
            data = np.frombuffer(raw + bytes(dv.SYMBOL), np.uint8)
            starts, lengths = dv.word_starts(data[: len(raw)], np.array([0, len(raw)]))
            order, fresh = dv.sort_words(data, starts, lengths, small)
            got = [words[i] for i in order]
            assert got == sorted(words, key=str.encode)
            assert fresh.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]
            assert all(order[i] > order[i - 1] for i in range(1, len(order)) if not fresh[i])


def some_rows():
    rng = random.Random(6)
    words = ["the", "The", "ÉTÉ", "été", "naïve", "日本", "x1y", "ab-cd", "zz_top", "supercalifragilistic", "supercalifragilism", "a", "I"]
    rows = [(n, " ".join(rng.choices(words, weights=range(1, 14), k=rng.randrange(30))), rng.choice(["en", "en", "fr", None, ""]), rng.choice(["a", "b", "c", None, "é", "lone"])) for n in range(400)]
    return rows + ROWS + [(900, LONG, "en", "a")] * 11 + [(1000, "", "xx", "empty"), (1001, None, "xx", "other"), (1002, "joined", "joi", "s"), (1003, "words", "joi", "s")]


def test_against_plain_python(spark):
    want = brute(some_rows())
    assert {r[2] for r in want} == {"pair", "term"}
    # the small slices cut the long texts into pieces
    for slice_bytes, small in ((dv.SLICE, dv.SMALL), (2000, 300)):
        got = sorted(tuple(r) for r in dv.audit_sources(messy(spark, some_rows()), slice_bytes=slice_bytes, small=small).collect())
        assert got == want


def test_counts_beyond_whole_numbers_of_64_bits(spark):
    row = spark.sql("SELECT 40000000000000 AS c, 900000000000000 AS n, 1000 AS v")
    assert row.select(dv.share(row.c, row.n, row.v)).first()[0] == 1 + SCALE * (40000000000000 + 2) // (900000000000000 + 2000)


def test_no_rows_and_no_kept_term(spark):
    assert dv.audit_sources(empty(spark)).collect() == []
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b")]
    assert sorted(tuple(r) for r in dv.audit_sources(messy(spark, rows)).collect()) == brute(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
