import random

import pyarrow as pa
import pytest

from gleaner.llm import decontamination, jaccard_join
from gleaner.llm.components import components
from tests.llm.tables import ROWS, empty, messy


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute_groups(rows, width, percent):
    sets = [shingles(r[1], width) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, r in enumerate(rows):
        if sets[i]:
            ids = smallest.setdefault(find(i), [])
            if r[0] is not None:
                ids.append(r[0])
    return sorted(((r[0], len(sets[i]), (min(smallest[find(i)], default=None) if sets[i] else r[0])) for i, r in enumerate(rows)), key=repr)


def near_copies(seed, n, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    out = []
    for c in range(n // 12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 160))]
        if c % 3 == 0:
            base += passage
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append((1000 + len(out), " ".join(copy), "en", "a"))
    return out


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_components_of_near_copies(spark, width, percent):
    rows = near_copies(width, 240, 5) + ROWS
    got = sorted(map(tuple, jaccard_join.shingle_groups(messy(spark, rows), width=width, percent=percent).collect()), key=repr)
    assert got == brute_groups(rows, width, percent)


def test_texts_hashed_together_have_the_sets_of_each_alone():
    texts = ["", "a b c", None, "w x y z", " \n ", "A b C d a b c d a b c d", "one", "p q r s t u v"]
    shingler = jaccard_join.Shingler(4)
    tokens, ends = shingler.of_all(texts)
    sets = [tokens[start:end].tolist() for start, end in zip(ends, ends[1:])]
    assert [len(s) for s in sets] == [len(shingles(t, 4)) for t in texts]
    assert sets == [shingler.of_all([t])[0].tolist() for t in texts] and all(s == sorted(set(s)) for s in sets)
    assert [len(run) for run in jaccard_join.together(pa.array([None, "x" * (jaccard_join.RUN_CHARS + 1), "y", None, "z"]))] == [2, 3]


def test_one_large_group_of_different_copies(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
        rows.append((i, " ".join(copy), "en", "a"))
    got = sorted(map(tuple, jaccard_join.shingle_groups(messy(spark, rows)).collect()), key=repr)
    assert got == brute_groups(rows, 4, 85)


def test_one_of_each_group_stays(spark):
    rows = near_copies(3, 120, 3) + ROWS
    kept = jaccard_join.keep_one(messy(spark, rows))
    assert kept.columns == messy(spark).columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    want = {c for i, n, c in brute_groups(rows, 5, 80) if n and i == c} | {i for i, n, _ in brute_groups(rows, 5, 80) if not n}
    assert set(ids) == want and ids.count(1) == 1
    assert jaccard_join.keep_one(empty(spark)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 299), (300, 299)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# ---- benchmark items

def table_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        if not text:
            break
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("abcdefgh ")
        elif kind == 1:
            text.insert(at, rng.choice("abcdefgh "))
        else:
            del text[at]
    return "".join(text)


def test_distance_is_that_of_the_table():
    rng = random.Random(2)
    for _ in range(60):
        item = "".join(rng.choice("abcd ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 60))) + edited(rng, item * 2, 5)[: rng.randint(0, 150)]
        assert decontamination.best_distance(item, text) == table_distance(item, text)


def test_recall_against_all_pairs(spark):
    rng = random.Random(6)
    syllables = ["the", "an", "er", "on", "re", "ti", "es", "or", "en", "at", "nd", "ha", "ou"]

    def prose(n):
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))

    items = [(i, prose(rng.randint(12, 50)).capitalize() + ".") for i in range(60)]
    docs = []
    for i in range(180):
        item = items[i % 60][1]
        inside = edited(rng, item, int(len(item) * (i % 3) * 0.045)) if i < 150 else ""
        docs.append((i, f"{prose(40)} {inside.upper() if i % 7 == 0 else inside}\n {prose(30)}", "en", "a"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in decontamination.find_items(messy(spark, docs), benchmark).collect()}
    want = {}
    for d, text, *_ in docs:
        for i, item in items:
            a, b = decontamination.normal_text(item), decontamination.normal_text(text)
            if (distance := decontamination.best_distance(a, b)) <= decontamination.allowed_edits(len(a), 0.1):
                want[d, i] = distance
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) / len(want) > 0.95 and len(want) >= 140


def test_short_items_with_the_full_tenth_of_edits():
    rng = random.Random(9)
    letters = "etaoinshrdlucm "

    def prose(n):
        return decontamination.normal_text("".join(rng.choice(letters) for _ in range(n)))

    items = []
    for size in range(16, 42):
        for _ in range(6):
            text = ""
            while len(text) != size:
                text = prose(size)
            items.append((len(items), text))
    texts = [f"{prose(60)}x{edited(rng, text, int(len(text) * 0.1))}x{prose(50)}" for _, text in items] + [prose(300) for _ in range(30)] + ["", "a"]
    texts = [decontamination.normal_text(t) for t in texts]
    got = {(n, i): d for n, hits in enumerate(decontamination.Items(items, 0.1).find(texts)) for i, d, _ in hits}
    want = {}
    for n, text in enumerate(texts):
        for i, item in items:
            if (distance := decontamination.best_distance(item, text)) <= int(len(item) * 0.1 + 1e-9):
                want[n, i] = distance
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(want) >= len(items) and len(got) / len(want) > 0.95
    by_size = {size: [(n, i) for n, i in want if len(items[i][1]) == size] for size in (16, 20, 24, 30, 32, 40)}
    assert all(sum(k in got for k in keys) >= len(keys) - 1 for keys in by_size.values())


def test_windows_by_pieces_lose_no_place():
    rng = random.Random(12)
    for share in (0.1, 0.25):
        text = "".join(rng.choice("abcdefghij ") for _ in range(24)).strip("  ").ljust(20, "k")
        text = decontamination.normal_text(text)
        limit = decontamination.allowed_edits(len(text), share)
        found = decontamination.Items([(0, text)], share)
        for _ in range(80):
            before = "".join(rng.choice("uvwxyz") for _ in range(30))
            whole = before + edited(rng, text, limit) + "uvwxyz" * 4
            opens = [p for _, places, _ in found._windows_by_pieces(decontamination.symbols(whole)) for p in places]
            assert any(abs(p - len(before)) <= limit for p in opens)


def test_items_of_messy_tables(spark):
    benchmark = spark.createDataFrame([(1, "brown fox jumps"), (2, None), (3, ""), (4, "QUICK  brown fox jumps over the lazy dog"), (4, "word"), (None, "lazy dog,")], "item_id bigint, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in decontamination.find_items(messy(spark), benchmark).collect()), key=repr)
    fox = [(1, i, 0) for i in (1, 4, None)] * 3 + [(2, i, 0) for i in (1, 4, None)]
    assert got == sorted([*fox, (8, 4, 0)], key=repr)
    kept = decontamination.without_items(messy(spark), benchmark)
    assert kept.columns == messy(spark).columns and kept.count() == len(ROWS) - 5
    assert decontamination.find_items(messy(spark), benchmark.limit(0)).collect() == []
    assert decontamination.find_items(empty(spark), benchmark).collect() == []
    assert decontamination.without_items(messy(spark), benchmark.limit(0)).count() == len(ROWS)


@pytest.mark.parametrize("kind,ids", [("int", [1, 2]), ("string", [None, "b"]), ("bigint", [None, 7]), ("smallint", [3, None])])
def test_item_ids_of_any_type(spark, kind, ids):
    text = "a benchmark item that is long enough to be looked for by its grams"
    items = spark.createDataFrame([(ids[0], text), (ids[1], text.replace("long", "wide enough"))], f"item_id {kind}, text string")
    docs = spark.createDataFrame([(1, f"before {text} after")], "doc_id bigint, text string")
    found = decontamination.find_items(docs, items)
    assert found.schema["item_id"].dataType == items.schema["item_id"].dataType
    assert ids[0] in [r["item_id"] for r in found.collect()]
