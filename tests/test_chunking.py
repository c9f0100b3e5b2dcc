import re
import random

import pytest

from gleaner.functions import text as tx
from gleaner.operators import chunking
from gleaner.operators import enrich
from gleaner.operators.keyword_index import build_index
from tests.conftest import rows

SCHEMA = "doc_id bigint, file_name string, text string"


def documents(spark, *texts):
    return spark.createDataFrame([(i, f"d{i}.md", t) for i, t in enumerate(texts)], SCHEMA)


@pytest.mark.parametrize(
    "n, sizes",
    [(0, []), (1, [1]), (1024, [1024]), (1025, [1024, 205]), (2001, [1024, 1024, 361]), (3000, [1024, 1024, 1024, 540])],
)
def test_window_sizes(spark, n, sizes):
    df = chunking.chunk_windows(documents(spark, " ".join(f"w{i}" for i in range(n))))
    assert [r["n_words"] for r in df.orderBy("chunk_no").collect()] == sizes


def test_windows_are_exact_pieces_of_the_text(spark):
    text = "  A b.\n\nC  d\te \n"
    df = chunking.chunk_windows(documents(spark, text, " \n\t", ""), size=3, overlap=1)
    assert rows(df.select("chunk_id", "text", "n_words"), "chunk_id") == [("0#0", "A b.\n\nC", 3), ("0#1", "C  d\te", 3)]


def plain_units(text, size, overlap):
    """Sentences with their word counts; one above ``size`` words becomes windows."""
    breaks = [match.end() for match in re.finditer(tx.SENTENCE_BREAK, text, re.ASCII)]
    for start, stop in zip([0, *breaks], [*breaks, len(text)]):
        found = re.compile(tx.SPACED_WORD_PATTERN, re.ASCII).findall(text, start, stop)
        if len(found) > size:
            for first in range(0, len(found) - overlap, size - overlap):
                yield "".join(found[first : first + size]), len(found[first : first + size])
        elif found:
            yield "".join(found), len(found)


def by_hand(text, size, overlap):
    """Chunks by trying every start: the rules stated on lists of sentences."""
    units = list(plain_units(text, size, overlap))
    chunks, start = [], 0
    while start < len(units):
        stop, total = start, 0
        while stop < len(units) and total + units[stop][1] <= size:
            total += units[stop][1]
            stop += 1
        chunks.append(("".join(u for u, _ in units[start:stop]).rstrip(), total))
        if stop == len(units):
            break
        nxt = stop
        while nxt - 1 > start and sum(n for _, n in units[nxt - 1 : stop]) <= overlap and sum(n for _, n in units[nxt - 1 : stop + 1]) <= size:
            nxt -= 1
        start = nxt
    return chunks


def test_sentence_chunks_follow_the_packing_rule(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(60):
        sentences = [" ".join("w" for _ in range(rng.choice([1, 2, 3, 5, 9, 14, 40]))) + rng.choice([". ", "! ", "\n\n", "?\n"]) for _ in range(rng.randrange(0, 30))]
        texts.append("".join(sentences))
    got = chunking.chunk_sentences(documents(spark, *texts), size=12, overlap=4).orderBy("doc_id", "chunk_no").collect()
    for number, text in enumerate(texts):
        assert [(r["text"], r["n_words"]) for r in got if r["doc_id"] == number] == by_hand(text, 12, 4)
    assert all(r["n_words"] <= 12 for r in got)


def test_every_word_is_in_some_chunk(spark):
    text = " ".join(f"w{i}{'.' if i % 7 == 0 else ''}" for i in range(5000))
    for cut in (chunking.chunk_windows, chunking.chunk_sentences):
        found = {w for r in cut(documents(spark, text)).collect() for w in r["text"].split()}
        assert found == set(text.split())


def test_long_sentence_becomes_windows(spark):
    got = chunking.chunk_sentences(documents(spark, "a b. " + "x " * 3000 + "end. c d."))
    assert [r["n_words"] for r in got.orderBy("chunk_no").collect()] == [2, 1024, 1024, 1024, 543]


def test_sentences_are_packed_without_python(spark):
    plan = chunking.chunk_sentences(documents(spark, "One. Two."))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
    assert chunking.chunk_sentences(spark.createDataFrame([(1, "a", None), (2, "b", ""), (3, "c", " \n")], "doc_id bigint, file_name string, text string")).count() == 0


def test_a_long_text_of_short_sentences(spark):
    text = "It is so. " * 60_000
    chunks = chunking.chunk_sentences(documents(spark, text), size=1000, overlap=100).collect()
    assert len(chunks) == 1 + -(-(180_000 - 999) // 900) and max(r["n_words"] for r in chunks) <= 1000


def test_metadata_stays_with_every_chunk(spark):
    data = [("a#0", "a", 0, "# Herbs\nSage grows slowly. Mint spreads."), ("a#1", "a", 1, "Mint wants shade."), ("b#0", "b", 0, "?!"), ("c#0", "c", 0, None)]
    chunks = spark.createDataFrame(data, "chunk_id string, doc_id string, chunk_no bigint, text string")
    got = enrich.run_transformations(chunks, enrich.metadata_steps(build_index(chunks), keywords=2, questions=1))
    found = {r["chunk_id"]: r for r in got.collect()}
    assert set(found) == {"a#0", "a#1", "b#0", "c#0"}
    assert [found[c]["title"] for c in ("a#0", "a#1", "b#0", "c#0")] == ["Herbs", "Herbs", "?!", None]
    assert found["a#1"]["keywords"] == "shade, wants" and found["a#1"]["questions"] == "Mint wants ____"
    assert found["a#1"]["prev_summary"] == found["a#0"]["summary"] is not None
    assert found["c#0"]["keywords"] is None and found["c#0"]["questions"] is None and found["c#0"]["summary"] is None
    told = {r["chunk_id"]: r["text"] for r in enrich.metadata_text(got).collect()}
    assert told["a#1"].startswith("Herbs\nshade, wants\n") and told["a#1"].endswith("\nMint wants shade.") and told["c#0"] == ""


def test_metadata_is_added_without_moving_texts(spark):
    data = [("a#0", "a", 0, "# Herbs\nSage grows slowly. Mint spreads."), ("a#1", "a", 1, "Mint wants shade."), ("b#0", "b", 0, "?!"), ("c#0", "c", 0, None), ("a#1", "a", 1, "Mint wants sun.")]
    chunks = spark.createDataFrame(data, "chunk_id string, doc_id string, chunk_no bigint, text string")
    index = build_index(chunks)
    columns = ["chunk_id", "title", "keywords", "questions", "summary", "prev_summary"]
    whole = enrich.run_transformations(chunks, enrich.metadata_steps(index, keywords=2, questions=1)).select(columns)
    bare = enrich.run_transformations(chunks.drop("text"), enrich.metadata_steps(index, keywords=2, questions=1, texts=chunks))
    assert sorted(map(tuple, bare.select(columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert "text" not in bare.columns and bare.count() == 4


def test_rare_terms_meet_their_frequencies_in_a_join(spark):
    texts = ["Aa bb cc. Dd ee ff aa.", "Aa bb. Gg hh. Bb ee.", "Aa. Ii.", "Bb aa cc ff.", "", "Kk " * 3 + "aa."]
    chunks = spark.createDataFrame([(f"c{i}", i, 0, t) for i, t in enumerate(texts)], "chunk_id string, doc_id bigint, chunk_no bigint, text string")
    index = build_index(chunks)
    whole = enrich.top_keywords(index, 2).orderBy("chunk_id", "rank").collect()
    told = enrich.summarize(chunks, index).orderBy("chunk_id").collect()
    for limit in (0, 1, 3):
        assert enrich.top_keywords(index, 2, limit).orderBy("chunk_id", "rank").collect() == whole
        assert enrich.summarize(chunks, index, limit).orderBy("chunk_id").collect() == told
    assert [r["summary"] for r in told] == ["Dd ee ff aa.", "Gg hh.", "Ii.", "Bb aa cc ff.", "Kk Kk Kk aa."]
