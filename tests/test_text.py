from pyspark.sql import functions as F

from gleaner.functions import text as tx
from tests.conftest import rows


def one(spark, value, expression, type_="string"):
    df = spark.createDataFrame([(value,)], f"v {type_}")
    return df.select(expression(F.col("v"))).first()[0]


def test_blank_texts_of_any_script(spark):
    for text, expected in [("", False), (" ", False), ("\t\n", False), ("  ", False), ("a", True), (None, False)]:
        assert one(spark, text, tx.is_nonblank) is expected


def test_terms_keep_repeats_and_drop_single_letters(spark):
    assert one(spark, "The café, the a_b I x2", tx.terms) == ["the", "café", "the", "a_b", "x2"]


def test_sentences_break_at_marks_and_blank_lines(spark):
    text = "One two. Three 3.14 four!  Five\n\nsix\nseven? "
    assert one(spark, text, tx.sentences) == ["One two.", "Three 3.14 four!", "Five", "six\nseven?"]


def test_preview_always_adds_dots(spark):
    assert one(spark, "short", tx.preview) == "short..."
    assert one(spark, "x" * 70, tx.preview) == "x" * 60 + "..."


def test_clean_output_is_a_single_pass(spark):
    assert one(spark, "\n a   b    c \n", tx.clean_output) == "a  b  c"


def test_last_line(spark):
    assert one(spark, "a\nRESULT: success\n\n", tx.last_line) == "RESULT: success"
    assert one(spark, "", tx.last_line) == ""


def test_blank_out_keyword(spark):
    assert one(spark, "The Dog, dogs and (DOG)", lambda c: tx.blank_out(c, F.lit("dog"))) == "The ____ dogs and ____"


def test_first_nonempty(spark):
    df = spark.createDataFrame([("", None, "p"), (None, "q", "p"), ("i", "q", "p"), (None, "", "")], "a string, b string, c string")
    got = [r[0] for r in df.select(tx.first_nonempty(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["p", "q", "i", ""]


def test_citations(spark):
    assert one(spark, "x [file=A.md] and [file=B-1.md].", tx.citations) == ["A.md", "B-1.md"]
    assert one(spark, "none", tx.citations) == []


def test_truncate_counts_tokens_but_cuts_characters(spark):
    assert one(spark, "aa bb cc", lambda c: tx.truncate_long(c, 2)) == "aa"
    assert one(spark, "aa bb cc", lambda c: tx.truncate_long(c, 3)) == "aa bb cc"


def test_hash_sees_part_boundaries(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    hashes = {r[0] for r in df.select(tx.content_hash(F.col("x"), F.col("y"))).collect()}
    assert len(hashes) == 2


def test_titles(spark):
    assert one(spark, "\n intro\n## Head one\nx", tx.first_heading) == "Head one"
    assert one(spark, "plain", tx.first_heading) is None
    assert one(spark, " \n\t line\nmore", tx.first_line) == "line"
    assert rows(spark.range(1).select(tx.first_line(F.lit(" \n")))) == [(None,)]
