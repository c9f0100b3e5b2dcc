"""Hand-made rows: nulls, empty and long texts, ties, repeated rows, columns whose names clash with inner ones."""

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size bigint, score double, predicted int, n bigint, token string, digest string, label string, copies bigint, row bigint, hash bigint, norm string, _text string"
)
LONG = "the long text goes on and on. " * 9000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog, and so on.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog, and so on.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog, and so on.", "en", "a"),
    (2, "The  quick brown fox\njumps over the lazy dog, and so on.", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, " \t\n", "de", None),
    (None, "Ein Text ohne Nummer, der trotzdem zählt.", "de", "b"),
    (None, None, None, None),
    (6, "12345 !!! ???", "fr", "a"),
    (7, LONG, "en", "a"),
    (8, "word", "en", "c"),
    (9, "a<|endoftext|>b   \x00 \x1c x, y. z.", "fr", "c"),
    (10, "É ñ ß, ø. 日本語 🙂🙂 naïve", None, "c"),
    (11, "+1 (212) 555-0153 me@mail.example.com 10.0.0.256 10.0.0.25, 4377 4111 7318 3993", "en", "b"),
]


def messy(spark, rows=None):
    full = [(*r, None if r[1] is None else len(r[1]), 7, None, None, 3, "t", "d", "l", 9, 4, 5, "x", "y") for r in (ROWS if rows is None else rows)]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return messy(spark, [])
