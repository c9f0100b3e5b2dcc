"""Text expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a word, a word with the space after it, a search term and a token.
WORD_PATTERN = r"\S+"
SPACED_WORD_PATTERN = r"\S+\s*"
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
# A sentence ends after . ! ? plus white space, or at a blank line.
SENTENCE_BREAK = r"(?<=[.!?])\s+|\n\s*\n"

BLANK = "____"


def words(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def spaced_words(text: Column) -> Column:
    """Words that keep the white space after them, so that joining restores the text."""
    return F.regexp_extract_all(text, F.lit(SPACED_WORD_PATTERN), F.lit(0))


def strip_end(text: Column) -> Column:
    """Text without white space at its end."""
    return F.regexp_replace(text, r"\s+$", "")


def strip(text: Column) -> Column:
    """Text without white space at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def first_line(text: Column) -> Column:
    """First line with a visible character, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(\S[^\n]*)", 1), F.lit(""))


def first_heading(text: Column) -> Column:
    """Text of the first Markdown heading, null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(?m)^#{1,6}[ \t]+(\S[^\n]*)", 1), F.lit(""))


def terms(text: Column) -> Column:
    """Lower-case search terms of two or more word characters, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def sentences(text: Column) -> Column:
    """Sentences in text order, blank ones left out."""
    return F.filter(F.split(text, SENTENCE_BREAK, -1), lambda s: s.rlike(r"\S"))


def token_count(text: Column) -> Column:
    """Number of word-character runs: the tokenizer-free token count."""
    return F.size(F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))).cast("bigint")


def truncate_long(text: Column, max_tokens: int) -> Column:
    """Texts of more than ``max_tokens`` tokens are cut to that many *characters*."""
    return F.when(token_count(text) > max_tokens, F.substring(text, 1, max_tokens)).otherwise(text)


def is_nonblank(text: Column) -> Column:
    """True when at least one character is not white space of any script."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def content_hash(*parts: Column) -> Column:
    """SHA-256 over the parts, separated so that shifted boundaries differ."""
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def preview(text: Column, width: int = 60) -> Column:
    """First characters of a text followed by dots, which are always added."""
    return F.concat(F.substring(text, 1, width), F.lit("..."))


def clean_output(text: Column) -> Column:
    """Double spaces become single in one pass, then the ends are stripped."""
    return strip(F.replace(text, F.lit("  "), F.lit(" ")))


def last_line(text: Column) -> Column:
    """Last line of a text, ignoring line ends after it."""
    return F.element_at(F.split(F.rtrim(text, F.lit("\r\n")), "\r?\n"), -1)


def blank_out(sentence: Column, keyword: Column) -> Column:
    """The sentence with every word that contains ``keyword`` as a term blanked."""
    return F.array_join(
        F.transform(
            words(sentence),
            lambda w: F.when(F.array_contains(terms(w), keyword), F.lit(BLANK)).otherwise(w),
        ),
        " ",
    )


def first_nonempty(*candidates: Column) -> Column:
    """First candidate that is neither null nor the empty string; the last one as it is."""
    *early, last = candidates
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in early], last)


def citations(answer: Column) -> Column:
    """File names cited inline as ``[file=NAME]``, in order, repeats kept."""
    return F.regexp_extract_all(answer, F.lit(r"\[file=([^\]]+)\]"), F.lit(1))
