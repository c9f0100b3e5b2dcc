"""Document sources: Markdown folders, web pages, and what is still to convert."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import text as tx
from gleaner.operators.common import require_rows

def read_corpus(spark: SparkSession, path: str, pattern: str = "*.md") -> DataFrame:
    """``(doc_id, file_name, text)``: one row per matching file of a folder; no file at all is an error.

    The name is unique in a folder and serves as ``doc_id``.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text")
    )
    return require_rows(files, f"corpus {path}").select(F.col("file_name").alias("doc_id"), "file_name", "text")


def pending(raw: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``raw`` whose ``key`` has not been converted yet."""
    return raw.join(done.select(key), key, "left_anti")


class _PageText(HTMLParser):
    """Readable text of a page with headings, list items and paragraphs as Markdown."""

    SKIPPED = {"script", "style", "nav", "template", "noscript", "head"}
    BLOCKS = {"p", "div", "article", "section", "ul", "ol", "table", "tr", "br", "main", "header", "footer", "body"}
    HEADINGS = {f"h{level}": "#" * level + " " for level in range(1, 7)}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.skip: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.SKIPPED:
            self.skip.append(tag)
        elif tag == "body":
            self.skip.clear()
        if tag in self.HEADINGS:
            self.parts.append("\n\n" + self.HEADINGS[tag])
        elif tag == "li":
            self.parts.append("\n- ")
        elif tag in self.BLOCKS:
            self.parts.append("\n\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in self.skip:
            while self.skip.pop() != tag:
                pass
        if tag in self.HEADINGS or tag in self.BLOCKS:
            self.parts.append("\n\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.parts.append(re.sub(r"\s+", " ", data))

    def text(self) -> str:
        lines = [line.strip() for line in "".join(self.parts).split("\n")]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def page_text(html: str) -> str:
    """Markdown text of one HTML page."""
    parser = _PageText()
    parser.feed(html)
    parser.close()
    return parser.text()


def convert_pages(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``(key, text, error)``: pages as Markdown, read in Arrow batches.

    A page that cannot be read gives an error instead of ending the run.
    """
    key_type = pages.schema[key].dataType.simpleString()

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for html in batch["html"]:
                try:
                    texts.append(page_text(html))
                    errors.append(None)
                except Exception as failure:
                    texts.append(None)
                    errors.append(f"{type(failure).__name__}: {failure}")
            yield pd.DataFrame({key: batch[key], "text": texts, "error": pd.Series(errors, dtype=object)})

    return pages.select(key, "html").mapInPandas(convert, f"{key} {key_type}, text string, error string")


# A heading line, the run that opens a code fence, and a line that can close one.
HEADING_LINE = r"^(#{1,6})[ \t]+(\S.*)$"
FENCE_OPENS = r"^ {0,3}(`{3,}(?=[^`]*$)|~{3,})"
FENCE_CLOSES = r"^ {0,3}(`{3,}|~{3,})[ \t]*$"


def _headings(lines: Column) -> Column:
    """Headings outside code fences, in order: line number, level, text and the headings above it.

    A fold over the lines. A fence is open until a line with at least as many
    of its marks and nothing else; what stands in it is no heading.
    """

    def step(state: Column, line: Column) -> Column:
        fence = state["fence"]
        opening, closing = F.regexp_extract(line, FENCE_OPENS, 1), F.regexp_extract(line, FENCE_CLOSES, 1)
        closes = (F.char_length(closing) >= F.char_length(fence)) & (F.substring(closing, 1, 1) == F.substring(fence, 1, 1))
        marks = F.regexp_extract(line, HEADING_LINE, 1)
        level = F.char_length(marks)
        is_heading = (fence == "") & (level > 0)
        title = F.regexp_extract(line, HEADING_LINE, 2)
        path = F.concat(F.filter(state["path"], lambda p: p["level"] < level), F.array(F.struct(level.alias("level"), title.alias("heading"))))
        entry = F.struct(state["line"].alias("line"), level.alias("level"), title.alias("heading"), F.transform(path, lambda p: p["heading"]).alias("path"))
        return F.struct(
            (state["line"] + 1).alias("line"),
            F.when(fence == "", opening).when(closes, F.lit("")).otherwise(fence).alias("fence"),
            F.when(is_heading, path).otherwise(state["path"]).alias("path"),
            F.when(is_heading, F.concat(state["out"], F.array(entry))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(
        F.lit(0).alias("line"), F.lit("").alias("fence"), F.array().cast("array<struct<level: int, heading: string>>").alias("path"),
        F.array().cast("array<struct<line: int, level: int, heading: string, path: array<string>>>").alias("out"),
    )
    return F.aggregate(lines, start, step, lambda state: state["out"])


def markdown_sections(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, section_no, level, heading, path, text)``: the text under each heading, blank sections left out.

    Text before the first heading has a null heading and level 0. ``path``
    lists the headings that a section stands under, its own last. Lines in a
    code fence are text, whatever they look like.
    """
    lines = F.split("text", r"\r?\n", -1)
    found = documents.select(key, lines.alias("lines")).select(key, "lines", _headings(F.col("lines")).alias("headings"))
    before = F.struct(F.lit(-1).alias("line"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("heading"), F.array().cast("array<string>").alias("path"))
    parts = found.select(key, "lines", F.concat(F.array(before), "headings").alias("parts"))
    cut = parts.select(key, "lines", "parts", F.posexplode("parts").alias("section_no", "part"))
    following = F.coalesce(F.get("parts", F.col("section_no") + 1)["line"], F.size("lines"))
    body = F.array_join(F.slice("lines", F.col("part.line") + 2, F.greatest(following - F.col("part.line") - 1, F.lit(0))), "\n")
    return cut.select(
        key, F.col("section_no").cast("bigint").alias("section_no"), "part.level", "part.heading", "part.path", tx.strip(body).alias("text")
    ).filter((F.col("text") != "") | F.col("heading").isNotNull())
