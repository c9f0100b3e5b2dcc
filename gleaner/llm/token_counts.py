"""Token counts by byte-pair merging with a heap and a linked list.

The symbols of a piece form a linked list, and a heap holds the adjacent pairs
by rank. The lowest is popped and joined again and again; the count is the
number of bytes less the number of joins. No identifier is emitted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.memo import Memo, per_worker
from gleaner.llm.pretokens import Pieces, special_strings

MEMO_WORDS = 400_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)})
    return letters


class PairMerger:
    """Counts the tokens of one pretoken."""

    def __init__(self, model: str):
        letters = byte_letters()
        spelled: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.joined: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(json.loads(model)["model"]["merges"]):
            left, right = (bytes(letters[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            made = spelled.setdefault(left + right, len(spelled))
            self.joined.setdefault((spelled[left], spelled[right]), (rank, made))

    def count(self, piece: str) -> int:
        symbols: list[int] = list(piece.encode())
        size = len(symbols)
        joined = self.joined
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        heap = [(joined[pair][0], at) for at, pair in enumerate(zip(symbols, symbols[1:])) if pair in joined]
        heapify(heap)
        merges = 0
        while heap:
            rank, at = heappop(heap)
            right = after[at]
            if right >= size:
                continue
            found = joined.get((symbols[at], symbols[right]))
            if found is None or found[0] != rank:
                continue  # one side was joined with another neighbour meanwhile
            symbols[at], symbols[right] = found[1], -1
            merges += 1
            following = after[at] = after[right]
            if following < size:
                before[following] = at
                new = joined.get((symbols[at], symbols[following]))
                if new:
                    heappush(heap, (new[0], at))
            if before[at] >= 0:
                new = joined.get((symbols[before[at]], symbols[at]))
                if new:
                    heappush(heap, (new[0], before[at]))
        return size - merges


class TokenCounter:
    """Counts the tokens of whole texts; words met before are looked up."""

    def __init__(self, model: str):
        self.pieces = Pieces(special_strings(model))
        self.merger = PairMerger(model)
        self.words = Memo(self._word, MEMO_WORDS)

    def _word(self, key: str) -> int:
        return sum(map(self.merger.count, self.pieces.tokens_of(key)))

    def count(self, text: str) -> int:
        total = 0
        for number, segment in enumerate(self.pieces.segments(text)):
            total += 1 if number % 2 else sum(map(self.words.__getitem__, self.pieces.cut(segment))) if segment else 0
        return total


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) per row of ``docs``.

    Equal to the byte-level vocabulary's own library: nothing is added or cut,
    and a special string inside a text is one token. A null text is an empty
    one of 0 tokens; repeated rows, null ids and other columns need no care;
    an empty table gives an empty one. The file is read by the driver only.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        model = file.read()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(("token counter", hash(model)), lambda: TokenCounter(model))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([counter.count(t) if t else 0 for t in texts], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes")
    ).mapInArrow(count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
