"""Repair of conversations whose rows were lost, blanked, cut, repeated or given to the wrong speaker.

The cheapest edits are a shortest path over a lattice: a node says how many
rows are done and which speaker came last, an arc keeps, rewrites, deletes or
inserts a row at a whole-number cost. An auction finds it: a path grows from
its origin by the arc that the prices favour, and where no arc is tight the
last node's price rises and the path draws back. With the prices converged,
every cheapest repair runs along tight arcs, and the least in letters is traced
on them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm.memo import Memo, per_worker

# The costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# A row is told by one letter: its speaker (system, user, assistant, other) and its first fault (none, blank, duplicate, truncated).
SPEAKERS, FAULTS = "suax", ".bdt"
CODE_BASE = ord("A")
# Speaker that came last: nobody yet, system, user, assistant; a repair ends at the first or the last of these.
NOBODY, SYSTEM, USER, ASSISTANT = range(4)
NEXT_SPEAKER = {NOBODY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}

# Rows between the lattice layers at which the auction starts anew, so that its paths stay short in long conversations.
SPAN = 8
# Turns per block of codes: no group that is gathered holds more turns.
BLOCK_TURNS = 4096
# Answers for short conversations are remembered by their codes.
REMEMBERED, SHORT = 50_000, 64


def row_code(speaker: str, fault: str) -> str:
    return chr(CODE_BASE + 4 * SPEAKERS.index(speaker) + FAULTS.index(fault))


def _after_keep(speaker: str, last: int) -> int | None:
    """Who came last after keeping a row of ``speaker``, None where that is out of order."""
    if speaker == "s":
        return SYSTEM if last == NOBODY else None
    if speaker == "u":
        return USER if last != USER else None
    return ASSISTANT if speaker == "a" and last == USER else None


class Auction:
    """Prices over the lattice of one conversation."""

    def __init__(self, codes: str):
        self.rows = [divmod(ord(c) - CODE_BASE, 4) for c in codes]
        self.end = 4 * (len(codes) + 1)
        self.price = [0] * (self.end + 1)
        self.settled = [False] * self.end + [True]
        self._arcs: dict[int, list[tuple[str, int, int]]] = {}

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """Label, cost and head of the arcs out of ``node``."""
        known = self._arcs.get(node)
        if known is not None:
            return known
        at, last = divmod(node, 4)
        turn = NEXT_SPEAKER[last]
        out = [("I", INSERT, 4 * at + turn)]
        if at < len(self.rows):
            speaker, fault = self.rows[at]
            speaker, fault = SPEAKERS[speaker], FAULTS[fault]
            out.append(("D", DELETE, node + 4))
            if fault in ".t":
                more = TRUNCATED if fault == "t" else 0
                kept = _after_keep(speaker, last)
                if kept is not None:
                    out.append(("K", more, 4 * (at + 1) + kept))
                if kept != turn:
                    out.append(("R", REROLE + more, 4 * (at + 1) + turn))
        elif last in (NOBODY, ASSISTANT):
            out.append(("", 0, self.end))
        self._arcs[node] = out
        return out

    def settle(self, origin: int) -> None:
        """Run the auction from ``origin`` until its price is its distance from the end.

        Prices never exceed distances, so a path of tight arcs that reaches a
        settled node is a shortest one and settles all nodes on it.
        """
        price, settled = self.price, self.settled
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            best, head = min((cost + price[to], to) for _, cost, to in self.arcs(node))
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
        for node in path:
            settled[node] = True

    def solve(self) -> tuple[int, str]:
        """Least cost, and the least in letters of the cheapest repairs."""
        for at in range(len(self.rows) // SPAN * SPAN, 0, -SPAN):
            for last in range(4):
                self.settle(4 * at + last)
        self.settle(0)
        letters, front = [], {0}
        while True:
            heads: dict[str, set[int]] = {}
            for node in front:
                for letter, cost, to in self.arcs(node):
                    # a price that only bounds the distance may rise when its node is settled
                    if self.price[node] == cost + self.price[to]:
                        self.settle(to)
                        if self.price[node] == cost + self.price[to]:
                            heads.setdefault(letter, set()).add(to)
            letter = min(heads)
            if not letter:
                return self.price[0], "".join(letters)
            letters.append(letter)
            front = heads[letter]


def cheapest_repair(codes: str) -> tuple[int, str]:
    """Cost and edits of a conversation told by ``codes``, see :func:`row_code`."""
    return Auction(codes).solve()


def fault_counts(codes: str) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours in an illegal order."""
    rows = [divmod(ord(c) - CODE_BASE, 4) for c in codes]
    faults = [FAULTS[f] for _, f in rows]
    speakers = "".join(SPEAKERS[s] for s, _ in rows)
    illegal = sum(speakers[i : i + 2] not in LEGAL for i in range(len(speakers) - 1))
    return faults.count("b"), faults.count("d"), faults.count("t"), illegal


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` rows after the damage that a checksum of their key picks, with ``copies`` 1 or 2.

    A null in any column of the key or the content is one space; a dropped row
    is left out.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.filter(kind != 0).select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _speaker(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def code_strings(rows: DataFrame) -> DataFrame:
    """``(conv_id, codes, gaps)`` of ``rows(conv_id, turn, role, text, copies)``.

    Codes go by turn, nulls first; rows of one turn by role, then by a digest
    of their text. Texts stay behind: equal rows are counted, and only digests
    and letters are exchanged, in blocks of turns.
    """
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")).rlike(r"[.!?]\z")
    light = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copies",
        F.when(blank, 1).when(cut, 3).otherwise(0).alias("fault"),
    )
    equal = light.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("copies").alias("copies"), F.first("fault").alias("fault"))
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    letter = lambda fault: F.char(CODE_BASE + 4 * _speaker(F.col("role")) + fault)
    again = F.when(F.col("fault") == 1, 1).otherwise(2)
    marked = equal.withColumn("new", F.row_number().over(seen) == 1).select(
        "conv_id", F.floor(F.col("turn") / BLOCK_TURNS).alias("block"), "turn", "role", "digest",
        F.concat(
            letter(F.when(F.col("new"), F.col("fault")).otherwise(again)),
            F.repeat(letter(again), (F.col("copies") - 1).cast("int")),
        ).alias("codes"),
    )
    ordered = lambda *names: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*names, "codes"))), lambda x: x["codes"]), "")
    # a null turn comes first: array_sort puts null fields before others
    blocks = marked.groupBy("conv_id", "block").agg(
        ordered("turn", "role", "digest").alias("codes"), F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"),
    )
    return blocks.groupBy("conv_id").agg(
        ordered("block").alias("codes"),
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("bigint").alias("gaps"),
    )


ANSWER = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def plan_repairs(coded: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of ``coded(conv_id, codes, gaps)``."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_worker("repairs", lambda: Memo(cheapest_repair, REMEMBERED, SHORT))
        for batch in batches:
            codes = batch.column(1).to_pylist()
            faults = [fault_counts(c) for c in codes]
            repairs = [known[c] for c in codes]
            numbers = [pa.array(column, pa.int64()) for column in (zip(*faults) if faults else [[]] * 4)]
            cost, audit = pa.array([r[0] for r in repairs], pa.int64()), pa.array([r[1] for r in repairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *numbers, cost, audit], ["conv_id", *COLUMNS])

    schema = T.StructType([coded.schema["conv_id"], *T.StructType.fromDDL(ANSWER).fields])
    return coded.select("conv_id", "codes", "gaps").mapInArrow(plan, schema)


class Rewriter:
    """Follows the edits of one conversation along its rows and digests what comes out."""

    def __init__(self, audit: str, emit=None):
        self.audit, self.at, self.last = audit, 0, NOBODY
        self.hash, self.first = hashlib.sha256(), True
        self.emit = emit

    def _put(self, role: str, text: str, last: int) -> None:
        self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first, self.last = False, last
        if self.emit:
            self.emit(role, text)

    def _turn(self, text: str) -> None:
        last = NEXT_SPEAKER[self.last]
        self._put("user" if last == USER else "assistant", text, last)

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._turn("")

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text, _after_keep(role[:1], self.last))
        elif edit == "R":
            self._turn(text)

    def close(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and a digest of the repaired text.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Damage as in :func:`damage`; rows by turn, null turns
    first, rows of one turn by role and a digest of their text. A null conv_id
    is a conversation too. One without rows after the damage has zeros, an
    empty audit and the digest of nothing. Other columns are ignored.

    Planning sees one letter per row. Texts are exchanged once, sorted within
    their conversation, and run past the edits one by one: what is held of a
    conversation is its edits and the state of its digest, never its rows. A
    digest over all rows of a conversation is one chain, so one task runs it.
    """
    rows = damage(conversations)
    coded = code_strings(rows)
    every = conversations.select(F.struct("conv_id").alias("key")).distinct()
    # compared as structs, so that a null id meets itself
    found = every.join(coded.select(F.struct("conv_id").alias("key"), "codes", "gaps"), "key", "left").select(
        "key.conv_id", F.coalesce("codes", F.lit("")).alias("codes"), F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps")
    )
    plans = plan_repairs(found)
    heads = plans.select("conv_id", F.struct(*COLUMNS).alias("head"))
    lines = rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")
    stream = (
        heads.unionByName(lines, allowMissingColumns=True)
        .withColumn("digest", F.sha2("text", 256))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc_nulls_last("head"), F.asc_nulls_first("turn"), "role", "digest")
        .select("conv_id", "head", "role", "text")
    )
    schema = T.StructType([conversations.schema["conv_id"], *T.StructType.fromDDL(ANSWER).fields, T.StructField("repaired_sha256", T.StringType())])
    return stream.mapInArrow(_digests, schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired digests of sorted rows; every conversation begins with its head."""
    names = ["conv_id", *COLUMNS, "repaired_sha256"]
    current, kind = None, None

    def flush(done):
        columns = [pa.array([d[0] for d in done], kind)]
        for k, name in enumerate(COLUMNS):
            columns.append(pa.array([d[1][name] for d in done], pa.string() if name == "audit" else pa.int64()))
        return pa.RecordBatch.from_arrays([*columns, pa.array([d[2].close() for d in done], pa.string())], names)

    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for conv_id, head, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if head is not None:
                if current is not None:
                    done.append(current)
                current = (conv_id, head, Rewriter(head["audit"]))
            else:
                current[2].row(role, text)
        if done:
            yield flush(done)
    if current is not None:
        yield flush([current])
