"""Running metrics, stateful chat assembly, and incremental ingest.

Streams need a session with the RocksDB state store; ``streaming_session``
gives one that shares the context and leaves the caller's settings alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gleaner.functions import results as rs
from gleaner.operators.usage import MEMORY
from gleaner.sources import store
from gleaner.sources.scratch import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """Sibling session for streams. ``partitions`` is the fixed number of state partitions."""
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    return sibling


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append it to Parquet files under ``path``, and stop."""
    (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def windowed_metrics(events: DataFrame, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Requests, mean latency and accuracy per window and provider of a result stream.

    ``events(ts, provider, latency_ms, pass)``. A window is final, and appears,
    once the watermark has passed its end.
    """
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", width).alias("window"), "provider")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.round(F.avg("latency_ms"), 6).alias("avg_latency"),
            F.round(rs.pass_rate(F.col("pass")), 6).alias("accuracy"),
        )
        .select(F.col("window.start").alias("window_start"), "provider", "requests", "avg_latency", "accuracy")
    )


ANSWER_SCHEMA = "session_id bigint, turn bigint, answer string, prompt bigint, cached bigint, completion bigint"
_PIECE_SCHEMA = "seq bigint, delta string, prompt bigint, cached bigint, completion bigint"


class AnswerAssembler(StatefulProcessor):
    """Collects the chunks of one answer, in any order, until the usage chunk and all before it are there.

    Chunks are appended to the state; it is read back only when enough of them
    have come to close the answer. A chunk that arrives twice counts once.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._pieces = handle.getListState("pieces", _PIECE_SCHEMA)
        self._progress = handle.getValueState("progress", "arrived bigint, closing bigint")

    def _add(self, frames) -> dict | None:
        """Take in chunks; the pieces of the whole answer by number once it can be closed."""
        whole = lambda value: None if pd.isna(value) else int(value)
        new = [
            (int(seq), None if pd.isna(delta) else delta, whole(prompt), whole(cached), whole(completion))
            for frame in frames
            for seq, delta, prompt, cached, completion in frame[["seq", "delta", "prompt", "cached", "completion"]].itertuples(index=False, name=None)
        ]
        arrived, closing = self._progress.get() if self._progress.exists() else (0, None)
        arrived += len(new)
        closing = max([p[0] for p in new if p[2] is not None] + ([] if closing is None else [closing]), default=None)
        self._pieces.appendList(new)
        self._progress.update((arrived, closing))
        if closing is None or arrived <= closing:
            return None
        pieces = {p[0]: tuple(p) for p in self._pieces.get() if p[0] <= closing}
        return pieces if len(pieces) > closing else None

    def _drop(self) -> None:
        self._pieces.clear()
        self._progress.clear()

    def _row(self, key, pieces: dict, **more) -> pd.DataFrame:
        text = "".join(pieces[seq][1] or "" for seq in sorted(pieces))
        prompt, cached, completion = pieces[max(pieces)][2:]
        usage = pd.DataFrame({"prompt": [prompt], "cached": [cached], "completion": [completion]}, dtype="Int64")
        return pd.concat([pd.DataFrame({"session_id": [key[0]], "turn": [key[1]], "answer": [text]}), usage], axis=1).assign(**more)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pieces = self._add(rows)
        if pieces is not None:
            self._drop()
            yield self._row(key, pieces)

    def close(self) -> None:
        pass


class ExpiringAssembler(AnswerAssembler):
    """Like the above, but nothing of an answer stays for longer than ``keep_ms`` after its last chunk.

    A closed answer leaves a mark that swallows repeats. When the watermark
    passes the deadline the mark goes, or the answer is given as far as it came.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self._handle = handle
        self._deadline = handle.getValueState("deadline", "at bigint, closed boolean")

    def _defer(self, frames: list[pd.DataFrame], closed: bool) -> None:
        """One timer per answer, at the last event time and ``keep_ms``."""
        at = max(int(frame["ts"].max().timestamp() * 1000) for frame in frames) + self.keep_ms
        if self._deadline.exists():
            earlier = self._deadline.get()[0]
            at = max(at, earlier)
            self._handle.deleteTimer(earlier)
        self._deadline.update((at, closed))
        self._handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [frame for frame in rows if len(frame)]
        if self._deadline.exists() and self._deadline.get()[1]:
            return
        pieces = self._add(frames)
        self._defer(frames, pieces is not None)
        if pieces is not None:
            self._drop()
            yield self._row(key, pieces, complete=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        pieces = {p[0]: tuple(p) for p in self._pieces.get()}
        self._drop()
        self._deadline.clear()
        if pieces:
            yield self._row(key, pieces, complete=False)


def assemble_stream(chunks: DataFrame) -> DataFrame:
    """Answers from a stream of ``chunks(session_id, turn, seq, delta, prompt, cached, completion)``.

    ``seq`` counts from 0 and the last chunk carries the usage. State is kept
    per answer, so a busy session spreads over its answers. An answer whose end
    never comes stays in the state; :func:`assemble_expiring` lets it go.
    """
    return chunks.groupBy("session_id", "turn").transformWithStateInPandas(
        statefulProcessor=AnswerAssembler(), outputStructType=ANSWER_SCHEMA, outputMode="Append", timeMode="None"
    )


def assemble_expiring(chunks: DataFrame, delay: str = "10 minutes", keep_ms: int = 3_600_000) -> DataFrame:
    """Answers from ``chunks`` with an event time ``ts`` besides, and a column ``complete``.

    Chunks may come ``delay`` late. ``keep_ms`` after the last chunk of an
    answer, by the watermark, its state goes: an unfinished answer is then given
    with the chunks that came, in order, and with ``complete`` false. A repeat
    that comes after the close changes nothing, and neither does one that
    is older than the watermark; one that comes after the mark of the close
    is gone opens the answer anew and expires in turn. A chunk without ``ts``
    has no place in event time and is left out.
    """
    timed = chunks.filter(F.col("ts").isNotNull()).withWatermark("ts", delay)
    return timed.groupBy("session_id", "turn").transformWithStateInPandas(
        statefulProcessor=ExpiringAssembler(keep_ms), outputStructType=f"{ANSWER_SCHEMA}, complete boolean", outputMode="Append", timeMode="EventTime"
    )


MEMORY_SCHEMA = "session_id bigint, version bigint, position bigint, turn bigint, role string, text string"


class LastMessages(StatefulProcessor):
    """The last n messages of a session; each change gives the whole memory under a higher version."""

    def __init__(self, n: int):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._memory = handle.getListState("memory", "turn bigint, role string, text string")
        self._seen = handle.getValueState("seen", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        memory = [(int(t), r, x) for t, r, x in self._memory.get()]
        seen = self._seen.get()[0] if self._seen.exists() else 0
        for frame in rows:
            seen += len(frame)
            memory += [(int(t), r, x) for t, r, x in frame[["turn", "role", "text"]].itertuples(index=False, name=None)]
            memory = sorted(memory, key=lambda m: m[0])[-self.n :]
        self._memory.put(memory)
        self._seen.update((seen,))
        newest = memory[::-1]
        yield pd.DataFrame({
            "session_id": key[0], "version": seen, "position": range(1, len(newest) + 1),
            "turn": [m[0] for m in newest], "role": [m[1] for m in newest], "text": [m[2] for m in newest],
        })

    def close(self) -> None:
        pass


def memory_stream(messages: DataFrame, n: int = MEMORY) -> DataFrame:
    """Memory versions from a stream of ``messages(session_id, turn, role, text)``."""
    return messages.groupBy("session_id").transformWithStateInPandas(
        statefulProcessor=LastMessages(n), outputStructType=MEMORY_SCHEMA, outputMode="Append", timeMode="None"
    )


def latest_memory(versions: DataFrame) -> DataFrame:
    """The newest version per session of a table written by :func:`memory_stream`."""
    return _newest(versions).drop("version")


def _newest(versions: DataFrame) -> DataFrame:
    newest = versions.groupBy("session_id").agg(F.max("version").alias("version"))
    return versions.join(newest, ["session_id", "version"])


def compact_memory(versions: DataFrame, path: str) -> None:
    """Write the newest version of each session to a new folder, where a later stream may append.

    Versions keep their numbers, so what is appended later still counts as newer.
    The old folder may go when the new one is written; a run that stops half way leaves the old one whole.
    """
    _newest(versions).write.mode("errorifexists").parquet(path)


def ingest_stream(documents: DataFrame, chunker: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, run: str | None = None) -> None:
    """Chunk newly arrived and changed documents into the store at ``path``, then stop.

    Each micro-batch is a version of the store and overwrites itself when it
    is repeated, so a failed run leaves no duplicates. ``run`` names the runs
    that share a checkpoint, by default after the checkpoint's path: with a new
    checkpoint an existing store stays, and what it holds is not stored again.
    """
    named = run or hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def ingest(batch: DataFrame, batch_id: int) -> None:
        store.ingest_documents(batch, chunker, path, f"{named}-{batch_id}")

    (
        documents.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start().awaitTermination()
    )


def replay(spark: SparkSession, rows: DataFrame, label: str, files_per_trigger: int = 4) -> DataFrame:
    """Rows of a table as a file stream of ``spark``, a few files per micro-batch."""
    path = scratch_path(spark, label)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
