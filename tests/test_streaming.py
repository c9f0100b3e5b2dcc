import datetime as dt

from pyspark.sql import functions as F

from gleaner.operators import chunking, usage
from gleaner.sources.store import read_store
from gleaner.sources.scratch import scratch_path
from gleaner.streaming import jobs
from tests.conftest import rows


def finish(spark, stream, label):
    path = scratch_path(spark, label)
    jobs.run_available(stream, path, scratch_path(spark, f"{label}-cp"))
    return spark.read.schema(stream.schema).parquet(path)


def test_windows_appear_once_the_watermark_has_passed(spark):
    s = jobs.streaming_session(spark, 2)
    data = [(f"2024-01-0{d} 12:00:00", p, 10.0 * d, d % 2 == 0) for d in (1, 2, 3) for p in ("A", "B")]
    events = s.createDataFrame(data, "ts string, provider string, latency_ms double, pass boolean").withColumn("ts", F.col("ts").cast("timestamp"))
    got = finish(spark, jobs.windowed_metrics(jobs.replay(s, events, "ev")), "windows")
    assert rows(got.select(F.dayofmonth("window_start"), "provider", "requests", "avg_latency", "accuracy"), "window_start", "provider") == [
        (1, "A", 1, 10.0, 0.0), (1, "B", 1, 10.0, 0.0), (2, "A", 1, 20.0, 100.0), (2, "B", 1, 20.0, 100.0)
    ]


def test_answers_wait_for_late_chunks(spark):
    s = jobs.streaming_session(spark, 2)
    schema = "session_id bigint, turn bigint, seq bigint, delta string, prompt bigint, cached bigint, completion bigint"
    data = [(1, 1, 3, None, 10, 0, 5), (1, 1, 0, "Hello", None, None, None), (1, 1, 2, "world!", None, None, None), (1, 1, 1, " ", None, None, None), (2, 1, 0, "open", None, None, None), (1, 1, 0, "Hello", None, None, None)]
    chunks = s.createDataFrame(data, schema).repartition(6)
    got = finish(spark, jobs.assemble_stream(jobs.replay(s, chunks, "chunks", files_per_trigger=1)), "answers")
    assert rows(got) == [(1, 1, "Hello world!", 10, 0, 5)]


TIMED = "session_id bigint, turn bigint, seq bigint, delta string, prompt bigint, cached bigint, completion bigint, ts timestamp"


def test_expired_answers_leave_no_state(spark):
    s = jobs.streaming_session(spark, 2)
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("timed", "timed-out", "timed-cp"))
    sizes = []

    def land(*data):
        made = s.createDataFrame([(*d[:-1], None if d[-1] is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=d[-1])) for d in data], TIMED)
        made.coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.assemble_expiring(s.readStream.schema(TIMED).parquet(folder), "1 minute", 10 * 60_000)
        query = (
            stream.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        return rows(spark.read.schema(stream.schema).parquet(out), "session_id", "turn", "complete")

    whole, part = (1, 1, "Hello", 9, 0, 2, True), (2, 1, "open end", None, None, None, False)
    assert land((1, 1, 0, "Hello", None, None, None, 0), (1, 1, 1, None, 9, 0, 2, 1), (2, 1, 1, " end", None, None, None, 0), (2, 1, 0, "open", None, None, None, 1), (3, 1, 0, "x", None, None, None, None)) == [whole]
    # a repeat of a closed answer is swallowed, and the clock runs on
    assert land((1, 1, 0, "Hello", None, None, None, 3), (9, 9, 0, "clock", None, None, None, 5)) == [whole]
    assert land((9, 9, 1, " runs", None, None, None, 40)) == [whole, part]
    # a repeat older than the watermark opens nothing
    before = sizes[-1]
    assert land((1, 1, 0, "Hello", None, None, None, 2)) == [whole, part]
    assert sizes[-1] <= before < sizes[0]


def test_compacted_memory_takes_later_versions(spark):
    schema = "session_id bigint, version bigint, position bigint, turn bigint, role string, text string"
    versions = spark.createDataFrame([(1, v, 1, v, "user", f"m{v}") for v in range(1, 6)] + [(2, 1, 1, 1, "user", None)], schema)
    path = scratch_path(spark, "compacted")
    jobs.compact_memory(versions, path)
    compacted = spark.read.schema(schema).parquet(path)
    assert rows(compacted, "session_id") == [(1, 5, 1, 5, "user", "m5"), (2, 1, 1, 1, "user", None)]
    spark.createDataFrame([(1, 6, 1, 6, "user", "m6")], schema).write.mode("append").parquet(path)
    assert rows(jobs.latest_memory(spark.read.schema(schema).parquet(path)).select("session_id", "text"), "session_id") == [(1, "m6"), (2, None)]


def test_memory_equals_the_batch_form(spark):
    s = jobs.streaming_session(spark, 2)
    data = [(k, t, "user", f"{k}-{t}") for k in (1, 2) for t in range(12 if k == 1 else 2)]
    messages = s.createDataFrame(data, "session_id bigint, turn bigint, role string, text string").repartitionByRange(4, "turn")
    versions = finish(spark, jobs.memory_stream(jobs.replay(s, messages, "messages", files_per_trigger=1)), "memory")
    batch = usage.last_messages(spark.createDataFrame(data, "session_id bigint, turn bigint, role string, text string"))
    columns = ["session_id", "position", "turn", "role", "text"]
    assert rows(jobs.latest_memory(versions).select(columns), *columns) == rows(batch.select(columns), *columns)


def test_ingest_takes_new_documents_once(spark):
    s = jobs.streaming_session(spark, 2)
    folder, store, checkpoint = (scratch_path(spark, n) for n in ("docs", "store", "cp"))
    schema = "doc_id bigint, file_name string, text string"

    def land(*data):
        s.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(folder)
        stream = s.readStream.schema(schema).parquet(folder)
        jobs.ingest_stream(stream, chunking.chunk_windows, store, checkpoint)
        return rows(read_store(spark, store).select("chunk_id", "text"), "chunk_id", "text")

    assert land((1, "a.md", "one")) == [("1#0", "one")]
    assert land((1, "a.md", "one"), (2, "b.md", "two")) == [("1#0", "one"), ("2#0", "two")]
    assert land((1, "a.md", "one changed")) == [("1#0", "one changed"), ("2#0", "two")]
