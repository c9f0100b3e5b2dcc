"""The test tables in the shape of the library's inputs.

The fragments of ``views.py`` define the same inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import results as rs
from gleaner.functions import text as tx
from gleaner.operators.common import segmented_lead, segmented_running_sum


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


class Tables:
    """Test tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` on at least as many partitions as there are cores.

        A file of one row group is one task, however long its texts take; a
        table with enough files is left as it is.
        """
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df

    def corpus(self) -> DataFrame:
        documents = self.read("documents").select(
            "doc_id", F.concat(F.lit("doc-"), F.col("doc_id"), F.lit(".md")).alias("file_name"), "text"
        )
        return self.spread(documents, "doc_id")

    def documents_as_chunks(self) -> DataFrame:
        return self.corpus().select(F.col("doc_id").alias("chunk_id"), "doc_id", "file_name", "text")

    def questions(self) -> DataFrame:
        return self.read("benchmark").select(F.col("item_id").alias("query_id"), "text")

    def vectors(self) -> DataFrame:
        return self.read("embeddings").select("vec_id", "embedding")

    def query_vectors(self) -> DataFrame:
        questions = self.read("benchmark").select(F.col("item_id").alias("vec_id"))
        return self.vectors().join(questions, "vec_id").select(F.col("vec_id").alias("query_id"), "embedding")

    def results(self) -> DataFrame:
        """Evaluation results from ``events``, with ``ts``, ``cost`` and the raw provider id besides."""
        events = self.read("events")
        kind = F.col("event_type")
        provider_id = (
            F.when(kind.isin("click", "view"), F.lit("rag/naive"))
            .when(kind.isin("purchase", "signup"), F.lit("rag/bm25"))
            .otherwise(F.lit("other"))
        )
        k = F.regexp_extract("props", r"\d+", 0).cast("int")
        query = F.concat(F.lit("event "), F.col("event_id"), F.lit(" by user "), F.col("user_id"), F.lit(" of kind "), kind, F.lit(" with properties "), F.col("props"))
        return (
            events.withColumn("k", k)
            .withColumn("pass", F.col("k") % 10 != 0)
            .select(
                provider_id.alias("provider_id"),
                rs.provider_name(provider_id).alias("provider"),
                F.round(F.col("value") * 20, 6).alias("latency_ms"),
                "pass",
                F.when(F.col("pass"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("score"),
                query.alias("raw_query"),
                tx.preview(query).alias("query"),
                F.col("event_id").alias("test_idx"),
                "ts", "user_id",
                F.round(F.col("k") * 0.0001, 6).alias("cost"),
            )
        )

    def counters(self) -> DataFrame:
        return self.results().groupBy("provider").agg(
            F.count(F.when(F.col("pass"), F.lit(1))).alias("test_pass_count"),
            F.count(F.when(~F.col("pass"), F.lit(1))).alias("test_fail_count"),
            F.sum("latency_ms").alias("total_latency_ms"),
            F.count(F.lit(1)).alias("num_requests"),
        )

    def messages(self) -> DataFrame:
        return self.read("conversations").select(F.col("conv_id").alias("session_id"), "turn", "role", "text")

    def usage(self) -> DataFrame:
        """Usage of assistant turns: all earlier words are prompt, all but the previous turn's are cached."""
        counted = self.messages().withColumn("words", F.size(tx.words(F.col("text"))).cast("bigint"))
        summed = segmented_running_sum(counted, ["session_id"], "turn", "words", "prompt")
        previous = counted.select("session_id", (F.col("turn") + 1).alias("turn"), F.col("words").alias("previous"))
        return (
            summed.filter(F.col("role") == "assistant")
            .join(previous, ["session_id", "turn"], "left")
            .select(
                "session_id", "turn", "prompt",
                (F.col("prompt") - F.coalesce("previous", F.lit(0))).alias("cached"),
                F.col("words").alias("completion"),
            )
        )

    def stream_chunks(self) -> DataFrame:
        """Words of assistant turns as deltas, with the usage on the last one."""
        pieces = self.messages().filter(F.col("role") == "assistant").select(
            "session_id", "turn", tx.spaced_words(F.col("text")).alias("pieces")
        )
        n = F.col("n")
        last = F.col("seq") == n - 1
        counted = pieces.select("session_id", "turn", F.size("pieces").cast("bigint").alias("n"), "pieces")
        return counted.select("session_id", "turn", "n", F.posexplode("pieces").alias("seq", "delta")).select(
            "session_id", "turn", F.col("seq").cast("bigint").alias("seq"), "delta",
            F.when(last, n * 10).alias("prompt"), F.when(last, n * 5).alias("cached"), F.when(last, n).alias("completion"),
        )

    def answer_latency(self) -> DataFrame:
        """Each event up to the next event of the same user, by hourly segments."""
        events = self.read("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
        return segmented_lead(events, ["user_id"], F.date_trunc("HOUR", "ts"), "ts", "event_id", "next_ts")

    def agent_steps(self) -> DataFrame:
        ends = (F.col("session_id") % 3 == 0) & (F.col("turn") % 2 == 1)
        return self.messages().select(
            "session_id", F.col("turn").alias("step_no"), F.col("role").alias("tool_calls"),
            F.col("text").alias("observations"),
            F.when(F.col("role") != "system", F.when(ends, F.concat("text", F.lit("\nRESULT: success\n"))).otherwise(F.col("text"))).alias("output"),
            "role", ((F.col("session_id") + F.col("turn")) % 2).alias("exit_code"),
        )

    def events(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("location"),
            F.col("o_totalprice").alias("popularity"), F.col("o_orderdate").alias("day"),
        )

    def sessions(self) -> DataFrame:
        return self.spread(self.read("lineitem").select(*LINE_COLUMNS), "l_orderkey").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("session_id"),
            F.col("l_orderkey").alias("event_id"), F.col("l_shipdate").alias("starts"),
            (F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber"))).alias("ends"),
        )

    def flights(self) -> DataFrame:
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("offer_id"), "l_linenumber", F.col("l_suppkey").alias("airline"),
            F.col("l_extendedprice").alias("price"),
            F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R").alias("is_best"),
        )

    def offers(self) -> DataFrame:
        price = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("NZ$"), F.format_string("%.2f", "o_totalprice")))
        return self.read("orders").select(F.col("o_orderkey").alias("offer_id"), price.alias("current_price"))

    def evaluation_files(self, per_file: int = 1000) -> DataFrame:
        """Nested result objects of at most ``per_file`` results each."""
        flat = self.results().withColumn("run", F.floor(F.col("test_idx") / per_file))
        metrics = (
            flat.groupBy("run", "provider_id")
            .agg(
                F.struct(
                    F.count(F.when(F.col("pass"), 1)).alias("testPassCount"), F.count(F.when(~F.col("pass"), 1)).alias("testFailCount"),
                    F.sum("latency_ms").alias("totalLatencyMs"), F.struct(F.count(F.lit(1)).alias("numRequests")).alias("tokenUsage"),
                ).alias("metrics")
            )
            .groupBy("run")
            .agg(F.collect_list(F.struct(F.col("provider_id").alias("provider"), "metrics")).alias("prompts"))
        )
        rows = flat.groupBy("run").agg(
            F.collect_list(
                F.struct(
                    F.struct(F.col("provider_id").alias("id")).alias("provider"), F.col("latency_ms").alias("latencyMs"),
                    F.struct("pass").alias("gradingResult"), "score", F.struct(F.col("raw_query").alias("raw")).alias("prompt"),
                    F.col("test_idx").alias("testIdx"),
                )
            ).alias("results")
        )
        return rows.join(metrics, "run").select(F.struct("prompts", "results").alias("results"))

