import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from gleaner.operators import answers, enrich
from gleaner.operators import keyword_index as ki
from gleaner.operators import retrieval as r
from gleaner.operators.common import broadcast_batches
from gleaner.plans.retrieval import whole_ranked_lists
from gleaner.plans.standins import Tables
from tests.conftest import rows

CHUNKS = "chunk_id string, doc_id bigint, file_name string, chunk_no bigint, text string"


def random_chunks(spark, n=60, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(25)]
    texts = [" ".join(rng.choices(vocabulary, weights=range(1, 26), k=rng.randrange(0, 30))) for _ in range(n)]
    data = [(f"c{i:02d}", i // 3, f"f{i // 3}.md", i % 3, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, CHUNKS), data


def bm25_by_hand(data, queries, k):
    split = {c: re.findall(r"\w{2,}", text.lower()) for c, _, _, _, text in data}
    mean = sum(map(len, split.values())) / len(split)
    hits = []
    for q, text in queries:
        scores = {}
        for term in re.findall(r"\w{2,}", text.lower()):
            df = sum(term in words for words in split.values())
            idf = math.log(1 + (len(split) - df + 0.5) / (df + 0.5))
            for c, words in split.items():
                tf = words.count(term)
                if tf:
                    scores[c] = scores.get(c, 0) + idf * tf / (tf + 1.5 * (0.25 + 0.75 * len(words) / mean))
        best = sorted(((-round(s, 6), c) for c, s in scores.items()))[:k]
        hits += [(q, rank, c, -s) for rank, (s, c) in enumerate(best, 1)]
    return hits


QUERIES = [(0, "t3 t24 t24"), (1, "t1 nothing"), (2, "unknown words"), (3, ""), (4, "T7, t8; t9")]


def test_bm25_by_brute_force(spark):
    chunks, data = random_chunks(spark)
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string")
    got = rows(r.bm25_topk(ki.build_index(chunks), queries), "query_id", "rank")
    wanted = bm25_by_hand(data, QUERIES, 5)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert np.allclose([g[3] for g in got], [w[3] for w in wanted], atol=2e-6)


def test_bm25_in_several_batches_loses_nothing(spark, monkeypatch):
    chunks, _ = random_chunks(spark)
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string")
    index = ki.build_index(chunks)
    whole = rows(r.bm25_topk(index, queries), "query_id", "rank")
    monkeypatch.setattr(r, "broadcast_batches", lambda df, key: broadcast_batches(df, key, max_rows=2))
    assert rows(r.bm25_topk(index, queries), "query_id", "rank") == whole


def test_broadcast_batches_cover_all_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    parts = broadcast_batches(df, "k", max_rows=30)
    assert len(parts) > 1
    assert sorted(row["k"] for p, small in parts for row in p.collect()) == list(range(100))
    assert all(small == (p.count() <= 30) for p, small in parts)
    one_key = broadcast_batches(df.withColumn("k", F.lit(1)), "k", max_rows=30)
    assert [(p.count(), small) for p, small in one_key] == [(100, False)]


def test_index_tables_round_trip_without_extra_exchange(spark, tmp_path):
    chunks, _ = random_chunks(spark)
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string")
    index = ki.build_index(chunks)
    ki.save_index(ki.build_index(chunks, partitions=4), "kept", str(tmp_path), buckets=4)
    assert len(list((tmp_path / "postings").glob("*.parquet"))) <= 4
    stored = ki.load_index(spark, "kept")
    hits = r.bm25_topk(stored, queries)
    assert rows(hits, "query_id", "rank") == rows(r.bm25_topk(index, queries), "query_id", "rank")
    plan = stored.postings.groupBy("chunk_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for table in ("postings", "chunks", "terms"):
        spark.sql(f"DROP TABLE kept_{table}")


def vectors(spark, n, dim, seed, name):
    data = np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)
    return data, spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], f"{name} bigint, embedding array<float>")


def test_dense_by_brute_force_in_both_forms(spark):
    v, vdf = vectors(spark, 300, 8, 1, "vec_id")
    q, qdf = vectors(spark, 23, 8, 2, "query_id")
    scores = np.round(q.astype(float) @ v.astype(float).T, 6)
    wanted = [
        (i, rank, j) for i, line in enumerate(scores) for rank, j in enumerate(sorted(range(300), key=lambda j: (-line[j], j))[:5], 1)
    ]
    few = r.dense_topk(vdf, qdf)
    many = r.dense_topk(vdf, qdf, max_broadcast_queries=4, block_rows=64)
    assert [g[:3] for g in rows(few, "query_id", "rank")] == wanted
    assert rows(many, "query_id", "rank") == rows(few, "query_id", "rank")


def test_dense_ties_go_to_the_smaller_id(spark):
    vdf = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5000)], "vec_id bigint, embedding array<float>").repartition(4)
    qdf = spark.createDataFrame([(7, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    assert [g[2] for g in rows(r.dense_topk(vdf, qdf), "rank")] == [0, 1, 2, 3, 4]


def test_dense_without_queries_or_vectors(spark):
    _, vdf = vectors(spark, 3, 4, 1, "vec_id")
    qdf = spark.createDataFrame([], "query_id bigint, embedding array<float>")
    assert r.dense_topk(vdf, qdf).count() == 0
    _, some = vectors(spark, 2, 4, 1, "query_id")
    assert r.dense_topk(vdf.limit(0), some).count() == 0
    assert r.dense_topk(vdf, some).count() == 6


def test_lsh_hits_are_scored_exactly_and_found_once(spark):
    _, vdf = vectors(spark, 400, 8, 1, "vec_id")
    _, qdf = vectors(spark, 10, 8, 2, "query_id")
    exact = r.dense_topk(vdf, qdf, k=400)
    found = r.dense_topk_lsh(vdf, qdf, k=400, dim=8, tables=4, bucket_length=0.5)
    assert found.select("query_id", "chunk_id").distinct().count() == found.count()
    assert found.join(exact, ["query_id", "chunk_id", "score"]).count() == found.count()
    recalls = [
        r.recall(r.dense_topk_lsh(vdf, qdf, dim=8, tables=4, bucket_length=b), r.dense_topk(vdf, qdf)).first()["recall"]
        for b in (0.05, 0.5, 50.0)
    ]
    assert recalls == sorted(recalls) and recalls[0] < 1.0 and recalls[-1] == 1.0


def test_fusion(spark):
    schema = "query_id bigint, rank bigint, chunk_id string"
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], schema)
    second = spark.createDataFrame([(1, 1, "b"), (1, 2, "c"), (2, 1, "z")], schema)
    got = rows(r.reciprocal_rank_fusion([first, second]), "query_id", "rank")
    assert got == [
        (1, 1, "b", round(1 / 60 + 1 / 61, 6)), (1, 2, "a", round(1 / 60, 6)), (1, 3, "c", round(1 / 61, 6)), (2, 1, "z", round(1 / 60, 6))
    ]


def test_variants_with_one_variant_keep_the_order(spark):
    chunks, _ = random_chunks(spark)
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string")
    index = ki.build_index(chunks)
    single = r.retrieve_variants(r.bm25_retriever(index), queries.withColumn("variant", F.lit(0)))
    plain = r.bm25_topk(index, queries)
    pick = lambda df: rows(df.select("query_id", "rank", "chunk_id"), "query_id", "rank")
    assert pick(single) == pick(plain)


HIT = "query_id bigint, rank bigint, score double, file_name string, title string, text string"


def test_context_defaults_and_order(spark):
    hits = spark.createDataFrame([(1, 2, 0.5, None, None, "second"), (1, 1, 0.95, "A.md", "T", "first")], HIT)
    context = answers.build_context(hits).first()["context"]
    assert context == "[1] score=0.950, file=A.md, title=T\nfirst\n\n---\n[2] score=0.500, file=unknown, title=Untitled\nsecond\n"
    prompt = answers.build_prompt(
        spark.createDataFrame([(1, context)], "query_id bigint, context string"), spark.createDataFrame([(1, "Why?")], "query_id bigint, text string")
    ).first()["prompt"]
    assert prompt.startswith("You are a helpful assistant answering questions based only on the context.\n\nContext:\n[1] score")
    assert "\n\nQuestion: Why?\n\nAnswer clearly" in prompt and prompt.endswith("[file=Source-File-Name2.md].")


def test_blank_hits_drop_and_files_keep_repeats(spark):
    hits = spark.createDataFrame(
        [(1, 1, 0.9, "A.md", None, "\t\n"), (1, 2, 0.8, "B.md", None, "x"), (1, 3, 0.7, "B.md", None, "y"), (2, 1, 0.1, "C.md", None, "")], HIT
    )
    kept = answers.drop_blank_hits(hits)
    assert rows(kept.select("query_id", "rank", "text"), "rank") == [(1, 1, "x"), (1, 2, "y")]
    queries = spark.createDataFrame([(1, "q"), (2, "q")], "query_id bigint, text string")
    outputs = answers.with_fallback(queries, answers.retrieved_files(kept))
    assert rows(outputs, "query_id") == [(1, "B.md\nB.md", True), (2, answers.NO_HITS, False)]


def test_extractive_answer(spark):
    hits = spark.createDataFrame(
        [(1, 1, 0.9, "A.md", None, "No match here. Dogs need a licence."), (1, 2, 0.8, "B.md", None, "A dog licence costs 50. Dogs need a licence too."), (2, 1, 0.5, "A.md", None, "Nothing.")], HIT
    )
    queries = spark.createDataFrame([(1, "What does a dog licence cost?"), (2, "zebra"), (3, "none")], "query_id bigint, text string")
    assert rows(answers.extractive_answer(hits, queries), "query_id") == [
        (1, "A dog licence costs 50. [file=B.md]"), (2, answers.DONT_KNOW), (3, answers.DONT_KNOW)
    ]


def test_rerank_by_coverage_keeps_old_order_on_ties(spark):
    hits = spark.createDataFrame([(1, 1, 0.9, "A.md", None, "aa"), (1, 2, 0.8, "B.md", None, "aa bb"), (1, 3, 0.7, "C.md", None, "bb aa")], HIT)
    queries = spark.createDataFrame([(1, "aa bb")], "query_id bigint, text string")
    got = rows(answers.rerank(hits, queries, 2).select("rank", "file_name", "rerank_score"), "rank")
    assert got == [(1, "B.md", 1.0), (2, "C.md", 1.0)]


def test_previous_summary_and_hot_terms(spark):
    chunks, data = random_chunks(spark, 200)
    index = ki.build_index(chunks)
    joined = enrich.join_term_stats(index.postings, index, "chunk_id", part_rows=4)
    assert rows(joined.select("chunk_id", "term", "tf", "df"), "chunk_id", "term") == rows(
        index.postings.join(index.term_stats, "term").select("chunk_id", "term", "tf", "df"), "chunk_id", "term"
    )
    numbered = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, None), (2, 0, "x")], "doc_id bigint, chunk_no bigint, summary string")
    assert rows(enrich.with_previous(numbered, "summary", "previous"), "doc_id", "chunk_no") == [
        (1, 0, "a", None), (1, 1, "b", "a"), (1, 2, None, "b"), (2, 0, "x", None)
    ]


def test_whole_lists_find_documents_without_a_vector(spark):
    tables = Tables(spark, "/root/testdata/sf0.01")
    dense, keyword = whole_ranked_lists(tables)
    vectors = tables.vectors().select(F.col("vec_id").alias("chunk_id"))
    assert keyword.join(vectors, "chunk_id", "left_anti").count() > 0
    fused = r.reciprocal_rank_fusion([dense, keyword])
    assert fused.join(vectors, "chunk_id", "left_anti").count() > 0


def test_vectors_that_a_search_cannot_take_are_listed(spark):
    data = [(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [float("nan"), 0.0]), (5, [None, 1.0]), (6, [0.5, 0.5]), (7, []), (8, [float("inf"), 1.0])]
    vectors = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    good, rejected = r.sort_out_vectors(vectors, 2)
    assert rows(rejected, "vec_id") == [(2, "length 1"), (3, "null"), (4, "not finite"), (5, "not finite"), (7, "length 0"), (8, "not finite")]
    queries = spark.createDataFrame([(9, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    assert [hit["chunk_id"] for hit in r.dense_topk(good, queries, 5).orderBy("rank").collect()] == [1, 6]


def test_queries_of_the_same_terms_are_searched_once(spark, monkeypatch):
    chunks, data = random_chunks(spark)
    asked = [(i, ["t3 t24", "t24, T3", "t8"][i % 3]) for i in range(90)]
    sizes = []
    monkeypatch.setattr(r, "broadcast_batches", lambda df, key: sizes.append(df.count()) or broadcast_batches(df, key))
    got = rows(r.bm25_topk(ki.build_index(chunks), spark.createDataFrame(asked, "query_id bigint, text string")), "query_id", "rank")
    assert sizes == [3]
    assert [g[:3] for g in got] == [w[:3] for w in bm25_by_hand(data, asked, 5)]


def test_terms_are_counted_in_the_row_of_their_chunk(spark):
    chunks = spark.createDataFrame([("a", "x1 y1 x1"), ("a", "y1 z1 y1 y1"), (None, "x1 q1"), ("b", ""), ("c", None)], "chunk_id string, text string")
    index = ki.build_index(chunks)
    assert rows(index.postings, "chunk_id", "term") == [(None, "q1", 1, 2), (None, "x1", 1, 2), ("a", "x1", 2, 3), ("a", "y1", 4, 4), ("a", "z1", 1, 4)]
    plan = index.postings._jdf.queryExecution().executedPlan().toString()
    assert " HashAggregate" not in plan  # no table of (chunk, term) groups
    hits = rows(r.bm25_topk(index, spark.createDataFrame([(None, "x1"), (2, "x1 z1")], "query_id bigint, text string")), "query_id", "rank")
    assert [h[:3] for h in hits] == [(None, 1, "a"), (None, 2, None), (2, 1, "a"), (2, 2, None)]


def test_keywords_ask_for_each_term_once_per_part(spark, monkeypatch):
    chunks, _ = random_chunks(spark)
    index = ki.staged_index(ki.build_index(chunks.coalesce(1)))
    asked, join = [], enrich.join_term_stats
    monkeypatch.setattr(enrich, "join_term_stats", lambda found, *rest: asked.append((found.count(), found.select("term").distinct().count())) or join(found, *rest))
    got = rows(enrich.top_keywords(index, 3).select("chunk_id", "rank", "term"), "chunk_id", "rank")
    parts = index.lists.rdd.getNumPartitions()
    assert asked[0][0] <= parts * asked[0][1] < index.postings.count()
    n, dfs = index.chunk_stats.count(), {x["term"]: x["df"] for x in index.term_stats.collect()}
    wanted = {}
    for x in index.postings.collect():
        wanted.setdefault(x["chunk_id"], []).append((-round(x["tf"] * math.log(n / dfs[x["term"]]), 6), x["term"]))
    assert got == [(c, i, t) for c in sorted(wanted) for i, (_, t) in enumerate(sorted(wanted[c])[:3], 1)]


def test_postings_never_become_rows(spark):
    texts = [(1, "aa bb bb"), (1, "bb cc"), (2, None), (3, ""), (4, "dd"), (None, "bb ee")]
    chunks = spark.createDataFrame(texts, "chunk_id bigint, text string")
    index = ki.build_index(chunks)
    terms = spark.createDataFrame([("bb",), ("dd",), ("zz",)], "term string")
    lists, n, mean = r._asked_lists(index, terms)
    # a null text counts as a chunk without a length
    assert (n, mean) == (6, 8 / 5)
    got = {x["chunk_id"]: [x["terms"], x["tfs"], x["dls"]] for x in lists.collect()}
    assert got == {1: [["bb"], [3], [3]], 4: [["dd"], [1], [1]], None: [["bb"], [1], [2]]}
    thinned = r._thinned_lists(index.lists.select("chunk_id", *r._list_columns(), "n_texts", "lengths"), terms)
    plan = thinned._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert "Generate" not in plan and plan.count("collect_list") <= 3


def test_more_terms_than_may_travel_lose_nothing(spark, monkeypatch):
    rng = random.Random(3)
    chunks = spark.createDataFrame([(i, " ".join(rng.choices("aa bb cc dd ee".split(), k=8))) for i in range(60)], "chunk_id bigint, text string")
    asked = spark.createDataFrame([(1, "aa bb"), (2, "cc dd dd")], "query_id bigint, text string")
    few = rows(r.bm25_topk(ki.build_index(chunks), asked), "query_id", "rank")
    monkeypatch.setattr(r, "BROADCAST_ROWS", 2)
    assert rows(r.bm25_topk(ki.build_index(chunks), asked), "query_id", "rank") == few


def test_hits_may_be_judged_before_their_texts_are_joined(spark):
    hits = spark.createDataFrame([(1, 1, "a", " \n"), (1, 2, "b", "x"), (2, 1, "a", " \n"), (1, 3, "c", None)], "query_id long, rank long, chunk_id string, text string")
    judged = hits.withColumn("seen", F.coalesce(F.length(F.trim(F.regexp_replace("text", r"\s", ""))) > 0, F.lit(False))).drop("text")
    assert rows(answers.drop_blank_hits(judged, F.col("seen")).select("query_id", "rank", "chunk_id")) == rows(answers.drop_blank_hits(hits).select("query_id", "rank", "chunk_id")) == [(1, 1, "b")]
