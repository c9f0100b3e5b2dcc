import os
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import keyword_index, pruned_index
from gleaner.operators import retrieval as r
from gleaner.sources import scratch
from tests.conftest import rows


@pytest.fixture(scope="module")
def chunks(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(300)], k=rng.randrange(3, 60))) for _ in range(900)]
    texts += [texts[5]] * 40 + ["", "solo solo solo", "x"]
    return spark.createDataFrame(list(enumerate(texts)), "chunk_id bigint, text string")


@pytest.fixture(scope="module")
def questions(spark):
    rng = random.Random(8)
    asked = [" ".join(rng.choices([f"w{i}" for i in range(300)], k=rng.randrange(1, 6))) for _ in range(40)]
    asked += ["solo", "nothing known", "", "w0 w0 w1", "w0"]
    return spark.createDataFrame(list(enumerate(asked)), "query_id bigint, text string")


def saved(chunks, path, **options):
    pruned_index.save_pruned(keyword_index.build_index(chunks), str(path), **options)
    return pruned_index.open_pruned(chunks.sparkSession, str(path))


@pytest.mark.parametrize("k,range_chunks", [(1, 10), (5, 10), (5, 100), (50, 5000)])
def test_same_hits_as_the_full_scan(spark, chunks, questions, tmp_path, k, range_chunks):
    stored = saved(chunks, tmp_path / "i", buckets=16, range_chunks=range_chunks)
    exact = r.bm25_topk(keyword_index.build_index(chunks), questions, k)
    assert rows(pruned_index.pruned_topk(stored, questions, k), "query_id", "rank") == rows(exact, "query_id", "rank")


def test_other_constants(spark, chunks, questions, tmp_path):
    stored = saved(chunks, tmp_path / "i", buckets=16, range_chunks=20)
    exact = r.bm25_topk(keyword_index.build_index(chunks), questions, 5, k1=0.6, b=0.2)
    assert rows(pruned_index.pruned_topk(stored, questions, 5, k1=0.6, b=0.2), "query_id", "rank") == rows(exact, "query_id", "rank")


def test_only_named_folders_are_opened(spark, chunks, tmp_path):
    stored = saved(chunks, tmp_path / "i", buckets=64, range_chunks=10_000)
    wanted = spark.createDataFrame([("w250",)], "term string").withColumn("bucket", pruned_index._folder(64, "term"))
    kept = pruned_index._only(stored.terms, pruned_index._folders(wanted))
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {row[0] for row in kept.select(F.input_file_name()).distinct().collect()}
    assert len(read) == 1 and len(stored.terms.select(F.input_file_name()).distinct().collect()) > 20


def test_ranges_out_of_reach_are_not_scored(spark, tmp_path):
    # ten chunks name the rare word, all name the frequent one
    texts = [(i, "common " * 3 + ("rare" if i % 300 == 0 else f"f{i}")) for i in range(3000)]
    stored = saved(spark.createDataFrame(texts, "chunk_id bigint, text string"), tmp_path / "i", buckets=8, range_chunks=10)
    asked = spark.createDataFrame([(1, "common rare")], "query_id bigint, text string")
    root = scratch.scratch_root(spark)
    before = set(os.listdir(root))
    hits = pruned_index.pruned_topk(stored, asked, 1)
    assert rows(hits)[0][2] % 300 == 0
    scored = sum(spark.read.parquet(f"{root}/{d}").count() for d in os.listdir(root) if d not in before and d.startswith(("first-ranges", "reachable-ranges")))
    assert scored <= 10 + pruned_index.FIRST_RANGES < stored.blocks.filter("term = 'common'").count() / 10


def test_an_empty_index_is_an_error(spark, tmp_path):
    empty = spark.createDataFrame([], "chunk_id bigint, text string")
    with pytest.raises(ValueError, match="empty"):
        pruned_index.save_pruned(keyword_index.build_index(empty), str(tmp_path / "i"))


def test_no_pairs_of_query_and_chunk_are_moved(spark, chunks, questions, tmp_path, monkeypatch):
    seen = []
    whole = pruned_index._scored_ranges

    def watched(blocks, asked, k, parts, impact):
        made = whole(blocks, asked, k, parts, impact)
        seen.append((asked.count(), made.count()))
        return made

    monkeypatch.setattr(pruned_index, "_scored_ranges", watched)
    monkeypatch.setattr(pruned_index, "PART_QUERIES", 16)
    monkeypatch.setattr(pruned_index, "TASK_POSTINGS", 300)
    stored = saved(chunks, tmp_path / "i", buckets=4, range_chunks=100)
    exact = r.bm25_topk(keyword_index.build_index(chunks), questions, 3)
    assert rows(pruned_index.pruned_topk(stored, questions, 3), "query_id", "rank") == rows(exact, "query_id", "rank")
    assert len(seen) == 2 and all(0 < moved <= 3 * ranges for ranges, moved in seen)


def test_ids_may_be_null_or_text(spark, tmp_path):
    chunks = spark.createDataFrame([("b", "aa bb"), ("a", "aa bb"), (None, "aa"), ("c", None)], "chunk_id string, text string")
    stored = saved(chunks, tmp_path / "i", buckets=2, range_chunks=1)
    asked = spark.createDataFrame([(1, "aa bb"), (2, "aa"), (3, None)], "query_id int, text string")
    exact = r.bm25_topk(keyword_index.build_index(chunks), asked)
    assert rows(pruned_index.pruned_topk(stored, asked), "query_id", "rank") == rows(exact, "query_id", "rank")
