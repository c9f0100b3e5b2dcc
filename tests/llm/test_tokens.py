import random
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from gleaner.llm import token_shards
from gleaner.llm.token_counts import count_tokens
from tests.llm.tables import ROWS, empty, messy

library = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return library.Tokenizer.from_file(PATH)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(1)
    parts = ["a", "Bc", "é", "日", "́", " ", "  ", "\n", "\t", ".", ",", ", ", ". ", "!!", "'s", "12", "_", "\xa0", "\x00", "<|endoftext|>", "🙂", "×", "×, "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]


def test_counts_are_the_librarys(spark, tokenizer):
    rows = ROWS + [(1000 + i, t, None, None) for i, t in enumerate(odd_texts())]
    got = sorted(map(tuple, count_tokens(messy(spark, rows), PATH).collect()), key=repr)
    want = sorted(((r[0], len((r[1] or "").encode()), len(ids(tokenizer, r[1])), len(ids(tokenizer, r[1])) > 512) for r in rows), key=repr)
    assert got == want
    assert count_tokens(empty(spark), PATH).collect() == []


def test_shards_round_trip(spark, tokenizer, tmp_path):
    rows = ROWS + [(1000 + i, t, None, None) for i, t in enumerate(odd_texts())]
    docs, folder = messy(spark, rows), str(tmp_path / "shards")
    token_shards.write_payload(docs, folder, PATH, 2, block_bytes=2000)
    token_shards.write_shard_table(spark, folder)
    token_shards.write_index(spark, folder, bucket_keys=100)
    got = token_shards.digests(docs, folder).collect()
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    sums = sorted((r["doc_id"] or -1, r["ids_crc32"]) for r in got)
    assert sums == sorted((r[0] or -1, zlib.crc32(np.array([*ids(tokenizer, r[1]), 2], "<u4").tobytes())) for r in rows)
    asked = spark.createDataFrame([(1,), (9,), (1003,), (77777,)], "doc_id bigint")
    fetched = token_shards.fetch(asked, folder).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in fetched) == sorted((r[0], [*ids(tokenizer, r[1]), 2]) for r in rows if r[0] in (1, 9, 1003))


@pytest.fixture
def many_shards(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_one_key_opens_its_bucket_and_block_only(spark, tokenizer, tmp_path, many_shards):
    words = odd_texts()
    docs = spark.createDataFrame([(i, " ".join(words[i % 1500 : i % 1500 + 20])) for i in range(3000)], "doc_id bigint, text string")
    folder = str(tmp_path / "shards")
    token_shards.write_payload(docs, folder, PATH, 2, block_bytes=2000)
    token_shards.write_shard_table(spark, folder)
    token_shards.write_index(spark, folder, bucket_keys=100)
    asked = spark.createDataFrame([(1234,)], "doc_id bigint")
    hashed = token_shards._hashes(asked, 30)
    index = token_shards.asked_buckets(hashed, folder, 30)
    bucket = hashed.first()["bucket"]
    filters = re.search(r"PartitionFilters: \[(.*?)\]", index._jdf.queryExecution().executedPlan().toString()).group(1)
    assert f"= {bucket})" in filters and [r["bucket"] for r in index.collect()] == [bucket]
    assert spark.read.parquet(f"{folder}/index").count() == 30
    found = token_shards.lookup(asked, folder)
    place = found.first()
    payload = token_shards.opened(found, folder)
    assert [(r["shard"], r["block"]) for r in payload.select("shard", "block").collect()] == [(place["shard"], place["block"])]
    assert len(payload.inputFiles()) == 1 < token_shards.read_payload(spark, folder).select("shard").distinct().count()
    plan = payload._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(block,{place['block']})" in plan
    file = pq.ParquetFile(payload.inputFiles()[0].removeprefix("file://"))
    assert file.num_row_groups > 1 and all(file.metadata.row_group(g).num_rows <= token_shards.ROWS_OPENED for g in range(file.num_row_groups))
    got = token_shards.fetch(asked, folder).collect()
    assert [(r["doc_id"], r["ids"]) for r in got] == [(1234, [*ids(tokenizer, docs.filter("doc_id = 1234").first()["text"]), 2])]


def test_a_key_of_many_rows_over_blocks_and_shards(spark, tokenizer, tmp_path, many_shards):
    words = odd_texts()
    rows = [(i if i % 3 else 600, " ".join(words[i % 1400 : i % 1400 + 9])) for i in range(1800)] + [(None, w) for w in words[:200]]
    docs, folder = spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "shards")
    token_shards.write_shards(docs, folder, PATH, 2, block_bytes=500)
    place = token_shards.lookup(docs.filter("doc_id = 600"), folder).first()
    assert place["n_rows"] == 600 and place["last_shard"] > place["shard"]
    for keys in (docs.filter("doc_id = 600 or doc_id is null or doc_id = 7"), docs):
        got = sorted(((r["doc_id"] or -1, r["ids"]) for r in token_shards.fetch(keys, folder).collect()))
        wanted = {r["doc_id"] for r in keys.collect()}
        assert got == sorted((k or -1, [*ids(tokenizer, t), 2]) for k, t in rows if k in wanted)
    starts = sorted((r["start"], r["n_tokens"]) for r in token_shards.digests(docs, folder).collect())
    assert len(starts) == len(rows) and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_empty_shards(spark, tmp_path):
    folder = str(tmp_path / "none")
    token_shards.write_shards(empty(spark), folder, PATH, 2)
    assert token_shards.digests(empty(spark), folder).collect() == []


def test_perfect_hash_is_minimal():
    hashes = np.random.default_rng(0).integers(0, 1 << 63, 20_000).astype(np.uint64)
    levels, numbers = token_shards.build_levels(hashes)
    assert sorted(numbers) == list(range(len(hashes)))
    assert (token_shards.find_numbers(levels, hashes) == numbers).all()
    assert sum(len(l) * 8 for l in levels) / len(hashes) < 6


def test_a_new_kind_of_work_gives_the_memory_of_the_old_one_back(monkeypatch):
    import sys

    from gleaner.llm import memo

    monkeypatch.delitem(sys.modules, "_gleaner_worker_memo", raising=False)
    given = []
    monkeypatch.setattr(memo, "give_back", lambda: given.append(getattr(sys.modules["_gleaner_worker_memo"], "held", None)))
    first = memo.per_worker("a", lambda: [1])
    assert memo.per_worker("a", lambda: [2]) is first and not given
    assert memo.per_worker("b", lambda: [3]) == [3]
    # once, and after the old work was dropped
    assert given == [None]
    sys.modules.pop("_gleaner_worker_memo", None)
