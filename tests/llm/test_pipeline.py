import pytest

import corpus_pipeline
from gleaner.llm import decontamination
from tests.llm.tables import ROWS, empty, messy
from tests.llm.test_matching import brute_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, made = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(step(spark, docs, FOLDER), "test")
        made[name] = (before, docs)
    return made


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        assert name == "token_shards" or before.columns == after.columns


def test_clean_documents_pass_language_identification(stages):
    before, after = stages["language_id"]
    assert before.count() == after.count()


def test_one_of_each_group(stages):
    before, after = stages["jaccard_join"]
    groups = brute_groups([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert {r["doc_id"] for r in after.collect()} == {c for _, _, c in groups}


def test_items_are_gone(spark, stages):
    before, after = stages["decontamination"]
    items = [decontamination.normal_text(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in before.collect() if not any(i in decontamination.normal_text(r["text"]) for i in items)}
    assert {r["doc_id"] for r in after.collect()} <= clean
    assert len(clean) - after.count() <= 2


def test_mix_and_ids(stages):
    before, after = stages["mixing"]
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}
    assert stages["token_shards"][1].count() == after.count()


def test_messy_and_empty_tables(spark):
    docs = messy(spark)
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, FOLDER), "messy")
        if name == "language_id":
            kept = {r["doc_id"] for r in docs.collect()}
            assert {1, 2, 7} <= kept and not kept & {3, 4, 5, 6}
        none = step(spark, empty(spark), FOLDER)
        assert none.collect() == []
    assert 0 < docs.count() <= 3 * len(ROWS)
