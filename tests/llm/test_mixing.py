import random

import pytest
from pyspark.sql import functions as F

from gleaner.llm.mixing import expected_copies, mix, source_targets, word_count
from tests.llm.tables import ROWS, empty, messy


def reshared(sizes, weights, cap):
    """The rule step by step: what is above a limit is shared out again by weight until none is."""
    target = {s: 0.0 for s in sizes}
    left, open_sources = float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and open_sources:
        whole = sum(weights[s] for s in open_sources)
        add = {s: left * weights[s] / whole for s in open_sources}
        left = 0.0
        for s, more in add.items():
            target[s] += more
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_sources.discard(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_what_resharing_gives(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02}": rng.choice([0, 1, 5, 50, 1000, 9000]) for i in range(9)}
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint"), (1, 2, 3), 3).collect()
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))}
    want = reshared(sizes, weights, 3)
    assert all(abs(r["target"] - want[r["source"]]) < 1e-6 * (1 + want[r["source"]]) for r in rows)


def test_taken_words_come_near_and_never_exceed_the_cap(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(1, 300)), "en", f"s{i % 7}" if i % 3 else "hot") for i in range(3000)]
    docs = messy(spark, rows)
    size = word_count(F.col("text"))
    got = expected_copies(docs, size).select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    again = expected_copies(docs, size, block_rows=16).select("doc_id", "copies").collect()
    assert dict((r["doc_id"], r["copies"]) for r in got) == dict(map(tuple, again))
    assert len(got) == 3000 and max(r["copies"] for r in got) <= 3
    taken, target = {}, {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 300 for s in taken)


def test_messy_rows(spark):
    docs = messy(spark)
    got = expected_copies(docs, word_count(F.col("text")))
    assert got.count() == len(ROWS)
    assert mix(docs).schema == docs.schema
    sizes = {r["doc_id"]: r["size"] for r in got.select("doc_id", "size").collect()}
    assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[1] == 12
    assert mix(empty(spark)).collect() == []
