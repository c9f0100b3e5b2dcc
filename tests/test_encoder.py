import hashlib
import math
import re

import pytest

from gleaner.operators import encoder
from gleaner.operators.models import QUERY_INSTRUCTION
from tests.conftest import rows

TEXTS = ["the cat sat on the mat", "The dog sat", "cat cat cat", "", None, "a b", "naïve été 日本"]


def plain(texts, asked, dim):
    terms = lambda t: re.findall(r"[\w]{2,}", (t or "").lower())
    place = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:6], 16) % dim
    sign = lambda t: 1 - 2 * (int(hashlib.md5(t.encode()).hexdigest()[6], 16) % 2)
    df = [0] * dim
    for t in texts:
        for s in {place(x) for x in terms(t)}:
            df[s] += 1
    out = []
    for t in asked:
        v = [0.0] * dim
        for x in terms(t):
            v[place(x)] += sign(x)
        v = [x * math.log((len(texts) + 1) / (n + 1)) for x, n in zip(v, df)]
        norm = math.sqrt(sum(x * x for x in v))
        out.append([x / norm for x in v] if norm else None)
    return out


def close(found, want):
    assert len(found) == len(want)
    for f, w in zip(found, want):
        assert (f is None) == (w is None)
        assert f is None or f == pytest.approx(w, abs=2e-6)


def test_vectors_of_a_saved_encoder(spark, tmp_path):
    table = spark.createDataFrame([(i, t, "e") for i, t in enumerate(TEXTS)], "chunk_id bigint, text string, embedding string")
    encoder.save_encoder(encoder.fit_table(table, 32), str(tmp_path / "e"))
    loaded = encoder.load_encoder(spark, str(tmp_path / "e"))
    assert loaded.count() == 32
    got = encoder.encode(table, loaded).orderBy("chunk_id").collect()
    assert got[0]["text"] == TEXTS[0]
    close([r["embedding"] for r in got], plain(TEXTS, TEXTS, 32))


def test_questions_carry_the_instruction(spark):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "query_id bigint, text string")
    weights = encoder.fit_table(table, 64)
    led = encoder.encode_queries(table.filter("query_id < 3"), weights).orderBy("query_id").collect()
    close([r["embedding"] for r in led], plain(TEXTS, [QUERY_INSTRUCTION + t for t in TEXTS[:3]], 64))
    bare = encoder.encode_queries(table.filter("query_id < 3"), weights, instruct=False).orderBy("query_id").collect()
    close([r["embedding"] for r in bare], plain(TEXTS, TEXTS[:3], 64))


def test_no_encoder_and_no_chunks(spark, tmp_path):
    empty = spark.createDataFrame([], "chunk_id bigint, text string")
    table = encoder.fit_table(empty, 8)
    assert [r["df"] for r in table.collect()] == [0] * 8
    assert rows(encoder.encode(empty, table)) == []
    encoder.save_encoder(table.limit(0), str(tmp_path / "e"))
    with pytest.raises(ValueError, match="encoder"):
        encoder.load_encoder(spark, str(tmp_path / "e"))
