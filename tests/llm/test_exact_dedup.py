import hashlib
import re
from collections import Counter

import pytest

from gleaner.llm.exact_dedup import exact_dedup
from tests.llm.tables import ROWS, empty, messy


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id))
    out = Counter()
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for place, member in enumerate(members):
            out[(member[2], members[0][2], len(members), place == 0, hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("slice_rows", [1, 2, 512])
def test_every_row_gets_its_group(spark, slice_rows):
    rows = ROWS + [(100 + i, "copy of a copy" + " " * (i % 3), "en", "a") for i in range(40)]
    got = Counter(tuple(r) for r in exact_dedup(messy(spark, rows), slice_rows=slice_rows).collect())
    assert got == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(empty(spark)).collect() == []


def test_text_is_exchanged_once_and_no_python_runs(spark):
    plan = exact_dedup(messy(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
