import os
import subprocess
import sys

from gleaner.operators import enrich
from tests.conftest import rows

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from gleaner.operators.chunking import chunk_sentences
from gleaner.session import get_session
spark = get_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false"}})
df = spark.createDataFrame([(1, "a.md", "One. Two.")], "doc_id bigint, file_name string, text string")
print("chunks", chunk_sentences(df).first()["text"])
"""


def test_tasks_run_where_the_package_is_not_installed(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "chunks One. Two." in done.stdout, done.stderr[-2000:]


def test_transformations_run_in_order(spark):
    steps = [lambda df: df.withColumnRenamed("id", "n"), lambda df: df.selectExpr("n * 2 AS n")]
    assert rows(enrich.run_transformations(spark.range(3), steps), "n") == [(0,), (2,), (4,)]
