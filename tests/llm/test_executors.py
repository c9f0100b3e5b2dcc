"""Operators on workers that have no copy of the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import corpus_pipeline
from gleaner.llm import queries
from gleaner.session import get_session
spark = get_session("elsewhere", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": {shared!r}}})
spark.sparkContext.setLogLevel("OFF")
for name, query in [*queries.QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    try:
        print(name, "rows", query(spark, "/root/testdata/sf0.001").count(), flush=True)
    except Exception as failure:
        print(name, "failed", str(failure)[-600:], flush=True)
"""


def test_every_query_runs_where_the_package_is_not_installed(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=REPO, shared=str(tmp_path / "shared"))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0 and "failed" not in done.stdout, done.stdout + done.stderr[-2000:]
    assert done.stdout.count(" rows ") == 14
