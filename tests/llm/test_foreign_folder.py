"""The queries where the executors have no copy of this package: the driver alone finds it."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import os
os.environ.pop("PYTHONPATH", None)
from eventide.session import build_session
from eventide.llm import queries
import corpus_pipeline
spark = build_session("local[4]", 4)
spark.sparkContext.setLogLevel("OFF")
for name, query in {**queries.QUERIES, "pipeline": corpus_pipeline.run}.items():
    assert query(spark, sys.argv[2]).count() > 0, name
    print("ran", name, flush=True)
"""


def test_all_queries_without_the_package_on_executors(tmp_path, sf):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo, sf], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-500:] + done.stderr[-2000:]
    assert done.stdout.count("ran op") == 13 and "ran pipeline" in done.stdout
