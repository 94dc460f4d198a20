"""Executors need no copy of this repository: what they run travels with the task."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
found = s.sparkContext.parallelize([0], 1).map(lambda _: __import__("importlib").util.find_spec("starloom") is not None).first()
rows = [e.queries()[n](s, "/root/testdata/sf0.001").collect() for n in ("op1_sentencepiece_codec", "op8_language_id", "op9_simhash_dedup")]
print("FOUND", found, [len(r) for r in rows])
"""


def test_tasks_do_not_import_the_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND False [200, 200, 200]" in out.stdout, out.stderr[-2000:]
