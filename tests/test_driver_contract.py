"""The driver contract in a fresh process with a plain session (no library session helpers)."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
import __spark_entry__ as E
out = {"entry_rows": E.entry(spark).count(), "n_queries": len(E._queries.QUERIES), "n_sql": len(E._oracle.oracle_sql())}
out["features_rows"] = E.queries()["features_goals"](spark, "/root/testdata/sf0.001").count()
spark.stop()
print(json.dumps(out))
"""


def test_entry_and_queries_in_a_fresh_process():
    res = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO], capture_output=True, text=True, timeout=600, cwd="/tmp"
    )
    assert res.returncode == 0, res.stderr[-2000:]
    out = json.loads(res.stdout.strip().splitlines()[-1])
    assert out["entry_rows"] == 1720
    assert out["n_queries"] == out["n_sql"] >= 46
    assert out["features_rows"] == 1720
