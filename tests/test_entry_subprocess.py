"""The driver's way of calling us: a fresh process, another working directory, a bare session."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as e
assert e.entry(spark).count() > 0
q = e.queries()
for name in ["complete_stored", "batch_assign", "silhouette_exact"]:
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("SUBPROCESS-OK")
"""


IMPORT_ONLY = f"""
import builtins, glob, sys, zipfile
sys.path.insert(0, {REPO!r})
def no(*a, **k):
    raise AssertionError("nothing is read at import")
zipfile.ZipFile = glob.glob = no
import __spark_entry__ as e
from pyspark.sql import SparkSession
assert len(e.oracle_sql()) > 90 and set(e.oracle_sql()) <= set(e.queries())
assert SparkSession.getActiveSession() is None
print("IMPORT-OK")
"""


def test_queries_and_sql_need_no_session_and_no_jars():
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "JAVA_HOME")}
    res = subprocess.run([sys.executable, "-c", IMPORT_ONLY], cwd="/tmp", env=env, capture_output=True, text=True, timeout=120)
    assert "IMPORT-OK" in res.stdout, res.stderr[-3000:]


def test_entry_from_another_directory_with_a_bare_session():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd="/tmp", env=env, capture_output=True, text=True,
                         timeout=600)
    assert "SUBPROCESS-OK" in res.stdout, res.stderr[-3000:]
