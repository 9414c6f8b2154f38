"""The driver contract on a bare session: no spark-defaults (no checkpoint dir), default
shuffle partitions, session time zone left to the JVM."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
import __spark_entry__ as e
print("entry", e.entry(spark).count())
print("lag", e.queries()["sender_prev_amount"](spark, "/root/testdata/sf0.001").count())
print("publish", e.queries()["publish_events"](spark, "/root/testdata/sf0.001").count())
"""


def test_contract_on_bare_session():
    conf_dir = tempfile.mkdtemp(prefix="bare-conf-")
    env = dict(os.environ, SPARK_CONF_DIR=conf_dir)
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tempfile.gettempdir(),
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    got = dict(line.split() for line in out.stdout.splitlines() if line.split()[0] in ("entry", "lag", "publish"))
    assert int(got["entry"]) > 0 and int(got["lag"]) > 0 and int(got["publish"]) > 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest
    from transferlake.session import scratch_for
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_for(master)
    for master in ("local", "local[4]", "local[*]", "local[2,3]"):
        assert os.path.isdir(scratch_for(master))
