"""The driver brings its own session: settings must apply to one built without ours."""

import pathlib
import subprocess
import sys

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as entry
from shelfline.session import RUNTIME_CONF
assert all(spark.conf.isModifiable(name) for name in RUNTIME_CONF), "static setting among the runtime ones"
assert entry.entry(spark).count() > 0
assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
print("PLAIN SESSION OK")
"""


def test_entry_in_a_plain_session():
    root = pathlib.Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, capture_output=True, text=True, timeout=300)
    assert "PLAIN SESSION OK" in done.stdout, done.stderr[-2000:]
