import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from tokenlake.operators.codec import encode
from tokenlake.operators.tokenizer import Merge, Tokenizer
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([(1, "abab")], "doc_id long, text string")
print("IDS", list(encode(df, Tokenizer((Merge(97, 98),)), method="arrow").first()["ids"]))
"""


def test_workers_need_no_installed_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert "IDS [256, 256]" in done.stdout, done.stderr[-2000:]
