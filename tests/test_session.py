import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from millrace.session import build_session, clear_scratch, materialize, scratch_path
spark = build_session("local[1]", 1, memory="1g")
assert spark.conf.get("spark.checkpoint.dir", None) is None
a, b = (materialize(spark.range(n), "t") for n in (3, 4))
assert (a.count(), b.count()) == (3, 4)
folder = scratch_path(spark, "x").rsplit("/", 1)[0]
assert scratch_path(spark, "y").rsplit("/", 1)[0] == folder
clear_scratch(spark)
import os
assert not os.path.exists(folder)
print("fine")
"""


def test_a_local_session_without_the_setting_gets_one_temporary_folder(tmp_path):
    """In a process of its own: the setting of a running session cannot be taken back."""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=200)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
