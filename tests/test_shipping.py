"""Workers find the package wherever the driver was started."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from tidepool.session import build_session
spark = build_session("local[2]", 4, extra={{"spark.ui.enabled": "false"}})
print("ROWS", e.queries()["smote_neighbours"](spark, "/root/testdata/sf0.001").count())
"""


def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
