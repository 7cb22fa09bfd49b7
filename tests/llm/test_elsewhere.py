"""Workers that stand outside the repository have no copy of the package; queries run there all the same."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from veritwin.session import local_session
spark = local_session("4", "elsewhere")
spark.sparkContext.setLogLevel("ERROR")
for name in sys.argv[2:]:
    rows = entry.queries()[name](spark, "/root/testdata/sf0.001").count()
    print(name, "rows", rows, flush=True)
"""


def test_queries_run_from_another_folder(tmp_path):
    names = ["op2_suffix_tree", "op5_near_vectors", "op6_language", "op7_decontaminate", "op11_fill_in_middle", "op12_orc_ids", "op13_table_means"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(REPO), *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if " rows " in line] == names
