import os
import subprocess
import sys
import tempfile

CODE = """
import os, sys
from lakemart.llm.common import staged
from lakemart.session import build_session
home = sys.argv[1]
spark = build_session("staged", master="local[2]", shuffle_partitions=2, conf={
    "spark.ui.enabled": "false", "spark.local.dir": home + "/local", "spark.checkpoint.dir": home + "/shared"})
kept = staged(spark.range(1000).repartition("id"))
left = [f for _, _, files in os.walk(home + "/local") for f in files if f.startswith("shuffle_")]
name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
print(len(left), kept.count(), spark.conf.get(name))
"""


def test_shuffle_files_of_a_staged_table_go():
    home = tempfile.mkdtemp(prefix="lakemart-staged-")
    os.mkdir(f"{home}/local")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", CODE, home], cwd=root, capture_output=True, text=True, timeout=120, check=True)
    assert out.stdout.split() == ["0", "1000", "false"]
