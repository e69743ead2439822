import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from siltstone import session
spark = session.create("far", **{{"spark.master": "local[2]", "spark.sql.shuffle.partitions": "2"}})
from siltstone.llm import chat
print("turns", chat.op8_template_compiler(spark, "/root/testdata/sf0.001").count())
"""


def test_workers_get_the_package_without_a_path_to_it(tmp_path):
    """Run elsewhere, where neither the folder nor PYTHONPATH leads workers to the code."""
    env = {"PATH": str(Path(sys.executable).parent) + ":/usr/bin:/bin", "HOME": str(tmp_path)}
    env |= {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "PATH", "SPARK_HOME")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200
    )
    assert "turns" in done.stdout, done.stderr[-2000:]
