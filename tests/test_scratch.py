"""Cut tables: where they go, and that they go away."""

import os
import subprocess
import sys
import time
from pathlib import Path

from quirework.sources.scratch import Scratch

ALONE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from quirework.sources.scratch import Scratch, folder
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
s = Scratch(spark, "alone")
assert s.cut(spark.range(5), "five").count() == 5 and folder(spark) == folder(spark)
print("FOLDER", folder(spark))
"""


def test_without_a_configured_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    run = subprocess.run([sys.executable, "-c", ALONE.format(root=root)], env=os.environ | {"SPARK_CONF_DIR": str(tmp_path)}, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    folder = run.stdout.rpartition("FOLDER ")[2].strip().removeprefix("file://")
    assert folder and not Path(folder).exists()  # gone at exit


def test_tables_go_with_the_driver(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    code = ALONE.format(root=root).replace("assert spark.conf.get", "s = Scratch(spark, 'x') or spark.conf.get").replace(" is None", "")
    code = code.replace('.config("spark.ui.enabled"', f'.config("spark.checkpoint.dir", "file://{tmp_path}/shared").config("spark.ui.enabled"')
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    for _ in range(50):
        if not list((tmp_path / "shared").glob("alone-*")):
            break
        time.sleep(0.2)
    assert not list((tmp_path / "shared").glob("alone-*"))


def test_dropped_tables_are_gone(spark):
    s = Scratch(spark, "dropped")
    df = s.cut(spark.range(3), "a")
    path = Path(s.paths["a"].removeprefix("file:"))
    assert df.count() == 3 and path.exists()
    s.drop("a")
    assert not path.exists()
