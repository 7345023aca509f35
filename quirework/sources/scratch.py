"""Tables that cut lineage, in the folder that the session names in spark.checkpoint.dir.

A cut table is written once as Parquet, so a lost executor costs a reread and never a recomputation of what came
before, and a plan that uses it twice doesn't run twice.  Operators drop tables that they are done with; those that a
result still reads go when the driver's JVM ends.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where it is unset, a folder of our own (single machine, as in tests), gone at exit."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        own = tempfile.mkdtemp(prefix="quirework-")
        atexit.register(shutil.rmtree, own, True)
        _own[app] = f"file://{own}"
    return _own[app]


#: Small row groups: a writer holds one whole group in memory.
WRITE = {"compression": "zstd", "parquet.block.size": str(16 << 20)}


class Scratch:
    """Cut tables of one operator call; drop() those that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.top, self.paths = spark, f"{folder(spark)}/{name}-{uuid.uuid4().hex}", {}
        top = spark._jvm.org.apache.hadoop.fs.Path(self.top)
        system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(top)
        system.deleteOnExit(top)

    def cut(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = f"{self.top}/{name}"
        df.write.mode("errorifexists").options(**(WRITE | options)).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def part(self, df: DataFrame, name: str, by: str, schemas: dict[str, str], **options) -> dict[str, DataFrame]:
        """One pass written in parts by the values of ``by``; a part without rows is an empty table."""
        path, out = f"{self.top}/{name}", {}
        df.write.mode("errorifexists").options(**(WRITE | options)).partitionBy(by).parquet(path)
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for value, schema in schemas.items():
            self.paths[f"{name}/{value}"] = own = f"{path}/{by}={value}"
            there = self.spark._jvm.org.apache.hadoop.fs.Path(own)
            exists = there.getFileSystem(hadoop).exists(there)
            out[value] = self.spark.read.schema(schema).parquet(own) if exists else self.spark.createDataFrame([], schema)
        return out

    def drop(self, *names: str) -> None:
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(hadoop).delete(path, True)
