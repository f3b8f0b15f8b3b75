"""Tables written between the steps of an operator.

A step that is read more than once, or that must not be recomputed when an
executor is lost, is written as Parquet under the folder that
``spark.checkpoint.dir`` names (shared by all executors) and read again.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one only for ``local`` masters (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    have = sc._jsc.sc().getCheckpointDir()
    if not have.isEmpty():
        return have.get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


class Scratch:
    """The tables of one operator call, in one folder of their own.

    ``keep`` writes a table and returns it as read back; ``drop`` removes the
    files of a table that a later step has replaced. What the operator's
    result still reads stays until the caller removes ``folder`` (``clear``).
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._path: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.folder}/{self._n:03d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._path[id(out)] = path
        out._scratch_path = path
        return out

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            self._delete(path)

    def clear(self) -> None:
        self._delete(self.folder)
