"""Versioned Parquet snapshots: write ``v{n+1}`` next to ``v{n}``, never overwrite
the version being read; the newest version with ``_SUCCESS`` is current.

A failed or retried write leaves no ``_SUCCESS`` and is simply ignored, so
jobs that rewrite a table are safe to re-run after losing executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


class Snapshot:
    def __init__(self, spark: SparkSession, base: str, schema: StructType):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema

    def versions(self) -> list[int]:
        fs, p, jvm = _fs(self.spark, self.base)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("v") and name[1:].isdigit() and \
                    fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[1:]))
        return sorted(out)

    def current_path(self) -> str | None:
        v = self.versions()
        return f"{self.base}/v{v[-1]:06d}" if v else None

    def read(self) -> DataFrame:
        path = self.current_path()
        if path is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path)

    def write(self, df: DataFrame) -> str:
        v = self.versions()
        path = f"{self.base}/v{(v[-1] + 1 if v else 1):06d}"
        df.write.mode("overwrite").parquet(path)
        return path
