"""Output of ``foreachBatch`` writers, a folder per epoch.

A micro-batch may run again after a failure: it overwrites the folder of its
epoch, and readers see committed folders only.  State is Spark's own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class AppendLog:
    """Per-epoch output folders ``epoch=<n>``; a rerun replaces its own epoch.

    Readers see only epochs whose write committed (``_SUCCESS``).
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), partition_by or []
        self.schema = None

    def read_all(self) -> DataFrame:
        """Every committed epoch without the ``epoch`` column; empty (with the
        written schema, when known) before the first write."""
        got = self.read()
        if got is not None:
            return got.drop("epoch")
        return self.spark.createDataFrame([], self.schema or "epoch int").drop("epoch")

    def write(self, df: DataFrame, epoch: int) -> None:
        self.schema = df.schema
        if self.partition_by:
            # one file per partition value and epoch, not one per task and value
            w = df.repartition(*self.partition_by).write.mode("overwrite").partitionBy(*self.partition_by)
        else:
            w = df.write.mode("overwrite")
        w.parquet(f"{self.path}/epoch={epoch}")

    def epochs(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(conf)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("epoch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[len("epoch="):]))
        return sorted(out)

    def read(self, before_epoch: int | None = None) -> DataFrame | None:
        eps = [e for e in self.epochs() if before_epoch is None or e < before_epoch]
        if not eps:
            return None
        paths = [f"{self.path}/epoch={e}" for e in eps]
        reader = self.spark.read.option("basePath", self.path)
        try:
            return reader.parquet(*paths)
        except AnalysisException:  # only empty epochs: no file to take a schema from
            return None
