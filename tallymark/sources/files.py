"""Numbered result folders: the newest complete one is what readers see."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its type."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


class Versions:
    """Folders ``<root>/version=N``. Spark's ``_SUCCESS`` marker, written last, completes one.

    A writer that dies leaves a folder without the marker: readers skip it, a rerun overwrites it.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.fmt = fmt

    def path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def complete(self) -> list[int]:
        fs, _ = file_system(self.spark, self.root)
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/version=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in found)

    def write(self, rows: DataFrame, version: int, partition_by: tuple[str, ...] = ()) -> None:
        """Write one version whole, whatever the session says about overwriting partitions, and check that it counts."""
        writer = rows.write.mode("overwrite").format(self.fmt).option("partitionOverwriteMode", "static")
        writer.save(self.path(version), partitionBy=list(partition_by) or None)
        fs, marker = file_system(self.spark, f"{self.path(version)}/_SUCCESS")
        if not fs.exists(marker):
            raise RuntimeError(f"{self.path(version)} was written without its marker")

    def read(self, versions: list[int]) -> DataFrame:
        """Rows of these versions, with their number in the column ``version``."""
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        if not versions:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.root).format(self.fmt)
        return reader.load([self.path(v) for v in versions]).select(*schema.names)

    def delete_before(self, version: int) -> None:
        fs, _ = file_system(self.spark, self.root)
        for old in self.complete():
            if old < version:
                fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(old)), True)
