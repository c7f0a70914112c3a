"""Session helpers shared by the corpus operators: input tables, shared scratch space, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute available)
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a temporary folder on a
    local master (tests) and a folder in the warehouse on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
            base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """Written intermediate tables of one operator call, in the shared folder.

    A cut is a complete Parquet table, so losing an executor costs only the tasks that ran on it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a cut that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """Column names that clash with none of `columns` (as Spark compares them): the given ones, where taken with more
    underscores in front."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of whole rows of about `limit` bytes of `text`; a longer text stands alone."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def concurrency(spark: SparkSession) -> int:
    """Reduce-side partitions: the session's own setting."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
