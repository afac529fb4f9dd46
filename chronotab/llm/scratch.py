"""Tables written for the time of a job, as Parquet in the shared folder."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession

from chronotab.llm.queries import shared_folder


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that this job made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written once and read back, compressed and by column, and its folder. A table with texts
    takes a fraction of what a checkpoint of its rows takes."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder), folder


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, an action's shuffle files go when it ends, not when the driver happens to collect its
    garbage: for iterations that cut their lineage in every round and never look back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
