"""Intermediate tables in the folder that the cluster shares."""

import gc

from pyspark.sql import DataFrame, SparkSession

from ..sinks.scratch import shared_folder


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet below the shared folder and read back: a short lineage."""
    path = f"{shared_folder(rows.sparkSession)}/{name}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of tables that are written and of no more use.

    It does so once the driver has collected the objects that stand for them, which on a driver
    with a large heap may take until the end of the job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
