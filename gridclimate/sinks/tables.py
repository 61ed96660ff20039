"""Stored tables, written in order of their clustering columns."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import curve_place
from ..sources.tables import (
    KEY_RANGE,
    KEY_RANGES,
    VERSION,
    current_path,
    read_key_ranges,
    table_path,
    versions,
)
from .scratch import shared_folder

# Observations and stations are in key order. The summary is in numeric order, so that the
# least and greatest values kept with each part of a file serve the lookups.
CLUSTER_BY = {
    "observations": ("key",),
    "stations": ("id",),
    "summary": ("latitude", "longitude", "year", "season"),
}
CELL_ORDER = ("key", "qualifier")


def summary_curve() -> tuple:
    """Another order of the summary: requests that are narrow in longitude or years skip as much as
    those that are narrow in latitude."""
    return curve_place(F.col("latitude"), F.col("longitude"), F.col("year")), "season"


def _ordered(rows: DataFrame, name: str, cluster_by=None):
    """A writer of the rows in order, a folder for each key range where the table has any.

    The number of files follows the amount of data: no partition count is given, so adaptive
    execution merges small neighbouring ranges. Clustering columns should be (nearly) unique
    together, as rows equal in all of them share one file. A key range is how the key begins, so
    the order of the keys is that of the folders as well.
    """
    columns = list(cluster_by or CLUSTER_BY.get(name, CELL_ORDER))
    if name not in KEY_RANGES:
        return rows.repartitionByRange(*columns).sortWithinPartitions(*columns).write
    key, length = KEY_RANGES[name]
    rows = rows.withColumn(KEY_RANGE, F.substring(key, 1, length)).repartitionByRange(*columns)
    return rows.sortWithinPartitions(KEY_RANGE, *columns).write.partitionBy(KEY_RANGE)


def write_table(rows: DataFrame, root: str, name: str, cluster_by=None) -> None:
    """Write a table below ``root``, ordered across and within its files, as a new version.

    The version before stays until the next write, for those who are reading it; what is older, or
    was left behind by a write that failed, is deleted afterwards.
    """
    spark = rows.sparkSession
    before = versions(spark, root, name)
    number = max([0, *(int(version.removeprefix(VERSION)) for version in before)]) + 1
    _ordered(rows, name, cluster_by).parquet(f"{table_path(root, name)}/{VERSION}{number:06d}")
    finished = [version for version, done in before.items() if done]
    folder = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for version in before:
        if version not in finished[-1:]:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, version), True)


def merge_table(
    rows: DataFrame, root: str, name: str, latest: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Add rows to a stored table; returns the key ranges that were written again.

    ``latest`` leaves one row per key; it is given the new rows and the stored ones of the key
    ranges that the new keys touch. Only the folders of these are replaced, after all of their
    files have been written; all other files stay as they are. A job that fails changes nothing.
    """
    spark = rows.sparkSession
    if not any(versions(spark, root, name).values()):
        write_table(latest(rows), root, name)
        path = current_path(spark, root, name)
        return sorted(r[0] for r in spark.read.parquet(path).select(F.col(KEY_RANGE).cast("string")).distinct().collect())
    # The new rows are worked out once.
    path = f"{shared_folder(spark)}/added"
    latest(rows).write.parquet(path)
    added = spark.read.schema(rows.schema).parquet(path)
    key, length = KEY_RANGES[name]
    ranges = sorted(r[0] for r in added.select(F.substring(key, 1, length)).distinct().collect())
    if ranges:
        merged = latest(read_key_ranges(spark, root, name, ranges).unionByName(added))
        writer = _ordered(merged, name).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(current_path(spark, root, name))
    return ranges
