"""Stored tables, read with their fixed schemas.

Each write of a whole table makes a new version, a folder below the table's own. A version counts
once Spark has marked the write as a success, so a table stays readable while it is replaced, and
after a write that failed.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CELL, TABLES

VERSION = "version-"
SUCCESS = "_SUCCESS"

# Tables that take additions: their key, and how many of its first characters name a key range.
KEY_RANGES = {"observations": ("key", 3), "stations": ("id", 2)}
KEY_RANGE = "key_range"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def schema_of(name: str) -> StructType:
    return TABLES.get(name, CELL)


def versions(spark: SparkSession, root: str, name: str) -> dict[str, bool]:
    """The folders of a table's versions, oldest first, and whether each was written to the end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return {}
    found = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith(VERSION)]
    names = sorted(path.getName() for path in found)
    done = {
        p.getName(): files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, SUCCESS)) for p in found
    }
    return {n: done[n] for n in names}


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """The newest finished version, or the table's own folder if it has none."""
    finished = [version for version, done in versions(spark, root, name).items() if done]
    return "/".join([table_path(root, name), *finished[-1:]])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the tables ``observations``, ``stations``, ``summary``, or a table of cells."""
    rows = spark.read.schema(schema_of(name)).parquet(current_path(spark, root, name))
    return rows.select(*schema_of(name).fieldNames()) if name in KEY_RANGES else rows


def read_key_ranges(spark: SparkSession, root: str, name: str, ranges: list[str]) -> DataFrame:
    """The rows of some key ranges of a table; the folders of the others are not read."""
    schema = StructType([*schema_of(name).fields, StructField(KEY_RANGE, StringType())])
    rows = spark.read.schema(schema).parquet(current_path(spark, root, name))
    return rows.where(rows[KEY_RANGE].isin(ranges)).select(*schema_of(name).fieldNames())
