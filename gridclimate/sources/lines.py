"""Raw text sources. Each gives one column ``value``, one row per line."""

from pyspark.sql import DataFrame, SparkSession


def read_observation_lines(
    spark: SparkSession, path: str, parallelism: int | None = None
) -> DataFrame:
    """Monthly record lines.

    A gzip archive is read by one task, however large. ``parallelism`` deals its lines out to
    that many tasks; that shuffles the raw text, so leave it unset where there are at least as
    many archives as cores, or where the files are plain text and split by themselves.
    """
    lines = spark.read.text(path)
    return lines if parallelism is None else lines.repartition(parallelism)


def read_station_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_country_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
