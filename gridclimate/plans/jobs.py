"""The batch jobs, from files to stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import area_extent, area_sums
from ..operators.grid import seasonal_grid_summary
from ..operators.observations import latest_per_key, parse_observations
from ..operators.stations import (
    add_country,
    latest_per_station,
    parse_countries,
    parse_stations,
)
from ..sinks.tables import merge_table, summary_curve, write_table
from ..sources.lines import read_country_lines, read_observation_lines, read_station_lines
from ..sources.tables import KEY_RANGES, read_key_ranges, read_table


def ingest_observations(
    spark: SparkSession,
    path: str,
    root: str,
    parallelism: int | None = None,
    compat: bool = False,
    add: bool = False,
) -> list[str] | None:
    """Record files to the table ``observations``, one row per key.

    With ``add`` the records come to those stored already, where the greater one of a key stays
    (see ``latest_per_key``); returns the key ranges that changed, for ``refresh_summary``.
    """
    observations = parse_observations(read_observation_lines(spark, path, parallelism), compat)
    if add:
        return merge_table(observations, root, "observations", latest_per_key)
    write_table(latest_per_key(observations), root, "observations")


def ingest_stations(
    spark: SparkSession,
    stations_path: str,
    countries_path: str,
    root: str,
    compat: bool = False,
    add: bool = False,
) -> None:
    """Station and country files to the table ``stations``, one row per id.

    With ``add`` the stations come to those stored already, where the greater row of an id stays.
    """
    stations = parse_stations(read_station_lines(spark, stations_path))
    countries = parse_countries(read_country_lines(spark, countries_path))
    rows = add_country(stations, countries, compat)
    if add:
        merge_table(rows, root, "stations", latest_per_station)
    else:
        write_table(latest_per_station(rows), root, "stations")


def build_summary(spark: SparkSession, root: str, curve: bool = False) -> None:
    """Stored observations and stations to the table ``summary``.

    It is stored in order of latitude, longitude, year and season, which serves lookups of a cell
    best; with ``curve`` in the order of a space-filling curve through latitudes, longitudes and
    years, which serves areas of any shape.
    """
    summary = seasonal_grid_summary(
        read_table(spark, root, "observations"), read_table(spark, root, "stations")
    )
    write_table(summary, root, "summary", cluster_by=summary_curve() if curve else None)


def refresh_summary(
    spark: SparkSession, root: str, ranges: list[str], curve: bool = False
) -> None:
    """The table ``summary`` after observations of some key ranges have changed.

    A key begins with the year, and a row of the summary belongs to one year: so only observations
    of these ranges are read, and the rows of all other years are carried over. After a change of
    stations ``build_summary`` has to make all of it.
    """
    changed = seasonal_grid_summary(
        read_key_ranges(spark, root, "observations", ranges), read_table(spark, root, "stations")
    )
    length = KEY_RANGES["observations"][1]
    year = F.substring(F.concat(F.col("year").cast("string"), F.lit(":")), 1, length)
    # Years of less than three digits share a range with months; they lie before the grid's first.
    carried = read_table(spark, root, "summary").where(~year.isin(ranges))
    order = summary_curve() if curve else None
    write_table(carried.unionByName(changed), root, "summary", cluster_by=order)


def build_area_sums(spark: SparkSession, root: str) -> None:
    """The stored summary to the tables ``area_extent`` and ``area_sums`` for batches of areas.

    To be made again whenever the summary is; ``read_area_sums`` gives both.
    """
    summary = read_table(spark, root, "summary")
    write_table(area_extent(summary), root, "area_extent", cluster_by=("year_min",))
    write_table(area_sums(summary), root, "area_sums", cluster_by=("latitude", "longitude", "year"))


def read_area_sums(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """What ``area_average_batch`` takes as ``prepared``."""
    return read_table(spark, root, "area_extent"), read_table(spark, root, "area_sums")
