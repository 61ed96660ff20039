"""The seasonal grid: observations and stations to one row per cell, year and season."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell_of
from ..functions.text import summary_key
from ..schemas import SUMMARY

# Fixed value: first year of the grid.
FIRST_YEAR = 1900


def join_stations(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Observations from ``FIRST_YEAR`` on, with the coordinates of their known station."""
    recent = observations.where(F.col("year") >= FIRST_YEAR)
    places = stations.select("id", "latitude", "longitude")
    return recent.join(places, recent["station_code"] == places["id"], "inner").select(
        "station_code", "year", "month", "season", "avg_temp", "latitude", "longitude"
    )


def snap_to_grid(located: DataFrame) -> DataFrame:
    """Add the cell of each row's coordinates."""
    return located.withColumns(
        {
            "cell_latitude": cell_of(F.col("latitude")),
            "cell_longitude": cell_of(F.col("longitude")),
        }
    )


def seasonal_grid_summary(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """Mean temperature, number of data points and stations per cell, year and season.

    Sums per station, year and season come first. They are plain sums and counts, merged before
    the shuffle by hash aggregation, so neither a station nor a cell with very many observations
    burdens one task; the join then sees each station only a few times a year, and the station
    list of a cell is gathered from distinct stations only, never from observations.
    """
    per_station = (
        observations.where(F.col("year") >= FIRST_YEAR)
        .groupBy("station_code", "year", "season")
        .agg(F.sum("avg_temp").alias("temp_sum"), F.count("avg_temp").alias("points"))
    )
    cells = snap_to_grid(stations).select("id", "cell_latitude", "cell_longitude")
    points = F.sum("points")
    return (
        per_station.join(cells, per_station["station_code"] == cells["id"], "inner")
        .groupBy(
            F.col("cell_latitude").alias("latitude"),
            F.col("cell_longitude").alias("longitude"),
            "year",
            "season",
        )
        .agg(
            F.when(points > 0, F.sum("temp_sum") / points).alias("avg_temp"),
            points.alias("data_points"),
            F.sort_array(F.collect_set("station_code")).alias("stations"),
        )
        .withColumn("key", summary_key(*[F.col(c) for c in ("latitude", "longitude", "year", "season")]))
        .select(*SUMMARY.fieldNames())
    )
