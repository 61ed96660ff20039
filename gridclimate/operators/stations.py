"""Fixed-width station and country lines to typed rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import number_of
from ..schemas import STATION

# First and end position of each station column, counted from 0, end left out.
STATION_RANGES = {
    "id": (0, 11),
    "latitude": (12, 20),
    "longitude": (21, 30),
    "elevation": (31, 37),
    "state": (38, 40),
    "stn_name": (41, 71),
    "gsn": (72, 75),
    "hcn_crn": (76, 79),
    "wmo_id": (80, None),
    "country_cd": (0, 2),
}
COUNTRY_RANGES = {"code": (0, 2), "name": (3, None)}


def _sliced(lines: DataFrame, ranges: dict, what: str) -> DataFrame:
    """Cut each line into columns; a line too short for the last one fails the job."""
    least = max(first if end is None else end for first, end in ranges.values())
    value = F.col("value")
    checked = lines.select(
        F.when(F.length(value) >= least, value)
        .otherwise(F.raise_error(F.concat(F.lit(f"{what} line is too short: "), value)))
        .alias("value")
    )

    def piece(first: int, end: int | None) -> Column:
        length = F.length(value) if end is None else F.lit(end - first)
        return F.substring(value, F.lit(first + 1), length)

    return checked.select(*[piece(*span).alias(name) for name, span in ranges.items()])


def parse_stations(lines: DataFrame) -> DataFrame:
    """Station rows without the country name. Text columns keep their blanks."""
    return _sliced(lines, STATION_RANGES, "station").select(
        "id",
        number_of(F.col("latitude"), "double").alias("latitude"),
        number_of(F.col("longitude"), "double").alias("longitude"),
        *[name for name in list(STATION_RANGES) if name not in ("id", "latitude", "longitude")],
    )


def parse_countries(lines: DataFrame) -> DataFrame:
    return _sliced(lines, COUNTRY_RANGES, "country")


def add_country(stations: DataFrame, countries: DataFrame, compat: bool = False) -> DataFrame:
    """Add the country name by code; NULL where the code is unknown.

    With ``compat``, an unknown code fails the job. Of several names for one code the greatest
    is taken. There is no broadcast hint: Spark broadcasts the names while they stay below
    ``spark.sql.autoBroadcastJoinThreshold``, and splits hot codes of a shuffled join otherwise.
    """
    names = countries.groupBy("code").agg(F.max("name").alias("country_name"))
    named = stations.join(names, stations["country_cd"] == names["code"], "left")
    name = F.col("country_name")
    if compat:
        name = F.when(name.isNotNull(), name).otherwise(
            F.raise_error(F.concat(F.lit("unknown country code: "), F.col("country_cd")))
        )
    return named.withColumn("country_name", name).select(*STATION.fieldNames())


def latest_per_station(stations: DataFrame) -> DataFrame:
    """One row per station id, the greatest by its columns in order, so that reruns agree."""
    others = [name for name in stations.columns if name != "id"]
    best = F.max(F.struct(*others))
    return stations.groupBy("id").agg(best.alias("best")).select("id", "best.*")
