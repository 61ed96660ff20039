"""Monthly record lines to typed observations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    AVG_TEMP_FIELD,
    DATE_FIELD,
    FIELD_SEPARATOR,
    PRECIPITATION_FIELD,
    STATION_FIELD,
    date_parts,
    has_enough_fields,
    is_number,
    number_of,
    observation_key,
    record_fields,
    season_of,
)
from ..schemas import OBSERVATION


def drop_header_lines(lines: DataFrame, compat: bool = False) -> DataFrame:
    """Drop lines whose first field is the column title, also with archive bytes in front of it.

    With ``compat``, every line that holds the title anywhere goes, data lines included.
    """
    if compat:
        return lines.where(~F.col("value").contains("STATION"))
    first = F.substring_index("value", FIELD_SEPARATOR, 1)
    return lines.where(~first.endswith('"STATION'))


def parse_observations(lines: DataFrame, compat: bool = False) -> DataFrame:
    """Observations of the usable record lines; see ``schemas.OBSERVATION``.

    Kept are records with enough fields, a date of two parts and a plain number as temperature.
    Among these, a date part that is no integer or a precipitation that is neither blank nor a
    number fails the job.
    """
    # Filters are not pushed below explode, so each line is split once, not once per use.
    records = drop_header_lines(lines, compat).select(
        F.explode(F.array(record_fields(F.col("value")))).alias("fields")
    )

    def field(position):
        return F.get("fields", F.lit(position))

    date = date_parts(field(DATE_FIELD))
    temperature, precipitation = field(AVG_TEMP_FIELD), field(PRECIPITATION_FIELD)
    usable = has_enough_fields(F.col("fields")) & (F.size(date) == 2) & is_number(temperature)
    # Bad text raises, so each number carries the condition with it wherever it is worked out.
    typed = records.where(usable).select(
        F.replace(field(STATION_FIELD), F.lit('"'), F.lit("")).alias("station_code"),
        F.when(usable, number_of(F.get(date, F.lit(0)), "int")).alias("year"),
        F.when(usable, number_of(F.get(date, F.lit(1)), "int")).alias("month"),
        F.when(usable & (precipitation == ""), F.lit(float("nan")))
        .when(usable, number_of(precipitation, "double"))
        .alias("precipitation"),
        F.when(usable, temperature.cast("double")).alias("avg_temp"),
    )
    return _with_derived_columns(typed)


def _with_derived_columns(typed: DataFrame) -> DataFrame:
    year, month = F.col("year"), F.col("month")
    return typed.select(
        observation_key(year, month, F.col("station_code")).alias("key"),
        "station_code",
        "year",
        "month",
        season_of(month).alias("season"),
        "precipitation",
        "avg_temp",
    ).select(*OBSERVATION.fieldNames())


def latest_per_key(observations: DataFrame) -> DataFrame:
    """One observation per key: the one with the greatest temperature, then precipitation.

    A missing precipitation (NaN) comes after every real one. Copies are merged by hashing before
    both shuffles, first those of one temperature, so a key with very many copies sends one row
    per task and temperature. The key and the season follow from the grouping columns; they are
    made anew, not shuffled.
    """
    real = F.nanvl("precipitation", F.lit(None).cast("double"))
    keys = ["station_code", "year", "month"]
    kept = (
        observations.groupBy(*keys, "avg_temp").agg(F.max(real).alias("precipitation"))
        .groupBy(*keys)
        .agg(
            F.max_by("precipitation", "avg_temp").alias("precipitation"),
            F.max("avg_temp").alias("avg_temp"),
        )
    )
    missing = F.coalesce("precipitation", F.lit(float("nan")))
    return _with_derived_columns(kept.withColumn("precipitation", missing))


def observations_by_season(observations: DataFrame) -> DataFrame:
    """Number of observations per year and season."""
    return observations.groupBy("year", "season").agg(F.count(F.lit(1)).alias("n_obs"))
