"""Column expressions for raw text: splitting, seasons, keys and text renderings."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

# The record layout and the patterns that decide which records count.
FIELD_SEPARATOR = '","'
MIN_FIELDS = 108
STATION_FIELD = 0
DATE_FIELD = 1
PRECIPITATION_FIELD = 102
AVG_TEMP_FIELD = 106
NUMBER = r"\A[-+]?\d+(\.\d+)?\z"
WHOLE = r"\A[-+]?\d+\z"
BLANK_FIELDS = r'\A(",")*\z'

# Months of each season.
SEASON_MONTHS = {
    "WINTER": (12, 1, 2),
    "SPRING": (3, 4, 5),
    "SUMMER": (6, 7, 8),
    "FALL": (9, 10, 11),
}
SEASONS = tuple(SEASON_MONTHS)


def record_fields(line: Column) -> Column:
    """The first ``MIN_FIELDS`` - 1 fields of a record line, then all the rest as one piece."""
    return F.split(line, FIELD_SEPARATOR, MIN_FIELDS)


def has_enough_fields(fields: Column) -> Column:
    """Whether a record has ``MIN_FIELDS`` fields, not counting blank ones at its end.

    The rest of the line then is a field, or several, that are not all blank.
    """
    rest = F.get(fields, F.lit(MIN_FIELDS - 1))
    return (F.size(fields) >= MIN_FIELDS) & ~rest.rlike(BLANK_FIELDS)


def date_parts(date: Column) -> Column:
    """Parts between the dashes of a date, not counting blank ones at its end."""
    return F.split(F.rtrim(date, F.lit("-")), "-")


def is_number(text: Column) -> Column:
    """Plain decimal text in full: no blanks, no exponent, digits on both sides of the point."""
    return text.rlike(NUMBER)


def number_of(text: Column, type_name: str) -> Column:
    """Text as a number; text that is none fails the job, whatever the session's ANSI mode.

    A whole number is digits with or without a sign in full, without the blanks a cast forgives.
    """
    message = F.concat(F.lit(f"not of type {type_name}: "), text)
    number = text.try_cast(type_name)
    if type_name == "int":
        number = F.when(text.rlike(WHOLE), number)
    return F.coalesce(number, F.raise_error(message).cast(type_name))


def season_of(month: Column) -> Column:
    """Season of a month; blank for months outside 1 to 12. December stays in its own year."""
    season = F.lit("")
    for name, months in SEASON_MONTHS.items():
        season = F.when(month.isin(*months), name).otherwise(season)
    return season


def observation_key(year: Column, month: Column, station_code: Column) -> Column:
    return F.concat_ws(":", year.cast("string"), month.cast("string"), station_code)


def summary_key(latitude: Column, longitude: Column, year: Column, season: Column) -> Column:
    parts = (latitude, longitude, year)
    return F.concat_ws(":", *[p.cast("string") for p in parts], season)


def as_text(value: Column, data_type: DataType) -> Column:
    """Text of a value; lists are joined with a semicolon, as they sit in comma-separated files."""
    if isinstance(data_type, ArrayType):
        return F.array_join(value, ";")
    return value.cast("string")
