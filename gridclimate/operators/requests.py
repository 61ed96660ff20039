"""Checks on the arguments of requests, and bounds put in order.

One rule for single requests and for tables of them. A coordinate is a number, or text of a plain
number or infinity: a point and an exponent are allowed, blanks around it, and one letter d or f
behind it. A year is a whole number of 32 bits, or its digits with or without a sign, nothing else:
no blanks, no point. Everything else, NaN too, is not a number.
"""

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: no year before this one may be asked for.
LEAST_YEAR = 1900

SAME_CORNERS = "the two corners are the same point"
EARLY_YEAR = "a year is before 1900"
NOT_NUMBERS = "a bound is not a number"


class AreaBounds(NamedTuple):
    latitude1: float
    longitude1: float
    latitude2: float
    longitude2: float
    year_from: int
    year_to: int


BLANKS = r"[\x00-\x20]*"
NUMBER = r"[-+]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"
COORDINATE = f"^{BLANKS}({NUMBER})[dDfF]?{BLANKS}$"
YEAR = "^[-+]?[0-9]+$"


def parse_coordinate(value) -> float:
    number = value
    if isinstance(value, str):
        found = re.fullmatch(COORDINATE[1:-1], value)
        number = float(found[1]) if found else None
    if number is None or isinstance(number, bool) or float(number) != float(number):
        raise ValueError(f"{NOT_NUMBERS}: {value!r}")
    return float(number)


def parse_year(value) -> int:
    if not re.fullmatch(YEAR[1:-1], str(value)) or not -(2**31) <= int(value) < 2**31:
        raise ValueError(f"{NOT_NUMBERS}: {value!r}")
    return int(value)


def coordinate_of(name: str, kind: str) -> Column:
    """The same as a column; NULL where it is not a number (or NaN, which the caller refuses)."""
    if kind != "string":
        return F.col(name).try_cast("double")
    text = F.regexp_extract(name, COORDINATE.replace("$", r"\z"), 1)
    return F.when(text != "", text).try_cast("double")


def year_of(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.when(text.rlike(YEAR.replace("$", r"\z")), text).try_cast("int")


def area_bounds(lat1, lon1, lat2, lon2, year1, year2) -> AreaBounds:
    """Bounds in rising order, or ``ValueError`` with the reason. Numbers may be given as text."""
    lat1, lon1, lat2, lon2 = [parse_coordinate(v) for v in (lat1, lon1, lat2, lon2)]
    year1, year2 = parse_year(year1), parse_year(year2)
    if (lat1, lon1) == (lat2, lon2):
        raise ValueError(SAME_CORNERS)
    if min(year1, year2) < LEAST_YEAR:
        raise ValueError(EARLY_YEAR)
    return AreaBounds(
        min(lat1, lat2),
        min(lon1, lon2),
        max(lat1, lat2),
        max(lon1, lon2),
        min(year1, year2),
        max(year1, year2),
    )
