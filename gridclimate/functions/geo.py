"""Whole-degree cells: a coordinate belongs to the cell of its rounded latitude and longitude."""

from decimal import ROUND_HALF_UP, Decimal
from math import isinf

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell_of(coordinate: Column) -> Column:
    """Nearest whole degree, halves away from zero. +180 and -180 stay two cells."""
    return F.round(coordinate)


def cell_of_value(coordinate: float) -> float:
    """``cell_of`` for one Python number."""
    if isinf(coordinate):
        return coordinate
    return float(Decimal(coordinate).quantize(Decimal(1), rounding=ROUND_HALF_UP)) + 0.0


# The steps of a space-filling curve on each side: whole degrees and years from these on.
CURVE_FROM = {"latitude": (-90, 8), "longitude": (-180, 9), "year": (1850, 8)}
CURVE_BITS = 9


def curve_place(latitude: Column, longitude: Column, year: Column) -> Column:
    """The place on a Z-order curve through latitudes, longitudes and years.

    The bits of the three are taken in turn, the greatest first, so rows near each other on the
    curve are near in all three. Values beyond a side count as its end.
    """
    place = F.lit(0).cast("long")
    for k, (value, (least, bits)) in enumerate(
        zip((latitude, longitude, year), CURVE_FROM.values())
    ):
        last = F.lit(float(least + (1 << bits) - 1))
        inside = F.greatest(F.nanvl(value.cast("double"), last), F.lit(float(least)))
        step = F.floor(F.least(inside, last)).cast("long") - least
        for bit in range(bits):
            own = F.shiftleft(F.shiftright(step, bit).bitwiseAND(1), 3 * (bit + CURVE_BITS - bits) + 2 - k)
            place = place.bitwiseOR(own)
    return place
