"""Single requests on the summary: one coordinate, one area, and the heat-map feed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell_of_value
from ..functions.text import SEASONS
from ..schemas import ENTRY, WIRE_NAMES
from ..sinks.text import text_values
from .requests import AreaBounds, area_bounds, parse_coordinate


def _at_coordinate(lat, lon, compat: bool) -> Column:
    if not compat:
        here = [cell_of_value(parse_coordinate(v)) for v in (lat, lon)]
        return (F.col("latitude") == here[0]) & (F.col("longitude") == here[1])
    same = F.lit(True)
    for name, value in (("latitude", lat), ("longitude", lon)):
        same = same & (F.col(name).cast("string") == str(value))
        try:  # equal text means equal numbers, and the numbers can prune files
            same = same & (F.col(name) == float(value))
        except ValueError:
            pass
    return same


def _in_area(b: AreaBounds, compat: bool) -> Column:
    ranges = {
        "latitude": (b.latitude1, b.latitude2),
        "longitude": (b.longitude1, b.longitude2),
        "year": (b.year_from, b.year_to),
    }
    inside = F.lit(True)
    for name, (low, high) in ranges.items():
        if compat:  # both sides as text, byte by byte
            text = F.col(name).cast("string")
            within = text.between(F.lit(low).cast("string"), F.lit(high).cast("string"))
        else:
            within = F.col(name).between(low, high)
        inside = inside & within
    return inside


def coordinate_summary(summary: DataFrame, lat, lon, compat: bool = False) -> DataFrame:
    """All seasons of the cell that holds a coordinate, in key order.

    With ``compat``, the coordinate must be the text of the cell itself, such as ``"45.0"``.
    """
    return summary.where(_at_coordinate(lat, lon, compat)).orderBy("key")


def _named(name: str, wire: bool) -> str:
    return WIRE_NAMES.get(name, name) if wire else name


def _entries(wire: bool) -> Column:
    """The seasons of the group as a list of entries in key order."""
    names = ENTRY.fieldNames()
    keyed = F.sort_array(F.collect_list(F.struct("key", *names)))
    return F.transform(keyed, lambda e: F.struct(*[e[name].alias(_named(name, wire)) for name in names]))


def coordinate_document(
    summary: DataFrame, lat, lon, compat: bool = False, wire: bool = False
) -> DataFrame:
    """One nested row for one coordinate, with an empty list where there is no data.

    The list holds one cell: one entry per year and season. With ``wire``, the names are those
    of ``schemas.WIRE_NAMES``.
    """
    matching = summary.where(_at_coordinate(lat, lon, compat))
    data_list = _named("data_list", wire)
    return matching.agg(_entries(wire).alias(data_list)).select(
        F.lit(lat).alias(_named("latitude", wire)), F.lit(lon).alias("longitude"), data_list
    )


def area_entries(
    summary: DataFrame, lat1, lon1, lat2, lon2, year1, year2, compat: bool = False
) -> DataFrame:
    """All summary rows of a rectangle and a range of years, bounds included, in key order.

    With ``compat``, bounds and values are compared as text.
    """
    bounds = area_bounds(lat1, lon1, lat2, lon2, year1, year2)
    return summary.where(_in_area(bounds, compat)).orderBy("key")


def _area_header(bounds: AreaBounds) -> list[Column]:
    return [F.lit(value).alias(name) for name, value in bounds._asdict().items()]


def _area_mean(compat: bool) -> Column:
    mean = F.avg("avg_temp")
    return F.coalesce(mean, F.lit(0.0)) if compat else mean


def area_average(
    summary: DataFrame, lat1, lon1, lat2, lon2, year1, year2, compat: bool = False
) -> DataFrame:
    """One row: the ordered bounds, the plain mean of the cell averages and their number.

    An area without data has a NULL mean, or 0.0 with ``compat``.
    """
    bounds = area_bounds(lat1, lon1, lat2, lon2, year1, year2)
    return (
        summary.where(_in_area(bounds, compat))
        .agg(_area_mean(compat).alias("average_temp"), F.count(F.lit(1)).alias("n_entries"))
        .select(*_area_header(bounds), "average_temp", "n_entries")
    )


def area_document(
    summary: DataFrame,
    lat1,
    lon1,
    lat2,
    lon2,
    year1,
    year2,
    compat: bool = False,
    wire: bool = False,
) -> DataFrame:
    """The JSON document of an area, line by line: columns ``part``, ``key`` and ``json``.

    An area may hold the whole grid, so its entries are never gathered in one row. In the order
    of ``part`` and ``key`` the lines are one document: the opening with bounds and mean, one
    line per entry, and the closing. All values are text. ``sinks.write_document`` stores it.
    With ``wire``, the names are those of ``schemas.WIRE_NAMES``.
    """
    bounds = area_bounds(lat1, lon1, lat2, lon2, year1, year2)
    inside = summary.where(_in_area(bounds, compat))
    keep_nulls = {"ignoreNullFields": "false"}

    totals = inside.agg(_area_mean(compat).alias("average_temp"))
    header = text_values(totals.select(*_area_header(bounds), "average_temp"))
    columns = [F.col(name).alias(_named(name, wire)) for name in header.columns]
    opening = F.to_json(F.struct(*columns), keep_nulls)
    begin = f',"{_named("data_list", wire)}":['
    first = header.select(
        F.lit(0).alias("part"),
        F.lit("").alias("key"),
        F.concat(F.rtrim(opening, F.lit("}")), F.lit(begin)).alias("json"),
    )

    names = ENTRY.fieldNames()
    entry = F.to_json(F.struct(*[F.col(n).alias(_named(n, wire)) for n in names]), keep_nulls)
    first_key = inside.agg(F.min("key")).scalar()
    comma = F.when(F.col("key") == first_key, "").otherwise(",")
    middle = text_values(inside.select("key", *names)).select(
        F.lit(1).alias("part"), "key", F.concat(comma, entry).alias("json")
    )

    last = summary.sparkSession.range(1).select(
        F.lit(2).alias("part"), F.lit("").alias("key"), F.lit("]}").alias("json")
    )
    return first.unionByName(middle).unionByName(last).orderBy("part", "key")


def heatmap_feed(summary: DataFrame, lat, lon) -> DataFrame:
    """Mean temperatures of one coordinate: one row per year, one column per season."""
    here = summary.where(_at_coordinate(lat, lon, compat=False))
    return (
        here.groupBy("year")
        .pivot("season", list(SEASONS))
        .agg(F.max("avg_temp"))
        .orderBy("year")
    )

