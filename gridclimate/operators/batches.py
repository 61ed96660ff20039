"""Whole tables of requests on the summary: coordinates and areas."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell_of
from ..functions.ranges import block_holding, blocks_covering, top_level
from .requests import EARLY_YEAR, LEAST_YEAR, NOT_NUMBERS, SAME_CORNERS, coordinate_of, year_of

# Dimensions of the grid, and the ordered bounds of a request on each.
BOUNDS = {
    "latitude": ("latitude1", "latitude2"),
    "longitude": ("longitude1", "longitude2"),
    "year": ("year_from", "year_to"),
}
DIMENSIONS = tuple(BOUNDS)

# Values beyond this are not counted from the least one but put in order one by one: infinite ones,
# and numbers that are no place on a globe.
FAR = float(2**31)

SAMPLED = 64  # of so many areas one tells which blocks very many share

CELL = ["cell_latitude", "cell_longitude"]


def coordinate_summary_batch(
    summary: DataFrame, points: DataFrame, requests_per_task: int = 100_000
) -> DataFrame:
    """The seasons of the cell of every requested coordinate.

    ``points`` has the columns ``request_id``, which should tell requests apart, ``latitude`` and
    ``longitude``. A request without data keeps one row with NULLs.

    A cell that is asked for more than ``requests_per_task`` times is dealt out: its requests go
    to as many parts as needed, and its few summary rows to every part. Requests are counted
    with sums merged before the shuffle, and cells nobody asks for drop out on the way.
    """
    asked = points.select(
        "request_id",
        "latitude",
        "longitude",
        cell_of(F.col("latitude")).alias("cell_latitude"),
        cell_of(F.col("longitude")).alias("cell_longitude"),
    )
    parts = F.ceil(F.count(F.lit(1)) / requests_per_task).cast("int")
    counted = asked.groupBy(*CELL).agg(parts.alias("parts"))

    own_part = F.pmod(F.xxhash64("request_id"), F.col("parts")).cast("int")
    nowhere = F.col("cell_latitude").isNull() | F.col("cell_longitude").isNull()
    dealt_out = asked.join(counted.where(F.col("parts") > 1), CELL, "left").select(
        *asked.columns,
        F.when(nowhere, F.hash("request_id")).otherwise(F.coalesce(own_part, F.lit(0))).alias("part"),
    )
    cells = (
        summary.withColumnsRenamed({"latitude": "cell_latitude", "longitude": "cell_longitude"})
        .join(counted, CELL)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .drop("parts")
    )
    return dealt_out.join(cells, [*CELL, "part"], "left").drop(*CELL, "part")


def _checked(boxes: DataFrame) -> DataFrame:
    """Requests with their bounds in order and the reason where a request is bad."""
    coordinates = ["latitude1", "longitude1", "latitude2", "longitude2"]
    kinds = dict(boxes.dtypes)
    typed = boxes.select(
        "request_id",
        *[coordinate_of(name, kinds[name]).alias(name) for name in coordinates],
        *[year_of(name).alias(name) for name in ("year1", "year2")],
    )
    unknown = F.col("year1").isNull() | F.col("year2").isNull()
    for name in coordinates:
        unknown = unknown | F.col(name).isNull() | F.isnan(name)
    same = (F.col("latitude1") == F.col("latitude2")) & (F.col("longitude1") == F.col("longitude2"))
    error = (
        F.when(unknown, NOT_NUMBERS)
        .when(same, SAME_CORNERS)
        .when(F.least("year1", "year2") < LEAST_YEAR, EARLY_YEAR)
    )
    return typed.select(
        "request_id",
        F.least("latitude1", "latitude2").alias("latitude1"),
        F.least("longitude1", "longitude2").alias("longitude1"),
        F.greatest("latitude1", "latitude2").alias("latitude2"),
        F.greatest("longitude1", "longitude2").alias("longitude2"),
        F.least("year1", "year2").alias("year_from"),
        F.greatest("year1", "year2").alias("year_to"),
        error.alias("error"),
    )


def _extent(cells: DataFrame) -> Column:
    """Least and greatest value of each dimension of the grid and its far values, as one struct.

    Spark finds them with one aggregate over three columns, as a scalar subquery.
    """
    parts = []
    for name in DIMENSIONS:
        place = F.col(name).cast("double")
        near = F.when(F.abs(place) <= FAR, place)
        far = F.collect_set(F.when(F.abs(place) > FAR, place))
        parts += [
            F.min(near).alias(f"{name}_min"),
            F.max(near).alias(f"{name}_max"),
            far.alias(f"{name}_far"),
        ]
    return cells.agg(F.struct(*parts)).scalar()


def _with_extent(rows: DataFrame, extent: Column) -> DataFrame:
    """The rows with the extent as a column.

    An explode of one element stands between it and its uses: a plain column would be replaced by
    the subquery wherever it is used, once for every bound of every dimension.
    """
    return rows.select("*", F.explode(F.array(extent)).alias("extent"))


def _first(name: str, bound: Column) -> Column:
    """Number of positions below a bound: the position of the first value at or above it.

    Positions are in order of values: each far value has one, and so has each whole step from the
    least near value to the greatest. The extent is in a column of that name.
    """
    bound = bound.cast("double")
    least, greatest = F.col(f"extent.{name}_min"), F.col(f"extent.{name}_max")
    near = F.ceil(F.least(F.greatest(bound, least), greatest + 1) - least)
    far = F.size(F.filter(f"extent.{name}_far", lambda value: value < bound))
    return F.coalesce(near, F.lit(0)) + far


def _last(name: str, bound: Column) -> Column:
    """The position of the last value at or below a bound; one less than the first if none is."""
    bound = bound.cast("double")
    least, greatest = F.col(f"extent.{name}_min"), F.col(f"extent.{name}_max")
    near = F.floor(F.greatest(F.least(bound, greatest), least - 1) - least)
    far = F.size(F.filter(f"extent.{name}_far", lambda value: value <= bound))
    return F.coalesce(near, F.lit(-1)) + far


def _block_sums(cells: DataFrame, extent: Column) -> DataFrame:
    """Sum and number of averages for every block of latitudes × longitudes × years.

    One dimension after the other, so each step multiplies the rows by the levels of one
    dimension only and merges them again before the shuffle. The grid bounds the result: about
    twice its cells and years in each dimension, whatever the number of observations.
    """
    tops = {name: f"{name}_top" for name in DIMENSIONS}
    sums = _with_extent(cells, extent).select(
        *[_first(name, F.col(name)).alias(name) for name in DIMENSIONS],
        *[_top(name).alias(top) for name, top in tops.items()],
        F.col("avg_temp").alias("temp_sum"),
        F.col("avg_temp").isNotNull().cast("long").alias("temps"),
        F.lit(1).cast("long").alias("entries"),
    )
    for name in DIMENSIONS:
        levels = F.sequence(F.lit(0), F.col(tops.pop(name)))
        blocks = {d: F.col(d) for d in DIMENSIONS}
        blocks[name] = block_holding(F.col(name), F.col("level"))
        # The tops still to be used are the same in all rows.
        sums = (
            sums.select("*", F.explode(levels).alias("level"))
            .groupBy(*[block.alias(d) for d, block in blocks.items()], *tops.values())
            .agg(*_totals())
        )
    return sums


def _top(name: str) -> Column:
    """The level of blocks whose first one holds all positions of a dimension."""
    least, greatest = F.col(f"extent.{name}_min"), F.col(f"extent.{name}_max")
    last = F.coalesce((greatest - least).cast("long"), F.lit(-1)) + F.size(f"extent.{name}_far")
    return top_level(F.greatest(last, F.lit(0)))


def _totals() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("temp_sum", "temps", "entries")]


def area_extent(summary: DataFrame) -> DataFrame:
    """The extent of the grid in one row, as ``area_average_batch`` takes it when stored."""
    return summary.sparkSession.range(1).select(_extent(_placed(summary)).alias("extent")).select(
        "extent.*"
    )


def area_sums(summary: DataFrame) -> DataFrame:
    """The sums of all blocks of the grid, as ``area_average_batch`` takes them when stored."""
    cells = _placed(summary)
    return _block_sums(cells, _extent(cells))


def _placed(summary: DataFrame) -> DataFrame:
    """A cell at no latitude or longitude lies in no area."""
    return summary.where(~F.isnan("latitude") & ~F.isnan("longitude"))


def _pieces(areas: DataFrame, ends: list[str]) -> DataFrame:
    """A row for each block that an area is put together from."""
    covers = [blocks_covering(f"{name}_first", f"{name}_last").alias(name) for name in BOUNDS]
    pieces = areas.select(*ends, "parts", *covers)
    for name in BOUNDS:
        # not the plain explode: Spark would work out the covers once more to skip empty ones
        pieces = pieces.withColumn(name, F.explode_outer(name))
    return pieces


def _with_sums(
    areas: DataFrame, ends: list[str], sums: DataFrame, pieces_per_task: int
) -> DataFrame:
    """The pieces of areas with the sums of their blocks; pieces outside the grid drop out.

    The pieces of a block that very many areas share are dealt out to several slots, and its one
    row of sums to each of them. Which blocks these are is told by one area in ``SAMPLED``, chosen
    by a hash; the answers don't depend on it.
    """
    chosen = areas.where(F.pmod(F.xxhash64(*ends), F.lit(SAMPLED)) == 0)
    slots = F.ceil(F.count(F.lit(1)) * SAMPLED / pieces_per_task).cast("int")
    hot = _pieces(chosen, ends).groupBy(*DIMENSIONS).agg(slots.alias("slots"))
    hot = hot.where(F.col("slots") > 1)
    number = F.pmod(F.xxhash64(*ends, F.lit(1)), F.col("slots"))
    dealt_out = _pieces(areas, ends).join(hot, list(DIMENSIONS), "left").select(
        *ends, "parts", *DIMENSIONS, F.coalesce(number, F.lit(0)).cast("int").alias("slot")
    )
    every_slot = F.explode(F.sequence(F.lit(0), F.coalesce("slots", F.lit(1)) - 1)).alias("slot")
    spread = sums.join(hot, list(DIMENSIONS), "left").select(*sums.columns, every_slot)
    return dealt_out.join(spread, [*DIMENSIONS, "slot"]).drop("slot")


def area_average_batch(
    summary: DataFrame,
    boxes: DataFrame,
    requests_per_task: int = 100_000,
    prepared: tuple[DataFrame, DataFrame] | None = None,
    pieces_per_task: int = 1_000_000,
) -> DataFrame:
    """The plain mean of the cell averages, and their number, for every requested area.

    ``boxes`` has the columns ``request_id``, ``latitude1``, ``longitude1``, ``latitude2``,
    ``longitude2``, ``year1`` and ``year2``. Every request keeps its row: without data the mean
    is NULL and the number 0, and a bad request says why in ``error``. Bounds are read as for
    single requests (see ``requests``); any bounds are exact, infinite ones too.

    An area is put together from the sums of a few large blocks (see ``functions.ranges``)
    found by an equi-join, so it costs some hundred rows at most and never one per cell and year.
    Equal areas are worked out once; an area that is asked for more than ``requests_per_task``
    times is dealt out to as many parts as needed, and so is a block that more than
    ``pieces_per_task`` different areas share. Bad requests are answered without a join.

    ``prepared`` is the extent and the sums of the same summary as ``plans.build_area_sums`` has
    stored them; a batch then only joins. Without it they are made anew.
    """
    cells = _placed(summary)
    if prepared is None:
        extent, sums = _extent(cells), _block_sums(cells, _extent(cells))
    else:
        stored, sums = prepared
        extent = stored.select(F.struct(*stored.columns)).scalar()
    checked = _checked(boxes)
    ends = {}
    for name, (low, high) in BOUNDS.items():
        ends |= {f"{name}_first": _first(name, F.col(low)), f"{name}_last": _last(name, F.col(high))}
    good = _with_extent(checked.where(F.col("error").isNull()), extent)
    asked = good.select(*checked.columns, *[place.alias(name) for name, place in ends.items()])

    parts = F.ceil(F.count(F.lit(1)) / requests_per_task).cast("int")
    areas = asked.groupBy(*ends).agg(parts.alias("parts"))
    found = _with_sums(areas, list(ends), sums, pieces_per_task)
    totals = found.groupBy(*ends, "parts").agg(*_totals())

    hot = areas.where(F.col("parts") > 1)
    own_part = F.pmod(F.xxhash64("request_id"), F.col("parts")).cast("int")
    dealt_out = asked.join(hot, list(ends), "left").select(
        *asked.columns, F.coalesce(own_part, F.lit(0)).alias("part")
    )
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    spread = totals.withColumn("part", every_part).drop("parts")

    mean = F.when(F.col("temps") > 0, F.col("temp_sum") / F.col("temps"))
    answered = dealt_out.join(spread, [*ends, "part"], "left").select(
        *checked.columns[:-1],
        mean.alias("average_temp"),
        F.coalesce("entries", F.lit(0)).cast("long").alias("n_entries"),
        "error",
    )
    refused = checked.where(F.col("error").isNotNull()).select(
        *checked.columns[:-1],
        F.lit(None).cast("double").alias("average_temp"),
        F.lit(0).cast("long").alias("n_entries"),
        "error",
    )
    return answered.unionByName(refused)
