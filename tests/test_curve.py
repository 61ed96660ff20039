import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pathlib import Path

import gridclimate as gc
from gridclimate.functions.geo import curve_place
from gridclimate.sinks.tables import summary_curve

BOXES = {
    "wide": {"latitude": (10, 12), "longitude": (-90, 90), "year": (1900, 1963)},
    "tall": {"latitude": (-60, 60), "longitude": (20, 22), "year": (1900, 1963)},
    "long": {"latitude": (10, 12), "longitude": (20, 22), "year": (1900, 1963)},
    "short": {"latitude": (-60, 60), "longitude": (-90, 90), "year": (1910, 1910)},
}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A grid of 64 latitudes, longitudes and years, in both orders, in many files."""
    grid = spark.range(64**3).selectExpr(
        "CAST(2 * (id % 64) - 64 AS DOUBLE) AS latitude",
        "CAST(4 * (id DIV 64 % 64) - 128 AS DOUBLE) AS longitude",
        "CAST(1900 + id DIV 4096 AS INT) AS year", "'FALL' AS season", "CAST(id % 77 AS DOUBLE) AS avg_temp",
        "1L AS data_points", "array('AA') AS stations",
    ).withColumn("key", F.concat_ws(":", "latitude", "longitude", "year", "season"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {name: spark.conf.get(name) for name in settings}
    roots = {}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for order, columns in (("plain", None), ("curve", summary_curve())):
            roots[order] = str(tmp_path_factory.mktemp(order))
            gc.write_table(grid, roots[order], "summary", cluster_by=columns)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return roots


def groups_read(root, box):
    """Parts of files whose least and greatest values don't rule the box out, and all parts."""
    read = total = 0
    for path in Path(root).rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            columns = {group.column(c).path_in_schema: group.column(c).statistics for c in range(group.num_columns)}
            read += all(columns[n].max >= low and columns[n].min <= high for n, (low, high) in box.items())
            total += 1
    return read, total


def test_any_shape_skips_most(stored):
    read = {o: {b: groups_read(root, box) for b, box in BOXES.items()} for o, root in stored.items()}
    print(read)
    for box in ("wide", "tall", "long", "short"):
        here, total = read["curve"][box]
        assert here <= 0.55 * total, box
    assert read["curve"]["short"][0] < 0.5 * read["plain"]["short"][0]
    assert read["curve"]["tall"][0] < 0.8 * read["plain"]["tall"][0]


def test_answers_are_the_same(spark, stored):
    for box in BOXES.values():
        (a, b), (c, d), (e, f) = box.values()
        answers = {
            gc.area_average(gc.read_table(spark, root, "summary"), a, c, b, d, e, f).collect()[0]
            for root in stored.values()
        }
        assert len(answers) == 1


def test_places_on_the_curve(spark):
    rows = spark.createDataFrame(
        [(-90.0, -180.0, 1850), (90.0, 180.0, 2100), (float("nan"), 1e300, 9999), (float("-inf"), 3.0, -5)],
        "latitude double, longitude double, year int",
    ).select(curve_place(*[F.col(c) for c in ("latitude", "longitude", "year")]).alias("p"))
    places = [r.p for r in rows.collect()]
    assert places[0] == 0 and all(0 <= p < 1 << 27 for p in places)
