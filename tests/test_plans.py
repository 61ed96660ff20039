"""The physical plans are the ones meant for large data."""

import re

import __spark_entry__ as entry
import pytest
import samples
from pyspark.sql import functions as F

import gridclimate as gc
from gridclimate import fixtures
from gridclimate.operators import batches


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", text))


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    root = entry._tables(spark, sf_dir)
    return {name: gc.read_table(spark, root, name) for name in ("observations", "stations", "summary")}


def test_grid(stored):
    text = plan(gc.seasonal_grid_summary(stored["observations"], stored["stations"]))
    assert shuffles(text) == 2
    assert "GreaterThanOrEqual(year,1900)" in text
    assert "ReadSchema: struct<station_code:string,year:int,season:string,avg_temp:double>" in text
    assert "ReadSchema: struct<id:string,latitude:double,longitude:double>" in text
    # sums per station are merged by hash before the shuffle, and the join comes after
    assert re.search(r"HashAggregate.*partial_sum\(avg_temp", text)
    assert text.index("BroadcastHashJoin") < text.index("partial_sum(avg_temp")


def test_grid_without_broadcast(spark, stored):
    """Beyond the size for a broadcast the join is a shuffled one, of station sums."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = gc.seasonal_grid_summary(stored["observations"], stored["stations"])
        text = plan(rows)
        assert "SortMergeJoin" in text and "Broadcast" not in text
        assert rows.exceptAll(stored["summary"]).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_are_split_once(spark, sf_dir):
    text = plan(entry.parse_observations(spark, sf_dir))
    assert text.count("split(value") == 1


def test_country_names_are_broadcast_while_small(spark, sf_dir):
    assert "BroadcastHashJoin" in plan(entry.stations_with_country(spark, sf_dir))


def test_lookups_are_pushed_down(stored):
    text = plan(gc.coordinate_summary(stored["summary"], 3.3, -2.6))
    assert "EqualTo(latitude,3.0)" in text and "EqualTo(longitude,-3.0)" in text
    text = plan(gc.area_average(stored["summary"], -5, -1, 10, 5, 1900, 1904))
    for bound in ("GreaterThanOrEqual(latitude,-5.0)", "LessThanOrEqual(longitude,5.0)",
                  "GreaterThanOrEqual(year,1900)"):
        assert bound in text
    assert "ReadSchema: struct<latitude:double,longitude:double,year:int,avg_temp:double>" in text


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("name", ["area_average_batch", "coordinate_summary_batch"])
def test_batches_have_equi_joins_only(spark, sf_dir, name, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        text = plan(entry.queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "HashJoin" in text or "SortMergeJoin" in text


@pytest.mark.parametrize("hot", ["88.0D", "CAST(NULL AS DOUBLE)"])
def test_hot_requests_are_dealt_out(spark, hot):
    """A third of all requests ask for one coordinate, or for none."""
    points = spark.range(60_000).selectExpr(
        "id AS request_id",
        f"IF(id % 3 = 0, {hot}, CAST(id % 170 - 85 AS DOUBLE)) AS latitude",
        "IF(id % 3 = 0, 3.0D, CAST(id % 350 - 175 AS DOUBLE)) AS longitude",
    )
    grid = samples.summary(spark, *[(88.0, 3.0, 1900 + i, "FALL", 1.0, 1) for i in range(3)])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = gc.coordinate_summary_batch(grid, points, requests_per_task=200)
        sizes = [r[0] for r in rows.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == (100_000 if hot == "88.0D" else 60_000)
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8


@pytest.mark.parametrize("hot", ["1.0D", "CAST(NULL AS DOUBLE)"])
def test_hot_areas_are_dealt_out(spark, hot):
    """A third of all requests ask for one area, or are bad."""
    boxes = spark.range(60_000).selectExpr(
        "id AS request_id",
        f"IF(id % 3 = 0, {hot}, CAST(id % 80 AS DOUBLE)) AS latitude1",
        "IF(id % 3 = 0, 3.0D, CAST(id % 170 AS DOUBLE)) AS longitude1",
        "99.0D AS latitude2", "200.0D AS longitude2", "1900 AS year1", "1910 AS year2",
    )
    grid = samples.summary(
        spark, *[(float(i), float(i), 1900 + i % 9, "FALL", 1.0 + i, 1) for i in range(90)]
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = gc.area_average_batch(grid, boxes, requests_per_task=200)
        used = F.sum(F.coalesce("average_temp", F.lit(0.0)) + F.col("n_entries"))
        sizes = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), used).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    sizes = [r.n for r in sizes]
    assert sum(sizes) == 60_000
    assert max(sizes) < 2.5 * sum(sizes) / 8


def test_the_extent_is_worked_out_once_a_plan(spark, sf_dir):
    text = plan(entry.area_average_batch(spark, sf_dir))
    assert text.count("FileScan") <= 24


def test_hot_blocks_are_dealt_out(spark, sf_dir):
    """Many different areas share one block of the grid."""
    ends = [f"{name}_{end}" for name in batches.BOUNDS for end in ("first", "last")]
    areas = spark.range(20_000).selectExpr(
        "id AS latitude_first", "65534L AS latitude_last", "0L AS longitude_first",
        "0L AS longitude_last", "0L AS year_first", "0L AS year_last", "1 AS parts",
    )
    sums = spark.range(1).selectExpr("65534L * 32 AS latitude", "0L AS longitude", "0L AS year",
                                     "1.0D AS temp_sum", "1L AS temps", "1L AS entries")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        sizes = {}
        for most in (10**9, 100):
            rows = batches._with_sums(areas, ends, sums, most)
            parts = rows.groupBy(F.spark_partition_id()).count().select("count").collect()
            sizes[most] = [r[0] for r in parts]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sizes[10**9] == [20_000]
    assert sum(sizes[100]) == 20_000 and len(sizes[100]) == 8
    assert max(sizes[100]) < 2.5 * sum(sizes[100]) / 8


def test_slots_of_blocks_change_no_answer(spark, sf_dir):
    boxes, summary = fixtures.boxes(spark, sf_dir), entry._summary(spark, sf_dir)
    few, usual = (gc.area_average_batch(summary, boxes, pieces_per_task=most) for most in (1, 10**9))
    rounded = lambda rows: sorted(
        (r.request_id, r.n_entries, r.error, r.average_temp and round(r.average_temp, 9)) for r in rows.collect()
    )
    assert rounded(few) == rounded(usual)


def test_no_python_in_any_plan(spark, sf_dir):
    for name, query in entry.climate_queries().items():
        text = plan(query(spark, sf_dir))
        assert "Python" not in text and "Arrow" not in text, name
