import random

import pytest
from samples import dicts, summary
from pyspark.sql import functions as F

import gridclimate as gc
from gridclimate.functions.ranges import BITS, LEVELS, block_holding, blocks_covering
from gridclimate.operators.requests import area_bounds

BOX = "request_id INT, latitude1 DOUBLE, longitude1 DOUBLE, latitude2 DOUBLE, longitude2 DOUBLE, year1 INT, year2 INT"


def numbers_of(block):
    index, level = divmod(block, LEVELS)
    return range(index << BITS * level, (index + 1) << BITS * level)


def test_blocks_cover_every_range_once(spark):
    pairs = spark.range(40).select(F.col("id").alias("a")).join(
        spark.range(40).select((F.col("id") - 1).alias("b")), F.lit(True)
    )
    for a, b, blocks in pairs.select("a", "b", blocks_covering("a", "b")).collect():
        covered = sorted(n for block in blocks for n in numbers_of(block))
        assert covered == list(range(a, b + 1))
        assert len(blocks) <= 15


def test_blocks_holding(spark):
    rows = spark.range(20).select(
        "id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("level")
    ).select("id", block_holding(F.col("id"), F.col("level")).alias("block"))
    assert all(r.id in numbers_of(r.block) for r in rows.collect())


def test_wide_range_needs_few_blocks(spark):
    ends = spark.range(1).select(F.lit(3).cast("long").alias("a"), F.lit(10**12).alias("b"))
    row = ends.select(blocks_covering("a", "b").alias("c")).first()
    assert len(row.c) < 6 * 21


def some_grid(rng, size=400):
    cells = {}
    for _ in range(size):
        lat, lon = float(rng.randint(-12, 12)), float(rng.randint(-30, 30))
        cells[lat, lon, rng.randint(1900, 1920), rng.choice(["WINTER", "FALL", ""])] = rng.randint(-40, 40) / 4
    # stray places far outside, and one at no latitude
    cells[1.0e6, 5.0, 1910, "WINTER"] = 3.0
    cells[float("nan"), 5.0, 1910, "WINTER"] = 99.0
    cells[3.0, 3.0, 2_000_000_000, "WINTER"] = 4.0
    return [(lat, lon, year, season, t, 1) for (lat, lon, year, season), t in cells.items()]


def test_areas_against_single_requests_in_plain_python(spark):
    rng = random.Random(5)
    grid = some_grid(rng)
    boxes = []
    for i in range(300):
        lat1, lat2 = rng.uniform(-15, 15), rng.uniform(-15, 15)
        lon1, lon2 = rng.uniform(-40, 40), rng.choice([rng.uniform(-40, 40), 4.5])
        boxes.append((i, lat1, lon1, lat2, lon2, rng.randint(1899, 1925), rng.randint(1900, 1925)))
    inf = float("inf")
    boxes += [
        (300, -inf, -inf, inf, inf, 1900, 2**31 - 1),
        (301, -1e300, -1e300, 1e300, 1e300, 1900, 1920),
        (302, 0.2, 0.2, 0.8, 0.8, 1900, 1920),
        (303, 100.0, 0.0, 1e7, 10.0, 1910, 1910),
        (304, 1e8, 0.0, 1e9, 10.0, 1910, 1910),
        (305, -7.0, 1.0, -7.0, 30.0, 1900, 1920),
        (306, 5.0, 5.0, 5.0, 5.0, 1900, 1920),
        (307, 5.0, 5.0, 5.0, 6.0, 1800, 1920),
        (308, None, 5.0, 5.0, 6.0, 1900, 1920),
        (309, float("nan"), 5.0, 5.0, 6.0, 1900, 1920),
        (310, 5.0, 5.0, 5.0, 6.0, None, 1920),
    ]
    # a third of the requests are copies of one
    boxes += [(1000 + i, -11.0, -29.5, 12.0, 30.0, 1901, 1919) for i in range(150)]
    got = gc.area_average_batch(summary(spark, *grid), spark.createDataFrame(boxes, BOX))
    rows = {r["request_id"]: r for r in dicts(got)}
    assert len(rows) == len(boxes)
    for i, lat1, lon1, lat2, lon2, y1, y2 in boxes:
        row = rows[i]
        if 306 <= i <= 310 or (y1 is not None and y1 < 1900):
            assert (row["average_temp"], row["n_entries"]) == (None, 0) and row["error"]
            continue
        assert row["error"] is None
        temps = [
            t for lat, lon, year, _, t, _ in grid
            if min(lat1, lat2) <= lat <= max(lat1, lat2)
            and min(lon1, lon2) <= lon <= max(lon1, lon2) and min(y1, y2) <= year <= max(y1, y2)
        ]
        assert row["n_entries"] == len(temps)
        assert row["average_temp"] == (pytest.approx(sum(temps) / len(temps)) if temps else None)


def test_areas_equal_single_requests(spark):
    grid = summary(spark, *some_grid(random.Random(1), 100)).cache()
    area = (-3.0, -8.0, 9.0, 20.0, 1903, 1911)
    (batch,) = dicts(gc.area_average_batch(grid, spark.createDataFrame([(1, *area)], BOX)))
    (single,) = dicts(gc.area_average(grid, *area))
    assert {k: batch[k] for k in single} == single


def test_bounds_may_be_text(spark):
    text = BOX.replace("DOUBLE", "STRING").replace("year1 INT, year2 INT", "year1 STRING, year2 STRING")
    boxes = spark.createDataFrame(
        [(1, "-3", "2", "4", "8", "1900", "1910"), (2, "x", "2", "4", "8", "1900", "1910"),
         (3, "-3", "2", "4", "8", "19oo", "1910")], text
    )
    grid = summary(spark, (1.0, 3.0, 1905, "FALL", 2.5, 1))
    rows = {r["request_id"]: r for r in dicts(gc.area_average_batch(grid, boxes))}
    assert rows[1]["average_temp"] == 2.5
    assert rows[2]["error"] and rows[3]["error"]


def test_areas_on_an_empty_summary(spark):
    grid = summary(spark, (1.0, 1.0, 1900, "FALL", 1.0, 1)).where("year > 2000")
    (row,) = dicts(gc.area_average_batch(grid, spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0, 1900, 1910)], BOX)))
    assert (row["average_temp"], row["n_entries"], row["error"]) == (None, 0, None)


@pytest.mark.parametrize("requests_per_task", [100_000, 3])
def test_coordinates_equal_single_requests(spark, requests_per_task):
    rng = random.Random(2)
    grid = summary(spark, *some_grid(rng)).cache()
    asked = [(i, rng.uniform(-13, 13), rng.uniform(-31, 31)) for i in range(20)]
    asked += [(20 + i, 3.0, 3.0) for i in range(10)] + [(30, 88.0, 0.0), (31, 3.0, None)]
    points = spark.createDataFrame(asked, "request_id INT, latitude DOUBLE, longitude DOUBLE")
    batch = gc.coordinate_summary_batch(grid, points, requests_per_task).collect()
    assert sum(r.request_id == 31 and r.key is None for r in batch) == 1
    for i, lat, lon in asked[:-1]:
        mine = sorted(r.key for r in batch if r.request_id == i and r.key)
        assert mine == sorted(r.key for r in gc.coordinate_summary(grid, lat, lon).collect())
        assert any(r.request_id == i for r in batch)


def test_infinite_and_far_cells(spark):
    """Every finite and infinite area gives what a single request gives."""
    inf = float("inf")
    places = [-inf, -1e300, -3.0, 0.0, 7.0, 1e300, inf]
    cells = [
        (lat, lon, 1905, "FALL", float(7 * i + j), 1)
        for i, lat in enumerate(places)
        for j, lon in enumerate(places)
    ]
    grid = summary(spark, *cells).cache()
    bounds = [-inf, -1e301, -1e300, -5.5, -3.0, 0.5, 7.0, 1e18, 1e300, 1e301, inf]
    rng = random.Random(4)
    boxes = [(i, *[rng.choice(bounds) for _ in range(4)], 1900, 1910) for i in range(120)]
    boxes = [b for b in boxes if (b[1], b[2]) != (b[3], b[4])]
    boxes.append((999, -inf, -inf, inf, inf, 1900, 1910))
    rows = gc.area_average_batch(grid, spark.createDataFrame(boxes, BOX)).collect()
    assert len(rows) == len(boxes)
    got = {r.request_id: (r.n_entries, r.average_temp, r.error) for r in rows}
    for i, lat1, lon1, lat2, lon2, *_ in boxes:
        temps = [
            c[4] for c in cells
            if min(lat1, lat2) <= c[0] <= max(lat1, lat2) and min(lon1, lon2) <= c[1] <= max(lon1, lon2)
        ]
        assert got[i][0] == len(temps) and got[i][2] is None
        assert got[i][1] == (pytest.approx(sum(temps) / len(temps)) if temps else None)
    (single,) = dicts(gc.area_average(grid, -inf, -inf, inf, inf, 1900, 1910))
    assert got[999][:2] == (single["n_entries"], single["average_temp"]) and single["n_entries"] == 49


ODD = [
    (" 5 ", "1901"), ("-5d", "1901"), ("5F", "1901"), ("1e1", "1901"), (".5", "1901"), ("5.", "1901"),
    ("Infinity", "1901"), ("-Infinity", "1901"), ("NaN", "1901"), ("inf", "1901"), ("1_0", "1901"),
    ("", "1901"), ("x", "1901"), ("0x10", "1901"), ("5dd", "1901"), ("٣", "1901"), ("5\n", "1901"),
    ("5", " 1901 "), ("5", "1901.9"), ("5", "1901.0"), ("5", "+1901"), ("5", "2147483647"),
    ("5", "2147483648"), ("5", "-2147483648"), ("5", "1e3"), ("5", ""), ("5", "1901\n"), ("5", "1899"),
]


def test_one_rule_for_arguments(spark):
    """The same verdict and reason for single requests and tables of them."""
    text = BOX.replace("DOUBLE", "STRING").replace("year1 INT, year2 INT", "year1 STRING, year2 STRING")
    boxes = spark.createDataFrame([(i, lat, "2", "4", "8", y, "1910") for i, (lat, y) in enumerate(ODD)], text)
    grid = summary(spark, (1.0, 3.0, 1905, "FALL", 2.5, 1))
    reasons = {r.request_id: r.error for r in gc.area_average_batch(grid, boxes).collect()}
    for i, (lat, year) in enumerate(ODD):
        try:
            area_bounds(lat, "2", "4", "8", year, "1910")
            expected = None
        except ValueError as error:
            expected = str(error).split(":")[0]
        assert reasons[i] == expected, ODD[i]
    assert sum(r is None for r in reasons.values()) == 11


def test_years_of_a_double_column_are_refused(spark):
    boxes = spark.createDataFrame(
        [(1, 1.0, 2.0, 4.0, 8.0, 1901.9, 1910.0)], BOX.replace("year1 INT, year2 INT", "year1 DOUBLE, year2 DOUBLE")
    )
    grid = summary(spark, (1.0, 3.0, 1905, "FALL", 2.5, 1))
    assert gc.area_average_batch(grid, boxes).first().error == "a bound is not a number"
    with pytest.raises(ValueError):
        area_bounds(1.0, 2.0, 4.0, 8.0, 1901.9, 1910)


def test_stored_sums_give_the_same(spark):
    grid = summary(spark, *some_grid(random.Random(9)), (float("inf"), 2.0, 1905, "FALL", 1.5, 1))
    root = gc.shared_folder(spark)
    gc.write_table(grid, root, "summary")
    gc.build_area_sums(spark, root)
    rng = random.Random(1)
    boxes = spark.createDataFrame(
        [(i, *[rng.uniform(-40, 40) for _ in range(4)], 1900 + i % 9, 1915) for i in range(60)]
        + [(60, -9.0, -9.0, float("inf"), 9.0, 1900, 1920), (61, None, 1.0, 2.0, 3.0, 1900, 1910)], BOX
    )
    prepared = gc.read_area_sums(spark, root)
    fresh = gc.area_average_batch(grid, boxes).collect()
    rows = gc.area_average_batch(grid, boxes, prepared=prepared).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, fresh))
