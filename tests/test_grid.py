import random
from collections import defaultdict

import pytest
from samples import dicts, observation, observations, stations
from pyspark.sql import functions as F

import gridclimate as gc


@pytest.mark.parametrize(
    "value, cell",
    [(0.5, 1.0), (-0.5, -1.0), (-0.3, 0.0), (2.5, 3.0), (179.6, 180.0), (-179.6, -180.0),
     (44.49, 44.0), (0.49999999999999994, 0.0)],
)
def test_cells(spark, value, cell):
    row = spark.range(1).select(gc.cell_of(F.lit(value)).alias("c")).first()
    assert str(row.c) == str(cell)
    assert str(gc.cell_of_value(value)) == str(cell)


def test_summary(spark):
    obs = observations(
        spark,
        observation("A", 1950, 12, 1.0),
        observation("A", 1950, 1, 2.0),
        observation("B", 1950, 2, 6.0),
        observation("B", 1950, 3, 7.0, "SPRING"),
        observation("C", 1950, 1, 5.0),
        observation("A", 1899, 1, 9.0),
        observation("A", 1900, 1, 9.0),
        observation("UNKNOWN", 1950, 1, 9.0),
    )
    places = stations(spark, ("A", 10.2, -0.3), ("B", 9.5, 0.4), ("C", 10.0, 1.0), ("IDLE", 0.0, 0.0))
    rows = {r["key"]: r for r in dicts(gc.seasonal_grid_summary(obs, places))}
    assert sorted(rows) == [
        "10.0:0.0:1900:WINTER", "10.0:0.0:1950:SPRING", "10.0:0.0:1950:WINTER",
        "10.0:1.0:1950:WINTER",
    ]
    assert rows["10.0:0.0:1950:WINTER"] == {
        "key": "10.0:0.0:1950:WINTER", "latitude": 10.0, "longitude": 0.0, "year": 1950,
        "season": "WINTER", "avg_temp": 3.0, "data_points": 3, "stations": ["A", "B"],
    }


def test_missing_temperatures_are_not_counted(spark):
    obs = observations(
        spark, observation("A", 1950, 1, None), observation("B", 1950, 2, 4.0),
        observation("C", 1950, 1, None),
    )
    places = stations(spark, ("A", 1.0, 1.0), ("B", 1.0, 1.0), ("C", 5.0, 5.0))
    rows = {r["latitude"]: r for r in dicts(gc.seasonal_grid_summary(obs, places))}
    assert (rows[1.0]["avg_temp"], rows[1.0]["data_points"], rows[1.0]["stations"]) == (4.0, 1, ["A", "B"])
    assert (rows[5.0]["avg_temp"], rows[5.0]["data_points"], rows[5.0]["stations"]) == (None, 0, ["C"])


def test_skewed_summary_against_plain_python(spark):
    """A third of all observations from one station, another third in one cell and season."""
    rng = random.Random(3)
    names = [f"S{i:03d}" for i in range(60)]
    places = {n: (rng.randint(-8, 8) / 4, rng.randint(-8, 8) / 4) for n in names}
    places.update({n: (50.0, 50.0) for n in names[30:]})
    raw = []
    for i in range(6000):
        third = i % 3
        station = names[0] if third == 0 else rng.choice(names[30:] if third == 1 else names)
        year = 1950 if third == 1 else rng.randint(1898, 1903)
        raw.append(observation(station, year, 1, rng.randint(-80, 80) / 4))
    expected = defaultdict(lambda: [0.0, 0, set()])
    for _, station, year, _, season, _, temp in raw:
        if year >= 1900:
            lat, lon = (gc.cell_of_value(v) for v in places[station])
            group = expected[lat, lon, year, season]
            group[0] += temp
            group[1] += 1
            group[2].add(station)
    got = gc.seasonal_grid_summary(
        observations(spark, *raw), stations(spark, *[(n, *p) for n, p in places.items()])
    ).collect()
    assert len(got) == len(expected)
    for r in got:
        total, points, codes = expected[r.latitude, r.longitude, r.year, r.season]
        assert (r.avg_temp, r.data_points, r.stations) == (total / points, points, sorted(codes))


def test_points_of_the_summary_are_the_joined_rows(spark, sf_dir):
    import __spark_entry__ as entry

    joined = entry.join_stations(spark, sf_dir).count()
    points = entry.seasonal_grid_summary(spark, sf_dir).agg(F.sum("data_points")).first()[0]
    assert points == joined > 0
