import json

import pytest
from samples import dicts, summary

import gridclimate as gc
from gridclimate.operators.requests import area_bounds


@pytest.fixture(scope="module")
def grid(spark):
    return summary(
        spark,
        (45.0, -93.0, 1950, "WINTER", 10.0, 9),
        (45.0, -93.0, 1950, "FALL", 20.0, 1),
        (45.0, -93.0, 1951, "SUMMER", 30.0, 2),
        (9.0, 9.0, 1950, "WINTER", 1.0, 1),
        (-6.0, 9.0, 1950, "WINTER", 2.0, 1),
        (-4.0, 9.0, 1950, "WINTER", 3.0, 1),
    ).cache()


def keys(rows):
    return [r.key for r in rows.collect()]


def test_coordinate(grid):
    expected = ["45.0:-93.0:1950:FALL", "45.0:-93.0:1950:WINTER", "45.0:-93.0:1951:SUMMER"]
    assert keys(gc.coordinate_summary(grid, 45.3, -93.2)) == expected
    assert keys(gc.coordinate_summary(grid, "45", "-93")) == expected
    assert keys(gc.coordinate_summary(grid, 46.0, -93.0)) == []


def test_coordinate_compat(grid):
    assert len(keys(gc.coordinate_summary(grid, "45.0", "-93.0", compat=True))) == 3
    for lat, lon in (("45.3", "-93.2"), ("45", "-93"), ("45.0", "-93"), ("x", "y")):
        assert keys(gc.coordinate_summary(grid, lat, lon, compat=True)) == []


def test_coordinate_document(grid):
    (row,) = gc.coordinate_document(grid, "45.3", -93.2).collect()
    assert (row.latitude, row.longitude) == ("45.3", -93.2)
    assert [(e.year, e.season, e.avg_temp, e.data_points, e.stations) for e in row.data_list] == [
        (1950, "FALL", 20.0, 1, ["AA"]), (1950, "WINTER", 10.0, 9, ["AA"]),
        (1951, "SUMMER", 30.0, 2, ["AA"]),
    ]
    (empty,) = gc.coordinate_document(grid, 1, 1).collect()
    assert empty.data_list == []


def test_area_mean_is_not_weighted(grid):
    (row,) = dicts(gc.area_average(grid, 40, -100, 50, -90, 1950, 1950))
    assert (row["average_temp"], row["n_entries"]) == (15.0, 2)


def test_swapped_bounds_change_nothing(grid):
    straight = dicts(gc.area_average(grid, 40, -100, 50, -90, 1950, 1951))
    assert straight == dicts(gc.area_average(grid, 50, -90, 40, -100, 1951, 1950))
    assert straight == dicts(gc.area_average(grid, "50", "-100", "40", "-90", "1951", "1950"))
    assert straight[0]["latitude1"] == 40.0 and straight[0]["year_to"] == 1951
    assert keys(gc.area_entries(grid, 50, -90, 40, -100, 1951, 1950)) == [
        "45.0:-93.0:1950:FALL", "45.0:-93.0:1950:WINTER", "45.0:-93.0:1951:SUMMER",
    ]


def test_text_bounds_with_compat(grid):
    area = (-5, 0, 10, 10, 1950, 1950)
    assert keys(gc.area_entries(grid, *area)) == ["-4.0:9.0:1950:WINTER", "9.0:9.0:1950:WINTER"]
    assert keys(gc.area_entries(grid, *area, compat=True)) == []
    wide = (-5, 0, 10, 90, 1950, 1950)
    assert keys(gc.area_entries(grid, *wide, compat=True)) == ["-6.0:9.0:1950:WINTER"]


@pytest.mark.parametrize("area", [(0.2, 0.2, 0.8, 0.8, 1950, 1950), (0, 0, 1, 1, 1950, 1950)])
def test_empty_area(grid, area):
    (row,) = dicts(gc.area_average(grid, *area))
    assert (row["average_temp"], row["n_entries"]) == (None, 0)
    (row,) = dicts(gc.area_average(grid, *area, compat=True))
    assert row["average_temp"] == 0.0


@pytest.mark.parametrize(
    "area",
    [
        (1, 2, 1, 2, 1950, 1950), (1, 2, 3, 4, 1899, 1950), (1, 2, 3, 4, 1950, 1899),
        ("north", 2, 3, 4, 1950, 1950), (1, 2, 3, "", 1950, 1950), (1, 2, 3, "1_0", 1950, 1950),
        (1, 2, 3, 4, "1950.5", 1950), (1, 2, 3, 4, " 1950", 1950), (1, 2, 3, 4, 1950, 2**31),
        (1, 2, 3, float("nan"), 1950, 1950),
    ],
)
def test_bad_requests(area):
    with pytest.raises(ValueError):
        area_bounds(*area)


def test_same_latitude_is_allowed():
    assert area_bounds(5, 3, "5", 1, 1950, "+1940") == (5.0, 1.0, 5.0, 3.0, 1940, 1950)


@pytest.mark.parametrize("compat, mean", [(False, None), (True, "0.0")])
def test_area_document(spark, grid, tmp_path, compat, mean):
    path = str(tmp_path / "document")
    gc.write_document(gc.area_document(grid, 50, -90, 40, -100, 1950, 1951), path)
    assert json.loads(read_whole(tmp_path / "document")) == {
        "latitude1": "40.0", "longitude1": "-100.0", "latitude2": "50.0", "longitude2": "-90.0",
        "year_from": "1950", "year_to": "1951", "average_temp": "20.0",
        "data_list": [
            {"year": "1950", "season": "FALL", "avg_temp": "20.0", "data_points": "1", "stations": "AA"},
            {"year": "1950", "season": "WINTER", "avg_temp": "10.0", "data_points": "9", "stations": "AA"},
            {"year": "1951", "season": "SUMMER", "avg_temp": "30.0", "data_points": "2", "stations": "AA"},
        ],
    }
    path = str(tmp_path / "empty")
    gc.write_document(gc.area_document(grid, 0, 0, 1, 1, 1950, 1951, compat=compat), path)
    empty = json.loads(read_whole(tmp_path / "empty"))
    assert (empty["average_temp"], empty["data_list"]) == (mean, [])


def read_whole(folder):
    return "".join(part.read_text() for part in sorted(folder.glob("part-*")))


def test_heatmap_feed(grid):
    assert dicts(gc.heatmap_feed(grid, 45.3, -93.2)) == [
        {"year": 1950, "WINTER": 10.0, "SPRING": None, "SUMMER": None, "FALL": 20.0},
        {"year": 1951, "WINTER": None, "SPRING": None, "SUMMER": 30.0, "FALL": None},
    ]


def test_names_on_the_wire(spark):
    import json

    grid = summary(spark, (1.0, 3.0, 1905, "FALL", 2.5, 1))
    (row,) = gc.to_json_documents(gc.coordinate_document(grid, 1, 3, wire=True)).collect()
    document = json.loads(row.json)
    assert list(document) == ["lattitude", "longitude", "dataList"]
    assert list(document["dataList"][0]) == ["year", "season", "avgTemp", "dataPoints", "stations"]
    lines = gc.area_document(grid, 0, 0, 5, 5, 1900, 1910, wire=True).orderBy("part", "key").collect()
    document = json.loads("".join(r.json for r in lines))
    assert list(document) == [
        "lattitude1", "longitude1", "lattitude2", "longitude2", "yearFrom", "yearTo", "averageTemp", "dataList",
    ]
    assert document["dataList"][0]["dataPoints"] == "1"
