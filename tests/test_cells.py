import math

from samples import dicts, observation, observations, stations, summary

import gridclimate as gc
from gridclimate.schemas import OBSERVATION, STATION, SUMMARY


def test_cells_of_a_summary(spark):
    cells = gc.to_cells(summary(spark, (45.0, -93.0, 1950, "FALL", 1.5, 3)), gc.SUMMARY_CELLS)
    key = "45.0:-93.0:1950:FALL"
    assert sorted(cells.collect()) == [
        (key, "SUMMARY_DETAILS", "AVG_TEMP", "1.5"),
        (key, "SUMMARY_DETAILS", "DATA_POINTS", "3"),
        (key, "SUMMARY_DETAILS", "LATITUDE", "45.0"),
        (key, "SUMMARY_DETAILS", "LONGITUDE", "-93.0"),
        (key, "SUMMARY_DETAILS", "SEASON", "FALL"),
        (key, "SUMMARY_DETAILS", "STATIONS_LIST", '["AA"]'),
        (key, "SUMMARY_DETAILS", "YEAR", "1950"),
    ]


def test_summary_round_trip(spark):
    rows = summary(spark, (45.0, -93.0, 1950, "", 1.5, 3), (0.0, 0.0, 1950, "FALL", None, 0))
    odd = rows.selectExpr("* EXCEPT (stations)", """array('a,b', 'c;d', 'e"f', '[]') AS stations""")
    back = gc.from_cells(gc.to_cells(odd, gc.SUMMARY_CELLS), gc.SUMMARY_CELLS, SUMMARY)
    assert back.schema == rows.schema
    assert sorted(back.collect()) == sorted(odd.collect())


def test_observation_round_trip(spark):
    rows = observations(
        spark, observation("A", 1950, 1, 1.25, precipitation=float("nan")),
        observation("B", 1950, 13, -3.0, season=""),
    )
    back = dicts(gc.from_cells(gc.to_cells(rows, gc.OBSERVATION_CELLS), gc.OBSERVATION_CELLS, OBSERVATION))
    found = {r["station_code"]: r for r in back}
    assert math.isnan(found["A"].pop("precipitation"))
    assert found["A"] == {"key": "1950:1:A", "station_code": "A", "year": 1950, "month": 1,
                          "season": "WINTER", "avg_temp": 1.25}
    assert found["B"]["season"] == ""


def test_unknown_country_has_no_cell(spark):
    rows = stations(spark, ("A", 1.0, 2.0))
    cells = gc.to_cells(rows, gc.STATION_CELLS, key="id")
    assert cells.where("qualifier = 'COUNTRY'").count() == 0
    assert cells.count() == 10
    assert gc.from_cells(cells, gc.STATION_CELLS, STATION).collect() == rows.collect()
