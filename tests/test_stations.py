import pytest
from samples import dicts, lines, stations
from pyspark.sql import functions as F

import gridclimate as gc

LINE = "US1FLSL0019  27.3237  -80.3111    3.0 FL PORT ST. LUCIE 4.1 E           GSN HCN 72204"


def test_a_station(spark):
    assert dicts(gc.parse_stations(lines(spark, LINE))) == [
        {
            "id": "US1FLSL0019",
            "latitude": 27.3237,
            "longitude": -80.3111,
            "elevation": "   3.0",
            "state": "FL",
            "stn_name": "PORT ST. LUCIE 4.1 E          ",
            "gsn": "GSN",
            "hcn_crn": "HCN",
            "wmo_id": "72204",
            "country_cd": "US",
        }
    ]


def test_shortest_line(spark):
    assert dicts(gc.parse_stations(lines(spark, LINE[:80])))[0]["wmo_id"] == ""
    with pytest.raises(Exception, match="station line is too short"):
        gc.parse_stations(lines(spark, LINE[:79])).collect()


def test_bad_latitude_fails(spark):
    with pytest.raises(Exception, match="not of type"):
        gc.parse_stations(lines(spark, LINE.replace("27.3237", "  x    "))).collect()


def test_countries(spark):
    rows = gc.parse_countries(lines(spark, "AC Antigua and Barbuda ", "AE United Arab Emirates"))
    assert sorted(rows.collect()) == [
        ("AC", "Antigua and Barbuda "), ("AE", "United Arab Emirates"),
    ]
    with pytest.raises(Exception, match="country line is too short"):
        gc.parse_countries(lines(spark, "AC")).collect()


def test_country_names(spark):
    plain = gc.parse_stations(lines(spark, LINE, LINE.replace("US1", "XX1")))
    names = gc.parse_countries(lines(spark, "US United States", "US Another name"))
    named = {r["id"]: r["country_name"] for r in dicts(gc.add_country(plain, names))}
    assert named == {"US1FLSL0019": "United States", "XX1FLSL0019": None}
    with pytest.raises(Exception, match="unknown country code: XX"):
        gc.add_country(plain, names, compat=True).collect()
    known = plain.where(F.col("country_cd") == "US")
    assert gc.add_country(known, names, compat=True).first()["country_name"] == "United States"


def test_one_row_per_station(spark):
    rows = stations(spark, ("A", 1.0, 2.0), ("A", 1.0, 3.0), ("B", 0.0, 0.0), ("B", 0.0, 0.0))
    kept = gc.latest_per_station(rows)
    assert kept.columns == rows.columns
    assert sorted((r.id, r.longitude) for r in kept.collect()) == [("A", 3.0), ("B", 0.0)]
