"""Hand-made lines and rows."""

from gridclimate.schemas import LINES, OBSERVATION, STATION, SUMMARY


def record(station="AA000000001", date="1950-05", precipitation="1.5", temperature="2.5", **more):
    """A record line; ``name`` sets the third field, ``fields`` their number."""
    fields = [""] * more.get("fields", 108)
    fields[0], fields[1], fields[2] = station, date, more.get("name", "")
    fields[102] = precipitation
    fields[106] = temperature
    fields[-1] = more.get("last", "x")
    return '"' + '","'.join(fields) + '"'


def header(prefix=""):
    return prefix + '"' + '","'.join(["STATION", "DATE"] + ["ELEMENT"] * 106) + '"'


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], LINES)


def observation(station, year, month, avg_temp, season="WINTER", precipitation=0.0):
    return (f"{year}:{month}:{station}", station, year, month, season, precipitation, avg_temp)


def observations(spark, *rows):
    return spark.createDataFrame(list(rows), OBSERVATION)


def stations(spark, *places):
    """Stations by id, latitude and longitude."""
    rest = ("", "", "", "", "", "", "AA", None)
    return spark.createDataFrame([(*place, *rest) for place in places], STATION)


def summary(spark, *rows):
    """Summary rows by latitude, longitude, year, season, mean and number of data points."""
    full = [
        (f"{lat}:{lon}:{year}:{season}", lat, lon, year, season, mean, points, ["AA"])
        for lat, lon, year, season, mean, points in rows
    ]
    return spark.createDataFrame(full, SUMMARY)


def dicts(rows):
    return [row.asDict() for row in rows.collect()]
