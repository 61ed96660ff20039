"""Fixed schemas of the stored tables and of the answers; nothing is inferred from data."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

LINES = StructType([StructField("value", StringType())])

OBSERVATION = StructType(
    [
        StructField("key", StringType()),
        StructField("station_code", StringType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
        StructField("season", StringType()),
        StructField("precipitation", DoubleType()),
        StructField("avg_temp", DoubleType()),
    ]
)

STATION = StructType(
    [
        StructField("id", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("elevation", StringType()),
        StructField("state", StringType()),
        StructField("stn_name", StringType()),
        StructField("gsn", StringType()),
        StructField("hcn_crn", StringType()),
        StructField("wmo_id", StringType()),
        StructField("country_cd", StringType()),
        StructField("country_name", StringType()),
    ]
)

COUNTRY = StructType(
    [
        StructField("code", StringType()),
        StructField("name", StringType()),
    ]
)

SUMMARY = StructType(
    [
        StructField("key", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("year", IntegerType()),
        StructField("season", StringType()),
        StructField("avg_temp", DoubleType()),
        StructField("data_points", LongType()),
        StructField("stations", ArrayType(StringType())),
    ]
)

ENTRY = StructType(
    [SUMMARY[name] for name in ("year", "season", "avg_temp", "data_points", "stations")]
)

CELL = StructType(
    [
        StructField("key", StringType()),
        StructField("family", StringType()),
        StructField("qualifier", StringType()),
        StructField("value", StringType()),
    ]
)

AREA_EXTENT = StructType(
    [
        StructField(f"{name}_{part}", kind)
        for name in ("latitude", "longitude", "year")
        for part, kind in (
            ("min", DoubleType()),
            ("max", DoubleType()),
            ("far", ArrayType(DoubleType())),
        )
    ]
)

AREA_SUMS = StructType(
    [
        StructField("latitude", LongType()),
        StructField("longitude", LongType()),
        StructField("year", LongType()),
        StructField("temp_sum", DoubleType()),
        StructField("temps", LongType()),
        StructField("entries", LongType()),
    ]
)

TABLES = {
    "observations": OBSERVATION,
    "stations": STATION,
    "summary": SUMMARY,
    "area_extent": AREA_EXTENT,
    "area_sums": AREA_SUMS,
}

# The names in documents for clients that know them by these.
WIRE_NAMES = {
    "latitude": "lattitude",
    "latitude1": "lattitude1",
    "latitude2": "lattitude2",
    "year_from": "yearFrom",
    "year_to": "yearTo",
    "average_temp": "averageTemp",
    "data_list": "dataList",
    "avg_temp": "avgTemp",
    "data_points": "dataPoints",
}
