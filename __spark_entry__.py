"""Registered queries of the package and their equivalents for DuckDB.

The raw weather lines are derived from the orders, customer and nation tables (``FIXTURES.md``).
Each query runs over the whole tables. The SQL works out the same results straight from the base
columns and never parses a line, so it checks the parsing as well.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import gridclimate as gc  # noqa: E402
from gridclimate import fixtures  # noqa: E402
from gridclimate.sinks.tables import summary_curve  # noqa: E402
from gridclimate.schemas import ENTRY, OBSERVATION, STATION, SUMMARY  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from gridclimate.llm import queries as llm  # noqa: E402
except ImportError as error:  # the folder may be left out, or a library that only it needs
    warnings.warn(f"the training-data queries are left out: {error}", stacklevel=2)
    llm = None

POINT = (3.3, -2.6)
AREA = (10, 5, -5, -1, 1904, 1901)
SHIFT = 0.0000003

# --- inputs -------------------------------------------------------------------------------------


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gc.latest_per_key(gc.parse_observations(fixtures.observation_lines(spark, sf_dir)))


def _plain_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gc.parse_stations(fixtures.station_lines(spark, sf_dir))


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = gc.parse_countries(fixtures.country_lines(spark, sf_dir))
    return gc.add_country(_plain_stations(spark, sf_dir), countries)


_roots: dict[tuple[str, str], str] = {}


def _tables(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored tables, made once per application by the batch jobs from text files."""
    made_for = (spark.sparkContext.applicationId, sf_dir)
    if made_for not in _roots:
        root = gc.shared_folder(spark)
        raw = {
            "records": fixtures.observation_lines(spark, sf_dir),
            "stations": fixtures.station_lines(spark, sf_dir),
            "countries": fixtures.country_lines(spark, sf_dir),
        }
        for name, lines in raw.items():
            lines.write.option("compression", "gzip").text(f"{root}/raw/{name}")
        gc.ingest_observations(spark, f"{root}/raw/records", root)
        gc.ingest_stations(spark, f"{root}/raw/stations", f"{root}/raw/countries", root)
        gc.build_summary(spark, root)
        gc.build_area_sums(spark, root)
        _roots[made_for] = root
    return _roots[made_for]


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return gc.read_table(spark, _tables(spark, sf_dir), name)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "summary")


def _plain(rows: DataFrame) -> DataFrame:
    """Make values comparable: a missing precipitation as NULL, station lists as one text."""
    if "precipitation" in rows.columns:
        rows = rows.withColumn("precipitation", F.nanvl("precipitation", F.lit(None)))
    if "stations" in rows.columns:
        rows = rows.withColumn("stations", F.array_join("stations", ","))
    return rows


# --- queries ------------------------------------------------------------------------------------


def parse_observations(spark, sf_dir):
    return _plain(gc.parse_observations(fixtures.observation_lines(spark, sf_dir)))


def parse_observations_compat(spark, sf_dir):
    return _plain(gc.parse_observations(fixtures.observation_lines(spark, sf_dir), compat=True))


def dedupe_observations(spark, sf_dir):
    return _plain(_observations(spark, sf_dir))


def observations_by_season(spark, sf_dir):
    return gc.observations_by_season(_observations(spark, sf_dir))


def parse_stations(spark, sf_dir):
    return _plain_stations(spark, sf_dir)


def parse_countries(spark, sf_dir):
    return gc.parse_countries(fixtures.country_lines(spark, sf_dir))


def stations_with_country(spark, sf_dir):
    return _stations(spark, sf_dir)


def join_stations(spark, sf_dir):
    return gc.join_stations(_observations(spark, sf_dir), _stations(spark, sf_dir))


def snap_to_grid(spark, sf_dir):
    cells = gc.snap_to_grid(_stations(spark, sf_dir))
    return cells.select("id", "latitude", "longitude", "cell_latitude", "cell_longitude")


def seasonal_grid_summary(spark, sf_dir):
    return _plain(
        gc.seasonal_grid_summary(_observations(spark, sf_dir), _stations(spark, sf_dir))
    )


def stored_observations(spark, sf_dir):
    return _plain(_stored(spark, sf_dir, "observations"))


def stored_stations(spark, sf_dir):
    return _stored(spark, sf_dir, "stations")


def stored_summary(spark, sf_dir):
    return _plain(_summary(spark, sf_dir))


def coordinate_summary(spark, sf_dir):
    return _plain(gc.coordinate_summary(_summary(spark, sf_dir), *POINT))


def coordinate_summary_compat(spark, sf_dir):
    return _plain(gc.coordinate_summary(_summary(spark, sf_dir), "3.0", "-3.0", compat=True))


def coordinate_document(spark, sf_dir):
    document = gc.coordinate_document(_summary(spark, sf_dir), *POINT)
    listed = document.select("latitude", "longitude", F.posexplode("data_list").alias("n", "entry"))
    return _plain(listed.select("latitude", "longitude", "n", "entry.*"))


def coordinate_document_json(spark, sf_dir):
    return gc.to_json_documents(gc.coordinate_document(_summary(spark, sf_dir), *POINT))


def coordinate_document_wire_json(spark, sf_dir):
    """With the names that existing clients read."""
    document = gc.coordinate_document(_summary(spark, sf_dir), *POINT, wire=True)
    return gc.to_json_documents(document)


def stations_with_country_compat(spark, sf_dir):
    """Stations of known countries; with ``compat`` any other one would fail the job."""
    countries = gc.parse_countries(fixtures.country_lines(spark, sf_dir))
    known = _plain_stations(spark, sf_dir).join(
        countries, F.col("country_cd") == countries["code"], "left_semi"
    )
    return gc.add_country(known, countries, compat=True)


_on_curve: dict[tuple[str, str], str] = {}


def area_average_on_curve(spark, sf_dir):
    """The same mean from a summary that is stored along a space-filling curve."""
    made_for = (spark.sparkContext.applicationId, sf_dir)
    if made_for not in _on_curve:
        root = gc.shared_folder(spark)
        gc.write_table(_summary(spark, sf_dir), root, "summary", cluster_by=summary_curve())
        _on_curve[made_for] = root
    summary = gc.read_table(spark, _on_curve[made_for], "summary")
    return _rounded(gc.area_average(summary, *AREA))


def area_entries(spark, sf_dir):
    return _plain(gc.area_entries(_summary(spark, sf_dir), *AREA))


def _rounded(rows: DataFrame) -> DataFrame:
    """Means of means depend on the order of summing in their last digits.

    Many are halves, quarters and so on, which lie on the edge of rounding; the shift moves the
    edge to where they do not lie.
    """
    return rows.withColumn("average_temp", F.round(F.col("average_temp") + SHIFT, 6))


def area_average(spark, sf_dir):
    return _rounded(gc.area_average(_summary(spark, sf_dir), *AREA))


def area_average_compat(spark, sf_dir):
    return _rounded(gc.area_average(_summary(spark, sf_dir), *AREA, compat=True))


def area_document(spark, sf_dir):
    """The lines of the document read back: opening with bounds and mean, entries, closing."""
    lines = gc.area_document(_summary(spark, sf_dir), *AREA)
    opening = F.concat("json", F.lit("]}"))
    mean = F.get_json_object(opening, "$.average_temp").cast("double")
    entry = F.from_json(F.ltrim("json", F.lit(",")), ENTRY_TEXT)
    return _rounded(
        lines.select(
            "part",
            "key",
            F.when(F.col("part") == 0, mean).alias("average_temp"),
            *[
                F.when(F.col("part") == 0, F.get_json_object(opening, f"$.{name}")).alias(name)
                for name in AREA_BOUNDS
            ],
            *[
                F.when(F.col("part") == 1, entry[name]).alias(name)
                for name in ENTRY.fieldNames()
            ],
            F.when(F.col("part") == 2, F.col("json")).alias("closing"),
        )
    )


AREA_BOUNDS = ("latitude1", "longitude1", "latitude2", "longitude2", "year_from", "year_to")
ENTRY_TEXT = ", ".join(f"{name} STRING" for name in ENTRY.fieldNames())


def coordinate_summary_batch(spark, sf_dir):
    answers = gc.coordinate_summary_batch(
        _summary(spark, sf_dir), fixtures.points(spark, sf_dir)
    )
    return _plain(answers)


def area_average_batch(spark, sf_dir):
    answers = gc.area_average_batch(_summary(spark, sf_dir), fixtures.boxes(spark, sf_dir))
    return _rounded(answers)


def area_average_batch_stored(spark, sf_dir):
    """The same from stored block sums."""
    prepared = gc.read_area_sums(spark, _tables(spark, sf_dir))
    boxes = fixtures.boxes(spark, sf_dir)
    return _rounded(gc.area_average_batch(_summary(spark, sf_dir), boxes, prepared=prepared))


def heatmap_feed(spark, sf_dir):
    return gc.heatmap_feed(_summary(spark, sf_dir), *POINT)


def observation_cells(spark, sf_dir):
    return gc.to_cells(_observations(spark, sf_dir), gc.OBSERVATION_CELLS)


def station_cells(spark, sf_dir):
    return gc.to_cells(_stations(spark, sf_dir), gc.STATION_CELLS, key="id")


def summary_cells(spark, sf_dir):
    return gc.to_cells(_summary(spark, sf_dir), gc.SUMMARY_CELLS)


def observation_cells_round_trip(spark, sf_dir):
    cells = gc.to_cells(_observations(spark, sf_dir), gc.OBSERVATION_CELLS)
    return _plain(gc.from_cells(cells, gc.OBSERVATION_CELLS, OBSERVATION))


def station_cells_round_trip(spark, sf_dir):
    cells = gc.to_cells(_stations(spark, sf_dir), gc.STATION_CELLS, key="id")
    return gc.from_cells(cells, gc.STATION_CELLS, STATION)


def cells_round_trip(spark, sf_dir):
    """The cells of the summary, stored in order and read back."""
    root = gc.shared_folder(spark)
    gc.write_table(gc.to_cells(_summary(spark, sf_dir), gc.SUMMARY_CELLS), root, "summary_cells")
    cells = gc.read_table(spark, root, "summary_cells")
    return _plain(gc.from_cells(cells, gc.SUMMARY_CELLS, SUMMARY))


def _disorder(rows: DataFrame, *order: str) -> DataFrame:
    """Neighbouring rows out of order inside files, and neighbouring files whose ranges overlap.

    A row's place in its file comes with the row, so each file is looked at in the order written.
    """
    placed = rows.select(
        F.struct(*order).alias("at"),
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("place"),
    )
    within = Window.partitionBy("file").orderBy("place")
    turned = placed.withColumn("before", F.lag("at").over(within)).where("before > at")
    files = placed.groupBy("file").agg(F.min("at").alias("least"), F.max("at").alias("greatest"))
    # One row per file.
    apart = files.withColumn("before", F.lag("greatest").over(Window.orderBy("least", "greatest")))
    overlapping = apart.where("before >= least").agg(F.count("*")).scalar()
    return turned.agg(F.count("*").alias("rows_out_of_order")).withColumn(
        "files_overlapping", F.coalesce(overlapping, F.lit(0))
    )


_added: dict[tuple[str, str], str] = {}


def _tables_of_two_loads(spark: SparkSession, sf_dir: str) -> str:
    """Folder of tables that were loaded in two parts which share a third of their lines."""
    made_for = (spark.sparkContext.applicationId, sf_dir)
    if made_for in _added:
        return _added[made_for]
    root = gc.shared_folder(spark)
    raw = {
        "records": fixtures.observation_lines(spark, sf_dir),
        "stations": fixtures.station_lines(spark, sf_dir),
    }
    third = F.pmod(F.xxhash64("value"), F.lit(3))
    for name, lines in raw.items():
        for load in (0, 1):
            lines.where(third != load).write.text(f"{root}/raw/{name}_{load}")
    fixtures.country_lines(spark, sf_dir).write.text(f"{root}/raw/countries")
    for load in (0, 1):
        gc.ingest_stations(
            spark, f"{root}/raw/stations_{load}", f"{root}/raw/countries", root, add=True
        )
    gc.ingest_observations(spark, f"{root}/raw/records_0", root, add=True)
    gc.build_summary(spark, root)
    changed = gc.ingest_observations(spark, f"{root}/raw/records_1", root, add=True)
    gc.refresh_summary(spark, root, changed)
    _added[made_for] = root
    return root


def added_observations(spark, sf_dir):
    return _plain(gc.read_table(spark, _tables_of_two_loads(spark, sf_dir), "observations"))


def added_stations(spark, sf_dir):
    return gc.read_table(spark, _tables_of_two_loads(spark, sf_dir), "stations")


def refreshed_summary(spark, sf_dir):
    return _plain(gc.read_table(spark, _tables_of_two_loads(spark, sf_dir), "summary"))


def stored_order(spark, sf_dir):
    """The stored tables and the stored cells, checked for the order that lookups rely on."""
    root = _tables(spark, sf_dir)
    cells = gc.shared_folder(spark)
    gc.write_table(gc.to_cells(_summary(spark, sf_dir), gc.SUMMARY_CELLS), cells, "summary_cells")
    orders = {
        "observations": (root, ("key",)),
        "stations": (root, ("id",)),
        "summary": (root, ("latitude", "longitude", "year", "season")),
        "summary_cells": (cells, ("key", "qualifier")),
    }
    found = [
        _disorder(gc.read_table(spark, folder, name), *order).select(
            F.lit(name).alias("name"), "rows_out_of_order", "files_overlapping"
        )
        for name, (folder, order) in orders.items()
    ]
    return reduce(DataFrame.unionByName, found)


def summary_text_view(spark, sf_dir):
    gc.register_summary_view(_summary(spark, sf_dir), "summary_text")
    return spark.sql("SELECT * FROM summary_text")


def summary_csv_round_trip(spark, sf_dir):
    path = f"{gc.shared_folder(spark)}/summary_csv"
    gc.export_csv(_summary(spark, sf_dir), path)
    texts = ", ".join(f"{name} STRING" for name in SUMMARY.fieldNames())
    return spark.read.schema(texts).csv(path)


def summary_json(spark, sf_dir):
    return gc.to_json_documents(_summary(spark, sf_dir))


# --- the same in SQL ----------------------------------------------------------------------------

_STATION_ID = "'N' || chr(65 + c_nationkey) || lpad(CAST(c_custkey AS VARCHAR), 9, '0')"

# Unusable records are those of pending orders with three priorities; see FIXTURES.md.
_RECORDS = f"""
records AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH'
              THEN 'ZZ' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
              ELSE {_STATION_ID} END AS station_code,
         CAST(year(o_orderdate) - 97 AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         CASE WHEN o_orderstatus = 'F' THEN CAST('NaN' AS DOUBLE)
              ELSE CAST((o_orderkey % 400) / 4.0 AS DOUBLE) END AS precipitation,
         CAST((o_orderkey % 161) / 4.0 - 20 AS DOUBLE) AS avg_temp,
         o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS titled
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE NOT (o_orderstatus = 'P'
             AND o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'))
),
parsed AS (
  SELECT CAST(year AS VARCHAR) || ':' || CAST(month AS VARCHAR) || ':' || station_code AS key,
         station_code, year, month,
         CASE WHEN month IN (12, 1, 2) THEN 'WINTER' WHEN month IN (3, 4, 5) THEN 'SPRING'
              WHEN month IN (6, 7, 8) THEN 'SUMMER' ELSE 'FALL' END AS season,
         precipitation, avg_temp, titled
  FROM records
)"""

_OBSERVATIONS = f"""{_RECORDS},
observations AS (
  SELECT key, station_code, year, month, season, precipitation, avg_temp
  FROM (SELECT *, row_number() OVER (PARTITION BY key
                                     ORDER BY avg_temp DESC,
                                     isnan(precipitation), precipitation DESC) AS place
        FROM parsed)
  WHERE place = 1
)"""

_STATIONS = f"""
countries AS (
  SELECT 'N' || chr(65 + n_nationkey) AS code, n_name AS name
  FROM nation WHERE n_regionkey <> 3
),
plain_stations AS (
  SELECT {_STATION_ID} AS id,
         CAST((c_custkey * 37 % 161) / 4.0 - 20 AS DOUBLE) AS latitude,
         CAST((c_custkey * 53 % 81) / 4.0 - 10 AS DOUBLE) AS longitude,
         printf('%6.1f', floor(c_acctbal / 10)) AS elevation,
         '  ' AS state, rpad(c_name, 30, ' ') AS stn_name, 'GSN' AS gsn, 'HCN' AS hcn_crn,
         '00000' AS wmo_id, 'N' || chr(65 + c_nationkey) AS country_cd
  FROM customer
),
stations AS (
  SELECT plain_stations.*, name AS country_name
  FROM plain_stations LEFT JOIN countries ON country_cd = code
)"""

_JOINED = f"""{_OBSERVATIONS}, {_STATIONS},
joined AS (
  SELECT station_code, year, month, season, avg_temp, latitude, longitude
  FROM observations JOIN stations ON station_code = id
  WHERE year >= 1900
)"""

# Adding 0.0 turns a negative zero into a plain one.
_SUMMARY = f"""{_JOINED},
grid AS (
  SELECT round(latitude) + 0.0 AS latitude, round(longitude) + 0.0 AS longitude, year, season,
         avg(avg_temp) AS avg_temp, count(avg_temp) AS data_points,
         list_sort(list(DISTINCT station_code)) AS station_list
  FROM joined
  GROUP BY ALL
),
summary AS (
  SELECT CAST(latitude AS VARCHAR) || ':' || CAST(longitude AS VARCHAR) || ':'
         || CAST(year AS VARCHAR) || ':' || season AS key,
         latitude, longitude, year, season, avg_temp, data_points,
         array_to_string(station_list, ',') AS stations, station_list
  FROM grid
),
summary_text AS (
  SELECT key, CAST(latitude AS VARCHAR) AS latitude, CAST(longitude AS VARCHAR) AS longitude,
         CAST(year AS VARCHAR) AS year, season, CAST(avg_temp AS VARCHAR) AS avg_temp,
         CAST(data_points AS VARCHAR) AS data_points,
         array_to_string(station_list, ';') AS stations
  FROM summary
)"""

_OBSERVATION_COLUMNS = """key, station_code, year, month, season,
  CASE WHEN isnan(precipitation) THEN NULL ELSE precipitation END AS precipitation, avg_temp"""
_STATION_COLUMNS = """id, latitude, longitude, elevation, state, stn_name, gsn, hcn_crn, wmo_id,
  country_cd, country_name"""
_SUMMARY_COLUMNS = "key, latitude, longitude, year, season, avg_temp, data_points, stations"
_HERE = "latitude = 3.0 AND longitude = -3.0"
_INSIDE = "latitude BETWEEN -5 AND 10 AND longitude BETWEEN -1 AND 5 AND year BETWEEN 1901 AND 1904"
_ROUNDED_MEAN = f"round(avg(s.avg_temp) + {SHIFT:.7f}, 6)"
_AREA_COLUMNS = """CAST(-5.0 AS DOUBLE) AS latitude1, CAST(-1.0 AS DOUBLE) AS longitude1,
  CAST(10.0 AS DOUBLE) AS latitude2, CAST(5.0 AS DOUBLE) AS longitude2,
  1901 AS year_from, 1904 AS year_to"""


def _cells(table: str, key: str, cells: list[tuple[str, str, str]]) -> str:
    """One SELECT per cell: family, qualifier, expression; NULLs have no cell."""
    return " UNION ALL ".join(
        f"SELECT {key} AS key, '{family}' AS family, '{qualifier}' AS qualifier, "
        f"{value} AS value FROM {table} WHERE {value} IS NOT NULL"
        for family, qualifier, value in cells
    )


def _text(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


_OBSERVATION_CELLS = _cells(
    "observations",
    "key",
    [
        ("ID_DETAILS", "MONTH", _text("month")),
        ("ID_DETAILS", "STATION_CODE", "station_code"),
        ("ID_DETAILS", "YEAR", _text("year")),
        ("WEATHER_DATA", "AVG_TEMP", _text("avg_temp")),
        (
            "WEATHER_DATA",
            "PRECIPITATION",
            f"CASE WHEN isnan(precipitation) THEN 'NaN' ELSE {_text('precipitation')} END",
        ),
        ("WEATHER_DATA", "SEASON", "season"),
    ],
)
_STATION_CELLS = _cells(
    "stations",
    "id",
    [
        ("STATION_DETAILS", "COUNTRY", "country_name"),
        ("STATION_DETAILS", "COUNTRY_CD", "country_cd"),
        ("STATION_DETAILS", "ELEVATION", "elevation"),
        ("STATION_DETAILS", "GSN", "gsn"),
        ("STATION_DETAILS", "HCN_CRN", "hcn_crn"),
        ("STATION_DETAILS", "ID", "id"),
        ("STATION_DETAILS", "LATITUDE", _text("latitude")),
        ("STATION_DETAILS", "LONGITUDE", _text("longitude")),
        ("STATION_DETAILS", "STATE", "state"),
        ("STATION_DETAILS", "STATION_NAME", "stn_name"),
        ("STATION_DETAILS", "WMO_ID", "wmo_id"),
    ],
)
_SUMMARY_CELLS = _cells(
    "summary",
    "key",
    [
        ("SUMMARY_DETAILS", "AVG_TEMP", _text("avg_temp")),
        ("SUMMARY_DETAILS", "DATA_POINTS", _text("data_points")),
        ("SUMMARY_DETAILS", "LATITUDE", _text("latitude")),
        ("SUMMARY_DETAILS", "LONGITUDE", _text("longitude")),
        ("SUMMARY_DETAILS", "SEASON", "season"),
        ("SUMMARY_DETAILS", "STATIONS_LIST", "CAST(to_json(station_list) AS VARCHAR)"),
        ("SUMMARY_DETAILS", "YEAR", _text("year")),
    ],
)

_REQUESTED = """
  CAST((c_custkey * 29 % 451) / 10.0 - 22 AS DOUBLE) AS {lat},
  CAST((c_custkey * 31 % 251) / 10.0 - 12 AS DOUBLE) AS {lon}"""
_POINTS = f"""points AS (
  SELECT c_custkey AS request_id, {_REQUESTED.format(lat="latitude", lon="longitude")}
  FROM customer
)"""
_BOXES = f"""asked AS (
  SELECT c_custkey AS request_id, {_REQUESTED.format(lat="lat1", lon="lon1")},
         CASE WHEN c_mktsegment = 'FURNITURE' THEN lat1
              ELSE CAST((c_custkey * 17 % 401) / 10.0 - 20 AS DOUBLE) END AS lat2,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN lon1
              ELSE CAST((c_custkey * 19 % 201) / 10.0 - 10 AS DOUBLE) END AS lon2,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 1899
              ELSE CAST(1900 + c_custkey % 4 AS INTEGER) END AS year1,
         CAST(1900 + c_custkey % 7 AS INTEGER) AS year2
  FROM customer
),
boxes AS (
  SELECT request_id,
         least(lat1, lat2) AS latitude1, least(lon1, lon2) AS longitude1,
         greatest(lat1, lat2) AS latitude2, greatest(lon1, lon2) AS longitude2,
         least(year1, year2) AS year_from, greatest(year1, year2) AS year_to,
         CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 'the two corners are the same point'
              WHEN least(year1, year2) < 1900 THEN 'a year is before 1900' END AS error
  FROM asked
)"""


def climate_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the climate operators by name."""
    registered = [
        parse_observations,
        parse_observations_compat,
        dedupe_observations,
        observations_by_season,
        parse_stations,
        parse_countries,
        stations_with_country,
        join_stations,
        snap_to_grid,
        seasonal_grid_summary,
        stored_observations,
        stored_stations,
        stored_summary,
        coordinate_summary,
        coordinate_summary_compat,
        coordinate_document,
        coordinate_document_json,
        area_entries,
        area_average,
        area_average_compat,
        area_document,
        coordinate_summary_batch,
        area_average_batch,
        area_average_batch_stored,
        heatmap_feed,
        observation_cells,
        station_cells,
        summary_cells,
        observation_cells_round_trip,
        station_cells_round_trip,
        cells_round_trip,
        area_average_on_curve,
        coordinate_document_wire_json,
        stations_with_country_compat,
        added_observations,
        added_stations,
        refreshed_summary,
        stored_order,
        summary_text_view,
        summary_csv_round_trip,
        summary_json,
    ]
    return {query.__name__: query for query in registered}


def climate_sql() -> dict[str, str]:
    """The same results in SQL, one for each of ``climate_queries()``."""
    observations = f"WITH {_OBSERVATIONS} SELECT {_OBSERVATION_COLUMNS} FROM observations"
    stations = f"WITH {_STATIONS} SELECT {_STATION_COLUMNS} FROM stations"
    summary = f"WITH {_SUMMARY} SELECT {_SUMMARY_COLUMNS} FROM summary"
    summary_text = f"WITH {_SUMMARY} SELECT {_SUMMARY_COLUMNS} FROM summary_text"
    document = ", ".join(f"'{c.strip()}', {c.strip()}" for c in _SUMMARY_COLUMNS.split(","))
    batch = f"""
WITH {_SUMMARY}, {_BOXES}
SELECT b.request_id, b.latitude1, b.longitude1, b.latitude2, b.longitude2, b.year_from,
       b.year_to, {_ROUNDED_MEAN} AS average_temp, count(s.key) AS n_entries, b.error
FROM boxes b LEFT JOIN summary s
  ON b.error IS NULL AND s.latitude BETWEEN b.latitude1 AND b.latitude2
 AND s.longitude BETWEEN b.longitude1 AND b.longitude2
 AND s.year BETWEEN b.year_from AND b.year_to
GROUP BY ALL"""
    names = "year season avg_temp data_points stations".split()
    entry = ", ".join(f"'{name}', {name}" for name in names)
    return {
        "parse_observations": f"WITH {_RECORDS} SELECT {_OBSERVATION_COLUMNS} FROM parsed",
        "parse_observations_compat": (
            f"WITH {_RECORDS} SELECT {_OBSERVATION_COLUMNS} FROM parsed WHERE NOT titled"
        ),
        "dedupe_observations": observations,
        "observations_by_season": (
            f"WITH {_OBSERVATIONS} SELECT year, season, count(*) AS n_obs "
            "FROM observations GROUP BY year, season"
        ),
        "parse_stations": f"WITH {_STATIONS} SELECT * FROM plain_stations",
        "parse_countries": f"WITH {_STATIONS} SELECT * FROM countries",
        "stations_with_country": stations,
        "stations_with_country_compat": f"{stations} WHERE country_name IS NOT NULL",
        "join_stations": f"WITH {_JOINED} SELECT * FROM joined",
        "snap_to_grid": (
            f"WITH {_STATIONS} SELECT id, latitude, longitude, "
            "round(latitude) + 0.0 AS cell_latitude, round(longitude) + 0.0 AS cell_longitude "
            "FROM stations"
        ),
        "seasonal_grid_summary": summary,
        "stored_observations": observations,
        "stored_stations": stations,
        "stored_summary": summary,
        "coordinate_summary": f"{summary} WHERE {_HERE}",
        "coordinate_summary_compat": f"{summary} WHERE {_HERE}",
        "coordinate_document": f"""
WITH {_SUMMARY}
SELECT CAST(3.3 AS DOUBLE) AS latitude, CAST(-2.6 AS DOUBLE) AS longitude,
       CAST(row_number() OVER (ORDER BY key) - 1 AS INTEGER) AS n,
       year, season, avg_temp, data_points, stations
FROM summary WHERE {_HERE}""",
        "coordinate_document_json": f"""
WITH {_SUMMARY}
SELECT '{{"latitude":"3.3","longitude":"-2.6","data_list":['
       || coalesce(string_agg(CAST(json_object({entry}) AS VARCHAR), ',' ORDER BY key), '')
       || ']}}' AS json
FROM summary_text JOIN (SELECT key FROM summary WHERE {_HERE}) USING (key)""",
        "coordinate_document_wire_json": f"""
WITH {_SUMMARY}
SELECT '{{"lattitude":"3.3","longitude":"-2.6","dataList":['
       || coalesce(string_agg(CAST(json_object('year', year, 'season', season, 'avgTemp', avg_temp,
                                               'dataPoints', data_points, 'stations', stations)
                                   AS VARCHAR), ',' ORDER BY key), '')
       || ']}}' AS json
FROM summary_text JOIN (SELECT key FROM summary WHERE {_HERE}) USING (key)""",
        "area_average_on_curve": (
            f"WITH {_SUMMARY} SELECT {_AREA_COLUMNS}, {_ROUNDED_MEAN} AS average_temp, "
            f"count(*) AS n_entries FROM summary s WHERE {_INSIDE}"
        ),
        "added_observations": observations,
        "added_stations": stations,
        "refreshed_summary": summary,
        "stored_order": """
SELECT name, CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_overlapping
FROM (VALUES ('observations'), ('stations'), ('summary'), ('summary_cells')) t(name)""",
        "area_entries": f"{summary} WHERE {_INSIDE}",
        "area_average": (
            f"WITH {_SUMMARY} SELECT {_AREA_COLUMNS}, {_ROUNDED_MEAN} AS average_temp, "
            f"count(*) AS n_entries FROM summary s WHERE {_INSIDE}"
        ),
        "area_average_compat": f"""
WITH {_SUMMARY}
SELECT {_AREA_COLUMNS}, coalesce({_ROUNDED_MEAN}, 0.0) AS average_temp,
       count(*) AS n_entries
FROM summary_text t JOIN summary s USING (key)
WHERE t.latitude BETWEEN '-5.0' AND '10.0' AND t.longitude BETWEEN '-1.0' AND '5.0'
  AND t.year BETWEEN '1901' AND '1904'""",
        "area_document": f"""
WITH {_SUMMARY}
SELECT 0 AS part, '' AS key, {_ROUNDED_MEAN} AS average_temp, '-5.0' AS latitude1,
       '-1.0' AS longitude1, '10.0' AS latitude2, '5.0' AS longitude2, '1901' AS year_from,
       '1904' AS year_to, NULL AS year, NULL AS season, NULL AS avg_temp, NULL AS data_points,
       NULL AS stations, NULL AS closing
FROM summary s WHERE {_INSIDE}
UNION ALL
SELECT 1, key, NULL, NULL, NULL, NULL, NULL, NULL, NULL, t.year, t.season, t.avg_temp,
       t.data_points, t.stations, NULL
FROM summary_text t JOIN (SELECT key FROM summary WHERE {_INSIDE}) USING (key)
UNION ALL
SELECT 2, '', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, ']}}'""",
        "coordinate_summary_batch": f"""
WITH {_SUMMARY}, {_POINTS}
SELECT p.request_id, p.latitude, p.longitude, s.key, s.year, s.season, s.avg_temp,
       s.data_points, s.stations
FROM points p LEFT JOIN summary s
  ON s.latitude = round(p.latitude) AND s.longitude = round(p.longitude)""",
        "area_average_batch": batch,
        "area_average_batch_stored": batch,
        "heatmap_feed": f"""
WITH {_SUMMARY}
SELECT year, max(CASE WHEN season = 'WINTER' THEN avg_temp END) AS "WINTER",
       max(CASE WHEN season = 'SPRING' THEN avg_temp END) AS "SPRING",
       max(CASE WHEN season = 'SUMMER' THEN avg_temp END) AS "SUMMER",
       max(CASE WHEN season = 'FALL' THEN avg_temp END) AS "FALL"
FROM summary WHERE {_HERE} GROUP BY year""",
        "observation_cells": f"WITH {_OBSERVATIONS} {_OBSERVATION_CELLS}",
        "station_cells": f"WITH {_STATIONS} {_STATION_CELLS}",
        "summary_cells": f"WITH {_SUMMARY} {_SUMMARY_CELLS}",
        "observation_cells_round_trip": observations,
        "station_cells_round_trip": stations,
        "cells_round_trip": summary,
        "summary_text_view": summary_text,
        "summary_csv_round_trip": summary_text,
        "summary_json": (
            f"WITH {_SUMMARY} SELECT CAST(json_object({document}) AS VARCHAR) AS json "
            "FROM summary_text"
        ),
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name; each takes the session and the folder of the tables."""
    if llm is None:
        return climate_queries()
    return climate_queries() | llm.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, as far as SQL can express them."""
    if llm is None:
        return climate_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return climate_sql() | llm.oracle_sql() | pipeline


def entry(spark: SparkSession) -> DataFrame:
    """The seasonal grid from raw lines, on the smallest tables."""
    return seasonal_grid_summary(spark, "/root/testdata/sf0.001")
