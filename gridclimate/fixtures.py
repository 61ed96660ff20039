"""Raw lines for trials and tests, derived from the customer, nation and orders tables.

Each customer becomes a station, each nation a country and each order a monthly record.
``FIXTURES.md`` lists the formulas. Temperatures lie on a quarter-degree grid, so that sums are
exact in any order.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = '","'


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _country_code(nation: Column) -> Column:
    return F.concat(F.lit("N"), F.char(F.lit(65) + nation))


def _station_id(nation: Column, customer: Column) -> Column:
    return F.concat(_country_code(nation), F.lpad(customer.cast("string"), 9, "0"))


def country_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries of all nations but those of region 3, whose codes stay unknown."""
    nation = _table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 3)
    line = F.concat_ws(" ", _country_code(F.col("n_nationkey")), F.col("n_name"))
    return nation.select(line.alias("value"))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, c = _table(spark, sf_dir, "customer"), F.col("c_custkey")
    line = F.concat_ws(
        " ",
        _station_id(F.col("c_nationkey"), c),
        F.printf(F.lit("%8.4f"), (c * 37 % 161) / 4 - 20),
        F.printf(F.lit("%9.4f"), (c * 53 % 81) / 4 - 10),
        F.printf(F.lit("%6.1f"), F.floor(F.col("c_acctbal") / 10).cast("double")),
        F.lit("  "),
        F.rpad("c_name", 30, " "),
        F.lit("GSN"),
        F.lit("HCN"),
        F.lit("00000"),
    )
    return customer.select(line.alias("value"))


def _pending(priority: str) -> Column:
    """Open orders of one priority: each priority gives its own kind of unusable record."""
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == priority)


def observation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record line per order, and a header line per nation as each file of an archive has."""
    orders, customer = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "customer")
    k, date = F.col("o_orderkey"), F.col("o_orderdate")

    known = _station_id(F.col("c_nationkey"), F.col("o_custkey"))
    unknown = F.concat(F.lit("ZZ"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    station = F.when(_pending("2-HIGH"), unknown).otherwise(known)
    year = (F.year(date) - 97).cast("string")
    month = F.concat_ws("-", year, F.lpad(F.month(date).cast("string"), 2, "0"))
    temperature = (
        F.when(_pending("5-LOW"), "")
        .when(_pending("4-NOT SPECIFIED"), " 1.5")
        .otherwise((((k % 161) / 4) - 20).cast("string"))
    )
    precipitation = F.when(F.col("o_orderstatus") == "F", "").otherwise(
        ((k % 400) / 4).cast("string")
    )
    # one name of a place holds the title of the first column
    place = F.when(_pending("1-URGENT"), "PALMER STATION").otherwise(F.col("c_name"))
    fillers = F.when(_pending("3-MEDIUM"), 39).otherwise(99)
    fields = F.concat(
        F.array(station, month, place),
        F.array_repeat(F.lit(""), fillers),
        F.array(precipitation, F.lit(""), F.lit(""), F.lit(""), temperature, F.lit("")),
    )
    records = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        _line(fields)
    )

    titles = F.concat(
        F.array(F.lit("STATION"), F.lit("DATE")), F.array_repeat(F.lit("ELEMENT"), 106)
    )
    headers = _table(spark, sf_dir, "nation").select(_line(titles))
    return records.unionByName(headers)


def _line(fields: Column) -> Column:
    line = F.concat(F.lit('"'), F.array_join(fields, SEPARATOR), F.lit('"'))
    # filters are not pushed below explode, so each line is made once, as if read from a file
    return F.explode(F.array(line)).alias("value")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coordinate request per customer, some beyond all stations."""
    c = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(
        c.alias("request_id"),
        ((c * 29 % 451) / 10 - 22).alias("latitude"),
        ((c * 31 % 251) / 10 - 12).alias("longitude"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area request per customer: corners in any order, some bad, some without data."""
    c = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    latitude, longitude = (c * 29 % 451) / 10 - 22, (c * 31 % 251) / 10 - 12
    same = segment == "FURNITURE"
    return _table(spark, sf_dir, "customer").select(
        c.alias("request_id"),
        latitude.alias("latitude1"),
        longitude.alias("longitude1"),
        F.when(same, latitude).otherwise((c * 17 % 401) / 10 - 20).alias("latitude2"),
        F.when(same, longitude).otherwise((c * 19 % 201) / 10 - 10).alias("longitude2"),
        F.when(segment == "MACHINERY", 1899).otherwise(1900 + c % 4).cast("int").alias("year1"),
        (1900 + c % 7).cast("int").alias("year2"),
    )
