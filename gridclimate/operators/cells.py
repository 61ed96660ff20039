"""Wide typed rows to cells of text (key, family, qualifier, value), and back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..schemas import CELL

# Column family, and qualifier of each column, per table.
OBSERVATION_CELLS = {
    "month": ("ID_DETAILS", "MONTH"),
    "station_code": ("ID_DETAILS", "STATION_CODE"),
    "year": ("ID_DETAILS", "YEAR"),
    "avg_temp": ("WEATHER_DATA", "AVG_TEMP"),
    "precipitation": ("WEATHER_DATA", "PRECIPITATION"),
    "season": ("WEATHER_DATA", "SEASON"),
}
STATION_CELLS = {
    "country_name": ("STATION_DETAILS", "COUNTRY"),
    "country_cd": ("STATION_DETAILS", "COUNTRY_CD"),
    "elevation": ("STATION_DETAILS", "ELEVATION"),
    "gsn": ("STATION_DETAILS", "GSN"),
    "hcn_crn": ("STATION_DETAILS", "HCN_CRN"),
    "id": ("STATION_DETAILS", "ID"),
    "latitude": ("STATION_DETAILS", "LATITUDE"),
    "longitude": ("STATION_DETAILS", "LONGITUDE"),
    "state": ("STATION_DETAILS", "STATE"),
    "stn_name": ("STATION_DETAILS", "STATION_NAME"),
    "wmo_id": ("STATION_DETAILS", "WMO_ID"),
}
SUMMARY_CELLS = {
    "avg_temp": ("SUMMARY_DETAILS", "AVG_TEMP"),
    "data_points": ("SUMMARY_DETAILS", "DATA_POINTS"),
    "latitude": ("SUMMARY_DETAILS", "LATITUDE"),
    "longitude": ("SUMMARY_DETAILS", "LONGITUDE"),
    "season": ("SUMMARY_DETAILS", "SEASON"),
    "stations": ("SUMMARY_DETAILS", "STATIONS_LIST"),
    "year": ("SUMMARY_DETAILS", "YEAR"),
}


def _cell_text(name: str, data_type: DataType) -> Column:
    """Text that reads back to the same value; lists become JSON, as they may hold any text."""
    column = F.col(name)
    return F.to_json(column) if isinstance(data_type, ArrayType) else column.cast("string")


def to_cells(rows: DataFrame, layout: dict, key: str = "key") -> DataFrame:
    """One cell per row and column of the layout; a NULL has no cell."""
    texts = [
        _cell_text(name, rows.schema[name].dataType).alias(qualifier)
        for name, (_, qualifier) in layout.items()
    ]
    qualifiers = [qualifier for _, qualifier in layout.values()]
    families = F.create_map(*[F.lit(v) for f, q in layout.values() for v in (q, f)])
    return (
        rows.select(F.col(key).alias("key"), *texts)
        .unpivot("key", qualifiers, "qualifier", "value")
        .where(F.col("value").isNotNull())
        .withColumn("family", families[F.col("qualifier")])
        .select(*CELL.fieldNames())
    )


def from_cells(cells: DataFrame, layout: dict, schema: StructType) -> DataFrame:
    """Typed rows of a table of cells: the inverse of ``to_cells``.

    The greatest value is taken where a cell occurs twice. Columns without a place in the layout
    are taken from the key.
    """
    values = [
        F.max(F.when((F.col("family") == family) & (F.col("qualifier") == qualifier), F.col("value")))
        .alias(name)
        for name, (family, qualifier) in layout.items()
    ]
    wide = cells.groupBy("key").agg(*values)

    def typed(field) -> Column:
        if field.name not in layout:
            return F.col("key").cast(field.dataType).alias(field.name)
        if isinstance(field.dataType, ArrayType):
            return F.from_json(field.name, field.dataType).alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return wide.select(*[typed(field) for field in schema.fields])
