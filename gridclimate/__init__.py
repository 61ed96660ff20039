"""Gridded climate analytics on PySpark: station records to a seasonal 1° × 1° grid."""

from .functions import cell_of, cell_of_value, observation_key, season_of, summary_key
from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .plans import (
    build_area_sums,
    build_summary,
    ingest_observations,
    ingest_stations,
    read_area_sums,
    refresh_summary,
)
from .sinks import (
    export_csv,
    merge_table,
    register_summary_view,
    shared_folder,
    to_json_documents,
    write_document,
    write_table,
)
from .sources import (
    read_country_lines,
    read_observation_lines,
    read_station_lines,
    read_table,
)

__all__ = [
    *_operators,
    "build_area_sums",
    "build_summary",
    "cell_of",
    "cell_of_value",
    "export_csv",
    "ingest_observations",
    "ingest_stations",
    "merge_table",
    "observation_key",
    "read_area_sums",
    "read_country_lines",
    "read_observation_lines",
    "read_station_lines",
    "read_table",
    "refresh_summary",
    "register_summary_view",
    "season_of",
    "shared_folder",
    "summary_key",
    "to_json_documents",
    "write_document",
    "write_table",
]
