from .lines import read_country_lines, read_observation_lines, read_station_lines
from .tables import read_table, table_path

__all__ = [
    "read_country_lines",
    "read_observation_lines",
    "read_station_lines",
    "read_table",
    "table_path",
]
