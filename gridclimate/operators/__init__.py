from .batches import area_average_batch, coordinate_summary_batch
from .cells import OBSERVATION_CELLS, STATION_CELLS, SUMMARY_CELLS, from_cells, to_cells
from .grid import join_stations, seasonal_grid_summary, snap_to_grid
from .lookups import (
    area_average,
    area_document,
    area_entries,
    coordinate_document,
    coordinate_summary,
    heatmap_feed,
)
from .observations import (
    drop_header_lines,
    latest_per_key,
    observations_by_season,
    parse_observations,
)
from .stations import add_country, latest_per_station, parse_countries, parse_stations

__all__ = [
    "OBSERVATION_CELLS",
    "STATION_CELLS",
    "SUMMARY_CELLS",
    "add_country",
    "area_average",
    "area_average_batch",
    "area_document",
    "area_entries",
    "coordinate_document",
    "coordinate_summary",
    "coordinate_summary_batch",
    "drop_header_lines",
    "from_cells",
    "heatmap_feed",
    "join_stations",
    "latest_per_key",
    "latest_per_station",
    "observations_by_season",
    "parse_countries",
    "parse_observations",
    "parse_stations",
    "seasonal_grid_summary",
    "snap_to_grid",
    "to_cells",
]
