from .jobs import (
    build_area_sums,
    build_summary,
    ingest_observations,
    ingest_stations,
    read_area_sums,
    refresh_summary,
)

__all__ = [
    "build_area_sums",
    "build_summary",
    "ingest_observations",
    "ingest_stations",
    "read_area_sums",
    "refresh_summary",
]
