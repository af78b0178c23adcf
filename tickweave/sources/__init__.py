"""Scans and sinks: driver tables, tick CSV/JSON, point-map JSON, HTML tables."""

from tickweave.sources.events import load_table, ticks_from_events
from tickweave.sources.files import (
    point_rejects,
    points_to_ticks,
    read_point_json,
    read_ticks_csv,
    read_ticks_json,
    write_result,
    write_ticks,
    write_windows,
)
from tickweave.sources.html import html_table_rows

__all__ = [
    "load_table",
    "ticks_from_events",
    "read_ticks_csv",
    "read_ticks_json",
    "read_point_json",
    "points_to_ticks",
    "point_rejects",
    "write_ticks",
    "write_result",
    "write_windows",
    "html_table_rows",
]
