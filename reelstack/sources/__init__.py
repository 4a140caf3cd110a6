"""Sources and sinks of the layers."""

from .bucketed import scan_bucketed, sink_bucketed
from .landing import land_raw, manifest, verify_landing
from .pages import flatten_pages
from .readers import scan_csv_pipe, scan_layer, scan_ndjson, scan_ndjson_checked
from .sinks import (file_stats, read_star, sink_ndjson, sink_parquet, sink_partitioned, star_paths,
                    star_states, write_star)

__all__ = [
    "flatten_pages", "land_raw", "manifest", "verify_landing", "scan_csv_pipe", "scan_layer", "scan_ndjson",
    "scan_ndjson_checked", "file_stats", "read_star", "sink_ndjson", "sink_parquet", "sink_partitioned",
    "star_paths", "write_star", "scan_bucketed", "sink_bucketed", "star_states",
]
