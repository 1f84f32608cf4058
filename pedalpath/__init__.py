"""Hot-path analytics over trip events, on Spark."""

from .config import DEFAULT, PathConfig
from .functions.shedding import shed
from .operators.clean import clean_trips, rejected_trips, sharded_rows
from .operators.overload import attach_flag, backlog, overload_switch
from .operators.sequence import chain_summary, drop_late, open_chains, sequence_trips
from .plans.hot_paths import early_variant, first_details, hot_paths, match_counts, match_details
from .plans.reports import compare_counts, count_correlation, sample_details, top_bikes, totals
from .sources.logs import read_match_log
from .sources.streams import read_matches, stream_matches, stream_trip_records
from .sources.trips import read_month_folders, read_trip_csv
from .streaming.ingest import csv_ingest_sink
from .streaming.matcher import dedupe_sink, dedupe_stream, hot_path_sink, hot_path_stream
from .streaming.monitor import latency_sink, latency_stream, overload_stream, read_latency

__all__ = [
    "DEFAULT", "PathConfig", "attach_flag", "backlog", "chain_summary", "clean_trips", "compare_counts",
    "count_correlation", "csv_ingest_sink", "dedupe_sink", "dedupe_stream", "drop_late", "early_variant", "first_details", "hot_path_sink", "hot_path_stream",
    "hot_paths", "latency_sink", "latency_stream", "match_counts", "match_details", "open_chains", "overload_stream", "overload_switch",
    "read_latency", "read_match_log", "read_matches", "read_month_folders", "read_trip_csv", "rejected_trips",
    "sample_details", "sequence_trips", "sharded_rows", "shed", "stream_matches", "stream_trip_records",
    "top_bikes", "totals",
]
