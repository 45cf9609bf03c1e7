"""Readers and writers: the driver-table adapter, CSV inputs, result sinks."""

from promoscope.sources.driver_tables import Tables
from promoscope.sources.files import read_table, read_lines, parse_log_lines, parse_user_lines
from promoscope.sources.sinks import (
    write_ranked_csv, write_ranked_text, write_scores, write_train_scores,
)

__all__ = [
    "Tables", "read_table", "read_lines", "parse_log_lines", "parse_user_lines",
    "write_ranked_csv", "write_ranked_text", "write_scores", "write_train_scores",
]
