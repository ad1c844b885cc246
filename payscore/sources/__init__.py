from payscore.sources.config import Feature, Range, active_features, load_feature_list, load_ranges
from payscore.sources.sinks import overwrite_partition, write_file, write_table
from payscore.sources.staging import (
    attach_months,
    conform,
    drop_header_lines,
    read_month,
    read_year,
    stage_for_scoring,
    stage_month,
    stage_year,
)

__all__ = [
    "Feature", "Range", "active_features", "load_feature_list", "load_ranges",
    "overwrite_partition", "write_file", "write_table",
    "attach_months", "conform", "drop_header_lines", "read_month", "read_year",
    "stage_for_scoring", "stage_month", "stage_year",
]
