"""Column-level functions (no DataFrame shape changes)."""

from tidemark.functions.checks import label
from tidemark.functions.labels import labels_to_columns, match_labels, matcher, organize
from tidemark.functions.numeric import (
    band,
    exact,
    exact_mean,
    exact_units,
    mean_of_decimal,
    scale,
    sum_units,
    to_table_decimal,
    units_to_double,
)
from tidemark.functions.time import (
    as_timestamp_literal,
    epoch_ms,
    iso_string,
    ms_to_ts,
    parse_timestamp,
    to_timestamp_utc,
    window_start_ms,
)

__all__ = [
    "as_timestamp_literal",
    "band",
    "epoch_ms",
    "exact",
    "exact_mean",
    "exact_units",
    "iso_string",
    "label",
    "labels_to_columns",
    "match_labels",
    "matcher",
    "mean_of_decimal",
    "ms_to_ts",
    "organize",
    "parse_timestamp",
    "scale",
    "sum_units",
    "to_table_decimal",
    "to_timestamp_utc",
    "units_to_double",
    "window_start_ms",
]
