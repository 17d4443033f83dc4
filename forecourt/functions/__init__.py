from forecourt.functions import columns, rules
from forecourt.functions.columns import (
    LOCAL_OFFSET_MINUTES,
    flag_label,
    full_name,
    local_date,
    local_floor,
    local_time,
    money,
    month_of,
    null_fallback,
    nullif,
    pattern_bucket,
    relabel,
    scaled,
    sentinel_normalise,
    ntz_literal,
    three_way_label,
    two_flag_label,
    utc_floor,
    with_suffix,
)

__all__ = [
    "LOCAL_OFFSET_MINUTES",
    "columns",
    "flag_label",
    "full_name",
    "local_date",
    "local_floor",
    "local_time",
    "money",
    "month_of",
    "null_fallback",
    "nullif",
    "pattern_bucket",
    "relabel",
    "rules",
    "scaled",
    "sentinel_normalise",
    "ntz_literal",
    "three_way_label",
    "two_flag_label",
    "utc_floor",
    "with_suffix",
]
