from forecourt.operators.aggs import (
    fanout_factor,
    fanout_sum,
    group_hidden_key,
    multi_measure,
    status_pivot,
)
from forecourt.operators.joins import (
    full_outer,
    guarded_join,
    hot_keys,
    lookup,
    lookup_chain,
    merge_null_safe,
    polymorphic_lookup,
    role,
    salted_lookups,
)
from forecourt.operators.latest import latest_per_key, max_id_per_key, owner_by_max_id
from forecourt.operators.windows import dense_rank_first, previous_in_range, repeat_deals, with_previous

__all__ = [
    "dense_rank_first",
    "fanout_factor",
    "fanout_sum",
    "full_outer",
    "group_hidden_key",
    "guarded_join",
    "hot_keys",
    "latest_per_key",
    "lookup",
    "lookup_chain",
    "max_id_per_key",
    "merge_null_safe",
    "multi_measure",
    "owner_by_max_id",
    "polymorphic_lookup",
    "previous_in_range",
    "repeat_deals",
    "role",
    "salted_lookups",
    "status_pivot",
    "with_previous",
]
