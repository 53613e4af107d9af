"""Reusable DataFrame operators."""

from martwright.operators.changes import change_points, hot_keys, previous_value
from martwright.operators.filters import (
    active_at,
    fill_zero,
    having,
    high_water,
    last_days,
    newer_than,
    on_date,
    previous_month,
    since,
    with_status,
)
from martwright.operators.joins import (
    broadcast_if_small,
    exclude,
    full,
    inner,
    keep_in,
    left,
    lookup,
    star,
)
from martwright.operators.members import (
    empty_like,
    insert_new,
    new_members,
    promote_staging,
    upsert,
    upsert_add,
    with_default,
    with_load_meta,
)
from martwright.operators.quality import (
    check,
    defaults,
    not_null,
    profile,
    quality_report,
    references,
    unique,
    write_checked,
)
from martwright.operators.ranking import (
    list_parts,
    ntile_score,
    ntile_scores,
    number_rows,
    period_rank,
    surrogate_id,
    top,
)
from martwright.operators.rows import count_flags, dedupe, distinct_rows, first_by, milestone, ordered_list
from martwright.operators.spatial import close_pairs, grid_join, nearest, sharing_pairs

__all__ = [
    "active_at",
    "broadcast_if_small",
    "change_points",
    "check",
    "count_flags",
    "dedupe",
    "defaults",
    "distinct_rows",
    "empty_like",
    "exclude",
    "fill_zero",
    "first_by",
    "full",
    "close_pairs",
    "grid_join",
    "having",
    "high_water",
    "hot_keys",
    "inner",
    "insert_new",
    "keep_in",
    "last_days",
    "left",
    "list_parts",
    "lookup",
    "milestone",
    "nearest",
    "sharing_pairs",
    "new_members",
    "newer_than",
    "not_null",
    "ntile_score",
    "ntile_scores",
    "number_rows",
    "on_date",
    "ordered_list",
    "period_rank",
    "previous_month",
    "previous_value",
    "profile",
    "promote_staging",
    "quality_report",
    "references",
    "since",
    "star",
    "surrogate_id",
    "top",
    "unique",
    "write_checked",
    "upsert",
    "upsert_add",
    "with_default",
    "with_load_meta",
    "with_status",
]
