from sluice.operators.bucketed import create_bucketed, merge_into, merged_with, read_bucketed  # noqa: F401
from sluice.operators.clean import (  # noqa: F401
    blank_sentinels,
    dedup_rows,
    drop_blank_rows,
    reject_sentinel_rows,
    rejected_sentinel_rows,
    stage_row_counts,
    trace_counts,
    traced,
)
from sluice.operators.partials import folded, partial_stats, with_folded_stats  # noqa: F401
from sluice.operators.shape import (  # noqa: F401
    add_totals,
    cast_by_schema,
    day_prune,
    epoch_to_timestamp,
    format_amount,
    in_windows,
    parse_dates,
    reorder_columns,
    replace_with_sum,
    round_column,
    stay_days,
    text_to_timestamp,
    time_range,
)
from sluice.operators.stamp import batch_stamp, new_batch_id, random_row_id, row_key  # noqa: F401
from sluice.operators.stats import (  # noqa: F401
    argmax_column,
    day_extremes,
    day_over_day_delta,
    daily_totals,
    describe_columns,
    global_stats,
    risk_score,
    with_scalar_stats,
    top_k_counts,
    with_day_extremes,
    with_global_stats,
)
from sluice.operators.upsert import create_keyed_table, keyed_upsert, upsert_buckets  # noqa: F401
