from sluice.functions.columns import (  # noqa: F401
    BLANK_SENTINELS,
    BLANK_SENTINELS_SMART_HOME,
    REJECT_SENTINELS,
    SENTINEL_PRESETS,
    blanked,
    content_key,
    epoch_seconds_to_ntz,
    is_sentinel,
    ntz_to_epoch_seconds,
    parse_day_first_date,
    round_binary_half_even,
    round_half_even,
    round_half_up,
    text_to_ntz,
)
