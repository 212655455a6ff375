"""Column-returning helpers usable in DataFrame code (no Python UDFs)."""

from tillpanel.functions.calendar import (  # noqa: F401
    is_major_holiday_week,
    nth_weekday,
    week_ending_friday,
)
from tillpanel.functions.metrics import (  # noqa: F401
    clip_at_zero,
    exact_mean,
    exact_sum,
    invert_forecast,
    log_target,
    mae,
    metric_aggs,
    nan_to_null,
    rmse,
    rmsle,
)
