from bourse.functions.scalars import (  # noqa: F401
    bucketize, epoch_to_local, millis_to_timestamp, utc_to_zone, pct_change,
    safe_div, to_number, to_date_safe, period_label, excludes_any, binary_to_text,
    ratio_round,
)
from bourse.functions.aggs import (  # noqa: F401
    first_when, min_when, max_when, first_non_null, priority_first,
)
