"""Column-level helpers: calendar parts, missing-value predicates, projections."""

from tidecast.functions.calendar import (  # noqa: F401
    date_parts, day_of_week, hour_of, fulldate, parse_date, date_sequence, with_calendar,
)
from tidecast.functions.columns import (  # noqa: F401
    rename, drop_columns, lower_columns, feature_columns, split_xy, is_missing,
    sentinel_to_null_expr, numeric_columns, float_columns,
)
