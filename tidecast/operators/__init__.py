"""DataFrame -> DataFrame operators."""

from tidecast.operators.fill import (  # noqa: F401
    backward_fill, ffill_bfill, ffill_pandas_api, forward_fill, lag_diff, lag_fill, lag_value,
    last_non_null, lead_fill, lead_value, sentinel_to_null, shift,
)
from tidecast.operators.index import partition_count, row_index  # noqa: F401
from tidecast.operators.joins import asof_join, complete_case_join, enrich  # noqa: F401
from tidecast.operators.profile import (  # noqa: F401
    between_dates, count_by_split, count_rows, drop_missing, histogram, min_max, null_count,
    null_profile, summary, to_long,
)
from tidecast.operators.scale import minmax, zscore, zscore_then_minmax  # noqa: F401
from tidecast.operators.split import (  # noqa: F401
    first_row, hash_split, latest, limit_n, ordered_split, split_frames, subtract_rows, tail_split,
    test_dates,
)
