"""Scalar column expressions used by the operators."""

from tillroll.functions.dates import (  # noqa: F401
    DATE_PARTS_SQL, as_date_lit, date_parts, epoch_seconds, epoch_to_date, month_name, months_back, ts_text,
)
from tillroll.functions.rounding import exact_sums, half_up, mean_tenths, tenths, toward_zero, total_tenths  # noqa: F401
from tillroll.functions.text import bar_label, fixed1, thousands, tick_label  # noqa: F401
