"""pacecast - month-end pace forecasting of daily business metrics on Spark.

Raw facts are rolled up into one long daily series with month-to-date
figures; each anchor day is compared with the same point of the three
previous months (aligning months of different length) to project the
month end three ways, their mean and a straight line, with spread, bounds,
errors against the realised value and last month's accuracy. Everything
is DataFrame work over a spine of anchor days.
"""

from .operators.backtest import backtest_errors, lookback_accuracy
from .operators.calendar import (backfill_spine, calendar_from_range, calendar_spine,
                                 spine_for_anchors, week_start)
from .operators.forecast import dispersion_bands, linear_projection, pace_forecast
from .operators.lookup import period_lookup
from .operators.series import (coded_series, cube_slice_series, hourly_peak_series,
                               metric_series, month_to_date, pair_total_series,
                               row_fee_series)
from .plans.pipeline import OUTPUT_COLUMNS, backfill, forecast_days, run_day
from .session import build_session, shared_dir
from .sources.store import write_slice

__all__ = [
    "backtest_errors", "lookback_accuracy", "backfill_spine", "calendar_from_range",
    "calendar_spine", "spine_for_anchors", "week_start", "dispersion_bands",
    "linear_projection", "pace_forecast", "period_lookup", "coded_series",
    "cube_slice_series", "hourly_peak_series", "metric_series", "month_to_date",
    "pair_total_series", "row_fee_series", "OUTPUT_COLUMNS", "backfill", "forecast_days",
    "run_day", "build_session", "shared_dir", "write_slice",
]
