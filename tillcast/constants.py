"""Names, windows and thresholds that results depend on."""

# The 45 model features, in model input order.
FEATURES = [
    "lag_1", "lag_7", "lag_14", "lag_21", "lag_28",
    "rolling_mean_7", "rolling_mean_14", "rolling_mean_28",
    "rolling_std_7", "rolling_std_14", "rolling_std_28",
    "stockout_ratio_7d", "stockout_ratio_14d", "stockout_ratio_28d",
    "stockout_ratio", "is_stockout", "stockout_hours",
    "series_scale",
    "day_of_week", "week_of_year", "month", "is_weekend", "day_of_month",
    "sin_7d_h1", "cos_7d_h1", "sin_7d_h2", "cos_7d_h2", "sin_7d_h3", "cos_7d_h3",
    "sin_30d_h1", "cos_30d_h1", "sin_30d_h2", "cos_30d_h2", "sin_30d_h3", "cos_30d_h3",
    "discount", "activity_flag", "holiday_flag",
    "precpt", "avg_temperature", "avg_humidity", "avg_wind_level",
    "first_category_id_te", "city_id_te",
    "city_id",
]

# Feature windows.
LAGS = (1, 7, 14, 21, 28)
WINDOWS = (7, 14, 28)
SCALE_WINDOW, SCALE_MIN_ROWS = 90, 7
FOURIER_PERIODS, FOURIER_HARMONICS = (7, 30), (1, 2, 3)

# Hours of a day, operating hours [6, 22), window length in days.
HOURS_PER_DAY, OPEN_HOUR, CLOSE_HOUR = 24, 6, 22
OPERATING_HOURS = CLOSE_HOUR - OPEN_HOUR
HORIZON_DAYS, WINDOW_DAYS = 90, 30
HOURLY_COVARIATES = ("discount", "holiday_flag", "precpt", "avg_temperature")
COVARIATE_OFFSET = 0.1

# Split, recency weights, encoding and denominators.
TEST_DAYS, VAL_DAYS = 7, 7
RECENT_DAYS, MID_DAYS = 30, 60
RECENT_WEIGHT, MID_WEIGHT, OLD_WEIGHT = 1.0, 0.5, 0.25
ENCODED_COLUMNS, SMOOTHING_ROWS = ("first_category_id", "city_id"), 100
RATIO_OFFSET = 0.01
CHANGED_TOLERANCE = 1e-6
MIN_DENOMINATOR = 1e-8
MIN_STOCKOUT_LEVELS = 3

# Blend, stacking, neighbours, group sizes, backtest, sample.
BLEND_OBSERVED, BLEND_RECOVERED = 0.7, 0.3
RIDGE_ALPHA, STACK_ALPHA, STACK_MIN_ROWS, STACK_FOLDS = 10.0, 1.0, 100, 3
NEIGHBOURS = 15
GROUP_MIN_ROWS, GROUP_MIN_TARGETS = 100, 50
BACKTEST_HORIZON, BACKTEST_WINDOWS, BACKTEST_STEP, BACKTEST_INPUT = 7, 2, 7, 30
IMPORTANCE_SAMPLE = 5000
BASELINE_WAPE, NEAR_WAPE = 27.62, 30.0

# Request limits and the defaults of absent request fields.
HISTORY_DAYS, MIN_HISTORY_DAYS, MIN_FORECAST_DAYS = 28, 7, 1
HISTORY_DEFAULTS = {
    "sale_amount": 0.0, "stockout_ratio": 0.0, "is_stockout": 0, "stockout_hours": 0,
}
FORECAST_DEFAULTS = {
    "day_of_week": 0, "week_of_year": 1, "month": 1, "is_weekend": 0, "day_of_month": 1,
    "discount": 0.0, "activity_flag": 0, "holiday_flag": 0,
    "precpt": 0.0, "avg_temperature": 25.0, "avg_humidity": 70.0, "avg_wind_level": 2.0,
    "city_id": 0, "first_category_id_te": 1.0, "city_id_te": 1.0,
}
FORECAST_RANGES = {
    "day_of_week": (0, 6), "week_of_year": (1, 53), "month": (1, 12),
    "is_weekend": (0, 1), "day_of_month": (1, 31),
}

SERIES_KEYS = ("store_id", "product_id")
DATE = "dt"


def features_without(prefixes):
    """The registry without the families whose names start with a prefix."""
    return [f for f in FEATURES if not f.startswith(tuple(prefixes))]


def present_features(df):
    """Registry names the frame has, in registry order."""
    return [f for f in FEATURES if f in df.columns]


FOURIER_PREFIXES = ("sin_", "cos_")
# Columns whose value for a future day is not known when the forecast is made.
SAME_DAY_STOCKOUT = ("stockout_ratio", "is_stockout", "stockout_hours")


def known_at_forecast():
    """The registry without same-day stockout columns."""
    return [f for f in FEATURES if f not in SAME_DAY_STOCKOUT]
