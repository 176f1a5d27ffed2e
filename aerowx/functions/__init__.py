"""Column expressions (all built-in, JVM-side, codegen friendly)."""

from aerowx.functions.timecols import (  # noqa: F401
    arrival_ts, departure_ts, format_date, hour_of, obs_date,
    observation_dates, split_hhmm, to_seconds, weather_ts, week_of_month)
from aerowx.functions.weathercols import (  # noqa: F401
    precip, sky_condition, to_double, weather_type, wind_speed)
