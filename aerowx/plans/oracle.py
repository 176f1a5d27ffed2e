"""DuckDB oracle SQL for every checkable query in the catalog.

Every statement starts from the driver's base tables: the shared CTE prefix
re-derives the fixtures (same rules as ``aerowx.sources.fixtures``) and then
the reference semantics, written independently of the Spark code where that
is practical (self-join for the hour representative, a range join for the
observation windows, ranks for the encoders).  Unreferenced CTEs are not
evaluated.
"""

from __future__ import annotations

THRESHOLD = 45

W_FIELDS = ["AIRPORT_ID", "Weather_TIMESTAMP", "DryBulbCelsius", "SkyCondition",
            "Visibility", "WindSpeed", "WeatherType", "HourlyPrecip"]
WO = [f"WO_{11 - i:02d}H" for i in range(12)]
WD = [f"WD_{11 - i:02d}H" for i in range(12)]
CODES = ["RA", "SN", "FG", "FG+", "WIND", "FZDZ", "FZRA", "MIFG", "FZFG"]

PREFIX = r"""
WITH tz AS (
  SELECT cast(s_suppkey AS INTEGER) AS AirportID, cast(10000 + s_suppkey AS INTEGER) AS WBAN,
         cast(-5 - (s_nationkey % 4) AS DOUBLE) AS TimeZone
  FROM supplier),
n_stations AS (SELECT count(*) AS n_st FROM supplier),
placed AS (
  SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE (o_custkey + c_nationkey) % n_st END AS origin
  FROM orders JOIN customer ON o_custkey = c_custkey, n_stations),
flights_raw AS (
  SELECT cast(DATE '2024-01-02' + cast(o_orderkey % 28 AS INTEGER) AS DATE) AS FL_DATE,
         cast(origin AS INTEGER) AS ORIGIN_AIRPORT_ID,
         cast((origin + 1 + o_orderkey % (n_st - 1)) % n_st AS INTEGER) AS DEST_AIRPORT_ID,
         cast(((o_orderkey * 7) % 24) * 100 + (o_orderkey * 13) % 60 AS INTEGER) AS CRS_DEP_TIME,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE cast(45 + o_orderkey % 400 AS DOUBLE) END AS CRS_ELAPSED_TIME,
         CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE cast(cast(floor(o_totalprice) AS BIGINT) % 60 AS DOUBLE) END AS ARR_DELAY_NEW,
         CASE WHEN o_orderkey % 7 = 0 THEN cast(o_orderkey % 30 AS DOUBLE) END AS WEATHER_DELAY,
         CASE WHEN o_orderkey % 11 = 0 THEN cast(o_orderkey % 45 AS DOUBLE) END AS NAS_DELAY,
         cast(CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END AS INTEGER) AS CANCELLED,
         cast(CASE WHEN o_orderkey % 83 = 0 THEN 1 ELSE 0 END AS INTEGER) AS DIVERTED
  FROM placed),
grid AS (
  SELECT cast(s_suppkey AS INTEGER) AS n, cast(h AS INTEGER) AS h
  FROM supplier, range(0, 720) t(h)
  WHERE (h * 131 + s_suppkey * 977) % 509 <> 0),
grid_readings AS (
  SELECT cast(10000 + n AS INTEGER) AS WBAN, cast(20240101 + h // 24 AS INTEGER) AS "Date",
         cast((h % 24) * 100 + (h * 11 + n * 17) % 60 AS INTEGER) AS "Time",
         CASE WHEN (h * 5 + n) % 89 = 0 THEN 'M' ELSE cast((h * 3 + n * 7) % 41 - 10 AS VARCHAR) END AS DryBulbCelsius,
         CASE (h + n) % 5 WHEN 0 THEN 'CLR' WHEN 1 THEN 'FEW010 OVC100' WHEN 2 THEN 'M' WHEN 3 THEN ''
              ELSE 'SCT025 BKN040' END AS SkyCondition,
         CASE WHEN (h * 7 + n) % 71 = 0 THEN 'M' ELSE cast((h * 7 + n * 3) % 11 AS VARCHAR) END AS Visibility,
         CASE WHEN (h + n * 3) % 31 = 0 THEN 'VR' ELSE cast((h * 7 + n) % 30 AS VARCHAR) END AS WindSpeed,
         CASE (h * 3 + n) % 11 WHEN 0 THEN 'RA' WHEN 1 THEN '-RA FG+' WHEN 2 THEN 'M' WHEN 3 THEN NULL
              WHEN 4 THEN 'FZFG' WHEN 5 THEN 'SN BR' ELSE '' END AS WeatherType,
         CASE (h + n * 2) % 13 WHEN 0 THEN 'T' WHEN 1 THEN ' ' WHEN 2 THEN NULL
              ELSE CASE (h + n) % 4 WHEN 0 THEN '0.25' WHEN 1 THEN '0.5' WHEN 2 THEN '0.75' ELSE '1.5' END
         END AS HourlyPrecip,
         CASE WHEN (h + n * 3) % 31 = 0 THEN 'VR' ELSE cast((h * 10 + n) % 360 AS VARCHAR) END AS WindDirection,
         CASE WHEN (h + n) % 43 = 0 THEN 'M' ELSE cast(cast(28 + (h + n) % 4 * 0.25 AS DECIMAL(4, 2)) AS VARCHAR) END AS StationPressure
  FROM grid),
ev AS (
  SELECT ts, event_type, value, cast(user_id % (SELECT count(*) FROM supplier) AS INTEGER) AS n FROM events),
event_readings AS (
  SELECT cast(10000 + n AS INTEGER) AS WBAN,
         cast(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS "Date",
         cast(hour(ts) * 100 + minute(ts) AS INTEGER) AS "Time",
         CASE WHEN event_type = 'error' THEN 'M' ELSE cast(cast(floor(value) AS BIGINT) % 41 - 10 AS VARCHAR) END AS DryBulbCelsius,
         CASE event_type WHEN 'view' THEN 'BKN015' WHEN 'click' THEN 'FEW020 SCT035 OVC050'
              WHEN 'signup' THEN 'VV002' WHEN 'purchase' THEN ' CLR' ELSE NULL END AS SkyCondition,
         cast(cast(floor(value) AS BIGINT) % 11 AS VARCHAR) AS Visibility,
         CASE WHEN event_type = 'signup' THEN 'VR' ELSE cast(cast(floor(value * 3) AS BIGINT) % 30 AS VARCHAR) END AS WindSpeed,
         CASE event_type WHEN 'error' THEN 'TS RA' WHEN 'purchase' THEN 'FZRA' ELSE 'M' END AS WeatherType,
         CASE WHEN event_type = 'view' THEN 'T' ELSE '0.5' END AS HourlyPrecip,
         CASE WHEN event_type = 'click' THEN NULL ELSE cast(cast(floor(value * 7) AS BIGINT) % 360 AS VARCHAR) END AS WindDirection,
         CASE WHEN event_type = 'error' THEN 'M' ELSE '29.5' END AS StationPressure
  FROM ev),
weather_raw AS (SELECT * FROM grid_readings UNION ALL SELECT * FROM event_readings),
fl_clean AS (
  SELECT DISTINCT FL_DATE, ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, CRS_DEP_TIME, CRS_ELAPSED_TIME,
         coalesce(ARR_DELAY_NEW, 0) AS ARR_DELAY_NEW, coalesce(WEATHER_DELAY, 0) AS WEATHER_DELAY,
         coalesce(NAS_DELAY, 0) AS NAS_DELAY
  FROM flights_raw
  WHERE CRS_ELAPSED_TIME IS NOT NULL AND DIVERTED <> 1 AND CANCELLED <> 1),
fl_st AS (
  SELECT f.*, o.WBAN AS ORIGIN_WBAN, d.WBAN AS DEST_WBAN, d.TimeZone - o.TimeZone AS "Dest-Orig"
  FROM fl_clean f JOIN tz o ON f.ORIGIN_AIRPORT_ID = o.AirportID
                  JOIN tz d ON f.DEST_AIRPORT_ID = d.AirportID),
fl_dep AS (
  SELECT *, CASE WHEN CRS_DEP_TIME >= 0 AND CRS_DEP_TIME // 100 <= 23 AND CRS_DEP_TIME % 100 <= 59
                 THEN cast(FL_DATE AS TIMESTAMP) + to_hours(CRS_DEP_TIME // 100) + to_minutes(CRS_DEP_TIME % 100)
            END AS dep
  FROM fl_st),
trips AS (
  SELECT ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, dep AS CRS_DEP_TIMESTAMP,
         dep + to_seconds(cast(trunc(CRS_ELAPSED_TIME * 60) AS BIGINT) + cast(trunc("Dest-Orig" * 3600) AS BIGINT))
           AS SCHEDULED_ARRIVAL_TIMESTAMP,
         ARR_DELAY_NEW
  FROM fl_dep),
trips_id AS (SELECT row_number() OVER () AS tid, * FROM trips),
airports AS (
  SELECT DISTINCT AIRPORT_ID, F_WBAN FROM (
    SELECT DEST_AIRPORT_ID AS AIRPORT_ID, DEST_WBAN AS F_WBAN FROM fl_st
    UNION ALL
    SELECT ORIGIN_AIRPORT_ID, ORIGIN_WBAN FROM fl_st)),
w_air AS (
  SELECT a.AIRPORT_ID, r."Date", r."Time", r.DryBulbCelsius, r.SkyCondition, r.Visibility,
         r.WindSpeed, r.WeatherType, r.HourlyPrecip
  FROM weather_raw r JOIN airports a ON r.WBAN = a.F_WBAN),
w_clean AS (
  SELECT AIRPORT_ID, "Date", "Time",
         TRY_CAST(DryBulbCelsius AS DOUBLE) AS DryBulbCelsius,
         CASE WHEN SkyCondition IS NULL OR SkyCondition = '' THEN 'M'
              WHEN regexp_extract(regexp_extract(SkyCondition, '(\S*)[\x00-\x20]*$', 1), '([A-Za-z]+)[0-9]*$', 1) = '' THEN 'OTHER'
              ELSE regexp_extract(regexp_extract(SkyCondition, '(\S*)[\x00-\x20]*$', 1), '([A-Za-z]+)[0-9]*$', 1)
         END AS SkyCondition,
         TRY_CAST(Visibility AS DOUBLE) AS Visibility,
         CASE WHEN WindSpeed = 'VR' THEN -1 ELSE cast(trunc(TRY_CAST(WindSpeed AS DOUBLE)) AS INTEGER) END AS WindSpeed,
         CASE WHEN WeatherType = 'M' THEN '' ELSE WeatherType END AS WeatherType,
         CASE WHEN HourlyPrecip = 'T' OR HourlyPrecip = ' ' THEN 0.0 ELSE TRY_CAST(HourlyPrecip AS DOUBLE) END AS HourlyPrecip,
         cast("Time" // 100 AS INTEGER) AS Time_hh, cast("Time" % 100 AS INTEGER) AS Time_mm
  FROM w_air),
w_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY AIRPORT_ID, "Date", Time_hh, Time_mm
      ORDER BY DryBulbCelsius NULLS FIRST, SkyCondition NULLS FIRST, Visibility NULLS FIRST,
               WindSpeed NULLS FIRST, WeatherType NULLS FIRST, HourlyPrecip NULLS FIRST, "Time") AS rn
    FROM w_clean) WHERE rn = 1),
w_mean AS (
  SELECT AIRPORT_ID, "Date", avg(DryBulbCelsius) AS average_temperature, avg(WindSpeed) AS average_windspeed,
         avg(Visibility) AS average_visibility, avg(HourlyPrecip) AS average_hourlyprecip
  FROM w_dedup
  WHERE WindSpeed <> -1 AND DryBulbCelsius IS NOT NULL AND WindSpeed IS NOT NULL
    AND HourlyPrecip IS NOT NULL AND Visibility IS NOT NULL
  GROUP BY AIRPORT_ID, "Date"),
w_joined AS (
  SELECT w.*, m.average_temperature, m.average_windspeed, m.average_visibility, m.average_hourlyprecip
  FROM w_dedup w JOIN w_mean m ON w.AIRPORT_ID = m.AIRPORT_ID AND w."Date" = m."Date"),
w_imp AS (
  SELECT AIRPORT_ID, "Date", "Time", coalesce(DryBulbCelsius, average_temperature) AS DryBulbCelsius,
         SkyCondition, coalesce(Visibility, average_visibility) AS Visibility,
         coalesce(cast(WindSpeed AS DOUBLE), average_windspeed) AS WindSpeed, WeatherType,
         coalesce(HourlyPrecip, average_hourlyprecip) AS HourlyPrecip, Time_hh, Time_mm
  FROM w_joined),
w_first AS (SELECT AIRPORT_ID, "Date", Time_hh, min(Time_mm) AS Time_mm FROM w_imp GROUP BY ALL),
w_hour AS (
  SELECT w.* FROM w_imp w JOIN w_first f
    ON w.AIRPORT_ID = f.AIRPORT_ID AND w."Date" = f."Date" AND w.Time_hh = f.Time_hh AND w.Time_mm = f.Time_mm),
obs AS (
  SELECT AIRPORT_ID,
         CASE WHEN Time_hh BETWEEN 0 AND 23
              THEN try_strptime(cast("Date" AS VARCHAR), '%Y%m%d') + to_hours(Time_hh) END AS Weather_TIMESTAMP,
         DryBulbCelsius, SkyCondition, Visibility, WindSpeed, WeatherType, HourlyPrecip
  FROM w_hour),
obs_keys AS (
  SELECT o.*, cast(Weather_TIMESTAMP AS DATE) AS obs_date FROM obs o
  UNION ALL
  SELECT o.*, cast(Weather_TIMESTAMP AS DATE) + 1 AS obs_date FROM obs o WHERE hour(Weather_TIMESTAMP) >= 12),
full_days AS (SELECT AIRPORT_ID, obs_date FROM obs_keys GROUP BY ALL HAVING count(*) = 36),
t_origin AS (
  SELECT t.* FROM trips_id t JOIN full_days d
    ON t.ORIGIN_AIRPORT_ID = d.AIRPORT_ID AND cast(t.CRS_DEP_TIMESTAMP AS DATE) = d.obs_date),
t_both AS (
  SELECT t.* FROM t_origin t JOIN full_days d
    ON t.DEST_AIRPORT_ID = d.AIRPORT_ID AND cast(t.SCHEDULED_ARRIVAL_TIMESTAMP AS DATE) = d.obs_date),
wo_rows AS (
  SELECT t.tid, o.*, row_number() OVER (PARTITION BY t.tid ORDER BY o.Weather_TIMESTAMP) AS pos
  FROM t_both t JOIN obs o ON o.AIRPORT_ID = t.ORIGIN_AIRPORT_ID
   AND o.Weather_TIMESTAMP > t.CRS_DEP_TIMESTAMP - INTERVAL 12 HOUR
   AND o.Weather_TIMESTAMP <= t.CRS_DEP_TIMESTAMP),
wd_rows AS (
  SELECT t.tid, o.*, row_number() OVER (PARTITION BY t.tid ORDER BY o.Weather_TIMESTAMP) AS pos
  FROM t_both t JOIN obs o ON o.AIRPORT_ID = t.DEST_AIRPORT_ID
   AND o.Weather_TIMESTAMP > t.SCHEDULED_ARRIVAL_TIMESTAMP - INTERVAL 12 HOUR
   AND o.Weather_TIMESTAMP <= t.SCHEDULED_ARRIVAL_TIMESTAMP),
learn_base AS (
  SELECT tid, cast(ORIGIN_AIRPORT_ID AS VARCHAR) AS ORIGIN_AIRPORT_ID, cast(DEST_AIRPORT_ID AS VARCHAR) AS DEST_AIRPORT_ID,
         cast(hour(CRS_DEP_TIMESTAMP) AS INTEGER) AS Hour_SO, cast(hour(SCHEDULED_ARRIVAL_TIMESTAMP) AS INTEGER) AS Hour_SA,
         cast(month(CRS_DEP_TIMESTAMP) AS INTEGER) AS Month_SO, cast(month(SCHEDULED_ARRIVAL_TIMESTAMP) AS INTEGER) AS Month_SA,
         cast((day(CRS_DEP_TIMESTAMP) - 1) % 7 + 1 AS INTEGER) AS Day_SO,
         cast((day(SCHEDULED_ARRIVAL_TIMESTAMP) - 1) % 7 + 1 AS INTEGER) AS Day_SA,
         cast(year(CRS_DEP_TIMESTAMP) AS INTEGER) AS Year_SO, cast(year(SCHEDULED_ARRIVAL_TIMESTAMP) AS INTEGER) AS Year_SA,
         CASE WHEN ARR_DELAY_NEW >= {threshold} THEN 1 ELSE 0 END AS Target,
         ('0x' || substr(md5(concat_ws('|', ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, strftime(CRS_DEP_TIMESTAMP, '%Y%m%d%H%M'),
           strftime(SCHEDULED_ARRIVAL_TIMESTAMP, '%Y%m%d%H%M'), cast(round(ARR_DELAY_NEW * 100) AS BIGINT))), 1, 15))::BIGINT AS row_key
  FROM t_both),
idx_origin AS (
  SELECT ORIGIN_AIRPORT_ID AS v, cast(row_number() OVER (ORDER BY count(*) DESC, ORIGIN_AIRPORT_ID) - 1 AS DOUBLE) AS idx
  FROM learn_base GROUP BY ORIGIN_AIRPORT_ID),
idx_dest AS (
  SELECT DEST_AIRPORT_ID AS v, cast(row_number() OVER (ORDER BY count(*) DESC, DEST_AIRPORT_ID) - 1 AS DOUBLE) AS idx
  FROM learn_base GROUP BY DEST_AIRPORT_ID),
assembled AS (
  SELECT l.*, io.idx AS f0, id.idx AS f1, cast(l.Hour_SO AS DOUBLE) AS f2, cast(l.Hour_SA AS DOUBLE) AS f3
  FROM learn_base l JOIN idx_origin io ON l.ORIGIN_AIRPORT_ID = io.v JOIN idx_dest id ON l.DEST_AIRPORT_ID = id.v),
fixture_pred AS (SELECT cast(quality AS INTEGER) AS label, cast(toxic AS DOUBLE) AS prediction FROM labels),
confusion AS (
  SELECT count(*) FILTER (WHERE prediction = 1 AND label = 1) AS tp,
         count(*) FILTER (WHERE prediction = 1 AND label = 0) AS fp,
         count(*) FILTER (WHERE prediction = 0 AND label = 1) AS fn,
         count(*) FILTER (WHERE prediction = 0 AND label = 0) AS tn
  FROM fixture_pred)
""".replace("{threshold}", str(THRESHOLD))

TRIP5 = "ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, CRS_DEP_TIMESTAMP, SCHEDULED_ARRIVAL_TIMESTAMP, ARR_DELAY_NEW"


def _summary(trips_cte: str, **sides: str) -> str:
    """Scalars of the window rows of each side (``wo`` / ``wd`` -> CTE)."""
    cols = ", ".join(f"{s}_n_obs, {s}_first_obs_ts, {s}_last_obs_ts, {s}_sum_temp, {s}_sky_seq" for s in sides)
    joins = "".join(f"""
JOIN (SELECT tid, count(*) AS {s}_n_obs, min(Weather_TIMESTAMP) AS {s}_first_obs_ts,
             max(Weather_TIMESTAMP) AS {s}_last_obs_ts, round(sum(DryBulbCelsius), 6) AS {s}_sum_temp,
             string_agg(SkyCondition, ',' ORDER BY Weather_TIMESTAMP) AS {s}_sky_seq
      FROM {rows} GROUP BY tid) {s} ON {s}.tid = t.tid""" for s, rows in sides.items())
    return f"""
SELECT t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.SCHEDULED_ARRIVAL_TIMESTAMP, t.ARR_DELAY_NEW,
       {cols}
FROM {trips_cte} t{joins}"""


BOTH = _summary("t_both", wo="wo_rows", wd="wd_rows")


def _hours_sql(hours: int) -> str:
    """Both windows of another length."""
    def rows(side, t):
        return f"""
  SELECT t.tid, o.* FROM th_both t JOIN obs o ON o.AIRPORT_ID = t.{side}_AIRPORT_ID
   AND o.Weather_TIMESTAMP > t.{t} - INTERVAL {hours} HOUR AND o.Weather_TIMESTAMP <= t.{t}"""
    return f""", keys_h AS (
  SELECT o.*, cast(Weather_TIMESTAMP AS DATE) AS obs_date FROM obs o
  UNION ALL
  SELECT o.*, cast(Weather_TIMESTAMP AS DATE) + 1 FROM obs o WHERE hour(Weather_TIMESTAMP) >= {24 - hours}),
full_h AS (SELECT AIRPORT_ID, obs_date FROM keys_h GROUP BY ALL HAVING count(*) = {24 + hours}),
th_both AS (
  SELECT t.* FROM trips_id t
  JOIN full_h d ON t.ORIGIN_AIRPORT_ID = d.AIRPORT_ID AND cast(t.CRS_DEP_TIMESTAMP AS DATE) = d.obs_date
  JOIN full_h e ON t.DEST_AIRPORT_ID = e.AIRPORT_ID AND cast(t.SCHEDULED_ARRIVAL_TIMESTAMP AS DATE) = e.obs_date),
wo_h AS ({rows("ORIGIN", "CRS_DEP_TIMESTAMP")}),
wd_h AS ({rows("DEST", "SCHEDULED_ARRIVAL_TIMESTAMP")})""" + _summary("th_both", wo="wo_h", wd="wd_h")


# origin-only window rows (trips whose origin day is complete)
_WO_ORIGIN_ONLY = """, wo1 AS (
  SELECT t.tid, o.*
  FROM t_origin t JOIN obs o ON o.AIRPORT_ID = t.ORIGIN_AIRPORT_ID
   AND o.Weather_TIMESTAMP > t.CRS_DEP_TIMESTAMP - INTERVAL 12 HOUR
   AND o.Weather_TIMESTAMP <= t.CRS_DEP_TIMESTAMP)"""


def _wide_select(fields=tuple(W_FIELDS[1:])) -> str:
    """Scalar view of the widened table: per window column, chosen fields."""
    parts = []
    for side, rows in (("WO", "wo_rows"), ("WD", "wd_rows")):
        for pos in range(1, 13):
            name = f"{side}_{12 - pos:02d}H"
            for f in fields:
                col = f"round({side.lower()}.{f}, 6)" if f in ("DryBulbCelsius", "Visibility", "WindSpeed", "HourlyPrecip") else f"{side.lower()}.{f}"
                parts.append(f"max(CASE WHEN {side.lower()}.pos = {pos} THEN {col} END) AS \"{name}_{f}\"")
    return ",\n  ".join(parts)


def wide_sql(fields=tuple(W_FIELDS[1:])) -> str:
    return f"""
SELECT t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.SCHEDULED_ARRIVAL_TIMESTAMP,
       t.ARR_DELAY_NEW AS Class,
  {_wide_select(fields)}
FROM t_both t JOIN wo_rows wo ON t.tid = wo.tid JOIN wd_rows wd ON t.tid = wd.tid AND wo.pos = wd.pos
GROUP BY t.tid, t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.SCHEDULED_ARRIVAL_TIMESTAMP, t.ARR_DELAY_NEW"""


def _flat_cols() -> list[tuple[str, str, int]]:
    """(window column, field, position) for the flattened table."""
    out = []
    for side in ("WO", "WD"):
        for pos in range(1, 13):
            for i, f in enumerate(W_FIELDS):
                out.append((f"{side}_{12 - pos:02d}H", f, i, pos))
    return out


def flatten_sql(drop_ids: bool = False) -> str:
    parts = []
    for w, f, i, pos in _flat_cols():
        if drop_ids and i == 0:
            continue
        side = w[:2].lower()
        parts.append(f"max(CASE WHEN {side}.pos = {pos} THEN {side}.{f} END) AS \"{i}_{w}\"")
    return f"""
SELECT t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.SCHEDULED_ARRIVAL_TIMESTAMP,
       t.ARR_DELAY_NEW AS Class,
  {",\n  ".join(parts)}
FROM t_both t JOIN wo_rows wo ON t.tid = wo.tid JOIN wd_rows wd ON t.tid = wd.tid AND wo.pos = wd.pos
GROUP BY t.tid, t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.SCHEDULED_ARRIVAL_TIMESTAMP, t.ARR_DELAY_NEW"""


def multi_hot_sql() -> str:
    parts = []
    for side in ("WO", "WD"):
        for pos in range(1, 13):
            w = f"{side}_{12 - pos:02d}H"
            s = side.lower()
            for code in CODES:
                parts.append(
                    f"max(CASE WHEN {s}.pos = {pos} THEN (CASE WHEN contains({s}.WeatherType, '{code}') THEN 1 ELSE 0 END) END) AS \"6_{w}_{code}\"")
    return f"""
SELECT t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.ARR_DELAY_NEW AS Class,
  {",\n  ".join(parts)}
FROM t_both t JOIN wo_rows wo ON t.tid = wo.tid JOIN wd_rows wd ON t.tid = wd.tid AND wo.pos = wd.pos
GROUP BY t.tid, t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.ARR_DELAY_NEW"""


def obs_parts_sql() -> str:
    parts = []
    for side in ("WO", "WD"):
        for pos in range(1, 13):
            w = f"{side}_{12 - pos:02d}H"
            s = side.lower()
            for p, fn in (("Year", "year"), ("Month", "month"), ("Day", "dayofweek"), ("Hour", "hour")):
                expr = f"{fn}({s}.Weather_TIMESTAMP)" + (" + 1" if fn == "dayofweek" else "")
                parts.append(f"max(CASE WHEN {s}.pos = {pos} THEN cast({expr} AS INTEGER) END) AS \"{p}_1_{w}\"")
    return f"""
SELECT cast(t.ORIGIN_AIRPORT_ID AS VARCHAR) AS ORIGIN_AIRPORT_ID, cast(t.DEST_AIRPORT_ID AS VARCHAR) AS DEST_AIRPORT_ID,
       cast(hour(t.CRS_DEP_TIMESTAMP) AS INTEGER) AS Hour_SO,
       CASE WHEN t.ARR_DELAY_NEW >= {THRESHOLD} THEN 1 ELSE 0 END AS Target,
  {",\n  ".join(parts)}
FROM t_both t JOIN wo_rows wo ON t.tid = wo.tid JOIN wd_rows wd ON t.tid = wd.tid AND wo.pos = wd.pos
GROUP BY t.tid, t.ORIGIN_AIRPORT_ID, t.DEST_AIRPORT_ID, t.CRS_DEP_TIMESTAMP, t.ARR_DELAY_NEW"""


def hour_range_sql(n_origin: int = 3, n_dest: int = 5) -> str:
    parts = []
    for side, n in (("WO", n_origin), ("WD", n_dest)):
        s = side.lower()
        for k in range(n, -1, -1):
            parts.append(f"max(CASE WHEN {s}.pos = {12 - k} THEN {s}.Weather_TIMESTAMP END) AS \"1_{side}_{k:02d}H\"")
    return f"""
SELECT l.ORIGIN_AIRPORT_ID, l.DEST_AIRPORT_ID, l.Hour_SO, l.Hour_SA, l.Month_SO, l.Month_SA, l.Day_SO, l.Day_SA,
       l.Year_SO, l.Year_SA, l.Target,
  {",\n  ".join(parts)}
FROM learn_base l JOIN wo_rows wo ON l.tid = wo.tid JOIN wd_rows wd ON l.tid = wd.tid AND wo.pos = wd.pos
GROUP BY l.tid, l.ORIGIN_AIRPORT_ID, l.DEST_AIRPORT_ID, l.Hour_SO, l.Hour_SA, l.Month_SO, l.Month_SA, l.Day_SO,
         l.Day_SA, l.Year_SO, l.Year_SA, l.Target"""


def weather_features_sql(n_origin: int = 11, n_dest: int = 11) -> str:
    """Feature frame with the window columns on: measures of each kept hour,
    its hour of day (year/month/day dropped by granularity 0,0,0) and the
    weather-type flags."""
    parts = []
    for side, n in (("WO", n_origin), ("WD", n_dest)):
        s = side.lower()
        for k in range(n, -1, -1):
            w, pos = f"{side}_{k:02d}H", 12 - k
            for i, f in enumerate(W_FIELDS):
                if f in ("AIRPORT_ID", "Weather_TIMESTAMP", "WeatherType"):
                    continue
                parts.append(f"max(CASE WHEN {s}.pos = {pos} THEN {s}.{f} END) AS \"{i}_{w}\"")
            parts.append(f"max(CASE WHEN {s}.pos = {pos} THEN cast(hour({s}.Weather_TIMESTAMP) AS INTEGER) END) AS \"Hour_1_{w}\"")
            for code in CODES:
                parts.append(f"max(CASE WHEN {s}.pos = {pos} THEN (CASE WHEN contains({s}.WeatherType, '{code}') "
                             f"THEN 1 ELSE 0 END) END) AS \"6_{w}_{code}\"")
    return f"""
SELECT l.ORIGIN_AIRPORT_ID, l.DEST_AIRPORT_ID, l.Hour_SO, l.Hour_SA, l.Target,
  {",\n  ".join(parts)}
FROM learn_base l JOIN wo_rows wo ON l.tid = wo.tid JOIN wd_rows wd ON l.tid = wd.tid AND wo.pos = wd.pos
GROUP BY l.tid, l.ORIGIN_AIRPORT_ID, l.DEST_AIRPORT_ID, l.Hour_SO, l.Hour_SA, l.Target"""


def _place(purpose: str) -> str:
    """A row's place in [0, 1), by purpose and seed 42."""
    return f"(('0x' || substr(md5('{purpose}:42:' || row_key), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)"


_BALANCED = f""", sizes AS (SELECT Target AS label, count(*) AS n FROM assembled GROUP BY Target),
major AS (SELECT label FROM sizes ORDER BY n DESC, label LIMIT 1),
ratio AS (SELECT min(n)::DOUBLE / max(n)::DOUBLE AS r FROM sizes),
balanced AS (SELECT a.* FROM assembled a, major m, ratio WHERE a.Target <> m.label OR {_place("balance")} < r),
train AS (SELECT * FROM balanced WHERE {_place("split")} < 0.7)"""


def _encode_wide_sql(folds: int = 5, prior: float = 20.0) -> str:
    return f""", slotted AS (
  SELECT ORIGIN_AIRPORT_ID || '-' || DEST_AIRPORT_ID || '-' || Hour_SO AS SLOT, Hour_SA, Target,
         cast(floor({_place("mean")} * {folds}) AS INTEGER) AS f
  FROM learn_base),
outside AS (  -- rows of a slot and of all slots that are not in the fold
  SELECT k.f, s.SLOT, sum(CASE WHEN s.f <> k.f THEN 1 ELSE 0 END) AS n, sum(CASE WHEN s.f <> k.f THEN Target ELSE 0 END) AS y
  FROM slotted s, range({folds}) k(f) GROUP BY k.f, s.SLOT),
base AS (SELECT f, sum(y)::DOUBLE / sum(n)::DOUBLE AS base FROM outside GROUP BY f)
SELECT s.SLOT, s.Hour_SA, s.Target, round((o.y + {prior} * b.base) / (o.n + {prior}), 9) AS slot_mean
FROM slotted s JOIN outside o ON s.SLOT = o.SLOT AND s.f = o.f JOIN base b ON s.f = b.f"""


LEARN_COLS = ("ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, Hour_SO, Hour_SA, Month_SO, Month_SA, "
              "Day_SO, Day_SA, Year_SO, Year_SA, Target")

BODIES: dict[str, str] = {
    # ---- sources and sinks
    "src_flights_csv": "SELECT * FROM flights_raw",
    "src_weather_csv": "SELECT * FROM weather_raw",
    "src_stations_csv": "SELECT * FROM tz",
    "conform_schema": f"SELECT {TRIP5} FROM trips",
    "sink_chunks": wide_sql(),
    "src_chunks_union": wide_sql(),
    # ---- projection, filter, cleaning
    "fill_nulls": """SELECT FL_DATE, ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, CRS_DEP_TIME, CRS_ELAPSED_TIME,
        coalesce(ARR_DELAY_NEW, 0) AS ARR_DELAY_NEW, coalesce(WEATHER_DELAY, 0) AS WEATHER_DELAY,
        coalesce(NAS_DELAY, 0) AS NAS_DELAY, CANCELLED, DIVERTED FROM flights_raw""",
    "drop_null_rows": "SELECT * FROM flights_raw WHERE CRS_ELAPSED_TIME IS NOT NULL",
    "filter_operated": "SELECT * FROM flights_raw WHERE DIVERTED <> 1 AND CANCELLED <> 1",
    "drop_columns": "SELECT * EXCLUDE (DIVERTED, CANCELLED) FROM flights_raw",
    "dedup_rows": "SELECT * FROM fl_clean",
    "dedup_keys": "SELECT * FROM w_dedup",
    "rename_columns": "SELECT * FROM fl_st",
    "project_weather": """SELECT AIRPORT_ID, "Date", "Time", DryBulbCelsius, SkyCondition, Visibility,
        WindSpeed, WeatherType, HourlyPrecip FROM w_air""",
    "cast_ids_string": """SELECT cast(ORIGIN_AIRPORT_ID AS VARCHAR) AS ORIGIN_AIRPORT_ID,
        cast(DEST_AIRPORT_ID AS VARCHAR) AS DEST_AIRPORT_ID, CRS_DEP_TIMESTAMP, ARR_DELAY_NEW FROM trips""",
    # ---- joins
    "join_origin_station": """SELECT f.*, o.WBAN AS ORIGIN_WBAN, o.TimeZone AS TZone_ORIGIN_AIRPORT_ID
        FROM fl_clean f JOIN tz o ON f.ORIGIN_AIRPORT_ID = o.AirportID""",
    "join_dest_station": """SELECT f.*, o.WBAN AS ORIGIN_WBAN, o.TimeZone AS TZone_ORIGIN_AIRPORT_ID,
        d.WBAN AS DEST_WBAN, d.TimeZone AS TZone_DEST_AIRPORT_ID
        FROM fl_clean f JOIN tz o ON f.ORIGIN_AIRPORT_ID = o.AirportID JOIN tz d ON f.DEST_AIRPORT_ID = d.AirportID""",
    "semi_join_stations": "SELECT * FROM weather_raw WHERE WBAN IN (SELECT F_WBAN FROM airports)",
    "join_weather_airport": "SELECT * FROM w_air",
    "join_daily_mean": """SELECT AIRPORT_ID, "Date", Time_hh, Time_mm, DryBulbCelsius, WindSpeed,
        round(average_temperature, 6) AS average_temperature, round(average_windspeed, 6) AS average_windspeed,
        round(average_visibility, 6) AS average_visibility, round(average_hourlyprecip, 6) AS average_hourlyprecip
        FROM w_joined""",
    "join_hour_representative": """SELECT AIRPORT_ID, "Date", Time_hh, Time_mm, round(DryBulbCelsius, 6) AS DryBulbCelsius,
        SkyCondition, round(Visibility, 6) AS Visibility, round(WindSpeed, 6) AS WindSpeed, WeatherType,
        round(HourlyPrecip, 6) AS HourlyPrecip FROM w_hour""",
    "join_obs_origin": f"""SELECT {TRIP5}, cast(36 AS BIGINT) AS n_list FROM t_origin""",
    "join_obs_dest": f"""SELECT {TRIP5}, cast(36 AS BIGINT) AS n_list FROM t_both""",
    "interval_window_origin": _WO_ORIGIN_ONLY + _summary("t_origin", wo="wo1"),
    "interval_filter": BOTH,
    "window_6h": _hours_sql(6),
    "window_24h": _hours_sql(24),
    "interval_window_dest": BOTH,
    "window_join_lag": BOTH,
    # ---- aggregation, sorting, sets
    "distinct_airports": """SELECT DISTINCT 'origin' AS side, ORIGIN_AIRPORT_ID AS AIRPORT_ID, ORIGIN_WBAN AS F_WBAN FROM fl_st
        UNION ALL SELECT DISTINCT 'dest', DEST_AIRPORT_ID, DEST_WBAN FROM fl_st""",
    "union_distinct": "SELECT * FROM airports",
    "count_airports": "SELECT count(*) AS n_airports FROM airports",
    "daily_mean": """SELECT AIRPORT_ID, "Date", round(average_temperature, 6) AS average_temperature,
        round(average_windspeed, 6) AS average_windspeed, round(average_visibility, 6) AS average_visibility,
        round(average_hourlyprecip, 6) AS average_hourlyprecip FROM w_mean""",
    "hour_first_minute": "SELECT * FROM w_first",
    "collect_observations": """SELECT AIRPORT_ID, obs_date, count(*) AS n_obs, min(Weather_TIMESTAMP) AS first_obs_ts,
        max(Weather_TIMESTAMP) AS last_obs_ts FROM obs_keys GROUP BY AIRPORT_ID, obs_date""",
    "complete_windows": "SELECT AIRPORT_ID, obs_date, cast(36 AS BIGINT) AS n_obs FROM full_days",
    "label_counts": "SELECT Target AS label, count(*) AS count FROM learn_base GROUP BY Target",
    "confusion_counts": "SELECT tp, fp, fn FROM confusion",
    "row_count": "SELECT count(*) AS n_rows FROM assembled",
    "sort_global": f"SELECT {TRIP5} FROM trips",
    "sort_order": "SELECT count(*) AS n_rows, 0::BIGINT AS n_out_of_order FROM trips",
    "sort_array": """SELECT k.AIRPORT_ID, k.obs_date,
        string_agg(strftime(k.Weather_TIMESTAMP, '%Y-%m-%d %H'), ',' ORDER BY k.Weather_TIMESTAMP) AS ts_seq
        FROM obs_keys k JOIN full_days d ON k.AIRPORT_ID = d.AIRPORT_ID AND k.obs_date = d.obs_date
        GROUP BY k.AIRPORT_ID, k.obs_date""",
    # ---- time functions
    "tz_offset_diff": """SELECT ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, "Dest-Orig" FROM fl_st""",
    "format_date": "SELECT FL_DATE, strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE_STR FROM fl_clean",
    "departure_ts": "SELECT FL_DATE, CRS_DEP_TIME, dep AS CRS_DEP_TIMESTAMP FROM fl_dep",
    "arrival_ts": f"SELECT {TRIP5} FROM trips",
    "split_hhmm": """SELECT AIRPORT_ID, "Date", "Time", Time_hh, Time_mm FROM w_clean""",
    "weather_ts": "SELECT AIRPORT_ID, Weather_TIMESTAMP FROM obs",
    "date_key": """SELECT ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, cast(CRS_DEP_TIMESTAMP AS DATE) AS dep_date,
        cast(SCHEDULED_ARRIVAL_TIMESTAMP AS DATE) AS arr_date FROM trips""",
    "roll_forward_key": "SELECT AIRPORT_ID, Weather_TIMESTAMP, obs_date FROM obs_keys",
    "schedule_parts": f"SELECT {LEARN_COLS} FROM learn_base",
    "obs_parts": obs_parts_sql(),
    # ---- scalar functions
    "cast_measures": """SELECT a.AIRPORT_ID, r."Date", r."Time", TRY_CAST(r.DryBulbCelsius AS DOUBLE) AS DryBulbCelsius,
        TRY_CAST(r.Visibility AS DOUBLE) AS Visibility FROM weather_raw r JOIN airports a ON r.WBAN = a.F_WBAN""",
    "sky_condition": r"""SELECT AIRPORT_ID, "Date", "Time", SkyCondition AS raw,
        CASE WHEN SkyCondition IS NULL OR SkyCondition = '' THEN 'M'
             WHEN regexp_extract(regexp_extract(SkyCondition, '(\S*)[\x00-\x20]*$', 1), '([A-Za-z]+)[0-9]*$', 1) = '' THEN 'OTHER'
             ELSE regexp_extract(regexp_extract(SkyCondition, '(\S*)[\x00-\x20]*$', 1), '([A-Za-z]+)[0-9]*$', 1)
        END AS code FROM w_air""",
    "wind_speed": """SELECT AIRPORT_ID, "Date", "Time", WindSpeed FROM w_clean""",
    "weather_type": """SELECT AIRPORT_ID, "Date", "Time", WeatherType FROM w_clean""",
    "hourly_precip": """SELECT AIRPORT_ID, "Date", "Time", HourlyPrecip FROM w_clean""",
    "impute_daily_mean": """SELECT AIRPORT_ID, "Date", Time_hh, Time_mm, round(DryBulbCelsius, 6) AS DryBulbCelsius,
        round(Visibility, 6) AS Visibility, round(WindSpeed, 6) AS WindSpeed, round(HourlyPrecip, 6) AS HourlyPrecip
        FROM w_imp""",
    "unit_seconds": """SELECT cast(trunc(CRS_ELAPSED_TIME * 60) AS BIGINT) AS elapsed_s,
        cast(trunc("Dest-Orig" * 3600) AS BIGINT) AS tz_s FROM fl_st""",
    "pivot_window": wide_sql(),
    "struct_flatten": flatten_sql(),
    "drop_obs_airport": flatten_sql(drop_ids=True),
    "weather_multi_hot": multi_hot_sql(),
    "target_label": "SELECT ARR_DELAY_NEW AS Class, CASE WHEN ARR_DELAY_NEW >= 45 THEN 1 ELSE 0 END AS Target FROM t_both",
    # ---- feature selection, encoding
    "hour_range_columns": hour_range_sql(),
    "feature_set": f"SELECT {LEARN_COLS} FROM learn_base",
    "date_granularity": "SELECT ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, Hour_SO, Hour_SA, Target FROM learn_base",
    "columns_by_type": "SELECT ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, Hour_SO, Hour_SA FROM learn_base",
    "string_index": """SELECT 'ORIGIN_AIRPORT_ID' AS column_name, v AS value, idx AS index FROM idx_origin
        UNION ALL SELECT 'DEST_AIRPORT_ID', v, idx FROM idx_dest""",
    "assemble_vector": "SELECT ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, Hour_SO, Hour_SA, f0, f1, f2, f3 FROM assembled",
    "vector_index": """SELECT 0 AS feature, count(DISTINCT f0) AS n_categories FROM assembled
        UNION ALL SELECT 1, count(DISTINCT f1) FROM assembled
        UNION ALL SELECT 2, count(DISTINCT f2) FROM assembled
        UNION ALL SELECT 3, count(DISTINCT f3) FROM assembled""",
    "encode_pipeline": """SELECT cast(dense_rank() OVER (ORDER BY f0) - 1 AS DOUBLE) AS v0,
        cast(dense_rank() OVER (ORDER BY f1) - 1 AS DOUBLE) AS v1,
        cast(dense_rank() OVER (ORDER BY f2) - 1 AS DOUBLE) AS v2,
        cast(dense_rank() OVER (ORDER BY f3) - 1 AS DOUBLE) AS v3, Target AS label FROM assembled""",
    "auc": """SELECT round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS auc
        FROM (SELECT cast(tp AS DOUBLE) tp, cast(fp AS DOUBLE) fp, cast(fn AS DOUBLE) fn, cast(tn AS DOUBLE) tn FROM confusion)""",
    "precision_recall_f1": """SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1
        FROM (SELECT cast(tp AS DOUBLE) / (tp + fp) AS p, cast(tp AS DOUBLE) / (tp + fn) AS r FROM confusion)""",
    # ---- model steps: what holds of every run, from the rows
    "string_index_wide": """SELECT ORIGIN_AIRPORT_ID || '-' || DEST_AIRPORT_ID || '-' || Hour_SO AS value,
        cast(row_number() OVER (ORDER BY count(*) DESC, value) - 1 AS DOUBLE) AS index FROM learn_base GROUP BY value""",
    "encode_wide": _encode_wide_sql(),
    "class_balance": _BALANCED + """
        SELECT s.label, s.n AS n_before, b.n_after, s.n = b.n_after AS kept_whole,
               abs(b.n_after - (SELECT min(n) FROM sizes)) <= 5 * sqrt((SELECT min(n) FROM sizes)) + 1 AS within_bound
        FROM sizes s JOIN (SELECT Target AS label, count(*) AS n_after FROM balanced GROUP BY Target) b ON s.label = b.label""",
    "train_test_split": f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE {_place("split")} < 0.7) AS n_train,
        count(*) FILTER (WHERE {_place("split")} >= 0.7) AS n_test, 0::BIGINT AS n_in_both FROM assembled""",
    "random_forest": "SELECT count(*) AS n_scored, 10 AS n_trees, TRUE AS depth_kept FROM assembled",
    "predict": "SELECT Target AS label, count(*) AS n_scored FROM assembled GROUP BY Target",
    "forest_shards": f"""SELECT cast(floor({_place("shard")} * 3) AS INTEGER) AS shard, Target AS label, count(*) AS n_scored
        FROM assembled GROUP BY ALL""",
    "forest_wide": "SELECT Target AS label, count(*) AS n_scored FROM assembled GROUP BY Target",
    "grid_search": _BALANCED + f""", held AS (
          SELECT cast(floor({_place("fold")} * 3) AS INTEGER) AS fold, count(*) AS n_held_out,
                 sum(Target)::BIGINT AS n_late_held_out, (SELECT count(*) FROM train) - count(*) AS n_trained
          FROM train GROUP BY 1)
        SELECT held.*, t AS "numTrees", d AS "maxDepth", m AS "minInstancesPerNode", TRUE AS scored
        FROM held, unnest([60, 70]) a(t), unnest([10, 20]) b(d), unnest([20, 30]) c(m)""",
    "best_params": "SELECT TRUE AS in_grid, TRUE AS is_best",
    "application": wide_sql(),
    # ---- physical controls
    "repartition_join_keys": BOTH,
    "persist_lists": BOTH,
    "salted_window_join": BOTH,
    "hot_key_salted_join": _WO_ORIGIN_ONLY + _summary("t_origin", wo="wo1"),
    "repartition_training": f"SELECT {LEARN_COLS} FROM learn_base",
    # ---- dormant options
    # raw text straight to numbers, what does not parse (VR too) to 0, one row per minute
    "impute_zero": """, zero AS (
        SELECT a.AIRPORT_ID, r."Date", r."Time", cast("Time" // 100 AS INTEGER) AS Time_hh,
               cast("Time" % 100 AS INTEGER) AS Time_mm,
               coalesce(TRY_CAST(r.DryBulbCelsius AS DOUBLE), 0) AS DryBulbCelsius,
               CASE WHEN r.SkyCondition = 'M' THEN '' ELSE r.SkyCondition END AS SkyCondition,
               coalesce(TRY_CAST(r.Visibility AS DOUBLE), 0) AS Visibility,
               cast(coalesce(trunc(TRY_CAST(r.WindDirection AS DOUBLE)), 0) AS INTEGER) AS WindDirection,
               cast(coalesce(trunc(TRY_CAST(r.WindSpeed AS DOUBLE)), 0) AS INTEGER) AS WindSpeed,
               CASE WHEN r.WeatherType = 'M' THEN '' ELSE r.WeatherType END AS WeatherType,
               coalesce(TRY_CAST(r.StationPressure AS DOUBLE), 0) AS StationPressure
        FROM weather_raw r JOIN airports a ON r.WBAN = a.F_WBAN)
      SELECT AIRPORT_ID, "Date", "Time", Time_hh, Time_mm, DryBulbCelsius, SkyCondition, Visibility, WindDirection,
             WindSpeed, WeatherType, StationPressure
      FROM (SELECT *, row_number() OVER (PARTITION BY AIRPORT_ID, "Date", Time_hh, Time_mm
              ORDER BY DryBulbCelsius, SkyCondition NULLS FIRST, Visibility, WindDirection, WindSpeed,
                       WeatherType NULLS FIRST, StationPressure, "Time") AS rn FROM zero) WHERE rn = 1""",
    "weather_type_closed": """SELECT AIRPORT_ID, "Date", "Time",
        CASE WHEN WeatherType IN ('RA', 'SN', 'FG', 'FG+', 'WIND', 'FZDZ', 'FZRA', 'MIFG', 'FZFG') THEN WeatherType
             ELSE 'OTHER' END AS WeatherType FROM w_clean""",
    "weather_features": weather_features_sql(),
    "ml_table": wide_sql(),
}


def oracle_sql() -> dict[str, str]:
    return {k: PREFIX + "\n" + v for k, v in BODIES.items()}
