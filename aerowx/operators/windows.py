"""Attach to each trip the ordered observation window before a time.

Two equivalent physical forms:

``attach_window`` (list form)
    equi-join trips to the complete (airport, date) lists, then keep the
    list items in ``(t - 12h, t]`` (a positional ``slice`` on complete lists,
    the interval ``filter`` otherwise).  The list
    side is small (one row per airport-day); AQE broadcasts it when its
    measured size allows, otherwise it is a sort-merge join whose hot
    (airport, date) keys AQE's skew handling splits.

``attach_window_frame`` (window-frame form)
    build, per airport-hour, the 12-reading window with a bounded
    ``ROWS BETWEEN 11 PRECEDING AND CURRENT ROW`` frame inside each
    (airport, date) group of 36, then join trips on (airport, date, hour).
    No window is exchanged: the join is hashed by (airport, date) as the
    frames are, and a trip meets the 24 windows of its day.

Both keep a trip only if its (airport, date) day is complete (36 readings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerowx.functions.timecols import obs_date
from aerowx.operators.observations import full_day, observation_keys
from aerowx.schemas import HOURS, OBS_FIELDS, window_columns

ORIGIN = ("ORIGIN_AIRPORT_ID", "CRS_DEP_TIMESTAMP", "WO_List")
DEST = ("DEST_AIRPORT_ID", "SCHEDULED_ARRIVAL_TIMESTAMP", "WD_List")


def in_window(list_col: str, t_col: str, hours: int = HOURS) -> F.Column:
    """Items of a time-sorted list with ``t - hours < ts <= t`` (lower bound
    exclusive, upper inclusive); order is preserved."""
    t = F.col(t_col)
    lo = t - F.make_dt_interval(F.lit(0), F.lit(hours))
    return F.filter(F.col(list_col),
                    lambda x: (x["Weather_TIMESTAMP"] > lo) & (x["Weather_TIMESTAMP"] <= t))


def in_complete_window(list_col: str, t_col: str, hours: int = HOURS) -> F.Column:
    """Same items as ``in_window`` for a *complete* list: one reading per
    hour from ``D-1 (24-hours):00`` to ``D 23:00`` sorted by time, so the
    readings in ``(t - hours, t]`` for ``t`` on ``D`` at hour ``H`` are
    exactly positions ``H + 1 .. H + hours`` (0-based; ``D H:00`` sits at
    ``hours + H``).  ``slice`` is compiled into the generated code; the
    lambda ``filter`` is interpreted per element."""
    return F.slice(F.col(list_col), F.hour(F.col(t_col)) + 2, F.lit(hours))


def attach_window(trips: DataFrame, lists: DataFrame, airport_col: str, ts_col: str,
                  out_col: str, hours: int = HOURS, complete: bool = True,
                  salt: int = 0, keys: DataFrame | None = None) -> DataFrame:
    """Inner-join trips to lists on (airport, date(ts)) and keep the list
    items in ``(ts - hours, ts]`` as ``out_col``.  ``complete`` states that
    ``lists`` holds only complete days (``observations.complete``), which
    allows the positional ``slice``; otherwise the interval ``filter`` runs.

    ``salt`` > 1 spreads every (airport, date) key of the trips over
    ``salt`` buckets (a seeded hash of the trip's own columns), so a hot
    airport-day is joined by ``salt`` tasks; ``salted_lists`` tells which lists
    each bucket gets.  ``keys`` are trips, of the columns to hash, among which
    are all of ``trips`` (by default they themselves).  Without ``salt``, AQE's
    skew-join handling splits oversized partitions at run time.
    """
    l = lists.select(F.col("AIRPORT_ID").alias("_la"), F.col("obs_date").alias("_ld"),
                     F.col("Weather_List").alias("_wl"))
    pick = in_complete_window if complete else in_window
    if salt and salt > 1:
        keys = trips if keys is None else keys
        l = salted_lists(l, keys, airport_col, ts_col, salt)
        if complete:
            l = l.withColumn("_wl", needed("_wl", hours))
            pick = in_needed
        t = trips.withColumn("_salt", salt_of(keys, salt))
        cond = (t[airport_col] == l["_la"]) & (obs_date(t[ts_col]) == l["_ld"]) & (t["_salt"] == l["_lsalt"])
        j = t.join(l, cond, "inner")
    else:
        cond = (trips[airport_col] == l["_la"]) & (obs_date(trips[ts_col]) == l["_ld"])
        j = trips.join(l, cond, "inner")
    return j.withColumn(out_col, pick("_wl", ts_col, hours)).drop("_la", "_ld", "_wl", "_salt", "_lsalt", "_lo", "_hi")


def salt_of(keys: DataFrame, salt: int) -> F.Column:
    """The bucket of a trip: a hash of its columns that ``keys`` has."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in keys.columns]), F.lit(salt))


def salted_lists(lists: DataFrame, keys: DataFrame, airport_col: str, ts_col: str, salt: int) -> DataFrame:
    """``lists`` (``_la``, ``_ld``, ...) once for each bucket ``_lsalt`` in which
    ``keys`` has a trip of their (airport, date), with the first and the last
    hour of those trips, ``_lo`` and ``_hi``.

    Most keys have fewer trips than there are buckets, and a bucket without a
    trip needs no list.  What is asked for is dealt by (airport, date), as the
    lists are that an aggregate made, so only what it leaves of them is
    exchanged."""
    asked = (keys.select(F.col(airport_col).alias("_ua"), obs_date(F.col(ts_col)).alias("_ud"),
                         salt_of(keys, salt).alias("_lsalt"), F.hour(F.col(ts_col)).alias("_h"))
             .repartition("_ua", "_ud").groupBy("_ua", "_ud", "_lsalt")
             .agg(F.min("_h").alias("_lo"), F.max("_h").alias("_hi")))
    return lists.join(asked.hint("shuffle_hash"), (lists["_la"] == asked["_ua"]) & (lists["_ld"] == asked["_ud"]),
                      "inner").drop("_ua", "_ud")


def needed(list_col: str, hours: int = HOURS) -> F.Column:
    """What windows ending at the hours ``_lo`` to ``_hi`` take of a complete list."""
    return F.slice(F.col(list_col), F.col("_lo") + 2, F.col("_hi") - F.col("_lo") + F.lit(hours))


def in_needed(list_col: str, t_col: str, hours: int = HOURS) -> F.Column:
    """``in_complete_window`` of what ``needed`` left."""
    return F.slice(F.col(list_col), F.hour(F.col(t_col)) - F.col("_lo") + 1, F.lit(hours))


def hot_keys(trips: DataFrame, airport_col: str, ts_col: str, fraction: float) -> DataFrame:
    """(airport, date) keys holding more than ``fraction`` (0 to 1) of all trips.

    There are fewer than ``1 / fraction`` such keys, so the result has a
    proven size bound and may be broadcast.  Computed with one partially
    aggregated count per key; the total is the sum of the counts."""
    if not 0 < fraction < 1:
        raise ValueError("fraction lies between 0 and 1; the key set is bounded by 1 / fraction")
    per_key = trips.groupBy(F.col(airport_col).alias("_ha"),
                            obs_date(F.col(ts_col)).alias("_hd")).count()
    total = per_key.agg(F.sum("count")).scalar()
    return per_key.where(F.col("count") > F.lit(fraction) * total).select("_ha", "_hd")


def attach_window_hot_salted(trips: DataFrame, lists: DataFrame, airport_col: str, ts_col: str,
                             out_col: str, buckets: int = 16, fraction: float = 0.01,
                             hours: int = HOURS) -> DataFrame:
    """``attach_window`` with only the hot (airport, date) keys salted: their
    trips are spread over ``buckets`` and only their lists are replicated
    ``buckets`` times; every other key joins as usual (bucket 0)."""
    hot = F.broadcast(hot_keys(trips, airport_col, ts_col, fraction).withColumn("_hot", F.lit(True)))
    t = trips.join(hot, (trips[airport_col] == hot["_ha"]) & (obs_date(trips[ts_col]) == hot["_hd"]), "left")
    t = t.withColumn("_salt", F.when(F.col("_hot"), F.pmod(
        F.xxhash64(*[F.col(c) for c in trips.columns]), F.lit(buckets))).otherwise(F.lit(0).cast("long")))
    t = t.drop("_ha", "_hd", "_hot")
    l = lists.select(F.col("AIRPORT_ID").alias("_la"), F.col("obs_date").alias("_ld"),
                     F.col("Weather_List").alias("_wl"))
    l = l.join(hot, (l["_la"] == hot["_ha"]) & (l["_ld"] == hot["_hd"]), "left")
    l = (l.withColumn("_lsalt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"),
                                                                           F.lit(buckets - 1).cast("long")))
                                          .otherwise(F.array(F.lit(0).cast("long")))))
          .drop("_ha", "_hd", "_hot"))
    cond = ((t[airport_col] == l["_la"]) & (obs_date(t[ts_col]) == l["_ld"]) & (t["_salt"] == l["_lsalt"]))
    j = t.join(l, cond, "inner").drop("_salt", "_lsalt")
    return j.withColumn(out_col, in_complete_window("_wl", ts_col, hours)).drop("_la", "_ld", "_wl")


def attach_windows(trips: DataFrame, lists: DataFrame, hours: int = HOURS, salt: int = 0,
                   complete: bool = True) -> DataFrame:
    """Origin window before departure, then destination window before the
    scheduled arrival; trips lacking either complete day drop out."""
    df = attach_window(trips, lists, *ORIGIN, hours=hours, salt=salt, complete=complete)
    return attach_window(df, lists, *DEST, hours=hours, salt=salt, complete=complete, keys=trips)


# ---------------------------------------------------------------- frame form

def hour_windows(obs: DataFrame, hours: int = HOURS) -> DataFrame:
    """(AIRPORT_ID, obs_date, hour, Window) for every hour of every complete
    day: the ``hours`` readings ending at that hour, oldest first."""
    k = observation_keys(obs, hours)
    day = Window.partitionBy("AIRPORT_ID", "obs_date")
    frame = day.orderBy("Weather_TIMESTAMP").rowsBetween(-(hours - 1), 0)
    rec = F.struct(*OBS_FIELDS)
    w = (k.withColumn("_n", F.count(F.lit(1)).over(day))
          .where(F.col("_n") == full_day(hours))
          .withColumn("Window", F.collect_list(rec).over(frame))
          .where(F.to_date("Weather_TIMESTAMP") == F.col("obs_date")))
    return w.select("AIRPORT_ID", "obs_date", F.hour("Weather_TIMESTAMP").alias("hour"), "Window")


def attach_window_frame(trips: DataFrame, windows: DataFrame, airport_col: str, ts_col: str,
                        out_col: str) -> DataFrame:
    """Inner-join trips to hour windows on (airport, date, hour).

    The join is hashed by (airport, date), by which the frames have already
    dealt the windows, and compares the hour behind it: an hour among the
    hashed keys would ship every window of every airport-hour to the trips."""
    w = windows.select(F.col("AIRPORT_ID").alias("_wa"), F.col("obs_date").alias("_wd"),
                       F.col("hour").alias("_wh"), F.col("Window").alias(out_col))
    t = trips[ts_col]
    # as a difference, or Spark makes the hour a hashed key, too
    cond = ((trips[airport_col] == w["_wa"]) & (obs_date(t) == w["_wd"])
            & (F.hour(t) - w["_wh"] == 0))
    return trips.join(w, cond, "inner").drop("_wa", "_wd", "_wh")


def attach_windows_frame(trips: DataFrame, obs: DataFrame, hours: int = HOURS) -> DataFrame:
    windows = hour_windows(obs, hours)
    df = attach_window_frame(trips, windows, *ORIGIN)
    return attach_window_frame(df, windows, *DEST)


# ---------------------------------------------------------------- widening

def widen(df: DataFrame, hours: int = HOURS) -> DataFrame:
    """Window lists -> one struct column per hour (item 0, the oldest, is
    ``*_11H`` of a 12-hour window; the last, at the trip's hour, ``*_00H``) and ``Class`` =
    ARR_DELAY_NEW."""
    wo = [F.col("WO_List")[i].alias(c) for i, c in enumerate(window_columns("WO", hours))]
    wd = [F.col("WD_List")[i].alias(c) for i, c in enumerate(window_columns("WD", hours))]
    return df.select(*wo, "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIMESTAMP",
                     "SCHEDULED_ARRIVAL_TIMESTAMP", *wd, F.col("ARR_DELAY_NEW").alias("Class"))


def window_summary(df: DataFrame, *list_cols: str) -> DataFrame:
    """Scalar view of window columns (for checks): for each, size, first and
    last time, summed temperature and the sky codes in order."""
    cols = []
    for name in list_cols:
        l, p = F.col(name), name.split("_")[0].lower()
        cols += [F.size(l).cast("long").alias(f"{p}_n_obs"), l[0]["Weather_TIMESTAMP"].alias(f"{p}_first_obs_ts"),
                 F.element_at(l, -1)["Weather_TIMESTAMP"].alias(f"{p}_last_obs_ts"),
                 F.round(F.aggregate(l, F.lit(0.0), lambda acc, x: acc + x["DryBulbCelsius"]), 6).alias(f"{p}_sum_temp"),
                 F.array_join(l["SkyCondition"], ",").alias(f"{p}_sky_seq")]
    return df.select("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIMESTAMP", "SCHEDULED_ARRIVAL_TIMESTAMP",
                     "ARR_DELAY_NEW", *cols)
