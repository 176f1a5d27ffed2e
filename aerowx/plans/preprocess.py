"""Preprocess plan: raw trips + readings + station map -> learning table.

Declared once as a lazy DataFrame plan; Catalyst prunes columns, pushes the
trip filters into the scan and reuses the observation-list exchange for
both window joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from aerowx.operators.clean import dedup, operated_trips
from aerowx.operators.hotkeys import find_hot_keys
from aerowx.operators.observations import complete_lists
from aerowx.operators.packed import attach_isolated, attach_packed, attach_salted, pack, unpack, widen_packed
from aerowx.operators.schedule import schedule
from aerowx.operators.stations import attach_stations, served_airports
from aerowx.operators.weather import hourly_observations
from aerowx.operators.windows import DEST, ORIGIN, attach_window, attach_windows_frame, widen
from aerowx.sources.liststore import ListStore, store_lists


@dataclass
class Prepared:
    trips: DataFrame          # trip records (5 columns)
    airports: DataFrame       # served (AIRPORT_ID, F_WBAN)
    observations: DataFrame   # one reading per airport-hour
    keys: DataFrame | None = None   # trips before the dedup, for their keys


def prepare(flights_raw: DataFrame, weather_raw: DataFrame, stations: DataFrame,
            keep: list[str] | None = None, weather_partitions: int | None = None) -> Prepared:
    """Trip records, served airports and hourly observations.  Spark and AQE
    pick the joins by the measured bytes of the map and the served set."""
    operated = operated_trips(flights_raw)
    ft = attach_stations(dedup(operated), stations)
    # exact-duplicate removal cannot change the set of (airport, station)
    # pairs, so the served set is taken before the dedup: a scan plus a
    # map-side partial distinct, instead of waiting on the full trip shuffle
    airports = served_airports(operated.select("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"), stations)
    trips = schedule(ft, keep=keep)
    obs = hourly_observations(weather_raw, airports, weather_partitions)
    # copies may make a key look hot that is not, which only spreads it
    return Prepared(trips, airports, obs, schedule(attach_stations(operated, stations)))


def packed_windows(p: Prepared, hours: int = 12, colocate: bool = False,
                   persist_lists: bool | ListStore = False, hot_share: float | None = None) -> DataFrame:
    """Trips with both windows as packed arrays (``operators.packed``)."""
    store = persist_lists if isinstance(persist_lists, ListStore) else None
    if persist_lists and store is None:
        store = store_lists(pack(complete_lists(p.observations, hours)))
    lists = store.read() if store else pack(complete_lists(p.observations, hours))
    if colocate:
        lists = lists.hint("shuffle_hash")
    df = p.trips
    hot = find_hot_keys(p.keys if p.keys is not None else p.trips, (ORIGIN, DEST), hot_share)
    for side, keys in zip((ORIGIN, DEST), hot):
        if store:
            df = attach_isolated(df, lists, *side, hours=hours, hot=keys)
        else:
            df = attach_packed(df, lists, *side, hours=hours, hot=keys, key_columns=p.trips.columns)
    return df


def with_windows(p: Prepared, method: str = "list", hours: int = 12,
                 colocate: bool = False, persist_lists: bool | ListStore = False,
                 salt: int = 0, hot_share: float | None = None) -> DataFrame:
    """Trips with both windows (``WO_List``, ``WD_List``).

    ``method`` = ``"list"`` (bucketed equi-join + slice) or ``"frame"``
    (hour-grain window frame).  Hot (airport, date) keys, those with more than
    ``hot_share`` of the trips, are found by a sketch and spread over buckets
    (``operators.hotkeys``); ``salt`` > 1 spreads every key instead.
    ``colocate`` has Spark build a hash table of the lists per partition, so
    trips are not sorted.  ``persist_lists`` stores the lists once in buckets,
    which neither join exchanges; pass a ``ListStore`` (``store_lists`` of
    packed lists) to release it after use.
    """
    if method == "frame":
        return attach_windows_frame(p.trips, p.observations, hours)
    if salt > 1:
        lists, df = pack(complete_lists(p.observations, hours)), p.trips
        for side in (ORIGIN, DEST):
            df = attach_salted(df, lists, *side, salt=salt, keys=p.trips, hours=hours, hint="shuffle_hash" if colocate else None)
        return unpack(df, hours)
    return unpack(packed_windows(p, hours, colocate, persist_lists, hot_share), hours)


def origin_windows(p: Prepared, hours: int = 12) -> DataFrame:
    """Trips with the origin window only (first half of the join)."""
    return attach_window(p.trips, complete_lists(p.observations, hours), *ORIGIN, hours=hours)


def ml_table(flights_raw: DataFrame, weather_raw: DataFrame, stations: DataFrame,
             method: str = "list", hours: int = 12) -> DataFrame:
    """The wide learning table: WO_11H..WO_00H, trip columns,
    WD_11H..WD_00H, Class."""
    p = prepare(flights_raw, weather_raw, stations)
    if method == "frame":
        return widen(with_windows(p, method, hours), hours)
    return widen_packed(packed_windows(p, hours), hours)
