"""Gold run (the whole galaxy schema) for every date in the given feeds.

``build`` returns the plans; ``load`` writes them idempotently: dimensions by
insert-if-absent, facts by replacing the days they contain.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import filters as FL
from ..sinks import writers as W
from ..sources.adapters import Feeds
from . import dims as D
from . import facts as FCT


FEED_NAMES = ["production", "consumption", "humidity", "temperature", "weather", "booking"]


def restrict(feeds: Feeds, start, end) -> Feeds:
    """Feeds limited to [start, end] (a ``date`` predicate: pruning when partitioned)."""
    return Feeds(*[FL.date_range(getattr(feeds, n), start, end) for n in FEED_NAMES])


def build(feeds: Feeds, start=None, end=None, bookings: Callable | None = None) -> dict[str, DataFrame]:
    """Every gold table, or what a run over [start, end] loads of it.

    A run's rows equal those of a full build: the rooms fact counts the rooms of whole months
    (G7) and then keeps its days, and a reservation's first booking (L6) is looked for among all
    bookings of the run's reservations. ``bookings(first, last)`` reads a date range of bookings
    (default: a filter on the feed).
    """
    every, months = feeds.booking, feeds.booking
    if start is not None and end is not None:
        bookings = bookings or (lambda a, b: FL.date_range(every, a, b))
        first, last = FL.month_bounds(start, end)
        months = bookings(first, last)
        feeds = restrict(feeds, start, end)
        mine = feeds.booking.select("reservation_id").distinct()
        every = every.join(mine, "reservation_id", "left_semi")
    rooms = FCT.rooms_fact(months)
    if start is not None and end is not None:
        rooms = FL.date_range(rooms, start, end, "partition_date")
    times = D.collect_times(feeds.production, feeds.consumption, feeds.humidity, feeds.temperature,
                            feeds.weather, feeds.booking)
    return {
        "DimTime": D.dim_time(times),
        "DimReservation": D.dim_reservation(every),
        "DimRoom": D.dim_room(feeds.booking),
        "DimConsumption": D.dim_profile(feeds.consumption, "consumption"),
        "DimHumidity": D.dim_profile(feeds.humidity, "humidity"),
        "DimTemp": D.dim_profile(feeds.temperature, "temperature"),
        "DimInverter": D.dim_inverter(feeds.production),
        "DimErrors": D.dim_errors(feeds.production),
        "DimForecast": D.dim_forecast(feeds.weather),
        "DimConsumptionPrediction": D.dim_consumption_prediction(feeds.consumption),
        "DimProductionPredictionPac": D.dim_production_prediction(feeds.weather, "pac"),
        "DimProductionPredictionDaysum": D.dim_production_prediction(feeds.weather, "daysum"),
        "Power_FactTable": FCT.power_fact(feeds.production, feeds.consumption),
        "Weather_FactTable": FCT.weather_fact(feeds.weather, feeds.humidity, feeds.temperature),
        "Rooms_FactTable": rooms,
        "Prediction_FactTable": FCT.prediction_fact(feeds.consumption, feeds.weather),
    }


CORE_TABLES = ["DimTime", "DimInverter", "DimConsumption", "DimErrors", "DimForecast", "DimRoom",
               "DimReservation", "Power_FactTable", "Weather_FactTable", "Rooms_FactTable", "Prediction_FactTable"]


def load(spark: SparkSession, feeds: Feeds, root: str, start=None, end=None, bookings: Callable | None = None,
         log: list | None = None) -> dict[str, int]:
    """Write every table under ``root``; returns rows added per dimension.

    Dimensions come first, one after the other, then the facts side by side (their writes share nothing, and a small one
    leaves most cores idle) with dynamic partition overwrite
    (re-running a day replaces it, other days stay). ``log`` takes (table, day or None, rows): of a dimension what was
    added, of a fact the rows of each day of [start, end].
    """
    tables = build(feeds, start, end, bookings)
    days = []
    if log is not None and start is not None and end is not None:
        first, last = FL.as_date(start), FL.as_date(end)
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    tables = {name: W.conform(df, schemas.GOLD[name]) for name, df in tables.items()}
    facts = [name for name in tables if name.endswith("FactTable")]
    added = {}
    for name, df in tables.items():
        if name not in facts:
            added[name] = W.upsert_dim(spark, df, f"{root}/{name}", df.columns[0])
            if log is not None:
                log.append((name, None, added[name]))

    def write(name: str) -> list:
        written = W.Written(days)
        W.replace_fact_days(tables[name], f"{root}/{name}", written=written)
        return list(written.by_day().items()) if days else [(None, written.total())]

    with ThreadPoolExecutor(max_workers=len(facts)) as pool:
        for name, rows in zip(facts, pool.map(write, facts), strict=True):
            if log is not None:
                log += [(name, day, n) for day, n in rows]
    return added
