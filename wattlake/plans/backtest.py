"""Walk-forward backtest of the energy forecast.

Every day of the calendar is forecast as the daily run would have done it on the evening before: production from a forest
trained on the seven days before, consumption from one trained on all days before, features as in ``forecast``
(the day's own weather forecast; humidity, temperature and rooms of the day before).

There is one model per day and target, so the days are the rows that Spark spreads: a task trains the forests of its days.
What they train on is the hourly frame, 24 rows per calendar day however many readings a day has; it is broadcast after
its rows are counted. (MLlib trains one forest over a cluster at a time, which for a day's 168 rows is all scheduling.)
"""

from __future__ import annotations

import datetime as dt
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks import writers as W
from . import forecast as FC

MAX_HOURS = 2_000_000           # rows of the hourly frame that may be broadcast: over two centuries
BINS = 32                       # split candidates of a feature
KINDS = ("production", "consumption")


# --- forest ---------------------------------------------------------------------------------------
def _codes(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)])


def _grow(codes: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, tries: int) -> list[tuple]:
    """Nodes (feature, bin, left, right, mean) of one regression tree; a leaf has the feature -1."""
    nodes, todo = [], [(np.arange(len(y)), 0, -1, 0)]
    while todo:
        rows, level, parent, side = todo.pop()
        own, value = len(nodes), y[rows]
        nodes.append([-1, 0, -1, -1, float(value.mean())])
        if parent >= 0:
            nodes[parent][2 + side] = own
        if level == depth or len(rows) < 2 or np.ptp(value) == 0:
            continue
        total, best = value.sum(), (1e-12, -1, 0)
        for f in rng.choice(codes.shape[1], tries, replace=False):
            c = codes[rows, f]
            n, s = np.bincount(c, minlength=BINS), np.bincount(c, value, BINS)
            nl, sl = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
            nr, sr = len(rows) - nl, total - sl
            ok = (nl > 0) & (nr > 0)
            gain = np.where(ok, sl ** 2 / np.maximum(nl, 1) + sr ** 2 / np.maximum(nr, 1) - total ** 2 / len(rows), -1.0)
            b = int(gain.argmax())
            if gain[b] > best[0]:
                best = (float(gain[b]), int(f), b)
        if best[1] >= 0:
            nodes[own][0], nodes[own][1] = best[1], best[2]
            left = codes[rows, best[1]] <= best[2]
            todo += [(rows[~left], level + 1, own, 1), (rows[left], level + 1, own, 0)]
    return nodes


def forest(x: np.ndarray, y: np.ndarray, at: np.ndarray, seed: int, trees: int = 20, depth: int = 6) -> np.ndarray:
    """Predictions for rows ``at`` of a forest trained on (x, y): bootstrap samples, a third of the features at each split."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    codes, seen, out = _codes(x, edges), _codes(at, edges), np.zeros(len(at))
    rng = np.random.default_rng(seed)
    for _ in range(trees):
        pick = rng.integers(0, len(y), len(y))
        nodes = _grow(codes[pick], y[pick], rng, depth, max(1, x.shape[1] // 3))
        for i, row in enumerate(seen):
            n = nodes[0]
            while n[0] >= 0:
                n = nodes[n[2] if row[n[0]] <= n[1] else n[3]]
            out[i] += n[4]
    return out / trees


# --- days -----------------------------------------------------------------------------------------
class History:
    """The hourly frame as arrays, in order of day and hour."""

    def __init__(self, frame: pa.Table):
        frame = frame.sort_by([("date", "ascending"), ("hour", "ascending")])
        self.day = frame["date"].cast(pa.int32()).to_numpy()
        self.hour = frame["hour"].to_numpy()
        self.x = np.column_stack([frame[f].to_numpy().astype(float) for f in FC.FEATURES])
        self.y = {k: frame[f"{k}_kwh"].to_numpy().astype(float) for k in KINDS}

    def between(self, first: int, last: int) -> slice:
        return slice(int(np.searchsorted(self.day, first)), int(np.searchsorted(self.day, last, "right")))

    def asked(self, day: int, forecast: dict[int, float]) -> np.ndarray:
        """Features of the 24 hours of a day as they are known on the evening before."""
        out = np.zeros((24, len(FC.FEATURES)))
        at = self.between(day - 1, day - 1)
        for name in ("humidity", "temperature", "rooms_booked"):
            k = FC.FEATURES.index(name)
            out[self.hour[at], k] = self.x[at, k]
        out[:, FC.FEATURES.index("hour")] = np.arange(24)
        out[:, FC.FEATURES.index("weekday")] = (dt.date(1970, 1, 1) + dt.timedelta(days=day)).isoweekday() % 7 + 1
        for h, v in forecast.items():
            out[h, FC.FEATURES.index("forecast")] = v
        return out


def predict_day(history: History, day: int, forecast: dict[int, float], prod_days: int, trees: int, depth: int, seed: int):
    """(hours trained on, 24 predictions) of each target; no predictions without a day before."""
    at = history.asked(day, forecast)
    for kind, first in zip(KINDS, (day - prod_days, -(1 << 30)), strict=True):
        w = history.between(first, day - 1)
        n = w.stop - w.start
        own = zlib.crc32(f"{seed}:{kind}:{day}".encode())
        yield n, forest(history.x[w], history.y[kind][w], at, own, trees, depth) if n else np.full(24, np.nan)


SCHEMA = "pred_date date, pred_hour int, n_train_production int, n_train_consumption int, predicted_production_kwh double, predicted_consumption_kwh double"


def walk_forward(frame: DataFrame, weather: DataFrame, prod_days: int = 7, trees: int = 20, depth: int = 6, seed: int = 42) -> DataFrame:
    """Forecast of every day of ``frame`` (``forecast.hourly_frame``) that has a day before it, 24 rows a day.

    ``prod_days`` days train the production forest, all earlier days the consumption forest. An empty frame gives no rows.
    """
    spark = frame.sparkSession
    frame = W.stage(spark, frame, "backtest-frame")
    hours = frame.count()
    if hours > MAX_HOURS:
        raise ValueError(f"{hours} hours of history; at most {MAX_HOURS} are broadcast")
    history = spark.sparkContext.broadcast(History(frame.select("date", "hour", *[f for f in FC.FEATURES if f != "hour"], *[f"{k}_kwh" for k in KINDS]).toArrow()))

    def run(batches):
        for batch in batches:
            out = []
            for day, hours, values in zip(batch["date"].cast(pa.int32()).to_pylist(), batch["hours"].to_pylist(), batch["values"].to_pylist(), strict=True):
                found = list(predict_day(history.value, day, dict(zip(hours, values, strict=True)), prod_days, trees, depth, seed))
                out += [(day, h, found[0][0], found[1][0], *[None if np.isnan(p[h]) else round(float(p[h]), 6) for _, p in found]) for h in range(24)]
            cols = list(zip(*out, strict=True)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int32()).cast(pa.date32()), *[pa.array(c, pa.int32()) for c in cols[1:4]], *[pa.array(c, pa.float64()) for c in cols[4:]]],
                names=[c.split()[0] for c in SCHEMA.split(", ")])
    first = frame.agg(F.min("date")).scalar()
    days = frame.select("date").distinct().where(F.col("date") > first)
    known = FC.hourly_forecast(weather).groupBy("date").agg(F.collect_list(F.struct("hour", "forecast")).alias("f"))         # 24 a day
    days = days.join(known, "date", "left").select(
        "date", *[F.coalesce(F.col(f"f.{c}"), F.array().cast(f"array<{t}>")).alias(n) for n, c, t in (("hours", "hour", "int"), ("values", "forecast", "double"))])
    # few rows of much work: a task per few days
    parts = max(1, min(1000, hours // 24 // 4))
    return days.repartition(parts, "date").mapInArrow(run, SCHEMA)


def compared(frame: DataFrame, predicted: DataFrame) -> DataFrame:
    """Actual hours beside their predictions; hours without one stay, with nulls."""
    p = predicted.withColumnsRenamed({"pred_date": "date", "pred_hour": "hour"})
    return frame.select("date", "hour", "production_kwh", "consumption_kwh").join(p, ["date", "hour"], "left")


def accuracy(both: DataFrame) -> DataFrame:
    """G16 of the model: MAE and accuracy by day, month and overall, over the hours that were forecast."""
    return FC.accuracy(both.where("predicted_production_kwh is not null and predicted_consumption_kwh is not null"))
