"""Seven-day error metrics: 168 hourly stamps from a midnight, or up to a given hour.

The windows overlap sevenfold, so error rows are not joined to them. They are reduced to
daily sums per model (and zone) first; a window starting at midnight is the sum of seven
days. Only daily sums are repeated and shuffled, however many errors a day holds.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.errors import error_metrics, safe_ratio
from zonecast.functions.stamps import hours, instant
from zonecast.schemas import ROLLING, ROLLING_BY_ZONE, ZONE
from zonecast.session import stored

DAYS = 7
LAST_HOUR = 24 * DAYS - 1
TASK_ROWS = 1 << 20
"""Rows of windows that a task adds up."""
MOST_PIECES = 200_000
"""Days, hours and ends of all windows that are handed to every task; more of them are joined by a shuffle."""
_SUMS = ("n", "sum_abs", "sum_sq", "sum_ratio", "n_ratio")


def whole_hour(stamp: Column) -> Column:
    """The stamp itself. A stamp that is no whole hour breaks the hourly grid and fails the job."""
    return F.when(stamp == F.date_trunc("hour", stamp), stamp).when(stamp.isNull(), stamp).otherwise(
        F.raise_error(F.lit("target_timestamp must be a whole hour: use rolling_7d_of_stamps")))


def daily_sums(errors: DataFrame, *keys: str) -> DataFrame:
    """Sums per day and key, the latest stamp of the day, and whether it has a midnight."""
    ratio = safe_ratio("absolute_error", "actual_demand")
    stamp = whole_hour(F.col("target_timestamp"))
    return errors.groupBy(F.to_date(stamp).alias("day"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("absolute_error").alias("sum_abs"),
        F.sum("squared_error").alias("sum_sq"), F.sum(ratio).alias("sum_ratio"),
        F.count(ratio).alias("n_ratio"), F.max("target_timestamp").alias("last"), F.max(F.hour("target_timestamp") == 0).alias("midnight"))


def complete_windows(daily: DataFrame) -> DataFrame:
    """Start days of the windows that begin at a midnight with errors and end no later than
    the last target of any model.

    From the daily sums. As stamps are whole hours there is at most one midnight
    per calendar day, so the list of a century fits one small row.
    """
    days = daily.groupBy(F.when(F.col("midnight"), F.col("day")).alias("day")).agg(F.max("last").alias("last"))
    known = days.agg(F.collect_list("day").alias("days"), F.max("last").alias("last"))
    starts = known.select(F.explode("days").alias("start"), "last")
    return starts.filter(F.col("start").cast("timestamp") + hours(LAST_HOUR) <= F.col("last")).select("start")


def _by_key(sums: DataFrame, rows: int, *keys: str) -> DataFrame:
    """The sums placed by key, so that the task that has a key's sums adds up its windows, of ``rows`` rows in all.

    The tasks are so many that each has a bounded number of rows to add, whatever the size of the table; a key has as many
    rows as the time has days or hours."""
    tasks = max(int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    return sums.repartition(tasks, *keys) if keys else sums


def _sum_windows(daily: DataFrame, starts: DataFrame, *keys: str) -> DataFrame:
    earlier = F.array(*[F.date_sub("day", k) for k in range(DAYS)])
    candidates = daily.select(F.explode(earlier).alias("start"), *keys, *_SUMS)
    # One row per calendar day: a century of windows is 36,525 dates.
    kept = candidates.join(F.broadcast(starts), "start", "left_semi")
    total = kept.groupBy("start", *keys).agg(*[F.sum(c).alias(c) for c in _SUMS])
    start = F.col("start").cast("timestamp")
    return total.select(
        F.to_date(start + hours(LAST_HOUR)).alias("metric_date"), *keys,
        start.alias("window_start_timestamp"), (start + hours(LAST_HOUR)).alias("window_end_timestamp"),
        F.col("n").alias("num_predictions"), (F.col("sum_abs") / F.col("n")).alias("mae"),
        F.sqrt(F.col("sum_sq") / F.col("n")).alias("rmse"),
        safe_ratio("sum_ratio", F.col("n_ratio").cast("double")).alias("mape_excluding_zero_actuals"))


def rolling_7d(errors: DataFrame, end_days: DataFrame | None = None, reread: bool = False) -> DataFrame:
    """All complete windows, or those ending at 23:00 of ``end_days`` (a ``day`` column,
    distinct), complete or not. ``reread`` is for errors that are a stored table, cheaper to read twice than to keep sums of."""
    return _rolling(errors, end_days, reread, "model_version").select(*ROLLING.fieldNames())


def rolling_7d_by_zone(errors: DataFrame, end_days: DataFrame | None = None, reread: bool = False) -> DataFrame:
    return _rolling(errors, end_days, reread, "model_version", ZONE).select(*ROLLING_BY_ZONE.fieldNames())


def _rolling(errors: DataFrame, end_days: DataFrame | None, reread: bool, *keys: str) -> DataFrame:
    daily = daily_sums(errors, *keys)
    if end_days is None:
        if reread:
            return _sum_windows(daily, complete_windows(daily_sums(errors)), *keys)
        daily = stored(daily, "daily-sums")  # read for the starts and for the sums; the errors are read once
        return _sum_windows(_by_key(daily, daily.count() * DAYS, *keys), complete_windows(daily), *keys)
    starts = end_days.select(F.date_sub("day", DAYS - 1).alias("start"))
    return _sum_windows(daily, starts, *keys)


def _window_ending(errors: DataFrame, end: datetime, model_version: str, *keys: str) -> DataFrame:
    """The window up to one hour, complete or not. The bounds are literals and prune the scan."""
    stop = instant(end)
    start = stop - hours(LAST_HOUR)
    inside = errors.filter(
        (F.col("model_version") == model_version) & F.col("target_timestamp").between(start, stop))
    return inside.groupBy("model_version", *keys).agg(*error_metrics()).select(
        "*", F.to_date(stop).alias("metric_date"), start.alias("window_start_timestamp"),
        stop.alias("window_end_timestamp"))


def rolling_7d_at(errors: DataFrame, end: datetime, model_version: str) -> DataFrame:
    return _window_ending(errors, end, model_version).select(*ROLLING.fieldNames())


def rolling_7d_by_zone_at(errors: DataFrame, end: datetime, model_version: str) -> DataFrame:
    return _window_ending(errors, end, model_version, ZONE).select(*ROLLING_BY_ZONE.fieldNames())


# --- windows over stamps of any kind -----------------------------------------------------

def _sums_by(points: DataFrame, unit: str, *keys: str) -> DataFrame:
    """Sums per key and bucket, the bucket being the ``unit`` (day, hour) a stamp lies in."""
    return points.groupBy(*keys, F.lit(unit).alias("unit"), F.date_trunc(unit, "stamp").alias("bucket")).agg(
        *[F.sum(c).alias(c) for c in _SUMS])


def window_sums(errors: DataFrame, windows: DataFrame, *keys: str) -> DataFrame:
    """start, end, keys and the sums of the errors in every window (start, end), both ends included.

    Stamps and ends are of any kind. A window is the whole days inside it, the whole hours on both sides of
    them, and the parts of an hour at its two ends. Days and hours meet sums of that bucket, by equality; the two
    parts meet the distinct stamps of their hour. Errors are summed up per stamp, hour and day once for all windows.
    """
    ratio = safe_ratio("absolute_error", "actual_demand")
    points = errors.groupBy(*keys, F.col("target_timestamp").alias("stamp")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("absolute_error").alias("sum_abs"), F.sum("squared_error").alias("sum_sq"),
        F.sum(ratio).alias("sum_ratio"), F.count(ratio).alias("n_ratio"))
    points = stored(points, "stamp-sums")

    def up(stamp: Column, unit: str, one: Column) -> Column:
        cut = F.date_trunc(unit, stamp)
        return F.when(cut == stamp, stamp).otherwise(cut + one)

    def buckets(first: Column, stop: Column, unit: str, one: Column) -> Column:
        """The buckets from ``first`` on that begin before ``stop``."""
        listed = F.when(first < stop, F.sequence(first, stop - one, one)).otherwise(F.array().cast("array<timestamp>"))
        return F.transform(listed, lambda b: F.struct(F.lit(unit).alias("unit"), b.alias("bucket")))

    hour, day = hours(1), hours(24)
    start, end = F.col("start"), F.col("end")
    h1, h2 = up(start, "hour", hour), F.date_trunc("hour", end)
    d1, d2 = up(h1, "day", day), F.date_trunc("day", h2)
    whole_days = d1 < d2
    pieces = F.concat(
        buckets(d1, d2, "day", day),
        F.when(whole_days, F.concat(buckets(h1, d1, "hour", hour), buckets(d2, h2, "hour", hour))).otherwise(buckets(h1, h2, "hour", hour)))
    # One hour, or the two at the ends; a whole first hour is among the pieces already.
    last = F.date_trunc("hour", end)
    ends = F.when((F.date_trunc("hour", start) != start) & (F.date_trunc("hour", start) < last), F.array(F.date_trunc("hour", start), last)).otherwise(F.array(last))
    edges = F.transform(ends, lambda b: F.struct(F.lit("edge").alias("unit"), b.alias("bucket")))
    asked = stored(windows.select("start", "end", F.inline(F.concat(pieces, edges))), "window-pieces")

    by_hour = _sums_by(points, "hour", *keys)
    by_day = _sums_by(points, "day", *keys)
    at_ends = points.select(*keys, F.lit("edge").alias("unit"), F.date_trunc("hour", "stamp").alias("bucket"), *_SUMS, "stamp").join(
        asked.filter("unit = 'edge'").select("bucket").distinct(), "bucket", "left_semi")
    sums = stored(by_hour.unionByName(by_day).unionByName(at_ends, allowMissingColumns=True), "bucket-sums")

    met = sums.groupBy("unit", "bucket").count().join(asked.groupBy("unit", "bucket").agg(F.count(F.lit(1)).alias("windows")), ["unit", "bucket"])
    rows = met.agg(F.sum(F.col("count") * F.col("windows"))).first()[0] or 0
    parts = _by_key(sums, rows, *keys).join(F.broadcast(asked) if asked.count() <= MOST_PIECES else asked, ["unit", "bucket"]).filter(
        F.col("stamp").isNull() | F.col("stamp").between(F.col("start"), F.col("end")))
    return parts.groupBy("start", "end", *keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def rolling_7d_of_stamps(errors: DataFrame, *keys: str) -> DataFrame:
    """The windows of :func:`rolling_7d` (with the zone as further key: :func:`rolling_7d_by_zone`) for stamps that need not
    be whole hours. A window starts at every stamp of a midnight hour and reaches 167 hours on, if any error is as late.
    """
    stamps = errors.groupBy(F.col("target_timestamp").alias("start")).agg(F.lit(1).alias("one"))
    last = errors.agg(F.max("target_timestamp").alias("last")).scalar()
    end = F.col("start") + hours(LAST_HOUR)
    windows = stamps.filter((F.hour("start") == 0) & (end <= last)).select("start", end.alias("end"))
    total = window_sums(errors, windows, "model_version", *keys)
    return total.select(
        F.to_date("end").alias("metric_date"), *keys, F.col("start").alias("window_start_timestamp"), F.col("end").alias("window_end_timestamp"),
        "model_version", F.col("n").alias("num_predictions"), (F.col("sum_abs") / F.col("n")).alias("mae"), F.sqrt(F.col("sum_sq") / F.col("n")).alias("rmse"),
        safe_ratio("sum_ratio", F.col("n_ratio").cast("double")).alias("mape_excluding_zero_actuals"))
