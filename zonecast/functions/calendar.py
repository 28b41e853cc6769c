"""Calendar features of an hour: cyclic encodings, weekend and holiday flags."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The holidays known to the models, 12 per year. Actual and observed dates are mixed.
HOLIDAYS = (
    "2023-01-02", "2023-01-16", "2023-02-20", "2023-05-29", "2023-06-19", "2023-07-04",
    "2023-09-04", "2023-10-09", "2023-11-07", "2023-11-11", "2023-11-23", "2023-12-25",
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-06-19", "2024-07-04",
    "2024-09-02", "2024-10-14", "2024-11-05", "2024-11-11", "2024-11-28", "2024-12-25",
    "2025-01-01", "2025-01-20", "2025-02-17", "2025-05-26", "2025-06-19", "2025-07-04",
    "2025-09-01", "2025-10-13", "2025-11-04", "2025-11-11", "2025-11-27", "2025-12-25",
    "2026-01-01", "2026-01-19", "2026-02-16", "2026-05-25", "2026-06-19", "2026-07-03",
    "2026-09-07", "2026-10-12", "2026-11-03", "2026-11-11", "2026-11-26", "2026-12-25",
)

# Column order of the tabular and of the sequence form.
TABULAR_CALENDAR = (
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend", "is_holiday")
SEQUENCE_CALENDAR = (
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "is_holiday", "month_sin", "month_cos")


def _cycle(position: Column, period: int) -> tuple[Column, Column]:
    angle = position * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def calendar_features(
    stamp: Column | str,
    order: Sequence[str] = TABULAR_CALENDAR,
    holidays: Sequence[str] | None = None,
) -> list[Column]:
    """The calendar block of ``stamp`` as named columns, Monday being day 0."""
    stamp = F.col(stamp) if isinstance(stamp, str) else stamp
    weekday = F.weekday(stamp)
    days = [F.lit(date.fromisoformat(d)) for d in (HOLIDAYS if holidays is None else holidays)]
    is_holiday = F.to_date(stamp).isin(*days) if days else F.lit(False)
    hour_sin, hour_cos = _cycle(F.hour(stamp), 24)
    dow_sin, dow_cos = _cycle(weekday, 7)
    month_sin, month_cos = _cycle(F.month(stamp) - 1, 12)
    values = {
        "hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos,
        "month_sin": month_sin, "month_cos": month_cos,
        "is_weekend": (weekday >= 5).cast("double"), "is_holiday": is_holiday.cast("double"),
    }
    return [values[name].alias(name) for name in order]


def sequence_calendar(include_month: bool = True) -> tuple[str, ...]:
    return SEQUENCE_CALENDAR if include_month else SEQUENCE_CALENDAR[:6]
