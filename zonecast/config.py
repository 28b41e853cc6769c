"""Job settings."""

from __future__ import annotations

from dataclasses import dataclass

from zonecast.operators.lags import DEFAULT_LAGS


@dataclass(frozen=True)
class DataConfig:
    # Names of the settings, and the default window lengths.
    process_start: str
    process_end: str
    train: tuple[str, str]
    test: tuple[str, str]
    validation: tuple[str, str] | None = None
    keep_license: str | None = None
    borough: str | None = None
    input_len: int = 24
    output_len: int = 1


@dataclass(frozen=True)
class BoostingConfig:
    # Default tree settings.
    n_estimators: int = 300
    max_depth: int = 4
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42
    lags: tuple[int, ...] = DEFAULT_LAGS
    horizon: int = 1
    use_calendar: bool = True
    zones_per_task: int = 4
    mode: str = "select"
    """``select``: the lags above and the calendar of the target hour. ``full``: every one of the last ``input_len`` hours, and its calendar."""
    input_len: int = 24

    def __post_init__(self):
        if self.mode not in ("select", "full"):
            raise ValueError(f"mode is select or full, not {self.mode!r}")

    @property
    def used_lags(self) -> tuple[int, ...]:
        return self.lags if self.mode == "select" else tuple(range(1, self.input_len + 1))

    @property
    def used_calendar(self) -> bool | tuple[int, ...]:
        """False, the target's own calendar, or the hours before it whose calendars are features."""
        return self.used_lags if self.use_calendar and self.mode == "full" else self.use_calendar
