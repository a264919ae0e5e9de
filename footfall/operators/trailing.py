"""Trailing windows over a daily series.

All frames end one step before the current row, so no feature sees its own
day. Steps are rows of the series by default; with `calendar=True` they are
days, and a missing day counts as a day without rows.

A series holds at most one row per key and day once the facts are aggregated,
so a window group is bounded by the length of the calendar however hot a key is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEK = 7


@dataclass(frozen=True)
class Series:
    keys: tuple[str, ...]
    day: str
    calendar: bool = False

    def _over(self, first: int, last: int = 1, by_weekday: bool = False) -> str:
        """OVER clause for the frame from `first` steps back to `last` steps back."""
        keys = [*self.keys, f"dayofweek({self.day})"] if by_weekday else self.keys
        unit, order = ("RANGE", f"unix_date({self.day})") if self.calendar else ("ROWS", self.day)
        return (
            f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order} "
            f"{unit} BETWEEN {first} PRECEDING AND {last} PRECEDING)"
        )

    def total(self, measure: str, steps: int) -> Column:
        """Sum over the previous `steps` steps, 0 if there are none."""
        return F.expr(f"coalesce(sum({measure}) {self._over(steps)}, 0)")

    def mean(self, measure: str, first: int, last: int = 1) -> Column:
        """Average over the steps `first` back to `last` back, 0 if there are none."""
        return F.expr(f"coalesce(avg({measure}) {self._over(first, last)}, 0D)")

    def weekday_mean(self, measure: str, weeks: int = 52) -> Column:
        """Average over the previous `weeks` rows that fall on the same weekday."""
        steps = weeks * WEEK if self.calendar else weeks
        return F.expr(f"coalesce(avg({measure}) {self._over(steps, by_weekday=True)}, 0D)")

    def lag(self, measure: str, steps: int) -> Column:
        """Value `steps` steps earlier, 0 if there is none."""
        if self.calendar:
            return F.expr(f"coalesce(max({measure}) {self._over(steps, steps)}, 0)")
        keys = ", ".join(self.keys)
        return F.expr(f"coalesce(lag({measure}, {steps}) OVER (PARTITION BY {keys} ORDER BY {self.day}), 0)")

    def trend(self, measure: str) -> Column:
        """Average of the last two weeks minus that of the two weeks before."""
        return self.mean(measure, 2 * WEEK) - self.mean(measure, 4 * WEEK, 2 * WEEK + 1)

    def ratio(self, numerator: str, denominator: str, steps: int) -> Column:
        """Quotient of two trailing sums, 0 where it is undefined."""
        over = self._over(steps)
        return F.expr(
            f"coalesce(cast(sum({numerator}) {over} AS double) / nullif(sum({denominator}) {over}, 0), 0D)"
        )
