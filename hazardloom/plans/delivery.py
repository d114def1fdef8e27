"""Delivery of a plan within a daily budget, resumable at any unit.

The plan is a small table: a row per unit (a table, or a month of one), not per delivered row. Rows travel from Spark to
the sink in tasks; the driver only decides which unit is next, as each decision depends on what the last one cost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

BUDGET, RESERVE, COST_PER_ROW = 60_000, 10_000, 5.0


@dataclass
class Usage:
    """What a day has cost, and the measured cost of a row, which outlives the day."""

    day: str
    written: int = 0
    statements: int = 0
    cost_per_row: float = COST_PER_ROW

    def on(self, day: str) -> Usage:
        return self if day == self.day else Usage(day, cost_per_row=self.cost_per_row)

    def measure(self, rows: int, written: int) -> None:
        if rows and written:
            self.cost_per_row = written / rows


@dataclass
class Outcome:
    state: str = "done"  # or budget, or failed
    delivered: list[str] = field(default_factory=list)
    error: str = ""


def deliver(units: DataFrame, send: Callable[[str], int], usage: Usage, confirm: Callable[[str], None], budget: int = BUDGET, reserve: int = RESERVE) -> Outcome:
    """Sends the units of ``units`` (``unit, stage, rows, backlog``) in order of stage, then newest unit first.

    A unit is started when its expected cost fits what is left of the budget; backlog units leave ``reserve`` for fresh
    rows. ``send`` returns what a unit cost; ``confirm`` stores that it arrived, which happens after the whole unit only,
    so a unit that failed is sent again. The first failure ends the run.
    """
    out = Outcome()
    for unit in sorted(units.collect(), key=lambda u: (u["stage"], _descending(u["unit"]))):
        limit = budget - (reserve if unit["backlog"] else 0)
        if usage.written + unit["rows"] * usage.cost_per_row > limit:
            out.state = "budget"
            break
        try:
            written = send(unit["unit"])
        except Exception as error:  # the sink's own errors end the run, whatever their kind
            out.state, out.error = "failed", str(error)
            break
        usage.written += written
        usage.statements += 1
        usage.measure(unit["rows"], written)
        confirm(unit["unit"])
        out.delivered.append(unit["unit"])
    return out


def _descending(text: str) -> list[int]:
    return [-ord(c) for c in text]
