"""Run metrics and plan text."""

from __future__ import annotations

import contextlib
import io
import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def with_metrics(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` observed under ``name``; read ``observation.get`` after an action.

    Without ``metrics`` the row count is observed as ``n_rows``. The metrics are
    gathered in the pass that the action makes anyway.
    """
    observation = Observation(name)
    return df.observe(observation, *(metrics or (F.count(F.lit(1)).alias("n_rows"),))), observation


class RunCounters:
    """Numbers gathered inside a plan, in the pass that an action makes anyway.

    Operators that take ``counters`` observe their steps with it; ``done`` observes the result.
    After one action on that result ``values`` has everything. A task that runs again after an
    executor was lost may be counted again in sums, not in maxima.
    """

    # Numbers of a step come just after those of the result, unless it was left out of the plan.
    PATIENCE = 2.0

    def __init__(self) -> None:
        self._steps: dict[str, Observation] = {}
        self._result: Observation | None = None

    def on(self, df: DataFrame, **metrics: str) -> DataFrame:
        """``df`` with the aggregates ``name="expression"`` observed."""
        observation = Observation()
        for name in metrics:
            self._steps[name] = observation
        return df.observe(observation, *(F.expr(e).alias(name) for name, e in metrics.items()))

    def done(self, df: DataFrame) -> DataFrame:
        """The result, whose rows are counted as ``n_rows``; run one action on this."""
        observed, self._result = with_metrics(df, "result")
        return observed

    @property
    def values(self) -> dict[str, int | None]:
        """Waits for the action. None for a step that was not run, as an empty table elsewhere
        in the plan made it needless; 0 or a null sum where it ran on no rows.
        """
        if self._result is None:
            raise ValueError("pass the result through done() and run an action on it first")
        found = dict(self._result.get)
        until = time.monotonic() + self.PATIENCE
        for name, observation in self._steps.items():
            # ``get`` fails, or in other versions waits for ever, for a step that was left out.
            step = observation._jo
            while not (ready := step.future().isCompleted()) and time.monotonic() < until:
                time.sleep(0.01)
            found[name] = observation.get[name] if ready and step.getRow().size() else None
        return found


def noted(df: DataFrame, note: str) -> DataFrame:
    """``df`` with a note on how it was planned, which ``explain_text`` prints."""
    df.plan_note = note
    return df


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain`` prints, as a string, after the note on the plan if it has one."""
    out = io.StringIO()
    if note := getattr(df, "plan_note", None):
        out.write(f"Chosen: {note}\n")
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
