"""Plan inspection and job counters.

``plan_text`` captures what ``DataFrame.explain`` prints (``simple``,
``extended``, ``formatted``, ``cost``, ``codegen``). ``counted`` attaches
named metrics to a DataFrame with ``DataFrame.observe``: they are computed by
the next action on it (a write, a count), with no extra pass over the data.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import Column, DataFrame, Observation


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode=mode)
    return buffer.getvalue()


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with ``metrics`` observed; read them with ``observation.get``
    after an action on the returned DataFrame."""
    observation = Observation(name)
    exprs = [expr.alias(alias) for alias, expr in metrics.items()]
    return df.observe(observation, *exprs), observation
