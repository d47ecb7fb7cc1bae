"""Physical-plan access for tests and the plan report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed plan as text (AQE's initial plan when not yet run)."""
    return df._jdf.queryExecution().executedPlan().toString()
