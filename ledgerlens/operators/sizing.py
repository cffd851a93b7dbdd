"""Broadcast only what has a proven size bound.

``fixed_dimension`` hints a broadcast when Catalyst proves from the plan alone that the side
is small (literal rows, and projections, filters or limits of them). Anything read from files
is left to the planner, which compares its size with the broadcast threshold. The hint never
changes an answer, and nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIXED_DIMENSION_MAX_ROWS = 10_000


def plan_max_rows(df: DataFrame) -> int | None:
    """Upper bound on the row count that Catalyst proves from the plan alone
    (exact for literal relations, propagated through projections, filters and
    limits), or None when the plan gives no bound."""
    bound = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(bound.get()) if bound.isDefined() else None


def fixed_dimension(df: DataFrame) -> DataFrame:
    """Broadcast a dimension whose size the plan itself proves (literal rows and
    projections or filters of them); anything else is left to the planner."""
    bound = plan_max_rows(df)
    if bound is not None and bound <= FIXED_DIMENSION_MAX_ROWS:
        return F.broadcast(df)
    return df
