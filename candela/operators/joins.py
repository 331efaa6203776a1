"""Dimension joins.

The build side is the planner's choice: it broadcasts a side whose size
statistics (or, under AQE, whose measured shuffle size) stay under
``spark.sql.autoBroadcastJoinThreshold`` and sort-merge joins beyond it, with
AQE splitting a hot key. No probe job runs and nothing is forced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a (usually small) dimension onto a fact."""
    return fact.join(dim, on, how)
