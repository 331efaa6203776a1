"""Deduplication of bars (O1): one row per (ticker, date).

The newest copy by ``processed_timestamp`` wins; exact ties fall back to
the full row order, so the result is deterministic. One aggregate with
map-side partial aggregation (sort-based, as its buffer holds a struct):
a hot key or a pile of copies of one bar is collapsed inside each input
partition before the shuffle. Rows with a NULL in a key part have no identity and are
kept as they are (the quality rules report them).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_bars(
    bars: DataFrame,
    keys: Sequence[str] = ("ticker", "date"),
    sequence_by: str = "processed_timestamp",
    keep_sequence: bool = False,
) -> DataFrame:
    """Latest copy per key; drops ``sequence_by`` unless ``keep_sequence``."""
    cols = bars.columns
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    best = F.max(F.struct(F.col(sequence_by).alias("_seq"), F.struct(*cols).alias("_row")))
    out = bars.where(known).groupBy(*keys).agg(best.alias("_b")).select("_b._row.*")
    out = out.unionByName(bars.where(~known))
    return out if keep_sequence else out.drop(sequence_by)
