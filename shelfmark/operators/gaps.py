"""Gap filling: every key at every step of a time range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.skew import attach


def densify(facts: DataFrame, time: str, keys: Sequence[str], start: Column, end: Column, step: str,
            fill: Sequence[str] = (), members: DataFrame | None = None) -> DataFrame:
    """Facts for each member (by default every key that occurs) at each step, both ends included.

    Steps come from `sequence` on the member row itself, so no cross join is planned. `fill` columns
    are zero where there is no fact, the others NULL.
    """
    members = facts.select(*keys).distinct() if members is None else members
    steps = F.explode(F.sequence(start, end, F.expr(f"interval {step}"))).alias(time)
    full = attach(members.select(*keys, steps), facts, [*keys, time],
                  [c for c in facts.columns if c not in (*keys, time)], bounded=False)
    return full.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(facts.schema[c].dataType)) for c in fill})
