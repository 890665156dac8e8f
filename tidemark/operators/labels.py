"""Churn labels around a cut-off date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.grid import Grid, complete
from tidemark.spec import ChurnSpec


def observation(events: DataFrame, spec: ChurnSpec, grid: Grid | None = None) -> DataFrame:
    """Accounts active (by the retention event types) before the cut-off; churned if never active on or after it.

    One aggregation per account carries both facts, so no self-join is needed. Missing mandatory values fail the job; a ``grid``
    of the log says that they were looked for.
    """
    cutoff = F.lit(spec.cutoff)
    before = F.to_date("event_time") < cutoff
    return (
        events.where(F.col("event_type").isin(*spec.retention_event_types))
        .groupBy("account_id")
        .agg(F.bool_or(before).alias("before"), F.bool_or(~before).alias("after"))
        .where(F.col("before") if grid else F.col("before") & complete(events))
        .select(
            "account_id",
            cutoff.alias("observation_date"),
            (~F.col("after")).alias("is_churn"),
        )
    )
