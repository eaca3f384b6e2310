"""Global positions in a total order, computed without funnelling rows into one task.

``cumulative_before`` gives every row the total weight of the rows ordered before it
(optionally within a group). It is the building block for exact quantiles (weights =
value counts) and for dictionary codes (weights = 1).

Plan: range-partitioned sort -> tag the Spark partition id -> reliable checkpoint (so
the tags and the data cannot diverge on a recompute) -> per-partition weight sums (one
row per partition and group) -> running offsets over that small table -> a running
sum inside each range partition. Every step is partitioned; the only global window
runs over the per-partition table, whose size is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir


def cumulative_before(
    df: DataFrame,
    order_by: list[str | Column],
    weight: str | None = None,
    group: str | None = None,
    out: str = "cum_before",
) -> DataFrame:
    """Add ``out`` = sum of ``weight`` (1 when None) over rows earlier in the order.

    The order (within ``group``) must be total, e.g. over distinct values, so the
    result does not depend on how ties are laid out.
    """
    ensure_checkpoint_dir(df.sparkSession)
    gcols = [group] if group else []
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    tagged = (
        df.withColumn("_w", w)
        .orderBy(*[F.col(g) for g in gcols], *order)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    per_part = tagged.groupBy(*gcols, "_part").agg(F.sum("_w").alias("_pw"))
    before_part = Window.partitionBy(*gcols).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_part.select(
        *gcols, "_part", F.coalesce(F.sum("_pw").over(before_part), F.lit(0)).alias("_off")
    )
    inside = Window.partitionBy("_part", *gcols).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        tagged.join(F.broadcast(offsets), [*gcols, "_part"])
        .withColumn(out, (F.col("_off") + F.coalesce(F.sum("_w").over(inside), F.lit(0))).cast("bigint"))
        .drop("_off", "_part", "_w")
    )
