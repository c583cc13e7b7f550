"""Exact percent rank without gathering the table in one task.

`PERCENT_RANK() OVER (ORDER BY ...)` without PARTITION BY moves every row to a
single task. Here the rows are first reduced to their distinct order keys with
counts. Those are range-partitioned, the partition number of each key is stored
with it, ranks are prefix sums inside a partition plus the total of all earlier
partitions, and the result is joined back on the order key.

Ranked tables have few different order keys, so one key may hold most rows. Keys with more
than a thousandth of all rows, at most a thousand, are sent to the rows; their rows then take
part in the shuffle of the others under a number of their own, so no task gathers them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import checkpointed

HOT_SHARE = 1_000   # a key with more than one in so many rows is sent


def percent_rank(rows: DataFrame, order: list[str], name: str = "risk_percentile") -> DataFrame:
    """`rows` plus (rank - 1) / (n - 1), ascending by `order`; 0 for a single row.

    `rows` is read twice, so pass a stored table (or a checkpointed one).
    """
    keys = rows.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    sorted_keys = keys.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    # Range bounds come from a sample, so another evaluation could cut elsewhere. Storing
    # the slice number makes it data: a lost executor rereads it instead of recomputing it.
    sorted_keys = checkpointed(sorted_keys)

    # One row per slice: the window below never sees more rows than there are partitions.
    slices = sorted_keys.groupBy("_slice").agg(F.sum("_copies").alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "_slice",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy()).alias("_n"),
    )
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sorted_keys.withColumn("_below", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
        # At most one row per shuffle partition: a bound set by configuration, not by data.
        .join(F.broadcast(offsets), "_slice")
        .select(
            *[F.col(c).alias(f"_key_{c}") for c in order],
            F.coalesce(
                F.try_divide(F.col("_below") + F.col("_offset"), F.col("_n") - 1), F.lit(0.0)
            ).alias(name),
            (F.col("_copies") * HOT_SHARE > F.col("_n")).alias("_hot"),
            # Always 0, but no literal: the optimizer would take that out of the join's keys.
            F.shiftright("_copies", 63).alias("_zero"),
        )
    )
    same_key = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in order]
    key_columns = [f"_key_{c}" for c in order]

    hot = ranked.where("_hot").select(*key_columns, F.col(name).alias("_hot_rank"))
    marked = rows.join(F.broadcast(hot), same_key, "left").drop(*key_columns)
    salt = F.when(F.col("_hot_rank").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(*rows.columns))
    cold = ranked.where("not _hot").select(*key_columns, F.col(name).alias("_cold_rank"), "_zero")
    joined = marked.withColumn("_salt", salt).join(cold, [*same_key, F.col("_salt") == F.col("_zero")], "left")
    return joined.select(*rows.columns, F.coalesce("_hot_rank", "_cold_rank").alias(name))
