"""Running sums and last values per group, without a task per group.

The rows are range-partitioned by (group, order) and checkpointed, so a hot
group lies in many partitions, and both passes see the same ones. Inside a
partition a window does the work. Across partitions only the first and the
last group of each can go on, so what came before is at most two rows a
partition: they are summed up, and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.session import checkpoint_root

PID = "_pid"


def lay_out(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` in partitions by (group, order), with the partition as ``_pid``."""
    checkpoint_root(df.sparkSession)
    return df.repartitionByRange(F.col(group), *[F.col(c) for c in order]).withColumn(PID, F.spark_partition_id()).checkpoint(eager=True)


def running(laid: DataFrame, group: str, order: list[str], sums: dict[str, str] | None = None,
            lasts: dict[str, str] | None = None) -> DataFrame:
    """Add, over the rows of the same group before each row, the sums of
    ``sums`` (column: name of the result, 0 at the begin) and the last
    non-null values of ``lasts`` (null at the begin).

    ``laid`` comes from ``lay_out`` with the same group and order, columns may
    have been added since; ``order`` is total within a group. A null group is
    a group."""
    sums, lasts = sums or {}, lasts or {}
    before = Window.partitionBy(PID, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = laid.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(o) for c, o in sums.items()],
                         *[F.last(c, ignorenulls=True).over(before).alias(o) for c, o in lasts.items()])
    bounds = laid.groupBy(PID).agg(F.min(F.struct(group)).alias("_lo"), F.max(F.struct(group)).alias("_hi"))
    place = F.struct(*order)
    edge = (laid.join(F.broadcast(bounds), PID).where((F.struct(group) == F.col("_lo")) | (F.struct(group) == F.col("_hi")))
            .groupBy(PID, F.col(group).alias("_g"))
            .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{c}") for c in sums],
                 *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_l_{c}") for c in lasts]))
    earlier = Window.partitionBy("_g").orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    carried = edge.select(F.col(PID).alias("_p"), "_g", *[F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)).alias(f"_c_{c}") for c in sums],
                          *[F.last(f"_l_{c}", ignorenulls=True).over(earlier).alias(f"_d_{c}") for c in lasts])
    both = inside.join(F.broadcast(carried), (F.col(PID) == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left")
    added = {o: F.col(o) + F.coalesce(F.col(f"_c_{c}"), F.lit(0)) for c, o in sums.items()}
    added |= {o: F.coalesce(F.col(o), F.col(f"_d_{c}")) for c, o in lasts.items()}
    return both.select(*laid.columns, *[v.alias(o) for o, v in added.items()])
