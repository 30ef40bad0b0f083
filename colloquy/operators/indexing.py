"""Consecutive 0-based positions in a global order, computed distributed.

A global ``row_number() OVER (ORDER BY ...)`` runs in a single partition.
Instead: range-sort once, count rows per sorted partition (one row per
partition), turn the counts into offsets, and add each row's position in
its partition. Only the per-partition counts are broadcast, and their
number is bounded by the partition count.

The sorted rows are used twice (counts, then positions). Recomputing them
would sample the range bounds again, possibly on differently ordered input,
and partition ids could differ between the two uses. So the sorted, tagged
rows are written once with a reliable ``checkpoint()`` into the shared
checkpoint folder, and both uses read that copy. This also cuts the lineage,
so a lost executor does not replay the sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.session import checkpoint_root


def dense_index(df: DataFrame, order, name: str = "idx") -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order``.

    ``order`` should be a total order (end with a unique key) for a
    deterministic result.
    """
    cols = [order] if isinstance(order, (str,)) else list(order)
    checkpoint_root(df.sparkSession)
    ranked = (df.orderBy(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id() - (F.col("_pid").cast("long") * (1 << 33)))
              .checkpoint(eager=True))
    counts = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    return (ranked.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))
