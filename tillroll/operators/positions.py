"""Dense 1-based positions in a global order without a single-partition window.

``row_number() OVER (ORDER BY k)`` makes Spark move every row to one task.
Instead: range-partition and sort (rows equal in all order columns share a range), freeze
the layout with a reliable checkpoint, count rows per partition, turn counts
into offsets (one row per partition, whatever the data's size) and add the in-partition index.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import checkpoint_root

_INDEX_BITS = 33  # monotonically_increasing_id = partition << 33 | index in partition


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "pos",
                  partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_root(spark)  # make sure a reliable checkpoint folder is configured
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = (ranged.sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Reliable checkpoint: the partition layout the offsets refer to survives
    # executor loss (a recomputation could re-sample the range bounds).
    frozen = ranged.checkpoint(eager=True)
    counts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    index = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _INDEX_BITS)
    return (frozen.join(offsets, "_pid")
            .withColumn(name, (F.col("_off") + index + 1).cast("long"))
            .drop("_pid", "_mid", "_off"))
