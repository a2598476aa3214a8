"""Dense, deterministic surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task. Instead:

1. range-partition on the ordering columns and sort inside each partition; the ordering is
   meant to be total (a unique key), so no single value can overload one partition. The number of
   ranges is the session's shuffle partitions, coalesced by AQE, whatever the input's splits,
2. number rows inside a partition from ``monotonically_increasing_id`` (its low 33 bits are
   the row position within the task's partition),
3. cut lineage with ``checkpoint()`` in the shared checkpoint folder so that the numbering is
   fixed even if executors are lost later; ranges stay apart and in order there,
4. count rows per range, sum the counts before each range, and join them back as a small table.

The result equals ``row_number() OVER (ORDER BY cols) - 1 + start`` when the ordering is total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_MASK = (1 << 33) - 1


def dense_key(df: DataFrame, order_by: list[Column], key: str, start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Append ``key`` = 0-based (+start) position of each row in the ``order_by`` order."""
    ranges = (df.repartitionByRange(num_partitions, *order_by) if num_partitions
              else df.repartitionByRange(*order_by))
    ranged = (ranges.sortWithinPartitions(*order_by)
              .withColumn("_rm_part", F.spark_partition_id())
              .withColumn("_rm_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
              # later jobs read the numbering back instead of running the range shuffle again
              .checkpoint(eager=True))
    before = Window.orderBy("_rm_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so at most as many as there are shuffle partitions
    offsets = (ranged.groupBy("_rm_part").agg(F.count(F.lit(1)).alias("_rm_n"))
               .select("_rm_part", (F.coalesce(F.sum("_rm_n").over(before), F.lit(0)) + start).alias("_rm_base")))
    return (ranged.join(F.broadcast(offsets), "_rm_part")
            .withColumn(key, (F.col("_rm_base") + F.col("_rm_pos")).cast("long"))
            .drop("_rm_part", "_rm_pos", "_rm_base"))
