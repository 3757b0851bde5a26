"""Row numbers within groups that hold at any group size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkshoal.session import checkpointed


def spread_row_number(df: DataFrame, groups: list[str], order: list[str], name: str = "rn") -> DataFrame:
    """``df`` with the row number (from 1) of each row in its group, without gathering a group in one task.

    Rows are range-partitioned and sorted on group and order columns, so a hot
    group spreads over many partitions. A row's number is its place in its
    partition's stretch of the group plus the sizes of the stretches before it.
    ``order`` must tell all rows of a group apart, else ties fall as they come.
    """
    keys = [*groups, *order]
    # Places are read twice, by the stretches and by the rows; written down once, they are the same for both whatever is run again or planned otherwise.
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    placed = checkpointed(df.sparkSession, placed)
    stretch = placed.groupBy(*groups, "_part").agg(F.min("_mid").alias("_first"), F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stretch.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_part").alias("_p"), "_first", before.alias("_before"))
    same = F.col("_part") == F.col("_p")  # without groups the stretches are the partitions
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(starts, same).withColumn(name, F.col("_mid") - F.col("_first") + F.col("_before") + 1).drop("_mid", "_part", "_p", "_first", "_before", *[f"_g{i}" for i in range(len(groups))])
