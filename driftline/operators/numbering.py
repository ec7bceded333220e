"""Row numbers within groups of any size, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.shared import discard, written

#: Counts of groups in partitions are broadcast up to so many rows; beyond that they are joined by shuffling.
BROADCAST_ROWS = 100_000


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str = "row", first: int = 0, nulls_first: bool = True) -> DataFrame:
    """All rows with ``out``: their number, from ``first``, in their group in the order named. Rows that tie get numbers in any order.

    Rows are dealt to ranges of (groups, order) and sorted there, so a large group is spread over many tasks; each task numbers
    its own rows, and what earlier ranges hold of a group is added. Ties are told apart by the row's place in the input, so that
    ranges can be cut anywhere. The numbered rows are written once to the shared folder. A null group is a group.
    """
    own = "_number_tie", "_number_at", "_number_part", "_number_low", "_number_before"
    if taken := {c.lower() for c in df.columns} & {*own, out.lower()}:
        raise ValueError(f"the table has {', '.join(sorted(taken))} already")
    tie, at, part, low, before = own
    up = [F.asc_nulls_first(c) if nulls_first else F.asc_nulls_last(c) for c in (*groups, *order, tie)]
    deal = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(deal, *up).sortWithinPartitions(*up).drop(tie)
    placed = written(ranges.withColumns({at: F.monotonically_increasing_id(), part: F.spark_partition_id()}), "numbered")
    held = placed.groupBy(*groups, part).agg(F.min(at).alias(low), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range that has some of the group
    held = written(held.select(*groups, part, low, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)), "numbered-counts")
    many = held.count() > BROADCAST_ROWS
    names = {g: f"_number_group{i}" for i, g in enumerate(groups)}
    right = held.select(*(F.col(g).alias(n) for g, n in names.items()), F.col(part).alias("_number_of"), low, before)
    same = F.col(part) == F.col("_number_of")
    for g, n in names.items():
        same = same & F.col(g).eqNullSafe(F.col(n))
    joined = placed.join(right if many else F.broadcast(right), same)
    result = joined.select(*df.columns, (F.col(at) - F.col(low) + F.col(before) + first).alias(out))
    result._tables = (placed, held)
    return result


def forget(table: DataFrame) -> None:
    """Delete what ``numbered`` wrote, once its result has been taken."""
    discard(*table._tables)
