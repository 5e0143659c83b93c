"""Record numbers 1..N over a whole result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollwright.session import materialise

# monotonically_increasing_id keeps the position within the partition in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def record_number(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "record_number",
    within: Sequence[str] = (),
) -> DataFrame:
    """Number the rows 1..N in the order of the given columns (nulls first), for each group of
    ``within`` anew. Groups may be of any size: they too are spread over partitions.

    Rows equal in these columns follow each other by a hash of the whole row, so that numbers repeat
    from run to run; copies of one row are interchangeable.

    A global ``row_number()`` would sort everything in one task. Here the rows are range-partitioned
    by the full order, numbered within their partition and written; the partition sizes (one row for
    each partition, and one more for each group) then give each partition its offset. The written
    copy keeps partition and position fixed if a task runs again. The task a row comes from is the
    last range key: it stays the same if the task is repeated, and cuts a large group of copies into
    pieces.
    """
    placed = _place(df, order_by, within)
    return _number(placed, _sizes(placed, within), df.columns, name, within)


def number_groups(
    df: DataFrame, order_by: Sequence[str], name: str, within: Sequence[str], heights: str = "height"
) -> tuple[DataFrame, DataFrame]:
    """The numbered rows, and the number of rows of each group: the sum of the sizes that numbering needs
    anyway. The sizes are written once, so that neither result counts the rows again."""
    placed = _place(df, order_by, within)
    sizes = materialise(_sizes(placed, within), "partition-sizes")
    return _number(placed, sizes, df.columns, name, within), sizes.groupBy("__group").agg(F.sum("__size").alias(heights)).select("__group.*", heights)


def rank_groups(df: DataFrame, name: str, within: Sequence[str], heights: str = "height") -> tuple[DataFrame, DataFrame]:
    """Any numbering 0..N-1 of the rows of each group, and the number of rows of each: nothing is sorted by range."""
    dealt = df.repartition(*[F.col(c) for c in df.columns]).sortWithinPartitions(*within)
    placed = _positions(dealt, within)
    sizes = materialise(_sizes(placed, within), "partition-sizes")
    ranked = _number(placed, sizes, df.columns, name, within).withColumn(name, F.col(name) - 1)
    return ranked, sizes.groupBy("__group").agg(F.sum("__size").alias(heights)).select("__group.*", heights)


def running_total(df: DataFrame, order_by: Sequence[str], value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all rows before each row, in the order of the given columns, which must be unique.

    Two levels: rows are range-partitioned by the order and summed up within their partition, in parallel; the
    totals of the partitions, one row each, are summed up apart and joined back.
    """
    placed = _place(df, order_by, ())
    inside = Window.partitionBy("__part").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    totals = placed.groupBy("__part").agg(F.sum(value).alias("__total")).withColumn("__group", F.lit(0))
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = totals.select("__part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))
    return summed.join(F.broadcast(earlier), "__part").select(*df.columns, (F.col("__before") + F.col("__inside")).alias(name))


def _place(df: DataFrame, order_by: Sequence[str], within: Sequence[str]) -> DataFrame:
    order = [F.asc_nulls_first(c) for c in [*within, *order_by]]
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order += [F.asc("__hash"), F.asc("__task")]
    tied = df.withColumns({"__hash": row_hash, "__task": F.spark_partition_id()})
    ranged = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("__hash", "__task")
    return _positions(ranged, within)


def _positions(ordered: DataFrame, within: Sequence[str]) -> DataFrame:
    placed = materialise(
        ordered.withColumn("__part", F.spark_partition_id()).withColumn(
            "__pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
        ),
        "numbered",
    )
    return placed.withColumn("__group", F.struct(*within) if within else F.lit(0))


def _sizes(placed: DataFrame, within: Sequence[str]) -> DataFrame:
    return placed.groupBy("__part", "__group").agg(F.count("*").alias("__size"), F.min("__pos").alias("__first"))


def _number(placed: DataFrame, sizes: DataFrame, columns: Sequence[str], name: str, within: Sequence[str]) -> DataFrame:
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("__size").over(before), F.lit(0))
    offsets = sizes.select("__part", "__group", (earlier - F.col("__first") + 1).alias("__offset"))
    if not within:
        offsets = F.broadcast(offsets)
    same = (placed["__part"] == offsets["__part"]) & placed["__group"].eqNullSafe(offsets["__group"])
    joined = placed.join(offsets, same)
    return joined.select(*columns, (F.col("__offset") + F.col("__pos")).alias(name))
