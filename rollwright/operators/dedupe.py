"""One row for each key, and total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW = "__row"


def descending(*columns: str) -> list[Column]:
    """Descending with nulls first."""
    return [F.desc_nulls_first(c) for c in columns]


def ascending(*columns: str) -> list[Column]:
    """Ascending with nulls first."""
    return [F.asc_nulls_first(c) for c in columns]


def _first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # ``row_number() = 1`` gets a group limit before the shuffle: each map task sends at most one row
    # of a key, so a key with a third of all rows costs the receiving task no more than any other.
    #
    # The window runs over a struct of the key, so its partitioning differs from that of a later join
    # on the key. That join then reads plain exchanges on both sides, the one shape in which adaptive
    # execution can split a hot join partition. The extra exchange carries deduplicated rows only.
    window = Window.partitionBy(F.struct(*keys)).orderBy(*order)
    return df.withColumn(_ROW, F.row_number().over(window)).where(F.col(_ROW) == 1).drop(_ROW)


def best_row_per_key(
    df: DataFrame, keys: Sequence[str], rank_by: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Highest row of each key: ``rank_by`` descending, nulls first, then ``tiebreak`` ascending.

    Without a tiebreak that tells rows of a key apart, any of the tied rows may be kept.
    """
    return _first_by(df, keys, [*descending(*rank_by), *ascending(*tiebreak)])


def first_row_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Lowest row of each key: ``order_by`` ascending, nulls first."""
    return _first_by(df, keys, ascending(*order_by))


def sort_rows(df: DataFrame, columns: Sequence[str], reverse: bool = False) -> DataFrame:
    """Total order with nulls first in both directions. Worth its shuffle only before publishing."""
    return df.orderBy(*(descending(*columns) if reverse else ascending(*columns)))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-null keys, ready to be joined to a table with hot keys (see ``_first_by``)."""
    held = df.na.drop(subset=list(keys)).groupBy(F.struct(*keys).alias("__key")).agg(F.lit(True).alias("__held"))
    return held.select("__key.*")
