"""Equi-joins against lookups and ID sets.

No side is broadcast by hint: lookups grow with the data. Spark broadcasts a side whose measured
size allows it and otherwise shuffles; hot partitions are split by adaptive execution, for which the
deduplicated sides are prepared (see ``dedupe``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.functions.columns import ColumnLike, as_column
from rollwright.operators.dedupe import distinct_keys


def _pairs(on: str | Sequence[str] | Mapping[str, str]) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(c, c) for c in on]


def _join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str], how: str) -> DataFrame:
    """Join on equal keys; the right key columns are dropped from the result. Another right column
    that the left side has too gets the suffix ``_right``."""
    pairs = _pairs(on)
    keys = {r for _, r in pairs}
    taken = {c.lower() for c in left.columns}
    renamed = {c: f"{c}_right" for c in right.columns if c not in keys and c.lower() in taken}
    keyed = right.withColumnsRenamed(renamed | {r: f"__right_{r}" for r in keys})
    condition = reduce(lambda a, b: a & b, [left[l] == keyed[f"__right_{r}"] for l, r in pairs])
    return left.join(keyed, condition, how).drop(*[f"__right_{r}" for _, r in pairs])


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Stop if a key occurs twice; otherwise return the table. Counts in Spark, brings back one row."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate lookup key {twice[0].asDict()}")
    return df


def left_enrich(
    left: DataFrame, lookup: DataFrame, on: str | Sequence[str] | Mapping[str, str], unique: bool = False
) -> DataFrame:
    """Add lookup columns, keep rows without a partner. Duplicate lookup keys multiply rows unless
    ``unique`` asks for a check."""
    if unique:
        require_unique(lookup, *[r for _, r in _pairs(on)])
    return _join(left, lookup, on, "left")


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    return _join(left, right, on, "inner")


def left_then_require(
    left: DataFrame, lookup: DataFrame, on: str | Sequence[str] | Mapping[str, str], required: str
) -> DataFrame:
    """Left join, then only rows where the lookup column holds a value (Catalyst makes it inner)."""
    return _join(left, lookup, on, "left").where(F.col(required).isNotNull())


def semi_join(left: DataFrame, ids: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows whose key is in the ID set."""
    pairs = _pairs(on)
    return _join_filter(left, distinct_keys(ids, *[r for _, r in pairs]), pairs, "left_semi")


def anti_join(left: DataFrame, ids: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows whose key is not in the ID set. A null key is neither in nor out, so it drops here too;
    a plain ``left_anti`` would keep it."""
    pairs = _pairs(on)
    held = left.na.drop(subset=[l for l, _ in pairs])
    return _join_filter(held, distinct_keys(ids, *[r for _, r in pairs]), pairs, "left_anti")


def _join_filter(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str) -> DataFrame:
    keyed = right.toDF(*[f"__right_{r}" for _, r in pairs])
    return left.join(keyed, reduce(lambda a, b: a & b, [left[l] == keyed[f"__right_{r}"] for l, r in pairs]), how)


def membership_flag(
    left: DataFrame, ids: DataFrame, on: str | Mapping[str, str], flag: str, yes: str = "Y", no: str | None = "N"
) -> DataFrame:
    """Add ``yes`` / ``no`` by membership; the number of rows does not change, a null key is ``no``."""
    ((left_key, right_key),) = _pairs(on)
    marked = distinct_keys(ids, right_key).toDF("__id").withColumn("__in", F.lit(True))
    joined = left.join(marked, left[left_key] == marked["__id"], "left")
    return joined.withColumn(flag, F.when(F.col("__in"), F.lit(yes)).otherwise(F.lit(no))).drop("__id", "__in")


def full_outer_flags(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """n ID sets -> one row for each ID with a true / null column for each set.

    One union and one aggregate instead of a chain of n - 1 full outer joins.
    """
    tagged = [ids.select(F.col(key), F.lit(name).alias("__set")) for name, ids in sets.items()]
    stacked = reduce(DataFrame.unionAll, tagged).where(F.col(key).isNotNull())
    flags = [F.bool_or(F.when(F.col("__set") == name, F.lit(True))).alias(name) for name in sets]
    return stacked.groupBy(key).agg(*flags)


def latest_mapping(mapping: DataFrame, old: str, new: str, order: str | None = None) -> DataFrame:
    """One row for each old value: the one latest by ``order`` (without it, the largest new value).

    A known order beats an unknown one; of equal orders the largest new value wins, so runs agree.
    """
    rank = [F.col(order).isNotNull().alias("known"), F.col(order).alias("order")] if order else []
    chosen = F.max(F.struct(*rank, F.col(new).alias("new")))["new"]
    return (
        mapping.where(F.col(old).isNotNull())
        .groupBy(F.struct(F.col(old).alias("__old")).alias("__key"))
        .agg(chosen.alias("__new"))
        .select("__key.__old", "__new")
    )


def replace_by_lookup(
    df: DataFrame, column: str, mapping: DataFrame, old: str, new: str, order: str | None = None
) -> DataFrame:
    """Value -> mapped value, else itself. One hop only; the latest duplicate in the map wins.

    The map must have the type of the column (IDs as bigint: through double, two IDs above 2^53 can
    become one).
    """
    if mapping.schema[old].dataType != df.schema[column].dataType:
        raise TypeError(f"{column} is {df.schema[column].dataType}, its map is keyed by {mapping.schema[old].dataType}")
    latest = latest_mapping(mapping, old, new, order)
    joined = df.join(latest, df[column] == latest["__old"], "left")
    return joined.withColumn(column, F.coalesce("__new", F.col(column))).drop("__old", "__new")


def coalesce_key(mapped: ColumnLike, alternative: ColumnLike) -> Column:
    """After a left join: the mapped key as text, else the alternative."""
    return F.coalesce(as_column(mapped).cast("string"), as_column(alternative).cast("string"))
