"""Row filters with their null rules spelled out, and the split of one table into several."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.functions.columns import ColumnLike, as_column, as_condition, ordered_rules, valid_score


def filter_eq(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Equal; a null row drops."""
    return df.where(F.col(column) == F.lit(value))


def filter_ne(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Not equal; a null row drops too."""
    return df.where(F.col(column) != F.lit(value))


def filter_gt(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Greater than; codes are compared as text ('B1' > '200')."""
    return df.where(F.col(column) > F.lit(value))


def filter_in(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def filter_not_in(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Outside the list; null is neither in nor out and drops."""
    return df.where(~F.col(column).isin(*values))


def not_all(*conditions: ColumnLike) -> Column:
    """``NOT (a AND b AND c)`` in three-valued logic: unknown drops the row in a filter."""
    return ~reduce(lambda a, b: a & b, [as_condition(c) for c in conditions])


def filter_not_all(df: DataFrame, *conditions: ColumnLike) -> DataFrame:
    return df.where(not_all(*conditions))


def filter_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """All named columns (by default every column) hold a value."""
    return df.na.drop(subset=list(columns) if columns is not None else None)


def filter_valid_score(df: DataFrame, column: str) -> DataFrame:
    """Neither null nor NaN."""
    return df.where(valid_score(column))


def combination_mask(rules: Sequence[Mapping[str, Sequence[Any]]]) -> Column:
    """Any rule holds; a rule holds if every named column is in its list."""
    return reduce(
        lambda a, b: a | b,
        [
            reduce(lambda a, b: a & b, [as_column(c).isin(*values) for c, values in rule.items()])
            for rule in rules
        ],
    )


def allowed_combinations(df: DataFrame, rules: Sequence[Mapping[str, Sequence[Any]]]) -> DataFrame:
    """Keep the rows whose code combination is legal."""
    return df.where(combination_mask(rules))


def partition_split(df: DataFrame, parts: Mapping[str, ColumnLike]) -> dict[str, DataFrame]:
    """Several filtered outputs of one parent; hand in a materialised parent if it is costly."""
    return {name: df.where(as_condition(condition)) for name, condition in parts.items()}


def label_parts(df: DataFrame, parts: Mapping[str, ColumnLike], label: str = "output_name") -> DataFrame:
    """The same split as one column, for a single-pass partitioned write of disjoint parts."""
    named = ordered_rules([(condition, name) for name, condition in parts.items()])
    return df.withColumn(label, named).where(F.col(label).isNotNull())
