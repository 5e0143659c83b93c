"""Person-level roster out of a wide fact table: filter, place, flag, classify, label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.functions.columns import ColumnLike, any_flag, as_condition, case_map, ordered_rules, prefix_of
from rollwright.operators.joins import semi_join

# (condition, value) in the order in which they are tried.
RuleList = Sequence[tuple[ColumnLike, Any]]


@dataclass(frozen=True)
class MarkGroup:
    """Marks that count when ``when`` holds. No marks: the condition alone decides."""

    when: ColumnLike
    marks: Sequence[str] = ()
    mark: str = "1"
    as_text: bool = False

    def holds(self) -> Column:
        condition = as_condition(self.when)
        return condition & any_flag(self.marks, self.mark, self.as_text) if self.marks else condition


def mark_flag(groups: Sequence[MarkGroup]) -> Column:
    """True if any group holds; false otherwise, also where a condition is unknown."""
    return ordered_rules([(g.holds(), True) for g in groups], False)


@dataclass(frozen=True)
class ClassifyRules:
    """Everything that is a code list, a predicate or a label in ``roster_classify``.

    Conditions are Columns or SQL text. ``derived`` columns are added one after the other, so a later
    rule list may use an earlier result, and repeat its name to override it.
    """

    include: ColumnLike
    filters: Sequence[ColumnLike]
    grade: str
    grade_map: Mapping[str, str]
    site: str
    columns: Sequence[ColumnLike]
    flags: Mapping[str, Sequence[MarkGroup]] = field(default_factory=dict)
    derived: Sequence[tuple[str, RuleList, Any]] = ()
    grade_out: str = "transformed_grade"
    site_out: str = "site_code"
    district_out: str = "district_code"
    district_width: int = 3
    # Columns read by the site join; anything else of the lookups is pruned.
    conversion: tuple[str, str] = ("site_from", "site_to")
    open_site: str = "site"
    open_when: ColumnLike | None = None
    listed_site: str = "site"
    # Keep the row multiplication of an open-site list with duplicate sites.
    multiply: bool = False
    # Rule lists that replace a derived column: name -> (override column, apply it or not).
    overrides: Mapping[str, tuple[RuleList, bool]] = field(default_factory=dict)


def roster_classify(
    facts: DataFrame,
    site_conversion: DataFrame,
    open_sites: DataFrame,
    listed_sites: DataFrame,
    rules: ClassifyRules,
) -> DataFrame:
    """Filter the facts, convert and check the site, then flag, classify and label each row.

    All row filters come before the first join, where they reach the scan.
    """
    rows = facts.where(as_condition(rules.include))
    for condition in rules.filters:
        rows = rows.where(as_condition(condition))
    rows = rows.withColumn(rules.grade_out, case_map(rules.grade, rules.grade_map))

    site_from, site_to = rules.conversion
    conversion = site_conversion.select(F.col(site_from).alias("__from"), F.col(site_to).alias("__to"))
    rows = rows.join(conversion, F.col(rules.site) == F.col("__from"), "left")
    rows = rows.withColumn(rules.site_out, F.coalesce("__to", F.col(rules.site))).drop("__from", "__to")

    opened = open_sites.where(as_condition(rules.open_when)) if rules.open_when is not None else open_sites
    if rules.multiply:
        opened = opened.select(F.col(rules.open_site).alias("__open"))
        rows = rows.join(opened, F.col(rules.site_out) == F.col("__open"), "inner").drop("__open")
    else:
        rows = semi_join(rows, opened, {rules.site_out: rules.open_site})
    rows = semi_join(rows, listed_sites, {rules.site_out: rules.listed_site})
    rows = rows.withColumn(rules.district_out, prefix_of(rules.site_out, rules.district_width))

    if rules.flags:
        rows = rows.withColumns({name: mark_flag(groups) for name, groups in rules.flags.items()})
    for name, rule_list, default in rules.derived:
        rows = rows.withColumn(name, ordered_rules(rule_list, default))
    for name, (rule_list, apply) in rules.overrides.items():
        if apply:
            rows = rows.withColumn(name, ordered_rules(rule_list, F.col(name)))
    return rows.select(*rules.columns)


def roster_views(roster: DataFrame, views: Mapping[str, ColumnLike]) -> dict[str, DataFrame]:
    """Named filtered views over one (materialised) roster; unknown drops the row."""
    return {name: roster.where(as_condition(condition)) for name, condition in views.items()}
