"""Subgroup counts at several levels, published as numbered reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from rollwright.functions.columns import ColumnLike, as_condition
from rollwright.operators.report import ReportFormat, report_bundle
from rollwright.operators.rollup import ordered_union, rollup_of_views
from rollwright.plans.classify import ClassifyRules, roster_classify
from rollwright.sources.sinks import write_headerless_csv

_TOTAL = "is_total"


@dataclass(frozen=True)
class ReportPlan:
    """One kind of report: its roster, its basic columns, its legal combinations and its format."""

    roster: DataFrame
    basic: Sequence[str]
    format: ReportFormat
    # Legal combinations of the zero-filled level.
    allowed: Sequence[Mapping[str, Sequence[Any]]] | None = None
    domains: Mapping[str, Sequence[Any]] | None = None
    # Which rows of the roster this kind counts; all of them without a condition.
    view: ColumnLike | None = None


@dataclass(frozen=True)
class KindPlan:
    """The same without a roster, for kinds that share the one a classification makes."""

    basic: Sequence[str]
    format: ReportFormat
    view: ColumnLike | None = None
    allowed: Sequence[Mapping[str, Sequence[Any]]] | None = None
    domains: Mapping[str, Sequence[Any]] | None = None


def subgroup_counts(
    plans: Mapping[str, ReportPlan],
    subgroup_sets: Sequence[Sequence[str]],
    levels: Mapping[str, str | None],
    id_column: str,
    count_name: str = "Counts",
    total_flag: str | None = _TOTAL,
) -> dict[str, dict[str, DataFrame]]:
    """kind -> level -> counts. Kinds of one roster are counted together, in one pass over it."""
    rosters: dict[int, dict[str, ReportPlan]] = {}
    for kind, plan in plans.items():
        rosters.setdefault(id(plan.roster), {})[kind] = plan
    counted: dict[str, dict[str, DataFrame]] = {}
    for together in rosters.values():
        counted |= rollup_of_views(
            next(iter(together.values())).roster,
            {kind: plan.basic for kind, plan in together.items()},
            subgroup_sets,
            id_column,
            levels,
            {kind: as_condition(plan.view) for kind, plan in together.items() if plan.view is not None},
            count_name,
            {kind: plan.domains for kind, plan in together.items()},
            {kind: plan.allowed for kind, plan in together.items()},
            total_flag,
        )
    return {kind: counted[kind] for kind in plans}


def subgroup_reports(
    plans: Mapping[str, ReportPlan],
    subgroup_sets: Sequence[Sequence[str]],
    levels: Mapping[str, str | None],
    id_column: str,
    count_name: str = "Counts",
    null_only_total: bool = False,
) -> dict[tuple[str, str], DataFrame]:
    """(kind, level) -> report records with ``line_no``.

    Each roster is read once, whatever the number of kinds and levels; all reports are numbered in one pass.
    ``null_only_total`` leaves the total indicator at 'N' throughout, which is what testing the
    subgroup columns for null gives: an unused subgroup is '', and nulls have been dropped.
    """
    subgroups = ordered_union(subgroup_sets)
    tables = subgroup_counts(plans, subgroup_sets, levels, id_column, count_name)
    formats = {kind: plan.format for kind, plan in plans.items()}
    order_by = {kind: ordered_union([plan.basic, subgroups]) for kind, plan in plans.items()}
    return report_bundle(tables, formats, levels, order_by, None if null_only_total else _TOTAL)


def classify_and_report(
    facts: DataFrame,
    site_conversion: DataFrame,
    open_sites: DataFrame,
    listed_sites: DataFrame,
    rules: ClassifyRules,
    kinds: Mapping[str, KindPlan],
    subgroup_sets: Sequence[Sequence[str]],
    levels: Mapping[str, str | None],
    id_column: str,
    count_name: str = "Counts",
    null_only_total: bool = False,
) -> dict[tuple[str, str], DataFrame]:
    """From wide facts to all reports: classify the rows, mark the views they belong to, count, number, head.

    The classified rows are never written: they flow into the finest counts with a bit for each kind whose
    view holds them, so the facts are scanned once. Kinds may differ in basic columns, legal combinations
    and format.
    """
    roster = roster_classify(facts, site_conversion, open_sites, listed_sites, rules)
    plans = {
        kind: ReportPlan(roster, plan.basic, plan.format, plan.allowed, plan.domains, plan.view) for kind, plan in kinds.items()
    }
    return subgroup_reports(plans, subgroup_sets, levels, id_column, count_name, null_only_total)


def publish_reports(
    reports: Mapping[tuple[str, str], DataFrame], directory: str, names: Mapping[tuple[str, str], str]
) -> dict[tuple[str, str], str]:
    """Write each report as CSV without a header line, records in order."""
    return {key: write_headerless_csv(df, directory, names[key], order="line_no") for key, df in reports.items()}
