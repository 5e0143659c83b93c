"""Numbered reports: body records as text under one header record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.functions.columns import cast_all_to_string
from rollwright.operators.numbering import number_groups, record_number
from rollwright.operators.rollup import table_height

LINE = "line_no"


@dataclass(frozen=True)
class LevelFormat:
    """How one level is named and which identifiers its records carry ('' where not applicable)."""

    title: str
    short: str
    identifiers: Mapping[str, Column | str] = field(default_factory=dict)


@dataclass(frozen=True)
class ReportFormat:
    """Everything fixed about one kind of report.

    ``file_name`` and ``identifier`` are templates over ``short`` (of the level), ``kind`` and
    ``period``. ``columns`` is the published column list in order; it may name the columns added
    here: ``file_record_number``, the fixed ones, the identifiers, ``table_name``, ``fillers``,
    ``total_indicator`` and ``explanation``.
    """

    kind: str
    title: str
    file_name: str
    identifier: str
    period: str
    columns: Sequence[str]
    levels: Mapping[str, LevelFormat]
    table_name: Column | str = ""
    fixed: Mapping[str, str] = field(default_factory=dict)
    fillers: Sequence[str] = ("filler",)

    def level(self, name: str) -> LevelFormat:
        if name not in self.levels:
            raise ValueError(f"report {self.kind} has no level {name!r}")
        return self.levels[name]


def _value(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def union_all(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name, duplicates kept."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def header_union(header: DataFrame, body: DataFrame, order: str = LINE) -> DataFrame:
    """The header record ahead of the body: order 0, body from 1."""
    return header.unionByName(body).select(*[c for c in body.columns if c != order], order)


def report_header(
    body: DataFrame, report: ReportFormat, level: str, columns: Sequence[str], height: DataFrame | None = None
) -> DataFrame:
    """Header record: file type, body row count, file name, identifier, period, blanks to the width.

    ``height`` is the count as a one-row table; without it the body is counted.
    """
    if len(columns) < 5:
        raise ValueError("a report needs at least five columns to hold its header")
    at = report.level(level)
    names = {"short": at.short, "kind": report.kind, "period": report.period}
    values = [
        F.lit(f"{at.title} {report.title}"),
        F.col("__height").cast("string"),
        F.lit(report.file_name.format(**names)),
        F.lit(report.identifier.format(**names)),
        F.lit(report.period),
    ] + [F.lit("")] * (len(columns) - 5)
    counted = table_height(body, "__height") if height is None else height.toDF("__height")
    return counted.select(*[v.alias(c) for v, c in zip(values, columns)], F.lit(0).cast("bigint").alias(LINE))


def report_body(
    df: DataFrame,
    report: ReportFormat,
    level: str,
    order_by: Sequence[str] | None,
    total: str | Column | None = None,
) -> DataFrame:
    """Number the counts by their full key and add the fixed, derived and blank columns.

    Without ``order_by`` the counts have a ``file_record_number`` already.
    ``total`` says which records count everybody: a boolean column (see ``total_flag`` of the
    rollups), or nothing, which gives 'N' throughout.
    """
    at = report.level(level)
    numbered = df if order_by is None else record_number(df, order_by, "file_record_number")
    is_total = F.lit(False) if total is None else (F.col(total) if isinstance(total, str) else total)
    added = {
        **{c: F.lit(v) for c, v in report.fixed.items()},
        **{c: _value(v) for c, v in at.identifiers.items()},
        "table_name": _value(report.table_name),
        **{c: F.lit("") for c in report.fillers},
        "total_indicator": F.when(is_total, F.lit("Y")).otherwise(F.lit("N")),
        "explanation": F.lit(""),
    }
    return numbered.withColumns(added)


def build_report(
    df: DataFrame,
    report: ReportFormat,
    level: str,
    order_by: Sequence[str] | None,
    total: str | Column | None = None,
    height: DataFrame | None = None,
) -> DataFrame:
    """One report as text records; ``line_no`` is the publishing order (0 = header)."""
    body = report_body(df, report, level, order_by, total)
    chosen = body.select(*report.columns, F.col("file_record_number").alias(LINE))
    # Every published column becomes text; the order column stays a number.
    lines = cast_all_to_string(chosen).withColumn(LINE, F.col(LINE).cast("bigint"))
    return header_union(report_header(body, report, level, report.columns, height), lines)


def merged_order(orders: Sequence[Sequence[str]]) -> list[str]:
    """One order of all names that agrees with each of the orders; an error where two of them disagree."""
    left = [list(dict.fromkeys(order)) for order in orders]
    merged: list[str] = []
    while any(left):
        heads = [order[0] for order in left if order]
        free = next((h for h in heads if not any(h in order[1:] for order in left)), None)
        if free is None:
            raise ValueError(f"reports are ordered in conflicting ways: {heads}")
        merged.append(free)
        left = [[c for c in order if c != free] for order in left]
    return merged


def number_reports(
    tables: Mapping[str, Mapping[str, DataFrame]],
    entities: Mapping[str, str | None],
    order_by: Mapping[str, Sequence[str]],
) -> dict[tuple[str, str], tuple[DataFrame, DataFrame]]:
    """(kind, level) -> its numbered table and its height as a one-row table, from one pass over all of them.

    All tables are stacked, ordered by entity and the key of their kind, and numbered within kind and level.
    A column that a kind does not have is null in its rows and so without a say in their order. The heights
    are sums of the partition sizes that numbering needs anyway; a table without rows has the height 0.
    """
    order = merged_order(list(order_by.values()))
    stacked = None
    for kind, by_level in tables.items():
        for level, df in by_level.items():
            entity = entities[level]
            part = df.select(
                F.lit(kind).alias("__kind"),
                F.lit(level).alias("__level"),
                (F.col(entity).cast("string") if entity else F.lit("")).alias("__entity"),
                *[c for c in df.columns if c != entity],
            )
            stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    numbered, heights = number_groups(
        stacked, ["__entity", *order], "file_record_number", within=["__kind", "__level"], heights="__height"
    )
    out = {}
    for kind, by_level in tables.items():
        for level, df in by_level.items():
            here = (F.col("__kind") == kind) & (F.col("__level") == level)
            body = numbered.where(here).withColumnRenamed("__entity", entities[level] or "__entity")
            height = heights.where(here).agg(F.coalesce(F.sum("__height"), F.lit(0)).alias("__height"))
            out[kind, level] = body.select(*df.columns, "file_record_number"), height
    return out


def report_bundle(
    tables: Mapping[str, Mapping[str, DataFrame]],
    reports: Mapping[str, ReportFormat],
    entities: Mapping[str, str | None],
    order_by: Mapping[str, Sequence[str]],
    total: str | Column | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """All reports of a run, from kind -> level -> counts: (kind, level) -> text records."""
    unknown = set(tables) - set(reports)
    if unknown:
        raise ValueError(f"no report format for {sorted(unknown)}")
    return {
        (kind, level): build_report(df, reports[kind], level, None, total, height)
        for (kind, level), (df, height) in number_reports(tables, entities, order_by).items()
    }
