"""Columns out of labelled, separated or patterned text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollwright.functions.columns import ColumnLike, as_column, null_if_placeholder, strip


def _literal(separator: str) -> str:
    """``split`` takes a pattern; quote the separator so that it stands for itself."""
    return rf"\Q{separator}\E"


def extract_labelled_fields(
    c: ColumnLike, patterns: Mapping[str, str], empty_as_null: bool = True, trim: bool = True
) -> list[Column]:
    """One column for each name -> pattern (group 1). Null text stays null.

    ``regexp_extract`` gives '' for no match; ``empty_as_null`` turns that into null.
    """
    out = []
    for name, pattern in patterns.items():
        value = F.regexp_extract(as_column(c), pattern, 1)
        value = strip(value) if trim else value
        out.append((F.nullif(value, F.lit("")) if empty_as_null else value).alias(name))
    return out


def cut_at_marker(c: ColumnLike, marker: str) -> Column:
    """Text before the first marker; all of it when the marker is absent."""
    return F.substring_index(as_column(c), marker, 1)


def replace_chain(c: ColumnLike, pairs: Sequence[tuple[str, str]], trim: bool = True) -> Column:
    """Literal replacements in the given order, then trim."""
    out = as_column(c)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return strip(out) if trim else out


def split_to_columns(
    c: ColumnLike, sep: str, names: Sequence[str], rest_in_last: bool = False, exact: bool = False
) -> list[Column]:
    """Split into named columns; a missing piece is null.

    ``rest_in_last`` keeps the unsplit remainder in the last column. ``exact`` gives nulls throughout
    unless there are exactly as many pieces as names.
    """
    parts = F.split(as_column(c), _literal(sep), len(names) if rest_in_last else -1)
    pieces = [F.get(parts, F.lit(i)) for i in range(len(names))]
    if exact:
        pieces = [F.when(F.size(parts) == len(names), p) for p in pieces]
    return [p.alias(n) for p, n in zip(pieces, names)]


def split_name(c: ColumnLike, first: str = "first", middle: str = "middle", last: str = "last") -> list[Column]:
    """First and last token, and whatever stands between them; one token is both first and last."""
    tokens = F.split(as_column(c), " ")
    between = F.when(
        F.size(tokens) > 2,
        F.array_join(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0))), " "),
    )
    return [
        F.get(tokens, F.lit(0)).alias(first),
        F.nullif(strip(between), F.lit("")).alias(middle),
        F.element_at(tokens, -1).alias(last),
    ]


def with_fixed_matches(
    df: DataFrame, column: str, pattern: str, names: Sequence[str], mismatch: str | None = None
) -> DataFrame:
    """All matches of group 1; exactly as many as names fill the columns, otherwise nulls.

    ``mismatch`` names a boolean column that tells the rows (with their source) that did not fit.
    """
    # A column of its own: the matches are then searched once for each row, not once for each name.
    found = F.regexp_extract_all(F.col(f"`{column}`"), F.lit(pattern), F.lit(1))
    fits = F.coalesce(F.size("__found") == len(names), F.lit(False))
    added = {n: F.when(fits, F.get("__found", F.lit(i))) for i, n in enumerate(names)}
    if mismatch:
        added[mismatch] = ~fits
    return df.withColumn("__found", found).withColumns(added).drop("__found")


def parse_date(c: ColumnLike, placeholders: Sequence[str] = (), fmt: str = "MM/dd/yyyy") -> Column:
    """Date from text; a placeholder or an impossible date is null."""
    c = as_column(c)
    return F.try_to_date(null_if_placeholder(c, *placeholders) if placeholders else c, fmt)


def parse_date_parts(
    c: ColumnLike, prefix: str, placeholders: Sequence[str] = (), fmt: str = "MM/dd/yyyy"
) -> list[Column]:
    """Day, month and year of a date given as text."""
    date = parse_date(c, placeholders, fmt)
    return [
        F.dayofmonth(date).alias(f"{prefix}Day"),
        F.month(date).alias(f"{prefix}Month"),
        F.year(date).alias(f"{prefix}Year"),
    ]
