"""Page records: text of page regions -> one clean row for each page."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollwright.functions.columns import conditional_null, strip
from rollwright.functions.text import (
    cut_at_marker,
    extract_labelled_fields,
    parse_date_parts,
    replace_chain,
    split_name,
    split_to_columns,
    with_fixed_matches,
)
from rollwright.operators.regions import Rect, region_text
from rollwright.session import materialise
from rollwright.sources.readers import scan_files
from rollwright.sources.sinks import write_parquet_and_csv

# What the pages print. Each can be replaced through ``PageLayout``.
PERCENT_PATTERN = r"(≥?≤?\d+%|NR|N/A)"
PERCENT_OF = ("School", "School_System", "State")
LABELS = {
    "Grade": r"Grade: (.*?)\n",
    "Report_Date": r"Report Date: (.*?)\n",
    "LASID": r"LASID: (.*?)\n",
    "School": r"School: (.*?)\n",
    "School_System": r"School System: (.*?)(?:\n|$)",
    "DoB": r"Date of Birth: (.*?)\n",
}
NAME_PATTERN = r"Student: (.*)\n"
NAME_CUT = "Grade:"
DATE_PLACEHOLDER = "--/--/----"
DATE_FORMAT = "MM/dd/yyyy"
VOID_MARK = "*"
GLYPHS = "«««"
STATE_SHARES = ("Strong", "Moderate", "Weak")
VOID_COLUMN = "If_Voided"
NAME_COLUMNS = ("Student_Name", "Student_First_Name", "Student_Middle_Initial", "Student_Last_Name")
DATE_PREFIX = "Summarized_DOB_"
PERCENT_COLUMN = "{}_{}_Percentage"
SHARE_COLUMN = "{}_State_Percentage_{}"
SCORE_COLUMN = "Scale_Score_{}"


@dataclass(frozen=True)
class PageLayout:
    """Which region feeds which column.

    ``trimmed`` regions get the listed literal replacements, then a trim. ``details`` are taken as
    they stand and blanked on voided pages; of these, ``cleaned`` lose glyphs and line ends, and
    ``shares`` (column -> region) are cut into strong / moderate / weak.
    """

    title_region: str
    title_columns: Sequence[str]
    info_region: str
    score_region: str
    levels: Sequence[str] = ()
    level_region: str = "Percent_Achievement_Level_{}"
    trimmed: Mapping[str, Sequence[tuple[str, str]]] = field(default_factory=dict)
    details: Sequence[str] = ()
    cleaned: Sequence[str] = ()
    shares: Mapping[str, str] = field(default_factory=dict)
    labels: Mapping[str, str] = field(default_factory=lambda: dict(LABELS))
    name_pattern: str = NAME_PATTERN
    date_label: str = "DoB"
    # Columns to split into code and name: column -> (code column, name column).
    code_and_name: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)


def extract_pages(pages: DataFrame, layout: PageLayout) -> DataFrame:
    """Raw page record from region texts: percentages, title parts, scores, void flag, details."""
    df = pages
    for level in layout.levels:
        names = [PERCENT_COLUMN.format(level, of) for of in PERCENT_OF]
        region = layout.level_region.format(level)
        df = with_fixed_matches(df, region, PERCENT_PATTERN, names, f"{level}_Mismatch").drop(region)
    df = df.withColumnRenamed(layout.title_region, "__title")
    df = df.select("*", *split_to_columns("__title", "\n", layout.title_columns, exact=True)).drop("__title")
    trims = {layout.info_region: (), **layout.trimmed}
    df = df.withColumns({c: F.nullif(replace_chain(c, pairs), F.lit("")) for c, pairs in trims.items()})
    voided = F.coalesce(F.col(layout.score_region) == VOID_MARK, F.lit(False))
    return conditional_null(df.withColumn(VOID_COLUMN, voided), layout.details, ~F.col(VOID_COLUMN))


def clean_pages(records: DataFrame, layout: PageLayout) -> DataFrame:
    """Fields out of the information block, name and date parts, cleaned texts and shares."""
    info = F.col(layout.info_region)
    df = records.withColumn(
        NAME_COLUMNS[0],
        F.nullif(
            strip(cut_at_marker(extract_labelled_fields(info, {"n": layout.name_pattern}, trim=False)[0], NAME_CUT)),
            F.lit(""),
        ),
    )
    df = df.select("*", *extract_labelled_fields(info, layout.labels))
    df = df.withColumns({c: replace_chain(c, [(GLYPHS, ""), ("\n", " ")], trim=False) for c in layout.cleaned})
    for column, region in layout.shares.items():
        shares = [SHARE_COLUMN.format(column, s) for s in STATE_SHARES]
        df = df.select("*", *split_to_columns(strip(region), "\n", shares))
    df = df.select(
        "*",
        *split_name(*NAME_COLUMNS),
        *parse_date_parts(layout.date_label, DATE_PREFIX, [DATE_PLACEHOLDER], DATE_FORMAT),
    )
    for column, names in layout.code_and_name.items():
        df = df.select("*", *split_to_columns(column, " ", list(names), rest_in_last=True)).drop(column)
    return df.drop(*layout.shares.values(), layout.date_label).withColumnsRenamed(dict(layout.names))


def page_records(
    words: DataFrame,
    regions: Mapping[str, Rect],
    layout: PageLayout,
    page: Sequence[str] = ("doc", "page"),
    template: str | None = None,
) -> DataFrame:
    """Word boxes -> region texts -> clean page records."""
    return clean_pages(extract_pages(region_text(words, regions, page, template), layout), layout)


def page_mismatches(records: DataFrame, layout: PageLayout, page: Sequence[str] = ("doc", "page")) -> DataFrame:
    """Side output: (page, level) whose region did not hold exactly one percentage for each body."""
    flags = F.array_compact(
        F.array(*[F.when(F.col(f"{level}_Mismatch"), F.lit(level)) for level in layout.levels])
    )
    return records.select(*page, F.explode(flags).alias("level"))


# -- the whole job: files to published records ----------------------------------------------------


class SeveralSubjects(ValueError):
    """The pages of one run must be about one subject: it names a column."""


@dataclass(frozen=True)
class PageFiles:
    """Text files of word boxes, a box a line: which files, and the columns of a line in order.

    The columns name at least ``page``, the four edges of the box and ``word``, which comes last and may hold the
    separator. A ``doc`` that is no column of the line is the file's name.
    """

    directory: str
    suffix: str
    any_of: Sequence[str] = ()
    required: str = ""
    columns: Sequence[str] = ("page", "x0", "y0", "x1", "y1", "word")
    separator: str = "\t"


@dataclass(frozen=True)
class PageJob:
    """Settings of ``page_job``. ``subject_column`` is one of the layout's title columns."""

    files: PageFiles
    regions: Mapping[str, Rect] | Mapping[str, Mapping[str, Rect]]
    layout: PageLayout
    subject_column: str
    subject_names: Mapping[str, str] = field(default_factory=dict)
    score_template: str = SCORE_COLUMN
    template: str | None = None


class PageResult(NamedTuple):
    records: DataFrame
    # (page, level) of regions that do not hold exactly one percentage for each body.
    mismatches: DataFrame
    subject: str | None
    parquet_path: str
    csv_path: str


def read_word_boxes(spark: SparkSession, files: PageFiles) -> DataFrame:
    """Word boxes out of the scanned files. A line with too few columns or no number for an edge is left out."""
    lines = scan_files(spark, files.directory, files.suffix, files.any_of, files.required)
    n = len(files.columns)
    # Exploded, the cut line is a column of its own: otherwise each condition on a part would cut it again.
    lines = lines.withColumn("__parts", F.explode(F.array(F.split("line", re.escape(files.separator), n))))
    at = {c: F.get("__parts", F.lit(i)) for i, c in enumerate(files.columns)}
    edges = {c: at[c].try_cast("double") for c in ("x0", "y0", "x1", "y1")}
    boxes = lines.where(F.size("__parts") == n).select(
        at.get("doc", F.col("file_name")).alias("doc"),
        *[at[c].alias(c) for c in files.columns if c not in {"doc", "page", "word", *edges}],
        at["page"].try_cast("int").alias("page"),
        *[v.alias(c) for c, v in edges.items()],
        at["word"].alias("word"),
    )
    return boxes.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("page", *edges)]))


def one_subject(records: DataFrame, column: str, page: Sequence[str] = ("doc", "page")) -> str | None:
    """The one value that the pages have in this column, None if none has any; several stop the job.

    The error names the values, at most ten of them, each with its first page and how many it has.
    """
    found = (
        records.where(F.col(column).isNotNull()).groupBy(column)
        .agg(F.min(F.struct(*page)).alias("first"), F.count("*").alias("n")).orderBy(column).limit(10).collect()
    )
    if len(found) > 1:
        said = [f"{r[column]!r} on {r['n']} pages, first {', '.join(map(str, r['first']))}" for r in found]
        raise SeveralSubjects(f"more than one {column}: {'; '.join(said)}")
    return found[0][column] if found else None


def page_job(spark: SparkSession, job: PageJob, directory: str, name: str = "pages") -> PageResult:
    """From scanned files of word boxes to records published as Parquet and as CSV under ``directory``.

    Two phases, as the schema depends on the data. The first cuts the regions out of the pages and writes the raw
    records, once. The subject is then read off one column of those; it must be the same on all pages and
    becomes part of the score column's name. The second phase cleans the written records and publishes them.
    """
    words = read_word_boxes(spark, job.files)
    layout = job.layout
    raw = materialise(extract_pages(region_text(words, job.regions, template=job.template), layout), "raw-pages")
    subject = one_subject(raw, job.subject_column)
    if subject is not None:
        score = job.score_template.format(job.subject_names.get(subject, subject))
        layout = replace(layout, names={**layout.names, layout.score_region: score})
    paths = f"{directory.rstrip('/')}/{name}.parquet", f"{directory.rstrip('/')}/{name}.csv"
    write_parquet_and_csv(clean_pages(raw, layout), *paths)
    return PageResult(spark.read.parquet(paths[0]), page_mismatches(raw, layout), subject, *paths)
