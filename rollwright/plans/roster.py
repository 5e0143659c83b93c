"""Roster matching: prepare, collect void sets, split into matched and unmatched, enrich the rest."""

from __future__ import annotations

import codecs
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwright.functions.columns import (
    add_constant_columns,
    assemble_date_text,
    case_map,
    compose_key,
    contains_class,
    id_normalise,
    nan_to_zero,
    override,
    starts_in,
    strip,
    valid_score,
    whole_number_text,
    zfill,
)
from rollwright.operators.dedupe import ascending, best_row_per_key, descending, distinct_keys, first_row_per_key
from rollwright.operators.joins import coalesce_key, full_outer_flags, left_enrich, left_then_require, replace_by_lookup
from rollwright.operators.report import union_all
from rollwright.session import materialise
from rollwright.sources.readers import SUFFIXES, Field, read_by_extension, suffix_of
from rollwright.sources.sinks import write_named_outputs


@dataclass(frozen=True)
class RosterColumns:
    """Names of the roster columns the jobs work on."""

    id: str = "person_id"
    grade: str = "grade"
    kind: str = "record_kind"
    district: str = "district_code"
    site_part: str = "site_part"
    site: str = "site_code"
    day: str = "birth_day"
    month: str = "birth_month"
    year: str = "birth_year"


@dataclass(frozen=True)
class RosterRules:
    """Codes that steer ``roster_prepare``."""

    grade: str
    other_grade: str
    drop_kind: str
    drop_site_part: str
    excluded_sites: Sequence[str] = ()
    site_width: int = 3
    day_width: int = 2
    # A site whose report code is this one belongs to this district (code and name).
    special_report_code: str | None = None
    special_district_name: str | None = None
    # Districts above this code (as text), but for the listed ones, are shown by their site.
    site_shown_above: str | None = None
    site_shown_except: Sequence[str] = ()
    # Test the raw, untrimmed kind and site part.
    filter_raw: bool = False


class PreparedRoster(NamedTuple):
    roster: DataFrame
    other_grade: DataFrame


def roster_prepare(
    roster: DataFrame,
    sites: DataFrame,
    retired: DataFrame,
    rules: RosterRules,
    cols: RosterColumns = RosterColumns(),
    site_columns: Mapping[str, str] | None = None,
    retired_columns: tuple[str, str, str | None] = ("retired_id", "active_id", None),
) -> PreparedRoster:
    """Clean an all-text roster, replace retired IDs, attach the site and name its district.

    ``site_columns`` maps site, district_name, site_name and report_code to the columns of ``sites``.
    The other grade leaves before the ID replacement, as it came.
    """
    at = {"site": "site_code", "district_name": "district_name", "site_name": "site_name", "report_code": "report_code"}
    at |= site_columns or {}
    wanted = (F.col("__kind") != rules.drop_kind) & (F.col("__part") != rules.drop_site_part)
    test = (lambda c: F.col(c)) if rules.filter_raw else strip
    cleaned = (
        roster.withColumns({"__kind": test(cols.kind), "__part": test(cols.site_part)})
        .where(wanted)
        .drop("__kind", "__part")
        .withColumns(
            {
                cols.grade: strip(cols.grade),
                cols.kind: strip(cols.kind),
                cols.site_part: strip(cols.site_part),
                cols.site: compose_key(strip(cols.district), zfill(strip(cols.site_part), rules.site_width)),
            }
        )
    )
    other = cleaned.where(F.col(cols.grade) == rules.other_grade)
    main = (
        cleaned.where(F.col(cols.grade) == rules.grade)
        .withColumns({cols.id: id_normalise(cols.id), cols.day: zfill(cols.day, rules.day_width)})
    )
    old, new, order = retired_columns
    main = replace_by_lookup(main, cols.id, retired, old, new, order)
    if rules.excluded_sites:
        main = main.where(~F.col(cols.site).isin(*rules.excluded_sites))
    # What the site list says about a site holds, whatever the roster has under the same names.
    told = [at[c] for c in ("district_name", "site_name", "report_code") if at[c] != cols.site]
    placed = left_enrich(main.drop(*[c for c in told if c not in vars(cols).values()]), sites, {cols.site: at["site"]})
    return PreparedRoster(name_districts(placed, rules, cols, at), other)


def name_districts(df: DataFrame, rules: RosterRules, cols: RosterColumns, at: Mapping[str, str]) -> DataFrame:
    """District code and name after both overrides, and their joint label."""
    code, name = cols.district, at["district_name"]
    if rules.special_report_code is not None:
        special = F.col(at["report_code"]) == rules.special_report_code
        df = df.withColumns(
            {
                code: override(code, special, rules.special_report_code),
                name: override(name, special, rules.special_district_name),
            }
        )
    if rules.site_shown_above is not None:
        by_site = F.col(code) > rules.site_shown_above
        if rules.site_shown_except:
            by_site = by_site & ~F.col(code).isin(*rules.site_shown_except)
        df = df.withColumns(
            {code: override(code, by_site, F.col(cols.site)), name: override(name, by_site, F.col(at["site_name"]))}
        )
    return df.withColumn("district_code_name", compose_key(code, name, sep="_"))


@dataclass(frozen=True)
class VoidFile:
    """One main file with its ID map."""

    main: DataFrame
    id_map: DataFrame
    row_id: str = "row_id"
    map_row_id: str = "record_id"
    mapped_id: str = "person_id"
    alternative_id: str = "own_id"
    status: str = "status"


def void_rows(
    file: VoidFile, void_codes: Sequence[str], id_column: str = "person_id", beside: Mapping[str, Column] | None = None
) -> DataFrame:
    """The voided rows of one file with their ID: the mapped one, else the row's own. ``beside`` adds columns."""
    renamed = file.id_map.select(
        F.col(file.map_row_id).alias("__map_row"), F.col(file.mapped_id).alias("__mapped")
    )
    keyed = file.main.withColumn("__row", id_normalise(file.row_id)).where(F.col(file.status).isin(*void_codes))
    joined = keyed.join(renamed, F.col("__row") == F.col("__map_row"), "left")
    chosen = id_normalise(coalesce_key("__mapped", file.alternative_id))
    return joined.select(chosen.alias(id_column), *[value.alias(name) for name, value in (beside or {}).items()])


def void_ids(file: VoidFile, void_codes: Sequence[str], id_column: str = "person_id") -> DataFrame:
    """IDs of the voided rows of one file."""
    return void_rows(file, void_codes, id_column)


def void_sets(files: Sequence[VoidFile], void_codes: Sequence[str], id_column: str = "person_id") -> DataFrame:
    """One row for each voided ID with a true / null column ``Voided_1`` .. ``Voided_n``."""
    sets = {f"Voided_{i}": void_ids(f, void_codes, id_column) for i, f in enumerate(files, 1)}
    return full_outer_flags(sets, id_column)


def read_void_files(
    spark: SparkSession,
    main_paths: Sequence[str],
    map_paths: Sequence[str],
    extra: Sequence[Mapping[str, str] | None],
    fields: Sequence[Field],
    map_schema: str | None = None,
) -> list[VoidFile]:
    """Open the file pairs of a setting, each by its suffix; the three lists must agree in length."""
    if not len(main_paths) == len(map_paths) == len(extra):
        raise ValueError("main files, ID maps and extra arguments differ in number")
    return [
        VoidFile(
            read_by_extension(spark, main, fields), read_by_extension(spark, ids, schema=map_schema), **(more or {})
        )
        for main, ids, more in zip(main_paths, map_paths, extra)
    ]


@dataclass(frozen=True)
class FileSource:
    """A file to open by its suffix, and how: fixed-width fields, CSV schema, encoding, padding, record length."""

    path: str
    fields: Sequence[Field] | None = None
    schema: str | None = None
    encoding: str = "UTF-8"
    pad: str | None = "start"
    width: int | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return read_by_extension(spark, self.path, self.fields, self.schema, self.encoding, self.pad, self.width)


@dataclass(frozen=True)
class VoidSource:
    """One pair of a manifest: main file, ID map, the names of their columns, and what its codes mean.

    ``reasons`` says for each code that voids a row why it does; other codes void nothing.
    """

    name: str
    main: FileSource
    id_map: FileSource
    reasons: Mapping[str, str]
    row_id: str = "row_id"
    map_row_id: str = "record_id"
    mapped_id: str = "person_id"
    alternative_id: str = "own_id"
    status: str = "status"


def _file_problems(spark: SparkSession, source: FileSource, needed: Sequence[str], of: str) -> list[str]:
    """What is wrong with a file as far as its name, its place and its declared or stored schema tell."""
    suffix = suffix_of(source.path)
    if suffix not in SUFFIXES:
        return [f"{of}: no reader for {source.path}"]
    try:
        # A listing: no content is read.
        spark.read.format("binaryFile").load(source.path)
    except AnalysisException:
        return [f"{of}: nothing at {source.path}"]
    if suffix == ".txt" and not source.fields:
        return [f"{of}: a fixed-width file needs its fields"]
    if suffix == ".csv" and not source.schema:
        return [f"{of}: a CSV file needs its schema"]
    problems = []
    if suffix == ".txt":
        names = [f.name for f in source.fields]
        ends = [f.start + f.length - 1 for f in source.fields]
        if source.width is not None and max(ends) > source.width:
            problems.append(f"{of}: fields end at {max(ends)}, beyond the record length {source.width}")
        try:
            codecs.lookup(source.encoding)
        except LookupError:
            problems.append(f"{of}: unknown encoding {source.encoding}")
    elif suffix == ".csv":
        names = T.StructType.fromDDL(source.schema).fieldNames()
    else:
        names = spark.read.parquet(source.path).columns
    missing = [c for c in needed if c not in names]
    return problems + ([f"{of}: no column {', '.join(missing)}"] if missing else [])


def check_manifest(spark: SparkSession, manifest: Sequence[VoidSource]) -> None:
    """Raise one error that names every fault of a manifest, before any content is read."""
    problems = []
    names = [source.name for source in manifest]
    problems += [f"{name}: listed twice" for name in dict.fromkeys(names) if names.count(name) > 1]
    if not manifest:
        problems.append("no files")
    for source in manifest:
        if not source.reasons:
            problems.append(f"{source.name}: no code voids a row")
        main = [source.row_id, source.alternative_id, source.status]
        problems += _file_problems(spark, source.main, main, f"{source.name} main file")
        problems += _file_problems(spark, source.id_map, [source.map_row_id, source.mapped_id], f"{source.name} ID map")
    if problems:
        raise ValueError("; ".join(problems))


def void_sets_from_files(spark: SparkSession, manifest: Sequence[VoidSource], id_column: str = "person_id") -> DataFrame:
    """One row for each voided ID: ``Voided_1`` .. ``Voided_n`` (true / null) and ``reasons``, sorted, joined by '; '.

    Each pair may have formats, layouts and encodings of its own; the whole manifest is checked first. Pairs are
    stacked and gathered once by ID, so a pair more costs no join more. A reason names its pair.
    """
    check_manifest(spark, manifest)
    stacked = []
    for i, source in enumerate(manifest, 1):
        main = source.main.read(spark)
        # A blank field is no ID.
        main = main.withColumns({c: F.nullif(strip(c), F.lit("")) for c in (source.row_id, source.alternative_id) if main.schema[c].dataType == T.StringType()})
        file = VoidFile(
            main, source.id_map.read(spark), source.row_id, source.map_row_id, source.mapped_id,
            source.alternative_id, source.status,
        )
        why = case_map(source.status, {code: f"{source.name}: {reason}" for code, reason in source.reasons.items()})
        stacked.append(
            void_rows(file, list(source.reasons), id_column, {"__why": why}).withColumn("__file", F.lit(i))
        )
    found = union_all(*stacked).where(F.col(id_column).isNotNull())
    return found.groupBy(id_column).agg(
        *[F.max(F.when(F.col("__file") == i, F.lit(True))).alias(f"Voided_{i}") for i in range(1, len(manifest) + 1)],
        F.array_join(F.array_sort(F.collect_set("__why")), "; ").alias("reasons"),
    )


class MatchResult(NamedTuple):
    matched: DataFrame
    unmatched: DataFrame
    # The whole roster with ``if_matched`` Y / N.
    flagged: DataFrame


@dataclass(frozen=True)
class History:
    """Score history and how the best record of a person is chosen."""

    table: DataFrame
    id: str
    score: str
    source: str
    # Ranking columns, highest first, nulls first; may name ``priority``.
    rank_by: Sequence[str]
    # Columns of any type, lowest first, that tell equally ranked records apart.
    tiebreak: Sequence[str] = ()
    # (part of the source name, priority), first hit counts.
    priorities: Sequence[tuple[str, int]] = ()
    # Keep one record for each value of this column instead of the ID (rows may then multiply).
    dedupe_key: str | None = None


def history_prepare(
    table: DataFrame,
    id_column: str,
    retired: DataFrame,
    retired_columns: tuple[str, str, str | None] = ("retired_id", "active_id", None),
) -> DataFrame:
    """Score history under current IDs (bigint)."""
    old, new, order = retired_columns
    return replace_by_lookup(table.withColumn(id_column, id_normalise(id_column)), id_column, retired, old, new, order)


def _ranked(history: History) -> DataFrame:
    df = history.table
    if history.priorities:
        df = df.withColumn("priority", contains_class(history.source, history.priorities))
    return df.withColumns({"__valid": valid_score(history.score), history.score: nan_to_zero(history.score)})


def id_profile(history: History, voids: DataFrame, void_id: str) -> DataFrame:
    """One row for each known ID: in the history with a valid score, voided, best score.

    The best record with and the best without a valid score are kept first, so a task sends at most two
    rows of an ID. Membership and the best score are then read off these and the void set, over a struct
    of the ID, so that the roster join can be split at hot IDs (see ``operators.dedupe``).
    """
    ranks = [f"__rank_{i}" for i, _ in enumerate(history.rank_by)]
    ties = [f"__tie_{i}" for i, _ in enumerate(history.tiebreak)]
    ranked = _ranked(history).select(
        F.col(history.id).cast("bigint").alias("__id"),
        F.col("__valid").alias("__history"),
        F.col(history.score).alias("__score"),
        *[F.col(c).alias(n) for c, n in zip(history.rank_by, ranks)],
        *[F.col(c).alias(n) for c, n in zip(history.tiebreak, ties)],
    )
    best = best_row_per_key(ranked.where(F.col("__id").isNotNull()), ["__id", "__history"], ranks, ties)
    voided = distinct_keys(voids.select(F.col(void_id).cast("bigint").alias("__id")), "__id")
    both = best.withColumn("__void", F.lit(False)).unionByName(voided.withColumn("__void", F.lit(True)), allowMissingColumns=True)
    person = Window.partitionBy(F.struct("__id"))
    order = person.orderBy("__void", *descending(*ranks), *ascending(*ties))
    return (
        both.select(
            "__id",
            F.coalesce(F.bool_or("__history").over(person), F.lit(False)).alias("__history"),
            F.bool_or("__void").over(person).alias("__void"),
            "__score",
            F.row_number().over(order).alias("__first"),
        )
        .where("__first = 1")
        .drop("__first")
    )


def match_split(
    roster: DataFrame,
    history: History,
    voids: DataFrame,
    keep: Sequence[str],
    id_column: str = "person_id",
    void_id: str = "person_id",
    names: Mapping[str, str] | None = None,
    write_once: bool = False,
) -> MatchResult:
    """Split a roster against the history and the void set.

    Matched: the ID has a valid score in the history or is voided; the row gets its best score and
    ``district_pay`` 'Y' where only the void set knows the ID. Unmatched: the ID is in neither. A
    null ID is in neither output, but is flagged 'N'.

    The roster is joined once, to ``id_profile``; all three outputs are filters over that join.
    ``write_once`` writes the join to the scratch folder, for callers who use more than one output.
    """
    profile = id_profile(history, voids, void_id)
    joined = roster.join(profile, roster[id_column] == profile["__id"], "left").drop("__id")
    if write_once:
        joined = materialise(joined, "matched-roster")
    in_history = F.coalesce("__history", F.lit(False))
    in_void = F.coalesce("__void", F.lit(False))
    found = in_history | in_void
    helpers = ["__history", "__void", "__score"]
    chosen = [*keep] if id_column in keep else [*keep, id_column]

    matched = joined.where(found)
    if history.dedupe_key and history.dedupe_key != history.id:
        # Best record by another column: the join on the ID may find several of them.
        best = best_row_per_key(_ranked(history), [history.dedupe_key], history.rank_by, history.tiebreak)
        scores = best.select(F.col(history.id).cast("bigint").alias("__id"), F.col(history.score).alias("__best"))
        matched = matched.join(scores, matched[id_column] == scores["__id"], "left").drop("__id", "__score")
        matched = matched.withColumnRenamed("__best", "__score")
    id_text = F.col(id_column).cast("string").alias(id_column)
    out = [id_text if c == id_column else F.col(c) for c in chosen]
    matched = matched.select(
        *out,
        whole_number_text("__score").alias("score_composite"),
        F.when(in_void & ~in_history, F.lit("Y")).alias("district_pay"),
    )
    unmatched = joined.where(F.col(id_column).isNotNull() & ~found).select(*out)
    flagged = joined.withColumn("if_matched", F.when(found, F.lit("Y")).otherwise(F.lit("N"))).drop(*helpers)
    names = dict(names or {})
    return MatchResult(matched.withColumnsRenamed(names), unmatched.withColumnsRenamed(names), flagged)


def publish_match(result: MatchResult, directory: str, fmt: str = "csv") -> dict[str, str]:
    """Write the unmatched and the matched people as two named tables."""
    return write_named_outputs({"NO_MATCH": result.unmatched, "MATCH": result.matched}, directory, fmt)


@dataclass(frozen=True)
class EnrichRules:
    """Settings of ``unmatched_enrich``."""

    keep: Sequence[str]
    final: Sequence[str]
    excluded_sites: Sequence[str] = ()
    # First characters of a site code that cannot opt in, and the flag values.
    no_opt_in_firsts: Sequence[str] = ("5", "6", "7", "8", "9")
    opt_in_flag: str = "opt_in"
    no_opt_in: str = "X"
    opt_in: str = "Y"
    birth_date: str = "birth_date"
    sentinel_year: str = "1900"
    null_columns: Sequence[str] = ()
    fixed_columns: Mapping[str, Any] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    text_columns: Sequence[str] = ()


def clean_crosswalk(
    crosswalk: DataFrame,
    site_map: DataFrame,
    excluded_sites: Sequence[str],
    site: str,
    organization: str,
    parent: str,
    site_map_columns: tuple[str, str, str | None] = ("old_site", "new_site", None),
) -> DataFrame:
    """Crosswalk under current site codes, without the excluded ones, one row for each site."""
    old, new, order = site_map_columns
    current = replace_by_lookup(crosswalk, site, site_map, old, new, order)
    if excluded_sites:
        current = current.where(~F.col(site).isin(*excluded_sites))
    return first_row_per_key(current, [site], [organization, site, parent])


def unmatched_enrich(
    flagged: DataFrame,
    other_grade: DataFrame,
    crosswalk: DataFrame,
    rules: EnrichRules,
    cols: RosterColumns = RosterColumns(),
    crosswalk_site: str = "site_code",
    organization: str = "organization",
) -> DataFrame:
    """Unmatched people and the other grade, with their organization and the columns to publish.

    ``crosswalk`` holds one row for each site (``clean_crosswalk``); people without an organization
    are left out.
    """
    people = union_all(
        flagged.where(F.col("if_matched") != "Y").select(*rules.keep),
        other_grade.select(*rules.keep).withColumn(cols.id, id_normalise(cols.id)),
    )
    placed = left_then_require(people, crosswalk, {cols.site: crosswalk_site}, organization)
    no_opt_in = starts_in(cols.site, rules.no_opt_in_firsts)
    derived = placed.withColumns(
        {
            rules.opt_in_flag: F.when(no_opt_in, F.lit(rules.no_opt_in)).otherwise(F.lit(rules.opt_in)),
            rules.birth_date: assemble_date_text(cols.month, cols.day, cols.year, rules.sentinel_year),
        }
    )
    filled = add_constant_columns(derived, rules.null_columns, rules.fixed_columns)
    out = filled.withColumnsRenamed(dict(rules.names)).select(*rules.final)
    return out.withColumns({c: F.col(c).cast("string") for c in rules.text_columns}) if rules.text_columns else out
