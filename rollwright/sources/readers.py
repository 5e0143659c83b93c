"""Text, delimited and columnar inputs. Parsers take a table of lines, so readers only wrap them."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollwright.functions.columns import strip
from rollwright.operators.numbering import record_number, running_total
from rollwright.session import materialise

LINE = "line"
SUFFIXES = (".csv", ".parquet", ".txt")


class UnsupportedFileType(TypeError):
    """The file suffix has no reader."""


@dataclass(frozen=True)
class Field:
    """One fixed-width column: 1-based start, length, name, Spark type."""

    start: int
    length: int
    name: str
    dtype: str = "string"


def read_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines as one text column, blank ones and control characters kept.

    The text source cuts at line ends and keeps bytes as they are, so any encoding whose line end is one
    byte is decoded afterwards.
    """
    lines = spark.read.text(path)
    if encoding.upper().replace("_", "-") in ("UTF-8", "UTF8"):
        return lines.withColumnRenamed("value", LINE)
    return lines.select(F.decode(F.col("value").cast("binary"), encoding).alias(LINE))


def _cast(value: Column, dtype: str) -> Column:
    return value if dtype == "string" else strip(value).cast(dtype)


def parse_fixed_width(
    lines: DataFrame,
    fields: Sequence[Field],
    pad: str | None = "start",
    line: str = LINE,
    width: int | None = None,
) -> DataFrame:
    """Lines -> columns by position.

    ``pad`` brings short lines to the longest length of the table: ``"start"`` (the default, as such
    files lose leading blanks), ``"end"`` or None. The length is a one-row subquery, and so another
    pass over the lines; a known record length given as ``width`` saves it.
    """
    text = F.col(line)
    if pad in ("start", "end"):
        longest = F.lit(width) if width else lines.agg(F.max(F.length(text))).scalar()
        padded = (F.lpad if pad == "start" else F.rpad)(text, longest, F.lit(" "))
        text = F.when(F.length(text) < longest, padded).otherwise(text)  # a longer line is never cut
    elif pad is not None:
        raise ValueError(f"pad must be start, end or None, not {pad!r}")
    return lines.select(
        *[_cast(F.substring(text, f.start, f.length), f.dtype).alias(f.name) for f in fields]
    )


def read_fixed_width(
    spark: SparkSession,
    path: str,
    fields: Sequence[Field],
    pad: str | None = "start",
    encoding: str = "UTF-8",
    width: int | None = None,
) -> DataFrame:
    return parse_fixed_width(read_lines(spark, path, encoding), fields, pad, width=width)


def parse_slices(lines: DataFrame, slices: Mapping[str, tuple[int, int]], line: str = LINE) -> DataFrame:
    """Lines -> columns by 0-based half-open slices, trimmed."""
    return lines.select(
        *[strip(F.substring(F.col(line), lo + 1, hi - lo)).alias(n) for n, (lo, hi) in slices.items()]
    )


def dash_fields(header: str, dashes: str, dtypes: Mapping[str, str] | None = None) -> list[Field]:
    """Fields from a name line and a line of dash runs: each run rules one column, blanks part them."""
    spans = [run.span() for run in re.finditer(r"\S+", dashes)]
    names = [header[slice(*span)].strip() for span in spans]
    types = dtypes or {}
    return [Field(lo + 1, hi - lo, name, types.get(name, "string")) for (lo, hi), name in zip(spans, names, strict=True)]


def ruled_columns(header: str = "header", dashes: str = "dashes") -> Column:
    """The same as an expression: an array of (name, start, length), one for each dash run of a row."""
    at = F.sequence(F.lit(1), F.greatest(F.length(dashes), F.lit(1)))
    dash = lambda i: F.substring(F.concat(F.lit(" "), F.col(dashes), F.lit(" ")), i + 1, F.lit(1)) != " "
    starts = F.filter(at, lambda i: dash(i) & ~dash(i - 1))
    ends = F.filter(at, lambda i: dash(i) & ~dash(i + 1))
    return F.zip_with(starts, ends, lambda lo, hi: F.struct(
        strip(F.substring(F.col(header), lo, hi - lo + 1)).alias("name"), lo.alias("start"), (hi - lo + 1).alias("length")
    ))


def read_dash_ruled(
    spark: SparkSession, path: str | Sequence[str], dtypes: Mapping[str, str] | None = None, file_column: str | None = None
) -> DataFrame:
    """Fixed-width files that rule their own columns: names in line 1, dash runs in line 2 of each file.

    Every file is read by its own ruling; files of one read may differ in widths, in the order of their columns and
    in the columns they have (null where a file has none). The rulings are found in Spark, a row for each file, and
    joined to the lines; the first two lines go by their place, so a body line may look like them. Only the column
    names reach the driver, in the order in which the first file (by name) has them, then those of others. Values
    are trimmed; ``dtypes`` gives other types than text, ``file_column`` adds the file's path.
    """
    # Positions rise one by one inside a block, and a file's first block starts at 0.
    lines = spark.read.text(path).select(
        F.col("value").alias(LINE), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__position"),
    )
    first = lines.where("__block = 0").groupBy("__file").agg(F.min("__position").alias("__first"))
    placed = lines.join(first, "__file").withColumn("__row", F.when(F.col("__block") == 0, F.col("__position") - F.col("__first")).otherwise(F.lit(2)))
    rulings = materialise(
        placed.where("__row < 2").groupBy("__file").agg(
            F.max(F.when(F.col("__row") == 0, F.col(LINE))).alias("header"), F.coalesce(F.max(F.when(F.col("__row") == 1, F.col(LINE))), F.lit("")).alias("dashes")
        ).select(F.col("__file").alias("__of"), ruled_columns().alias("__ruling")), "rulings",
    )
    named = rulings.select(F.col("__of"), F.posexplode("__ruling").alias("place", "column"))
    order = named.groupBy("column.name").agg(F.min(F.struct("__of", "place")).alias("at")).orderBy("at")
    names = [r["name"] for r in order.collect()]
    types = dtypes or {}
    body = placed.where("__row >= 2").join(rulings, F.col("__file") == F.col("__of"))

    def value(name: str) -> Column:
        rule = F.get(F.filter("__ruling", lambda r: r["name"] == name), F.lit(0))
        return _cast(strip(F.substring(F.col(LINE), rule["start"], rule["length"])), types.get(name, "string")).alias(name)

    return body.select(*[value(name) for name in names], *([F.col("__file").alias(file_column)] if file_column else []))


def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = "|", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Delimited text without a header, every column text. An empty field is null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, sep=sep, encoding=encoding, schema=schema, header=False)


def read_header_csv(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType | None = None,
    multi_line: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV with a header line, quotes doubled inside quoted values.

    A declared schema saves the extra pass that detecting types costs. Values that hold line ends need
    ``multi_line``, with which a file is read whole by one task.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line, "encoding": encoding}
    if schema is None:
        return spark.read.csv(path, inferSchema=True, **options)
    return spark.read.csv(path, schema=schema, enforceSchema=False, **options)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def suffix_of(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower()


def read_by_extension(
    spark: SparkSession,
    path: str,
    fields: Sequence[Field] | None = None,
    schema: str | T.StructType | None = None,
    encoding: str = "UTF-8",
    pad: str | None = "start",
    width: int | None = None,
) -> DataFrame:
    """Choose the reader by suffix: .csv, .parquet, or .txt (fixed width, needs ``fields``).

    ``encoding`` holds for both kinds of text, ``pad`` and ``width`` for fixed width.
    """
    suffix = suffix_of(path)
    if suffix == ".csv":
        return read_header_csv(spark, path, schema, encoding=encoding)
    if suffix == ".parquet":
        return read_parquet(spark, path)
    if suffix == ".txt":
        if not fields:
            raise ValueError("a fixed-width file needs its fields")
        return read_fixed_width(spark, path, fields, pad, encoding, width)
    raise UnsupportedFileType(f"no reader for {suffix or 'a file without suffix'}: {path}")


def scan_files(
    spark: SparkSession,
    directory: str,
    suffix: str,
    any_of: Sequence[str] = (),
    required: str = "",
    as_text: bool = True,
) -> DataFrame:
    """Content of the files with this suffix whose name holds one of ``any_of`` and ``required``.

    Text gives (file_name, line); otherwise (file_name, content) as bytes. The name test is a
    filter on file metadata, so files that fail it are not opened.
    """
    source = spark.read.option("pathGlobFilter", f"*{suffix}")
    df = source.format("text" if as_text else "binaryFile").load(directory)
    name = F.col("_metadata.file_name")
    if any_of:
        wanted = F.lit(False)
        for part in any_of:
            wanted = wanted | name.contains(part)
        df = df.where(wanted)
    if required:
        df = df.where(name.contains(required))
    return df.select(name.alias("file_name"), F.col("value").alias(LINE) if as_text else F.col("content"))


def row_length_profile(
    lines: DataFrame, order_by: Sequence[str], line: str = LINE, in_bytes: bool = False
) -> DataFrame:
    """Row number and length of each line, in the order of the given columns."""
    length = (F.octet_length if in_bytes else F.length)(F.col(line))
    measured = lines.select(*order_by, length.alias("row_length"))
    return record_number(measured, order_by, "row_number")


def examine_row_lengths(spark: SparkSession, path: str, in_bytes: bool = False) -> DataFrame:
    """Row number and length of each line of a file, in file order."""
    # The lines are not sorted: inside a block their positions rise one by one, so the blocks, in the order of
    # file and start, say where each block's numbers begin: a running total over one row for each input split,
    # of which there may be many. The written copy keeps the positions fixed if a scan task runs again.
    block = ["file", "block"]
    lines = materialise(
        spark.read.text(path).select(
            (F.octet_length if in_bytes else F.length)("value").alias("row_length"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("position"),
        ),
        "line-lengths",
    )
    sizes = lines.groupBy(*block).agg(F.count("*").alias("size"), F.min("position").alias("first"))
    starts = running_total(sizes, block, "size", "before").drop("size")
    number = F.col("before") + F.col("position") - F.col("first") + 1
    return lines.join(starts, block).select(number.alias("row_number"), "row_length")


def row_length_histogram(lines: DataFrame, line: str = LINE, in_bytes: bool = False) -> DataFrame:
    """How many lines have which length: the quick look at an uneven fixed-width file."""
    length = (F.octet_length if in_bytes else F.length)(F.col(line)).alias("row_length")
    return lines.groupBy(length).agg(F.count("*").alias("rows"))
