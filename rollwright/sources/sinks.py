"""Published outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Blanks at the ends of a value are part of it.
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_parquet_and_csv(df: DataFrame, parquet_path: str, csv_path: str) -> None:
    """The same result as parquet and as headed CSV. The CSV is made from the written parquet, so the
    result is computed once. Values with line ends are quoted: read such a file with ``multi_line``."""
    write_parquet(df, parquet_path)
    written = df.sparkSession.read.schema(df.schema).parquet(parquet_path)
    written.write.mode("overwrite").csv(csv_path, header=True, escape='"', **_KEEP_BLANKS)


def write_headerless_csv(df: DataFrame, directory: str, name: str, order: str | None = None) -> str:
    """CSV without a header line under directory/name.csv.

    With ``order`` the part files, taken by name, follow that column (which is not published): a
    range sort, so a large report is never squeezed through one task; a small one comes out as a
    single part.
    """
    path = f"{directory.rstrip('/')}/{name}.csv"
    out = df.orderBy(F.asc_nulls_first(order)).drop(order) if order else df
    out.write.mode("overwrite").csv(path, header=False, emptyValue="", **_KEEP_BLANKS)
    return path


def write_named_outputs(outputs: Mapping[str, DataFrame], directory: str, fmt: str = "parquet") -> dict[str, str]:
    """Several named tables of one run. Materialise a costly shared parent first."""
    paths = {}
    for name, df in outputs.items():
        paths[name] = f"{directory.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite")
        writer.csv(paths[name], header=True, escape='"', **_KEEP_BLANKS) if fmt == "csv" else writer.format(fmt).save(paths[name])
    return paths


def write_labelled_parts(df: DataFrame, label: str, directory: str) -> None:
    """Disjoint parts (see ``filters.label_parts``) in one pass, one folder for each label value."""
    df.write.mode("overwrite").partitionBy(label).parquet(directory)


def materialise_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a catalog table by this result; with ``path`` its files lie there."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
