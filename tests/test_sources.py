"""Readers and writers on small hand-written files."""

from __future__ import annotations

from pathlib import Path

import pytest

from rollwright import session
from rollwright.operators.filters import label_parts
from rollwright.sources import readers as R
from rollwright.sources import sinks as S
from tests.conftest import rows


def put(path: Path, text: str, encoding: str = "utf-8") -> str:
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_fixed_width_pads_short_lines_at_the_start(spark, tmp_path):
    path = put(tmp_path / "f.txt", "  12Ann  \n7Bob  \n 345Zoé  \n")
    fields = [R.Field(1, 4, "n", "int"), R.Field(5, 5, "name")]
    assert rows(R.read_fixed_width(spark, path, fields)) == [(7, "Bob  "), (12, "Ann  "), (345, "Zoé  ")]
    short = spark.createDataFrame([("ab",), ("abcd",)], "line string")
    parts = [R.Field(1, 2, "x"), R.Field(3, 2, "y")]
    assert rows(R.parse_fixed_width(short, parts)) == [("  ", "ab"), ("ab", "cd")]
    assert rows(R.parse_fixed_width(short, parts, pad="end")) == [("ab", "  "), ("ab", "cd")]
    assert rows(R.parse_fixed_width(short, parts, pad=None)) == [("ab", ""), ("ab", "cd")]
    assert rows(R.parse_fixed_width(short, parts, width=4)) == [("  ", "ab"), ("ab", "cd")]
    with pytest.raises(ValueError):
        R.parse_fixed_width(short, parts, pad="middle")


def test_slices_trim_and_forgive_short_lines(spark):
    lines = spark.createDataFrame([(" ab\tcd",), ("a",)], "line string")
    assert rows(R.parse_slices(lines, {"x": (0, 4), "y": (4, 9)})) == [("a", ""), ("ab", "cd")]


def test_each_file_is_read_by_its_own_ruling(spark, tmp_path):
    (tmp_path / "a.rpt").write_text("id   name  \n---- ------\n   1 ann   \n---- ------\nid   name  \n")
    (tmp_path / "b.rpt").write_text("name id extra\n---- -- -----\nbob  22 x\n")
    (tmp_path / "c.rpt").write_text("name id\n---- --\n")
    (tmp_path / "d.rpt").write_text("")
    got = R.read_dash_ruled(spark, str(tmp_path), file_column="file")
    assert got.columns == ["id", "name", "extra", "file"]
    assert rows(got.drop("file")) == [("----", "------", None), ("1", "ann", None), ("22", "bob", "x"), ("id", "name", None)]
    assert {r["file"].rsplit("/", 1)[-1] for r in got.collect()} == {"a.rpt", "b.rpt"}


def test_row_numbers_of_many_files(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i:02}.txt").write_text("".join(f"{'x' * (i + k)}\n" for k in range(i % 5)))
    got = R.examine_row_lengths(spark, str(tmp_path))
    lengths = [i + k for i in range(40) for k in range(i % 5)]
    assert rows(got) == [(n + 1, length) for n, length in enumerate(lengths)]
    shape = got._jdf.queryExecution().executedPlan().toString()
    # The splits, one row each, are summed up by range; what meets in one task is one row for each partition.
    assert shape.count("SinglePartition") <= 1 and "rangepartitioning" not in shape


def test_dash_ruled(spark, tmp_path):
    path = put(tmp_path / "r.rpt", "name   n\n------ ----\nAnn       1\nBob Le   22\n")
    got = R.read_dash_ruled(spark, path, {"n": "int"})
    assert rows(got) == [("Ann", 1), ("Bob Le", 22)]


def test_delimited_is_all_text_in_latin_1(spark, tmp_path):
    path = put(tmp_path / "d.txt", "Zoé|007| 5\nAnn||x\n", "iso-8859-1")
    assert rows(R.read_delimited(spark, path, ["name", "id", "kind"])) == [("Ann", None, "x"), ("Zoé", "007", " 5")]
    assert rows(R.read_lines(spark, path, "ISO-8859-1")) == [("Ann||x",), ("Zoé|007| 5",)]


def test_header_csv(spark, tmp_path):
    path = put(tmp_path / "h.csv", "a,b\n1,x\n2,y\n")
    assert rows(R.read_header_csv(spark, path)) == [(1, "x"), (2, "y")]
    assert rows(R.read_header_csv(spark, path, "a string, b string")) == [("1", "x"), ("2", "y")]


def test_reader_by_suffix(spark, tmp_path):
    csv = put(tmp_path / "a.csv", "a\n1\n")
    txt = put(tmp_path / "a.txt", "12\n")
    assert rows(R.read_by_extension(spark, csv)) == [(1,)]
    assert rows(R.read_by_extension(spark, txt, [R.Field(1, 2, "n", "int")])) == [(12,)]
    spark.range(2).write.parquet(str(tmp_path / "a.parquet"))
    assert rows(R.read_by_extension(spark, str(tmp_path / "a.parquet"))) == [(0,), (1,)]
    for name in ("a.xlsx", "a"):
        with pytest.raises(R.UnsupportedFileType):
            R.read_by_extension(spark, str(tmp_path / name))
    with pytest.raises(ValueError):
        R.read_by_extension(spark, txt)


def leaves(node):
    children = node.children()
    if children.isEmpty():
        yield node
    for i in range(children.size()):
        yield from leaves(children.apply(i))


def test_scan_files_by_name(spark, tmp_path):
    for name in ("Math_final.txt", "Math_draft.txt", "Art_final.txt", "Math_final.csv"):
        put(tmp_path / name, name + "\n")
    got = R.scan_files(spark, str(tmp_path), ".txt", any_of=["Math", "Sci"], required="final")
    assert rows(got) == [("Math_final.txt", "Math_final.txt")]
    # The others were not opened.
    got._jdf.javaToPython().count()
    (scan,) = [n for n in leaves(got._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan")]
    assert scan.metrics().get("numFiles").get().value() == 1
    assert R.scan_files(spark, str(tmp_path), ".txt", required="final", as_text=False).count() == 2


def test_line_lengths_in_file_order(spark, tmp_path):
    path = put(tmp_path / "l.txt", "".join("é" * (i % 7) + "\n" for i in range(50)))
    got = rows(R.examine_row_lengths(spark, path))
    assert got == [(i + 1, i % 7) for i in range(50)]
    assert rows(R.examine_row_lengths(spark, path, in_bytes=True))[6] == (7, 12)
    assert rows(R.row_length_histogram(R.read_lines(spark, path)))[0] == (0, 8)


def test_line_lengths_over_many_splits(spark, tmp_path):
    path = put(tmp_path / "big.txt", "".join("x" * (i % 100) + "\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 4
        assert rows(R.examine_row_lengths(spark, path)) == [(i + 1, i % 100) for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "n int, s string")
    S.write_parquet_and_csv(df, str(tmp_path / "p"), str(tmp_path / "c"))
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == rows(R.read_header_csv(spark, str(tmp_path / "c"), df.schema))
    path = S.write_headerless_csv(df.select("s", "n"), str(tmp_path), "h", order="n")
    text = "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))
    assert text.split() == ["a", "b"] or text.splitlines() == ["a", "b", '""'] or text.splitlines() == ["a", "b", ""]
    named = S.write_named_outputs({"one": df, "two": df.limit(1)}, str(tmp_path / "named"), fmt="csv")
    assert R.read_header_csv(spark, named["one"], df.schema).count() == 3
    S.write_labelled_parts(label_parts(df, {"x": "n = 1", "y": "n > 1"}), "output_name", str(tmp_path / "parts"))
    assert spark.read.parquet(str(tmp_path / "parts" / "output_name=y")).count() == 2


def test_table_is_replaced(spark):
    S.materialise_table(spark.range(3), "rollwright_t")
    assert S.materialise_table(spark.range(2), "rollwright_t").count() == 2
    assert R.read_table(spark, "rollwright_t").count() == 2
    spark.sql("DROP TABLE rollwright_t")


def test_tune_sets_only_what_it_is_given(spark):
    key, splits = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(splits)
    session.tune(spark)
    assert spark.conf.get(key, None) is None and spark.conf.get(splits) == before
    try:
        session.tune(spark, partitions=9, split_bytes=1 << 20)
        assert (spark.conf.get(key), spark.conf.get(splits)) == ("9", str(1 << 20))
    finally:
        spark.conf.unset(key)
        spark.conf.set(splits, before)


def test_lines_longer_than_the_width_are_whole(spark, tmp_path):
    path = put(tmp_path / "w.txt", "abcdefXY\nab\n")
    fields = [R.Field(1, 2, "a"), R.Field(7, 2, "b")]
    assert rows(R.read_fixed_width(spark, path, fields, pad="end", width=6)) == [("ab", ""), ("ab", "XY")]


def test_latin1_keeps_blank_lines_and_control_characters(spark, tmp_path):
    path = str(tmp_path / "l.txt")
    with open(path, "wb") as file:
        file.write("Zo\xe9\n\nx\x01tail\n".encode("latin-1"))
    assert rows(R.read_lines(spark, path, "ISO-8859-1")) == [("",), ("Zo\xe9",), ("x\x01tail",)]


def test_csv_keeps_line_ends_quotes_and_backslashes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, 'say "x"'), (3, "c\\d")], "id int, v string")
    S.write_parquet_and_csv(df, str(tmp_path / "p"), str(tmp_path / "c"))
    assert rows(R.read_header_csv(spark, str(tmp_path / "c"), "id int, v string", multi_line=True)) == rows(df)


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = session.scratch_path(spark, "x")
    assert path.startswith(root + "/rollwright/x-") and path != session.scratch_path(spark, "x")
    df = spark.range(5)
    kept = session.materialise(df)
    assert rows(kept) == rows(df) and kept.inputFiles()


def test_scratch_is_released_on_demand(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    kept = session.materialise(spark.range(5), "kept")
    assert kept.count() == 5 and session.release_scratch(spark) == 1
    assert session.release_scratch(spark) == 0 and not any((tmp_path / "rollwright").iterdir())
