"""Jobs over files: one subject for each page run, void sets out of a checked manifest."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollwright.plans import pages as P
from rollwright.plans import roster as R
from rollwright.sources.readers import Field, UnsupportedFileType, read_by_extension
from tests.conftest import rows

REGIONS = {"Title": (0, 0, 99, 3), "Info": (0, 10, 99, 12), "Score": (0, 20, 99, 21)}
LAYOUT = P.PageLayout("Title", ["Report", "Subject", "Season"], "Info", "Score", labels={"Grade": r"Grade: (.*?)(?:\n|$)", "DoB": r"Date of Birth: (.*?)(?:\n|$)"})


def page(number, subject, score="17"):
    lines = [(0, "Yearly Report"), (1, subject), (2, "Spring 1"), (10, "Student: Ann B Cole"), (11, "Grade: 12"), (20, score)]
    return [f"{number}\t{x}\t{y}\t{x + 1}\t{y + 1}\t{word}" for y, line in lines for x, word in enumerate(line.split(" ")) if word]


def job(folder, **changes):
    files = P.PageFiles(str(folder), ".boxes", any_of=["page"], required="ok")
    return P.PageJob(files, REGIONS, LAYOUT, "Subject", {"English Language Arts": "ELA"}, **changes)


def test_the_subject_of_the_files_names_the_score(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "page_ok_1.boxes").write_text("\n".join([*page(1, "English Language Arts"), *page(2, "English Language Arts", "*")]))
    (folder / "page_ok_2.boxes").write_text("\n".join([*page(1, "English Language Arts"), "no box", "1\tx\t0\t1\t1\tword"]))
    (folder / "page_bad.boxes").write_text("\n".join(page(9, "Mathematics")))
    (folder / "page_ok_3.text").write_text("\n".join(page(9, "Mathematics")))
    result = P.page_job(spark, job(folder), str(tmp_path / "out"))
    assert result.subject == "English Language Arts" and rows(result.mismatches) == []
    got = rows(result.records.select("doc", "page", "Subject", "Scale_Score_ELA", "Student_Last_Name", "Grade"))
    assert got == [
        ("page_ok_1.boxes", 1, "English Language Arts", "17", "Cole", "12"),
        ("page_ok_1.boxes", 2, "English Language Arts", "*", "Cole", "12"),
        ("page_ok_2.boxes", 1, "English Language Arts", "17", "Cole", "12"),
    ]
    again = spark.read.csv(result.csv_path, header=True, schema=result.records.schema, multiLine=True, escape='"')
    assert rows(again) == rows(result.records)


def test_several_subjects_stop_the_job_with_their_pages(spark, tmp_path):
    (tmp_path / "page_ok_1.boxes").write_text("\n".join([*page(1, "Science"), *page(2, "Science"), *page(3, "Art")]))
    with pytest.raises(P.SeveralSubjects, match=r"'Art' on 1 pages, first page_ok_1.boxes, 3; 'Science' on 2 pages, first page_ok_1.boxes, 1"):
        P.page_job(spark, job(tmp_path), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_no_page_no_subject(spark, tmp_path):
    (tmp_path / "page_ok_1.boxes").write_text("")
    result = P.page_job(spark, job(tmp_path), str(tmp_path / "out"))
    assert result.subject is None and result.records.count() == 0 and "Score" in result.records.columns


def test_void_sets_out_of_mixed_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("    1né  71L\n    2né  82ü\n    3né    L\n".encode("latin-1"))
    (tmp_path / "a.csv").write_text("record_id,person_id\n1,100\n9,900\n")
    spark.createDataFrame([("1", "55", "X"), ("7", "71", "X"), ("8", None, "X"), ("9", "5", None)], "line string, own string, code string").coalesce(1).write.parquet(str(tmp_path / "b.parquet"))
    (tmp_path / "b.csv").write_text("record_id,person_id\n7,\n1,100\n")
    fields = [Field(1, 5, "row_id"), Field(6, 2, "note"), Field(8, 4, "own_id"), Field(12, 1, "status")]
    ids = "record_id bigint, person_id bigint"
    manifest = [
        R.VoidSource("first", R.FileSource(str(tmp_path / "a.txt"), fields, encoding="ISO-8859-1", width=12), R.FileSource(str(tmp_path / "a.csv"), schema=ids), {"L": "late"}),
        R.VoidSource("second", R.FileSource(str(tmp_path / "b.parquet")), R.FileSource(str(tmp_path / "b.csv"), schema=ids), {"X": "gone"}, row_id="line", alternative_id="own", status="code"),
    ]
    # Row 3 of the first and row 8 of the second file have no ID at all.
    assert rows(R.void_sets_from_files(spark, manifest)) == [
        (71, None, True, "second: gone"), (100, True, True, "first: late; second: gone"),
    ]


def test_a_manifest_is_checked_before_the_first_read(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1")
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    text, table = str(tmp_path / "a.txt"), str(tmp_path / "a.csv")
    manifest = [
        R.VoidSource("one", R.FileSource(text), R.FileSource(table, schema="x int"), {"L": "late"}),
        R.VoidSource("one", R.FileSource(text, [Field(1, 9, "row_id")], width=5, encoding="no-such"), R.FileSource(str(tmp_path / "gone.csv"), schema="x int"), {}),
        R.VoidSource("two", R.FileSource(str(tmp_path / "a.xlsx")), R.FileSource(table), {"L": "late"}),
    ]
    with pytest.raises(ValueError) as error:
        R.void_sets_from_files(spark, manifest)
    for part in (
        "one: listed twice", "one main file: a fixed-width file needs its fields", "one ID map: no column record_id, person_id", "one: no code voids a row",
        "fields end at 9, beyond the record length 5", "unknown encoding no-such", "no column own_id, status", "nothing at", "two main file: no reader", "two ID map: a CSV file needs its schema",
    ):
        assert part in str(error.value), part
    with pytest.raises(ValueError, match="no files"):
        R.void_sets_from_files(spark, [])


def test_read_by_extension_passes_encoding_and_width(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é1\n".encode("latin-1"))
    (tmp_path / "a.csv").write_bytes("a\né\n".encode("latin-1"))
    fields = [Field(1, 2, "a"), Field(3, 2, "b")]
    assert rows(read_by_extension(spark, str(tmp_path / "a.txt"), fields, encoding="ISO-8859-1", pad="end", width=4)) == [("é1", "  ")]
    assert rows(read_by_extension(spark, str(tmp_path / "a.csv"), schema="a string", encoding="ISO-8859-1")) == [("é",)]
    with pytest.raises(UnsupportedFileType):
        read_by_extension(spark, str(tmp_path / "a.xlsx"))
