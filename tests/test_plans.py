"""Each job end to end on a tiny invented data set."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollwright.operators.regions import region_text, region_text_by_table, region_text_long
from rollwright.plans import classify as CL
from rollwright.plans import pages as PG
from rollwright.plans import roster as RO
from rollwright.sources.readers import Field
from tests.conftest import rows

NAN = float("nan")


@pytest.fixture()
def prepared(spark):
    roster = spark.createDataFrame(
        [
            (" 1 ", "12", "1", "001", " 7 ", "3", "4", "2006"),
            ("2", " 12", "1", "005", "8", "12", "4", "2006"),
            ("3", "12", "1", "004", "9", "3", "4", "2006"),
            ("4", "12", " 5", "001", "7", "3", "4", "2006"),  # dropped kind
            ("5", "12", "1", "001", "997", "3", "4", "2006"),  # dropped site part
            ("6", "12", "1", "002", "2", "3", "4", "2006"),  # excluded site
            ("7", "11", "1", "001", "7", "3", "4", "1900"),
            ("8", "10", "1", "001", "7", "3", "4", "2006"),
        ],
        "person_id string, grade string, record_kind string, district_code string, site_part string,"
        " birth_day string, birth_month string, birth_year string",
    )
    sites = spark.createDataFrame(
        [("001007", "North", "Hill", ""), ("005008", "South", "Lake", ""), ("004009", "West", "Dale", "S99")],
        "site_code string, district_name string, site_name string, report_code string",
    )
    retired = spark.createDataFrame([(1, 100)], "retired_id bigint, active_id bigint")
    rules = RO.RosterRules(
        "12", "11", "5", "997", ["002002"], special_report_code="S99", special_district_name="Special",
        site_shown_above="003", site_shown_except=["S99"],
    )
    return roster, sites, retired, rules


def test_roster_prepare(spark, prepared):
    out = RO.roster_prepare(*prepared)
    got = rows(out.roster, "person_id", "site_code", "birth_day", "district_code_name")
    assert got == [
        (2, "005008", "12", "005008_Lake"),
        (3, "004009", "03", "S99_Special"),
        (100, "001007", "03", "001_North"),
    ]
    assert rows(out.other_grade, "person_id", "birth_day") == [("7", "3")]


def test_raw_filter_lets_padded_codes_pass(spark, prepared):
    import dataclasses

    roster, sites, retired, rules = prepared
    out = RO.roster_prepare(roster, sites, retired, dataclasses.replace(rules, filter_raw=True))
    assert 4 in [r[0] for r in rows(out.roster, "person_id")]


def test_bad_id_stops_the_job(spark, prepared):
    roster, *rest = prepared
    with pytest.raises(Exception, match="not an ID"):
        RO.roster_prepare(roster.withColumn("person_id", F.lit("x")), *rest).roster.collect()


def test_void_sets(spark):
    main = spark.createDataFrame(
        [(" 1 ", "50", "L"), ("2.0", "60", "H"), ("3", "70", ""), ("4", "80", None), ("5", "60", "L")],
        "row_id string, own_id string, status string",
    )
    ids = spark.createDataFrame([(1, 11), (2, None), (9, 12)], "record_id bigint, person_id bigint")
    second = spark.createDataFrame([("9", "0", "H")], "row_id string, own_id string, status string")
    got = RO.void_sets([RO.VoidFile(main, ids), RO.VoidFile(second, ids)], ["L", "H"])
    assert rows(got) == [(11, True, None), (12, None, True), (60, True, None)]


def test_void_files_by_path(spark, tmp_path):
    (tmp_path / "m.txt").write_text("  1  50L\n  2  60H\n  3  70 \n")
    (tmp_path / "i.csv").write_text("record_id,person_id\n1,11\n")
    fields = [Field(1, 3, "row_id"), Field(4, 4, "own_id"), Field(8, 1, "status")]
    args = ([str(tmp_path / "m.txt")], [str(tmp_path / "i.csv")])
    files = RO.read_void_files(spark, *args, [None], fields, "record_id bigint, person_id bigint")
    assert rows(RO.void_sets(files, ["L", "H"])) == [(11, True), (60, True)]
    with pytest.raises(ValueError):
        RO.read_void_files(spark, *args, [], fields)


HISTORY = [
    (1, 20.5, "Prime file", 1),
    (1, 33.0, "EAST", 2),
    (1, NAN, "x", 3),  # no priority: null ranks first, its score counts as 0
    (2, 17.9, "EAST", 4),
    (2, 18.2, "east", 5),
    (3, NAN, "PRIME", 6),  # no valid score
    (4, None, "PRIME", 7),
    (6, 25.0, "PRIME", 8),
    (6, 25.0, "PRIME", 9),
]
ROSTER = [(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (4, "d"), (5, "e"), (None, "n"), (6, "f")]


def history(spark, **changes):
    table = spark.createDataFrame(HISTORY, "person_id bigint, score double, source string, seq bigint")
    settings = dict(rank_by=["priority", "score"], tiebreak=["seq"], priorities=[("prime", 1), ("east", 0)])
    return RO.History(table, "person_id", "score", "source", **(settings | changes))


def test_match_split(spark, tmp_path):
    roster = spark.createDataFrame(ROSTER, "person_id bigint, name string")
    voids = spark.createDataFrame([(3,), (3,), (1,), (None,)], "person_id bigint")
    out = RO.match_split(roster, history(spark), voids, ["person_id", "name"], names={"name": "Name"})
    assert rows(out.matched) == [
        ("1", "a", "0", None),
        ("2", "b", "18", None),
        ("2", "b2", "18", None),
        ("3", "c", "0", "Y"),
        ("6", "f", "25", None),
    ]
    assert rows(out.unmatched) == [("4", "d"), ("5", "e")]
    assert rows(out.flagged, "name", "if_matched") == [
        ("a", "Y"), ("b", "Y"), ("b2", "Y"), ("c", "Y"), ("d", "N"), ("e", "N"), ("f", "Y"), ("n", "N")
    ]
    once = RO.match_split(
        roster, history(spark), voids, ["person_id", "name"], names={"name": "Name"}, write_once=True
    )
    assert [rows(a) for a in once] == [rows(a) for a in out]
    paths = RO.publish_match(once, str(tmp_path))
    assert set(paths) == {"MATCH", "NO_MATCH"} and spark.read.csv(paths["MATCH"], header=True).count() == 5
    # Matched, unmatched and null IDs make up the roster.
    assert out.matched.count() + out.unmatched.count() + 1 == len(ROSTER) == out.flagged.count()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=8),
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 6)),
            st.one_of(st.none(), st.just(NAN), st.sampled_from([1.5, 2.5, 30.0])),
            st.sampled_from(["prime", "east", "x"]),
        ),
        max_size=12,
    ),
    st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=5),
)
def test_match_split_against_plain_python(spark, people, records, void):
    table = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(records)], "person_id bigint, score double, source string, seq bigint"
    )
    import dataclasses

    past = dataclasses.replace(history(spark), table=table)
    roster = spark.createDataFrame([(p, i) for i, p in enumerate(people)], "person_id bigint, line int")
    voids = spark.createDataFrame([(v,) for v in void], "person_id bigint")
    out = RO.match_split(roster, past, voids, ["person_id", "line"])

    valid = {p for p, s, _ in records if p is not None and s is not None and s == s}
    voided = {v for v in void if v is not None}

    def best(person):
        ranked = []
        for seq, (p, s, source) in enumerate(records):
            if p == person:
                s = 0.0 if s is not None and s != s else s
                priority = {"prime": 1, "east": 0}.get(source)
                ranked.append((priority is None, priority or 0, s is None, s or 0.0, -seq))
        return str(int(max(ranked)[3])) if ranked else "0"

    matched = sorted(
        (line, str(p), best(p), "Y" if p not in valid else None)
        for line, p in enumerate(people)
        if p in valid | voided
    )
    assert sorted(tuple(r) for r in out.matched.select("line", "person_id", "score_composite", "district_pay").collect()) == matched
    unmatched = sorted(line for line, p in enumerate(people) if p is not None and p not in valid | voided)
    assert sorted(r["line"] for r in out.unmatched.collect()) == unmatched
    flags = {r["line"]: r["if_matched"] for r in out.flagged.collect()}
    assert flags == {line: "Y" if p in valid | voided else "N" for line, p in enumerate(people)}


def test_best_score_by_another_key_may_multiply_rows(spark):
    roster = spark.createDataFrame(ROSTER, "person_id bigint, name string")
    voids = spark.createDataFrame([(3,)], "person_id bigint")
    by_row = history(spark, dedupe_key="seq")
    out = RO.match_split(roster, by_row, voids, ["person_id", "name"])
    assert [r[2] for r in rows(out.matched) if r[0] == "1"] == ["0", "20", "33"]
    same = RO.match_split(roster, history(spark, dedupe_key="person_id"), voids, ["person_id", "name"])
    assert rows(same.matched, "person_id", "score_composite")[0] == ("1", "0")


def test_unmatched_enrich(spark):
    flagged = spark.createDataFrame(
        [(1, "001007", "3", "4", "2006", "N"), (2, "500001", "3", "4", "2006", "N"), (3, "001007", "3", "4", "2006", "Y"),
         (4, "009009", "3", "4", "2006", "N")],
        "person_id bigint, site_code string, birth_day string, birth_month string, birth_year string, if_matched string",
    )
    other = spark.createDataFrame(
        [("7", "001007", "x", "4", "1900")],
        "person_id string, site_code string, birth_day string, birth_month string, birth_year string",
    )
    raw = spark.createDataFrame(
        [("OLD", "O2", "P"), ("001007", "O1", "P"), ("500001", "O3", "P"), ("009009", None, "P"), ("bad", "O9", "P")],
        "site_code string, organization string, parent string",
    )
    site_map = spark.createDataFrame([("OLD", "001007")], "old_site string, new_site string")
    crosswalk = RO.clean_crosswalk(raw, site_map, ["bad"], "site_code", "organization", "parent")
    assert rows(crosswalk, "site_code", "organization") == [("001007", "O1"), ("009009", None), ("500001", "O3")]
    rules = RO.EnrichRules(
        keep=["person_id", "site_code", "birth_day", "birth_month", "birth_year"],
        final=["State ID", "organization", "opt_in", "birth_date", "S_1", "kind"],
        null_columns=["S_1"], fixed_columns={"kind": "K"}, names={"person_id": "State ID"}, text_columns=["State ID"],
    )
    assert rows(RO.unmatched_enrich(flagged, other, crosswalk, rules)) == [
        ("1", "O1", "Y", "4/3/2006", None, "K"),
        ("2", "O3", "X", "4/3/2006", None, "K"),
        ("7", "O1", "Y", "x", None, "K"),
    ]


def test_roster_classify(spark):
    facts = spark.createDataFrame(
        [
            (1, "Y", 3, "05", "001001", "1", None, "Y"),
            (2, "N", 3, "05", "001001", "1", None, "Y"),  # not included
            (3, "N", 5, "11", "OLD", None, None, None),  # type 5 passes every rollup filter
            (4, "Y", None, "05", "001001", None, None, "Y"),  # NOT(type = 9 AND ...) unknown only if the rest holds
            (5, "Y", 9, "05", "001001", None, "1", "Y"),  # dropped by NOT(...)
            (6, "Y", 3, "12", "999001", None, None, "Y"),  # closed site
            (7, "Y", 3, "12", "002001", "0", "1", "N"),
        ],
        "id int, roll string, kind int, grade string, site string, m1 string, m2 string, taken string",
    )
    conversion = spark.createDataFrame([("OLD", "002001")], "site_from string, site_to string")
    opened = spark.createDataFrame([("001001", 1), ("002001", 1), ("002001", 1), ("999001", 6)], "site string, status int")
    listed = spark.createDataFrame([("001001",), ("002001",), ("999001",), (None,)], "site string")
    rules = CL.ClassifyRules(
        include="(roll = 'Y' AND grade >= '03') OR kind = 5",
        filters=["NOT (kind = 9 AND grade = '05')"],
        grade="grade", grade_map={"11": "10", "12": "10"}, site="site", open_when="status NOT IN (2, 6, 7)",
        flags={"marked": [CL.MarkGroup("kind = 1"), CL.MarkGroup("kind = 3", ["m1", "m2"])]},
        derived=[
            ("done", [("taken = 'Y'", True)], False),
            ("status", [("done AND marked", "WITH"), ("done", "WITHOUT"), ("NOT done", "NONE"), ("kind = 5", "FIVE")], None),
        ],
        overrides={"status": ([("id = 7", "EXCUSED")], False)},
        columns=["id", "transformed_grade", "site_code", "district_code", "marked", "status"],
    )
    got = CL.roster_classify(facts, conversion, opened, listed, rules)
    assert rows(got) == [
        (1, "05", "001001", "001", True, "WITH"),
        (3, "10", "002001", "002", False, "NONE"),
        (7, "10", "002001", "002", True, "NONE"),
    ]
    import dataclasses

    twice = CL.roster_classify(facts, conversion, opened, listed, dataclasses.replace(rules, multiply=True))
    assert [r[0] for r in rows(twice, "id")] == [1, 3, 3, 7, 7]
    excused = dataclasses.replace(rules, overrides={"status": ([("id = 7", "EXCUSED")], True)})
    assert rows(CL.roster_classify(facts, conversion, opened, listed, excused), "status")[0] == ("EXCUSED",)
    views = CL.roster_views(got, {"all": "NOT (id = 3 AND status = 'NONE')", "none": "status != 'WITH'"})
    assert [r[0] for r in rows(views["all"], "id")] == [1, 7] and views["none"].count() == 2


def boxes(spark, texts):
    data = [
        ("d", page, float(x), y, x + 1.0, y + 1.0, word)
        for page, lines in texts.items()
        for y, line in lines.items()
        for x, word in enumerate(line.split(" "))
        if word
    ]
    return spark.createDataFrame(data, "doc string, page int, x0 double, y0 double, x1 double, y1 double, word string")


def test_region_text(spark):
    words = boxes(spark, {1: {0.0: "one two three", 1.5: "four"}, 2: {9.0: "out"}})
    regions = {"top": (0, 0, 2, 1), "all": (0, 0, 9, 5), "none": (50, 50, 60, 60)}
    got = rows(region_text(words, regions), "page", "top", "all", "none")
    assert got == [(1, "one two", "one two three\nfour", None), (2, None, None, None)]
    long = rows(region_text_long(words, regions), "page", "region", "text")
    assert long == [(1, "all", "one two three\nfour"), (1, "top", "one two")]
    keyed = words.withColumn("template", F.lit("t"))
    by_template = {"t": {"top": (0, 0, 1, 1)}, "u": {"top": (0, 0, 9, 9), "rest": (0, 1, 9, 9)}}
    assert rows(region_text(keyed, by_template, template="template"), "page", "top", "rest")[0] == (1, "one", None)


def test_region_text_by_table_counts_boxes_and_compares_no_pairs(spark):
    draw = random.Random(3)
    schema = "doc int, t string, x0 double, y0 double, x1 double, y1 double, word string"
    words = [(draw.randrange(3), draw.choice(["a", "b", None]), float(x := draw.randrange(9)), float(y := draw.randrange(4)), x + 1.0, y + 1.0, draw.choice(["w", "w\t", "w w", "", None])) for _ in range(500)]
    rects = [("a", "one", 0, 0, 5, 2), ("a", "one", 2, 0, 9, 3), ("a", "two", 0, 1, 99, 99), ("b", "one", 1, 0, 7, 4), ("b", "one", 1, 0, 7, 4), ("b", "two", 8, 0, 3, 4)]
    table = spark.createDataFrame([(t, r, *map(float, at)) for t, r, *at in rects], "t string, region string, x0 double, y0 double, x1 double, y1 double")
    got = region_text_by_table(spark.createDataFrame(words, schema), table, page=["doc"], template="t")
    shape = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in shape and "exists(" not in shape
    lines = {}
    for doc, t, x0, y0, x1, y1, word in words:
        for name, region, *by in set(rects):
            if name == t and by[0] <= x0 and by[1] <= y0 and x1 <= by[2] and y1 <= by[3]:
                lines.setdefault((doc, region), {}).setdefault(y0, []).append(((x0, word is not None, word or "", x1), by))
    want = []
    for key, found in lines.items():
        text = []
        for _, hits in sorted(found.items()):
            kept = sorted(box for box, by in hits if by == min(b for o, b in hits if o == box))
            text.append(" ".join(word for _, known, word, _ in kept if known))
        want.append((*key, "\n".join(text)))
    assert rows(got.select("doc", "region", "text")) == sorted(want)
    # A line of 30,000 words.
    long = spark.range(30_000).selectExpr("1 AS doc", "'a' AS t", "double(id) AS x0", "0D AS y0", "double(id + 1) AS x1", "1D AS y1", "'w' AS word")
    ((_, _, text),) = rows(region_text_by_table(long, spark.createDataFrame([("a", "all", 0.0, 0.0, 1e9, 9.0)], table.schema), page=["doc"], template="t"))
    assert text == " ".join(["w"] * 30_000)


def test_page_records(spark):
    layout = PG.PageLayout(
        title_region="title", title_columns=["Title", "Subject", "Season"], info_region="info", score_region="score",
        levels=["High"], level_region="Percent_{}", trimmed={"score": [("\n", " "), ("SCORE", "")]},
        details=["read", "read_shares"], cleaned=["read"], shares={"read": "read_shares"},
        code_and_name={"School": ("School_Code", "School_Name")}, names={"Grade": "Summarized_Grade"},
    )
    good = {
        0.0: "Report", 1.0: "English Arts", 2.0: "Spring 2001",
        10.0: "Student: Ann B Lee Grade: 9", 11.0: "Grade: 9", 12.0: "School: 007 Hill High", 13.0: "Date of Birth: 02/03/2004",
        14.0: "School System: 01 North",
        20.0: "≥95% 3% NR", 30.0: "SCORE", 31.0: "712", 40.0: "«««", 41.0: "Strong", 50.0: "50%", 51.0: "30%",
    }
    void = good | {1.0: "", 13.0: "Date of Birth: --/--/----", 20.0: "1% 2%", 31.0: "*"}
    regions = {
        "title": (0, 0, 99, 3), "info": (0, 10, 99, 15), "Percent_High": (0, 20, 99, 21), "score": (0, 30, 99, 32),
        "read": (0, 40, 99, 42), "read_shares": (0, 50, 99, 53),
    }
    words = boxes(spark, {1: good, 2: void})
    one, two = PG.page_records(words, regions, layout).orderBy("page").collect()
    assert (one["Title"], one["Subject"], one["Season"]) == ("Report", "English Arts", "Spring 2001")
    assert (one["Student_First_Name"], one["Student_Middle_Initial"], one["Student_Last_Name"]) == ("Ann", "B", "Lee")
    assert (one["School_Code"], one["School_Name"], one["School_System"]) == ("007", "Hill High", "01 North")
    assert (one["Summarized_DOB_Day"], one["Summarized_DOB_Month"], one["Summarized_DOB_Year"]) == (3, 2, 2004)
    assert (one["High_School_Percentage"], one["High_State_Percentage"], one["High_Mismatch"]) == ("≥95%", "NR", False)
    assert (one["score"], one["If_Voided"], one["read"], one["Summarized_Grade"]) == ("712", False, " Strong", "9")
    shares = [one[f"read_State_Percentage_{s}"] for s in ("Strong", "Moderate", "Weak")]
    assert shares == ["50%", "30%", None] and one["LASID"] is None
    assert (two["score"], two["If_Voided"], two["read"], two["Title"]) == ("*", True, None, None)
    assert two["Summarized_DOB_Year"] is None and two["High_School_Percentage"] is None
    records = PG.extract_pages(region_text(words, regions), layout)
    assert rows(PG.page_mismatches(records, layout)) == [("d", 2, "High")]
