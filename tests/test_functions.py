"""Case tables for the column expressions (rules in SURVEY/FIXTURES)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlink import functions as fx


def run(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_grade(spark):
    vals = ["4", "04", "4.0", " Grade  04 ", "FOURTH", "4th", "K", "kindergarten", "14",
            "13", "0", "KG", "PK", "4.5", "  ", None, "grade\t4", "12TH", "Grade K"]
    exp = [4, 4, 4, 4, 4, 4, 14, 14, 14, None, None, None, None, None, None, None, 4, 12, 14]
    assert run(spark, vals, fx.clean_grade) == exp


def test_clean_int(spark):
    vals = ["00123", " 12 ", "4.7", "-4.7", "1,234", "4d", "x", "", None, "99999999999999999999999"]
    exp = [123, 12, 4, -4, None, None, None, None, None, None]
    assert run(spark, vals, fx.clean_int) == exp


def test_parse_date(spark):
    d = dt.date
    cases = {
        "03/05/2025": d(2025, 3, 5), "3/5/2025": d(2025, 3, 5), "3-5-2025": d(2025, 3, 5),
        "2025-03-05 00:00:00": d(2025, 3, 5), "20250305": d(2025, 3, 5), "03052025": d(2025, 3, 5),
        "3052025": d(2025, 3, 5), "030525": d(2025, 3, 5), "3/5/25": d(2025, 3, 5),
        "10122025": d(2025, 10, 12), "030531": d(1931, 3, 5), "3/5/31": d(2031, 3, 5),
        "3/5/75": d(1975, 3, 5), "31525": d(2025, 3, 15), "2025315": d(5315, 2, 2),
        "023025": d(230, 2, 5), "2302025": d(2302, 2, 5), "45000": None, "2/30/2025": None,
        "3/5/2025 1:00 PM": None, "2025-03-05T00:00": None, None: None, "  ": None,
    }
    got = run(spark, list(cases), fx.parse_partner_date)
    assert got == list(cases.values())


def test_date_text_and_dob(spark):
    df = spark.createDataFrame([("03/05/2015",), ("03/05/1990",), ("03/05/2023",)], "v string")
    out = df.select(fx.date_text(fx.plausible_dob(fx.parse_partner_date("v"), dt.date(2025, 9, 1))))
    assert [r[0] for r in out.collect()] == ["03/05/2015", None, None]


def test_grade_list(spark):
    vals = ["3-5", "3 - 5", "K-2", "3;4 7", "GRADE 4", "x", None, "k, 1", "3-5-7", "10-12,4"]
    exp = [[3, 4, 5], [3, 5], [], [3, 4, 7], [4], [], [], [1, 14], [], [4, 10, 11, 12]]
    assert run(spark, vals, fx.parse_grade_list) == exp


def test_incorrect_term(spark):
    ok = ["Spring 2025", "2024-25", "SPR2025", "SP25", "2024", None, "SPRING"]
    bad = ["Fall 2025", "F24", "Winter", "WI", "2023", "SP22"]
    df = spark.createDataFrame([(t,) for t in ok + bad], "t string")
    got = [r[0] for r in df.select(fx.incorrect_term("t", F.lit("202502"))).collect()]
    assert got == [False] * len(ok) + [True] * len(bad)


def test_test_date_range(spark):
    rows = [("02/01/2025", False), ("06/30/2025", False), ("01/31/2025", True),
            ("07/01/2025", True), ("2025315", False), (None, False)]
    df = spark.createDataFrame(rows, "v string, e boolean")
    got = df.select(fx.test_date_out_of_range(fx.parse_partner_date("v"), F.lit("202502")), "e").collect()
    assert [r[0] for r in got] == [r[1] for r in got]
    absurd = spark.createDataFrame([("2025315",)], "v string").select(
        fx.test_date_out_of_range(fx.parse_partner_date("v"), F.lit("202502"), True)).collect()
    assert absurd[0][0] is True


def test_agency_code(spark):
    vals = ["North District 0123.csv", "south_45.CSV", "West12.csv", "East-7.csv", "x 5.xlsx",
            "7 files.txt", "12.csv"]
    assert run(spark, vals, fx.agency_code) == ["0123", "45", None, "7", "5", None, "12"]
    assert run(spark, ["West12.csv", "a1b22.csv", "none.csv"], fx.agency_code_legacy) == ["12", "22", None]


def test_name_key(spark):
    assert run(spark, ["Ann-Lee", "O'NEIL", None, "ann"], fx.name_key) == ["AL", "ONEIL", None, ""]
    assert run(spark, ["Ann-Lee"], lambda c: fx.name_key(c, fold_first=True)) == ["ANNLEE"]


def test_blank_and_edited(spark):
    assert run(spark, ["a", " ", " ", "", None], fx.blank_to_null) == ["a", None, None, None, None]
    assert run(spark, ["edited_x.csv", "EDITED_y.csv", "x.csv"], fx.is_edited_file) == [True, True, False]
    assert run(spark, ["Edited_edited_x.csv"], fx.strip_edited_prefix) == ["edited_x.csv"]


def test_vendor_codes(spark):
    assert run(spark, [13, 14, 16, 17, 5, 99, None], fx.vendor_grade, "int") == [0, -1, 0, 0, 5, None, None]
    assert run(spark, [12, 7, 3], fx.scale_code, "int") == [7, 7, 3]
    assert run(spark, ["Asian", "White", "x"], fx.ethnic_code) == [2, 8, None]
    df = spark.createDataFrame([("male", "F"), (None, "f"), ("x", None), ("0", "M")], "p string, v string")
    assert [r[0] for r in df.select(fx.sex_code("p", "v")).collect()] == [1, 0, None, 0]


def test_pct_half_even(spark):
    df = spark.createDataFrame([(1, 400), (1, 0), (1, None)], "a int, b int")
    got = [r[0] for r in df.select(fx.pct("a", "b", 1)).collect()]
    assert got == [0.2, None, None]


def test_saved_forms(spark):
    df = spark.createDataFrame([(" a ", [3, None, 4], 1.5), (None, None, None)], "t string, l array<int>, d double")
    assert [tuple(r) for r in fx.sanitize_columns(df.where("d > 1")).collect()] == [("a", "[3, 4]", 1.5)]
    assert tuple(fx.sanitize_columns(df.where("d is null")).first()) == (None, None, None)
    names = ["counts.xlsx", "a.b.csv", "none", ".hidden", "..x.txt", "dot.", "two\nlines.csv"]
    when = F.timestamp_seconds(F.lit(86400 + 3661))
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", fx.timestamped_name("n", when).alias("o")).collect()
    import os
    assert {r.n: r.o for r in got} == {n: os.path.splitext(n)[0] + "_19700102_010101" + os.path.splitext(n)[1] for n in names}


def test_simple_grade_list_and_subjects(spark):
    cases = {"3, 4,5": [3, 4, 5], " 7 ": [7], "": [], None: [], ",,2,": [2], "3-5": None, "K": None, "+4,-1": [4, -1]}
    got = spark.createDataFrame([(c,) for c in cases], "c string").select("c", fx.simple_grade_list("c").alias("g")).collect()
    assert {r.c: r.g for r in got} == cases
    got = {r.c: r.s for r in spark.createDataFrame([(1,), (7,), (12,), (110,), (99,), (None,)], "c int").select("c", fx.subject_name("c").alias("s")).collect()}
    assert got == {1: "Math", 7: "Reading - Spanish", 12: "Reading - Spanish", 110: "Earth, Space, and Life Sciences", 99: None, None: None}


def test_usual_date_layouts_read_like_any_layout(spark):
    from cohortlink.functions import dates
    heads = ["1/2/2024", "01/02/2024", "13/1/2024", "2/30/2024", "2/29/2023", "2/29/24", "1/2/68", "1/2/69", "1/2/0000", "1/2/0001", "0/1/2024",
             "2024-01-02", "2024-1-2", "0000-1-2", "2024-13-1", "2024-02-30", "01022024", "20240102", "13132024", "00000000", "02300000",
             "99991231", "12319999", "1/2/224", "1-2-2024", "2024/1/2", "1/ 2/2024", "102024", "12024", "1124", "1/2", "x", "", "2024-01-02T00:00"]
    tails = ["", " ", "\n", " 00:00", " 00:00:00", " 9:05:1", "  00:00", " x"]
    texts = [None] + [lead + h + t for lead in ("", " ") for h in heads for t in tails]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    differ = df.where(~fx.parse_partner_date("v").eqNullSafe(dates._any_layout(F.col("v")))).collect()
    assert differ == []
    assert "transform" not in df.select(dates._usual_layouts(F.col("v"), F.lit(None).cast("date")))._jdf.queryExecution().optimizedPlan().toString()


def test_term_readings_tell_what_incorrect_term_tells(spark):
    terms = [None, "", "Spring 2025", "2024-25", "SP25", "50", "51", "125", "2050", "20512", "FALL 25", "W25", "1/25", "2099"]
    df = spark.createDataFrame([(t, y) for t in terms for y in ("202502", "205102", "002502", "405002", "x", None)], "t string, y string")
    got = df.select(fx.incorrect_term("t", "y").alias("a"), fx.contradicts(fx.term_reading("t"), fx.study_year("y")).alias("b")).collect()
    assert all(r.a == r.b and r.a is not None for r in got)
    assert [r.a for r in df.where("y = '202502'").select(fx.incorrect_term("t", "y").alias("a")).collect()] == [
        False, False, False, False, False, True, False, False, True, True, True, True, False, True]
