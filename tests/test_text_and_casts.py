from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from rollcall.functions import casts, names, text


def values(spark, fn, cells):
    rows = [(i, c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, "i int, c string")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


def test_texts_with_white_space_in_odd_places(spark):
    cells = [" ", "~ ", " !", "a\u00a0", "\u3000 a", " a\t ", "\x1f nan \x85", "é", " é ", "a b", "nan nan", "banana", " \u2003NaN", "NAN\x1c", None, "\x7f"]
    assert values(spark, text.strip, cells) == [c if c is None else c.strip() for c in cells]
    assert values(spark, text.blank_missing, cells) == ["" if c is None or c.strip().lower() == "nan" else c for c in cells]


def test_strip_is_pythons_strip(spark):
    cells = [" a ", "\t\nB b\r", " x　", "", "  ", "in side", " \x1cé\x1f"]
    assert values(spark, text.strip, cells) == [c.strip() for c in cells]
    assert values(spark, text.clean, cells) == [c.strip().lower() for c in cells]


def test_missing_becomes_blank(spark):
    cells = [None, "nan", " NaN ", "Nancy", ""]
    assert values(spark, text.key_text, cells) == ["", "", "", "nancy", ""]
    assert values(spark, text.blank_missing, cells) == ["", "", "", "Nancy", ""]


def test_has_letter_matches_case_rule(spark):
    cells = ["", "123", "a1", "Éa", "李", "-.", "ß", "éa"]
    assert values(spark, text.has_letter, cells) == [c.upper().isupper() for c in cells]


def test_age(spark):
    cells = ["", " ", None, " 40 ", "17", "4x", "12.0", "999999999999"]
    assert values(spark, casts.to_age, cells) == [999, 999, 999, 40, 17, None, None, None]


def test_integer_keys(spark):
    cells = ["12", " 7 ", "", None, "x1", "1.5", "-3", "99999999999999999999"]
    assert values(spark, casts.to_key, cells) == [12, 7, None, None, None, None, -3, None]
    assert values(spark, casts.to_number_or_zero, cells) == [12, 7, 0, 0, 0, 0, -3, 0]


def test_stamp_is_strict_and_zone_free(spark):
    cells = ["1970-01-02 00:00:01", "2024-03-10 02:30:00", "2024-03-10", "", None, "2024-13-01 00:00:00"]
    want = [86401, 1710037800, None, None, None, None]
    assert values(spark, casts.to_seconds, cells) == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, casts.to_seconds, cells) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_days(spark):
    cells = ["2020-02-29", "02/29/2020", "2021-02-29", "", None, "unknown", " 1999-12-31 ", "2020/01/05"]
    want = [date(2020, 2, 29), date(2020, 2, 29), None, None, None, None, date(1999, 12, 31), date(2020, 1, 5)]
    assert values(spark, casts.to_day, cells) == want
    us = [d.strftime("%m/%d/%Y") if d else "" for d in want]
    assert values(spark, lambda c: casts.day_text(casts.to_day(c)), cells) == us


@pytest.mark.parametrize(
    "name, want",
    [
        ("Dr. Ana Q Diaz", ("Ana", "Diaz")),
        ("Dr Ana Diaz", ("Ana", "Diaz")),
        ("doctor Diaz", ("", "Diaz")),
        ("DRA. Diaz", ("", "Diaz")),
        ("Dr.", ("", "")),
        ("Dr. A B MD", ("A", "MD")),
        ("Ana Q Diaz, MD", ("Ana", "Diaz")),
        ("Ana Diaz NP", ("Ana", "Diaz")),
        ("Diaz,md", ("", "Diaz")),
        ("MD", ("", "")),
        ("Ana Diaz", ("Ana", "Diaz")),
        ("Ana Q. Diaz", ("Ana", "Diaz")),
        ("Diaz", ("", "")),
        ("A B C D", ("", "")),
        ("Dr A B C D", ("", "")),
        (" ., ", ("", "")),
        ("", ("", "")),
        ("  Ana\t Diaz ", ("Ana", "Diaz")),
        ("安娜 迪亚斯", ("安娜", "迪亚斯")),
    ],
)
def test_provider_names(spark, name, want):
    got = values(spark, lambda c: names.first_last(names.name_tokens(c)), [name])[0]
    assert (got["first"], got["last"]) == want
