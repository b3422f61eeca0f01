"""Clocks, situation codes, strengths and seasons."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from slotline.functions import scalars as s


def one(spark, column):
    """A column's value over one row."""
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "seconds"),
    [("20:00", 1200), ("", None), ("-1:00", None), ("00:60", None), ("1:2", None), (" 01:00", None), ("01:00:00", None), ("999999999999:00", None)],
)
def test_strict_clock(spark, text, seconds):
    assert one(spark, s.clock_seconds(F.lit(text))) == seconds


def test_lenient_clock_accepts_signs_and_short_seconds(spark):
    assert one(spark, s.lenient_clock(F.lit("1:2"))) == 62
    assert one(spark, s.lenient_clock(F.lit("-1:00"))) == -60
    assert one(spark, s.lenient_clock(F.lit("bad"))) is None


@pytest.mark.parametrize(
    ("game_type", "period", "kind", "text", "second"),
    [(2, 4, "OT", "05:00", 3900), (2, 4, "OT", "05:01", None), (2, 5, "SO", "00:00", None), (3, 4, "REG", "05:00", None), (3, 5, "OT", "20:00", 6000)],
)
def test_event_clock(spark, game_type, period, kind, text, second):
    got = one(spark, s.event_clock(F.lit(game_type), F.lit(period), F.lit(kind), F.lit(text)))
    assert (got and got["game_seconds"]) == second


@pytest.mark.parametrize("code", ["1551", "1451", "1541", "0651", "1560", "1331", "1341", "0641"])
def test_valid_codes(spark, code):
    assert tuple(one(spark, s.decode_situation(F.lit(code)))) == tuple(int(x) for x in code)


@pytest.mark.parametrize("code", ["", "155", "15511", "15x1", "2551", "1552"])
def test_invalid_codes(spark, code):
    assert one(spark, s.decode_situation(F.lit(code))) is None


@pytest.mark.parametrize(
    ("code", "home", "away"), [("1451", "pp", "sh"), ("0651", "ev", "ev"), ("0641", "sh", "pp"), ("1331", "ev", "ev"), ("1341", "pp", "sh"), ("1441", "ev", "ev")]
)
def test_owner_strength(spark, code, home, away):
    got = [one(spark, s.owner_strength(s.decode_situation(F.lit(code)), F.lit(x))) for x in (True, False)]
    assert got == [home, away]
    assert one(spark, s.owner_strength(s.decode_situation(F.lit(code)), F.lit(None).cast("boolean"))) is None


def test_precedence_of_strength(spark):
    code = s.decode_situation(F.lit("1451"))
    none = s.decode_situation(F.lit("bad"))
    goal, owner = F.lit(True), F.lit(True)
    assert tuple(one(spark, s.resolve_strength(code, F.lit(None).cast("boolean"), goal, F.lit("sh"), F.lit("ev")))) == (None, "situation_code")
    assert tuple(one(spark, s.resolve_strength(none, owner, goal, F.lit("sh"), F.lit("ev")))) == ("sh", "scoring_summary")
    assert tuple(one(spark, s.resolve_strength(none, owner, F.lit(False), F.lit("sh"), F.lit("ev")))) == ("ev", "html_report")


def test_seasons(spark):
    day = F.to_date(F.lit("2025-09-15"))
    assert one(spark, s.season_of(day)) == 20242025
    assert one(spark, s.season_of(F.to_date(F.lit("2025-03-01")))) == 20242025
    assert one(spark, s.active_seasons(day)) == [20242025, 20252026]
    assert one(spark, s.season_start(F.lit(2025020001))) == 2025
    assert one(spark, s.report_key(F.lit(2025020001))) == "020001"


def test_names_and_lists(spark):
    assert one(spark, s.canonical_abbreviation(F.lit("t.b"))) == "TBL"
    assert one(spark, s.report_event_type(F.lit(" penl "))) == "penalty"
    assert one(spark, s.listed(F.lit("BOS"), F.lit("NYR, BOS"))) is True
    assert one(spark, s.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, s.report_clock(F.lit("1:05"))) == "01:05"
    assert one(spark, s.report_clock(F.lit("1:75"))) is None
    assert one(spark, s.described_team(F.lit("(TOR) shot"))) == "TOR"
    assert one(spark, s.described_team(F.lit("Longname"))) is None
    assert one(spark, s.optional_team(F.lit("N/A"))) is None
    assert one(spark, s.report_side(F.lit("T.B"), F.lit("TBL"), F.lit("NYR"))) is True
