"""Which keys are selected."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from slotline.operators import candidates

GAME = "game_id long, game_type int, game_state string, game_date date"


def day(text="2024-01-20"):
    return F.lit(text).cast("date")


@pytest.fixture(scope="module")
def tables(spark):
    """Seven past games without events by state of progress, one with events, others out of reach."""
    far, near = date(2023, 12, 1), date(2024, 1, 18)
    games = [(i, 2, "OFF", far) for i in range(1, 9)]
    games += [(20, 2, "OFF", near), (21, 2, "LIVE", near), (22, 1, "OFF", near), (23, 3, "FINAL", date(2024, 1, 21)), (24, 2, "OFF", None)]
    progress = [(1, "done"), (2, "skipped"), (3, "failed"), (4, "pending"), (20, "done")]
    attempts = [(1, "1", "complete"), (2, "6", "running"), (3, "7", "failed"), (4, "7", "complete"), (5, "2", "failed")]
    return (
        spark.createDataFrame(games, GAME), spark.createDataFrame([(5,), (6,), (7,), (8,)], "game_id long"),
        spark.createDataFrame([("events", k, i, datetime(2024, 1, 1), datetime(2024, 1, 1), o) for i, k, o in attempts], "dataset string, entity_key string, attempt_id long, started_at timestamp, finished_at timestamp, outcome string"),
        spark.createDataFrame(progress, "game_id long, state string"),
    )


def chosen(df):
    return sorted(r.game_id for r in df.collect())


def test_event_candidates(tables):
    # 3 and 4 have neither events nor an acknowledgement, 6 runs, 2 is acknowledged but failed, 20 is recent
    assert chosen(candidates.event_candidates(*tables, day())) == [2, 3, 4, 6, 20]


def test_window_length(tables):
    assert chosen(candidates.event_candidates(*tables, day(), days=0)) == [2, 3, 4, 6]
    assert chosen(candidates.event_candidates(*tables, day(), days=60)) == [1, 2, 3, 4, 5, 6, 7, 8, 20]
    with pytest.raises(ValueError):
        candidates.event_candidates(*tables, day(), days=367)


def test_explicit_date_overrides_all_reasons(tables):
    assert chosen(candidates.event_candidates(*tables, day(), since=day("2023-12-02"))) == [20]
    assert chosen(candidates.event_candidates(*tables, day(), since=day("2023-12-01"))) == [1, 2, 3, 4, 5, 6, 7, 8, 20]
