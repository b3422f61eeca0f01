"""Clocks, situation codes, strengths and seasons as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_SUPPORTED_SEASON = 20102011
COMPLETED = ("OFF", "OVER", "FINAL")
#: Report spellings of event types.
REPORT_TYPES = {
    "GOAL": "goal",
    "SHOT": "shot-on-goal", "SHOT (!)": "shot-on-goal",
    "MISS": "missed-shot", "MISSED SHOT": "missed-shot",
    "BLOCK": "blocked-shot", "BLOCKED SHOT": "blocked-shot",
    "HIT": "hit", "HIT (!)": "hit",
    "GIVE": "giveaway", "GIVEAWAY": "giveaway",
    "TAKE": "takeaway", "TAKEAWAY": "takeaway",
    "FAC": "faceoff", "FACE-OFF": "faceoff",
    "PENL": "penalty", "PENALTY": "penalty",
    "STOP": "stoppage", "STOPPAGE": "stoppage",
    "PSTR": "period-start", "PEND": "period-end", "GEND": "game-end",
    "SOC": "shootout-complete", "GOALIE": "goalie-change",
}


def clock_seconds(text: Column) -> Column:
    """Strict ``M:SS`` to seconds; null for signs, blanks, one-digit or over-59 seconds, and overflow."""
    minutes = F.substring_index(text, ":", 1).try_cast("long")
    seconds = F.substring_index(text, ":", -1).substr(1, 2).try_cast("long")
    return F.when(
        text.rlike(r"^[0-9]+:[0-5][0-9]$"), F.expr("1L") * F.try_add(F.try_multiply(minutes, F.lit(60).cast("long")), seconds)
    ).try_cast("int")


def lenient_clock(text: Column) -> Column:
    """``M:S`` to seconds as ingestion reads it: signs and one-digit seconds pass."""
    parts = F.split(text, ":")
    return F.when(
        F.size(parts) == 2,
        F.try_add(
            F.try_multiply(parts[0].try_cast("int"), F.lit(60)), parts[1].try_cast("int")
        ),
    )


def report_clock(text: Column) -> Column:
    """A report's clock as ``mm:ss``; null for anything else."""
    part = lambda k: F.regexp_extract(text, r"^([0-9]+):([0-9]+)$", k).try_cast("int")
    padded = F.concat(F.format_string("%02d", part(1)), F.lit(":"), F.format_string("%02d", part(2)))
    return F.when(text.rlike(r"^[0-9]+:[0-9]+$") & (part(2) <= 59) & part(1).isNotNull(), padded)


def period_length(game_type: Column, period: Column) -> Column:
    """Seconds of a period: regulation 1200, overtime 300, in the playoffs 1200; null for no such period or game type."""
    return (
        F.when(game_type.isin(2, 3) & period.between(1, 3), 1200)
        .when((game_type == 2) & (period == 4), 300)
        .when((game_type == 3) & (period >= 4), 1200)
    )


def event_clock(game_type: Column, period: Column, period_type: Column, text: Column) -> Column:
    """(period, period_seconds, game_seconds) of an event, null if type, period and time don't fit."""
    seconds, length = clock_seconds(text), period_length(game_type, period)
    fits = ((period_type == "REG") & (period <= 3)) | ((period_type == "OT") & (period >= 4))
    return F.when(
        fits & (seconds <= length),
        F.struct(
            period.alias("period"), seconds.alias("period_seconds"), ((period - 1) * 1200 + seconds).alias("game_seconds")
        ),
    )


def decode_situation(code: Column) -> Column:
    """``[away goalie][away skaters][home skaters][home goalie]`` as a struct; null if invalid."""
    digit = lambda k: F.substring(code, k, 1).cast("int")
    return F.when(
        code.rlike("^[01][0-9]{2}[01]$"),
        F.struct(
            digit(1).alias("away_goalie"), digit(2).alias("away_skaters"), digit(3).alias("home_skaters"),
            digit(4).alias("home_goalie"),
        ),
    )


def owner_strength(situation: Column, owner_is_home: Column) -> Column:
    """pp, sh or ev from the owner's side; a pulled goalie's extra skater doesn't count."""
    home = situation["home_skaters"] - F.when(situation["home_goalie"] == 0, 1).otherwise(0)
    away = situation["away_skaters"] - F.when(situation["away_goalie"] == 0, 1).otherwise(0)
    edge = F.when(owner_is_home, home - away).otherwise(away - home)
    return F.when(owner_is_home.isNull() | situation.isNull(), None).otherwise(
        F.when(edge > 0, "pp").when(edge < 0, "sh").otherwise("ev")
    )


def resolve_strength(situation: Column, owner_is_home: Column, is_goal: Column, summary: Column, report: Column) -> Column:
    """(strength, source) by precedence: situation code, scoring summary (goals), report, unavailable."""
    from_code = F.struct(owner_strength(situation, owner_is_home).alias("strength"), F.lit("situation_code").alias("source"))
    of = lambda c, s: F.struct(c.alias("strength"), F.lit(s).alias("source"))
    return (
        F.when(situation.isNotNull(), from_code)
        .when(is_goal & summary.isNotNull(), of(summary, "scoring_summary"))
        .when(report.isNotNull(), of(report, "html_report"))
        .otherwise(of(F.lit(None).cast("string"), "unavailable"))
    )


def owner_side(owner: Column, home: Column, away: Column) -> Column:
    """True for home, false for away, null for any other owner."""
    return F.when(owner == home, True).when(owner == away, False)


def invert_strength(strength: Column) -> Column:
    """pp and sh changed for each other."""
    return F.when(strength == "pp", "sh").when(strength == "sh", "pp").otherwise(strength)


def is_completed(state: Column) -> Column:
    """Whether a game is over."""
    return state.isin(*COMPLETED)


def is_supported_type(game_type: Column) -> Column:
    """Whether the source's game type is one that is stored: preseason, season, playoffs, all-star."""
    return game_type.isin(1, 2, 3, 4)


def is_analysed_type(game_type: Column) -> Column:
    """Whether games of this type are analysed: season and playoffs."""
    return game_type.isin(2, 3)


def position_role(position: Column) -> Column:
    """goalie, skater or unknown from a position letter."""
    return F.when(position == "G", "goalie").when(position.isin("C", "L", "R", "LW", "RW", "D", "F"), "skater").otherwise("unknown")


def season_of(date: Column) -> Column:
    """Season code of a date; a season begins in October."""
    first = F.year(date) - F.when(F.month(date) < 10, 1).otherwise(0)
    return (first * 10000 + first + 1).cast("int")


def active_seasons(date: Column) -> Column:
    """Seasons that may change on a date: in September the one that ends and the one that begins."""
    now = season_of(date)
    return F.when(F.month(date) == 9, F.array(now, now + 10001)).otherwise(F.array(now))


def season_start(game_id: Column) -> Column:
    """First year of a game's season."""
    return F.floor(game_id / 1_000_000).cast("int")


def report_key(game_id: Column) -> Column:
    """Six digits that name a game's report."""
    return F.format_string("%06d", game_id % 1_000_000)


def canonical_abbreviation(text: Column) -> Column:
    """Letters and digits in upper case, old spellings mapped. Aliases are fixed values."""
    bare = F.upper(F.regexp_replace(text, "[^A-Za-z0-9]", ""))
    return F.when(bare == "LA", "LAK").when(bare == "NJ", "NJD").when(bare == "SJ", "SJS").when(bare == "TB", "TBL").otherwise(bare)


def report_event_type(text: Column) -> Column:
    """Canonical event type of a report's spelling; null if unknown."""
    names = F.create_map(*[F.lit(x) for pair in REPORT_TYPES.items() for x in pair])
    return F.try_element_at(names, F.upper(F.trim(text)))


def described_team(description: Column) -> Column:
    """The team a description begins with: its first word without marks, if that has two to four characters."""
    first = F.regexp_replace(F.try_element_at(F.split(F.trim(description), r"\s+"), F.lit(1)), "^[^A-Za-z0-9]+|[^A-Za-z0-9]+$", "")
    return F.when(F.length(first).between(2, 4), first)


def optional_team(text: Column) -> Column:
    """A team's spelling; null where empty or N/A."""
    return F.when(~F.trim(text).isin("", "N/A"), F.trim(text))


def report_side(team: Column, home: Column, away: Column) -> Column:
    """True for home, false for away, by canonical abbreviations."""
    name = canonical_abbreviation(team)
    return F.when(name == canonical_abbreviation(home), True).when(name == canonical_abbreviation(away), False)


def listed(member: Column, comma_list: Column) -> Column:
    """Whether a comma-separated list holds a member."""
    return F.array_contains(F.transform(F.split(comma_list, ","), lambda x: F.trim(x)), member)


def ratio(part: Column, whole: Column, empty: float | None = None) -> Column:
    """part / whole, or ``empty`` where whole is zero."""
    return F.when(whole == 0, F.lit(empty).cast("double")).otherwise(part.cast("double") / whole)


def overlap_seconds(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Length of two intervals' intersection, 0 at least."""
    return F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(start_a, start_b))
