"""Fixed reference data: which franchise a source's team is, and from which season on each event type is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Source team id, franchise id, abbreviation, name.
TEAM_IDENTITIES = (
    (1, 23, "NJD", "New Jersey Devils"), (2, 22, "NYI", "New York Islanders"), (3, 10, "NYR", "New York Rangers"),
    (4, 16, "PHI", "Philadelphia Flyers"), (5, 17, "PIT", "Pittsburgh Penguins"), (6, 6, "BOS", "Boston Bruins"), (7, 19, "BUF", "Buffalo Sabres"),
    (8, 1, "MTL", "Montréal Canadiens"), (9, 30, "OTT", "Ottawa Senators"), (10, 5, "TOR", "Toronto Maple Leafs"),
    (11, 35, "ATL", "Atlanta Thrashers"), (12, 26, "CAR", "Carolina Hurricanes"), (13, 33, "FLA", "Florida Panthers"),
    (14, 31, "TBL", "Tampa Bay Lightning"), (15, 24, "WSH", "Washington Capitals"), (16, 11, "CHI", "Chicago Blackhawks"),
    (17, 12, "DET", "Detroit Red Wings"), (18, 34, "NSH", "Nashville Predators"), (19, 18, "STL", "St. Louis Blues"),
    (20, 21, "CGY", "Calgary Flames"), (21, 27, "COL", "Colorado Avalanche"), (22, 25, "EDM", "Edmonton Oilers"),
    (23, 20, "VAN", "Vancouver Canucks"), (24, 32, "ANA", "Anaheim Ducks"), (25, 15, "DAL", "Dallas Stars"), (26, 14, "LAK", "Los Angeles Kings"),
    (27, 28, "PHX", "Phoenix Coyotes"), (28, 29, "SJS", "San Jose Sharks"), (29, 36, "CBJ", "Columbus Blue Jackets"),
    (30, 37, "MIN", "Minnesota Wild"), (31, 15, "MNS", "Minnesota North Stars"), (32, 27, "QUE", "Quebec Nordiques"),
    (33, 35, "WIN", "Winnipeg Jets (1979)"), (34, 26, "HFD", "Hartford Whalers"), (35, 23, "CLR", "Colorado Rockies"),
    (36, 3, "SEN", "Ottawa Senators (1917)"), (37, 4, "HAM", "Hamilton Tigers"), (38, 9, "PIR", "Pittsburgh Pirates"),
    (39, 9, "QUA", "Philadelphia Quakers"), (40, 12, "DCG", "Detroit Cougars"), (41, 2, "MWN", "Montreal Wanderers"),
    (42, 4, "QBD", "Quebec Bulldogs"), (43, 7, "MMR", "Montreal Maroons"), (44, 8, "NYA", "New York Americans"), (45, 3, "SLE", "St. Louis Eagles"),
    (46, 13, "OAK", "Oakland Seals"), (47, 21, "AFM", "Atlanta Flames"), (48, 23, "KCS", "Kansas City Scouts"), (49, 13, "CLE", "Cleveland Barons"),
    (50, 12, "DFL", "Detroit Falcons"), (51, 8, "BRK", "Brooklyn Americans"), (52, 35, "WPG", "Winnipeg Jets"), (53, 28, "ARI", "Arizona Coyotes"),
    (54, 38, "VGK", "Vegas Golden Knights"), (55, 39, "SEA", "Seattle Kraken"), (56, 13, "CGS", "California Golden Seals"),
    (57, 5, "TAN", "Toronto Arenas"), (58, 5, "TSP", "Toronto St. Patricks"), (59, 40, "UTA", "Utah Hockey Club"), (68, 40, "UTA", "Utah Mammoth"),
)
#: Event types and the first season that declares them.
EVENT_SEASONS = {
    "blocked-shot": 20092010, "delayed-penalty": 20192020, "faceoff": 20092010, "giveaway": 20092010, "goal": 19171918, "hit": 20092010,
    "missed-shot": 20092010, "penalty": 19171918, "shot-on-goal": 19971998, "stoppage": 20092010, "takeaway": 20092010,
}


def team_identities(spark: SparkSession) -> DataFrame:
    """(nhl_team_id, franchise_id, abbrev, full_name) of every source team."""
    return spark.createDataFrame(TEAM_IDENTITIES, "nhl_team_id long, franchise_id long, abbrev string, full_name string")


def coverage_catalog(spark: SparkSession, declared: dict[str, int | None] = EVENT_SEASONS) -> DataFrame:
    """(event_type, declared_season): what the archive claims to hold."""
    return spark.createDataFrame(list(declared.items()), "event_type string, declared_season int")
