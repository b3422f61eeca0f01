"""The library's tables as projections of the driver's star schema.

Every column is one expression that Spark and DuckDB read alike, so a query and
its SQL equivalent start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: View: (source, {column: expression}).
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "hx_games": ("supplier", {
        "game_id": "cast(2025020000 + s_suppkey as bigint)",
        "season": "cast(case when s_suppkey % 10 = 0 then 20092010 else 20252026 end as int)",
        "game_type": "cast(case when s_suppkey % 7 = 0 then 3 when s_suppkey % 13 = 0 then 1 else 2 end as int)",
        "game_state": "case when s_suppkey % 11 = 0 then 'FUT' else 'OFF' end",
        "game_date": "cast(date '2024-01-01' + cast(s_suppkey % 30 as int) as date)",
        "home_team_id": "cast(1 as bigint)",
        "away_team_id": "cast(2 as bigint)",
    }),
    "hx_shifts": ("lineitem", {
        "game_id": "cast(2025020000 + l_suppkey as bigint)",
        "source_shift_id": "cast(l_orderkey as bigint) * 1000000 + l_partkey * 10 + l_linenumber",
        "order_key": "cast(l_orderkey as bigint)",
        "player_id": "cast(l_partkey % 40 as bigint)",
        "team_id": "cast(case when l_partkey % 40 < 20 then 1 else 2 end as bigint)",
        "role": "case when l_partkey % 20 < 2 then 'goalie' else 'skater' end",
        "period": "cast(1 + l_linenumber % 3 as int)",
        "start_s": "cast(floor(l_extendedprice) as bigint) % 1200",
        "end_s": "least(1200, cast(floor(l_extendedprice) as bigint) % 1200"
                 " + case when l_orderkey % 17 = 0 then 0 else cast(2 * l_quantity as bigint) end)",
    }),
    "hx_events": ("events, n_suppliers", {
        "game_id": "cast(2025020000 + event_id % n as bigint)",
        "event_id": "cast(event_id as bigint)",
        "season": "cast(case when (event_id % n) % 10 = 0 then 20092010 else 20252026 end as int)",
        "period": "cast(1 + cast(floor(value) as bigint) % 3 as int)",
        "sec": "cast((minute(ts) % 20) * 60 + second(ts) as bigint)",
        "event_type": "case event_type when 'view' then 'shot-on-goal' when 'click' then 'hit' when 'purchase' then 'goal'"
                      " when 'signup' then 'faceoff' else 'penalty' end",
        "situation_code": "case event_id % 6 when 0 then '1551' when 1 then '1451' when 2 then '1541' when 3 then '0651'"
                          " when 4 then '155x' end",
        "owner_team_id": "cast(1 + event_id % 2 as bigint)",
        "player_id": "cast(user_id as bigint)",
    }),
    "hx_attempts": ("events, n_suppliers", {
        "attempt_id": "cast(event_id as bigint)",
        "dataset": "'events'",
        "entity_key": "cast(2025020000 + event_id % n as string)",
        "started_at": "cast(ts as timestamp)",
        "outcome": "case event_type when 'purchase' then 'complete' when 'error' then 'failed' when 'signup' then 'partial'"
                   " when 'view' then 'unavailable' else 'running' end",
        "finished_at": "case when event_type = 'click' then null else cast(ts as timestamp) end",
    }),
}


def _view(tables: dict[str, DataFrame], name: str) -> DataFrame:
    source, columns = VIEWS[name]
    base = tables[source.split(",")[0]]
    if "n_suppliers" in source:
        base = base.crossJoin(F.broadcast(tables["supplier"].agg(F.count(F.lit(1)).alias("n"))))  # one row
    return base.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One ``hx_*`` view, or a driver table, as a DataFrame."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    if name == "hx_shifts_raw":
        return raw_shifts(view(spark, sf_dir, "hx_shifts"))
    if name == "hx_official":
        return official(view(spark, sf_dir, "hx_shifts"))
    if name == "hx_revisions":
        return revisions(read("orders"), read("lineitem"))
    if name not in VIEWS:
        return read(name)
    names = {t.strip() for t in VIEWS[name][0].replace("n_suppliers", "supplier").split(",")}
    return _view({t: read(t) for t in names}, name)


_RAW = {
    "game_id": "game_id", "source_shift_id": "source_shift_id",
    "player_id": "case when order_key % 51 = 0 then null else player_id end",
    "nhl_team_id": "case when order_key % 53 = 0 then 99 else team_id end",
    "team_id": "case when order_key % 53 = 0 then null else team_id end",
    "position": "case when role = 'goalie' then 'G' else 'C' end",
    "type_code": "cast(517 as int)", "period": "period",
    "start_time": "case when order_key % 59 = 0 then {end} else {start} end",
    "end_time": "case when order_key % 50 = 0 then 'bad' when order_key % 59 = 0 then {start} else {end} end",
    "duration": "{duration}",
}


def _clock(x: str) -> str:
    return f"lpad(cast(cast(floor(({x}) / 60) as bigint) as string), 2, '0') || ':' || lpad(cast(({x}) % 60 as string), 2, '0')"


def _raw_columns() -> dict[str, str]:
    parts = {"start": _clock("start_s"), "end": _clock("end_s"), "duration": _clock("end_s - start_s")}
    return {c: e.format(**parts) for c, e in _RAW.items()}


def raw_shifts(shifts: DataFrame) -> DataFrame:
    """Shifts as text, with planted faults."""
    return shifts.selectExpr(*[f"{e} AS {c}" for c, e in _raw_columns().items()])




def official(shifts: DataFrame) -> DataFrame:
    """Official totals per game and player, some off, invalid or missing."""
    totals = shifts.groupBy("game_id", "player_id").agg(
        F.sum(F.col("end_s") - F.col("start_s")).alias("t"), F.min("role").alias("player_type")
    )
    return totals.where("(game_id + player_id) % 37 <> 0").selectExpr(
        "game_id", "player_id", "player_type",
        "cast(case when (game_id + player_id) % 41 = 0 then -1 else t + player_id % 3 - 1 end as bigint) AS toi_s",
    )


def revisions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Each customer's orders as revisions of a nested set of facts, in long form."""
    numbered = orders.select(
        F.col("o_custkey").cast("string").alias("entity_key"), F.col("o_orderdate").cast("date").alias("recorded_at"), "o_orderkey",
        F.expr("dense_rank() over (partition by o_custkey order by o_orderdate, o_orderkey)").cast("int").alias("revision"),
    )
    return (
        numbered.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
        # an order is a revision: with its key, by which the join has dealt the rows, they are added up where they are
        .groupBy("o_orderkey", "entity_key", "revision", "recorded_at", (F.col("l_linenumber") % 4).cast("int").alias("player_id"),
                 F.col("l_returnflag").alias("stat_code"))
        .agg(F.sum("l_quantity").cast("double").alias("stat_value")).drop("o_orderkey")
    )


def sql(*names: str) -> str:
    """``WITH`` clause that defines views for DuckDB, with those they need."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name in parts:
            return
        if name == "hx_shifts_raw":
            add("hx_shifts")
            parts[name] = f"SELECT {', '.join(f'{e} AS {c}' for c, e in _raw_columns().items())} FROM hx_shifts"
        elif name == "hx_official":
            add("hx_shifts")
            parts[name] = (
                "SELECT game_id, player_id, player_type, cast(case when (game_id + player_id) % 41 = 0 then -1"
                " else t + player_id % 3 - 1 end as bigint) AS toi_s FROM (SELECT game_id, player_id,"
                " sum(end_s - start_s) AS t, min(role) AS player_type FROM hx_shifts GROUP BY ALL)"
                " WHERE (game_id + player_id) % 37 <> 0"
            )
        elif name == "hx_revisions":
            parts[name] = (
                "SELECT entity_key, revision, recorded_at, cast(l_linenumber % 4 as int) AS player_id,"
                " l_returnflag AS stat_code, cast(sum(l_quantity) as double) AS stat_value FROM"
                " (SELECT cast(o_custkey as varchar) AS entity_key, cast(o_orderdate as date) AS recorded_at, o_orderkey,"
                " cast(dense_rank() over (partition by o_custkey order by o_orderdate, o_orderkey) as int) AS revision FROM orders)"
                " JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"
            )
        else:
            source, columns = VIEWS[name]
            source = source.replace("n_suppliers", "(SELECT count(*) AS n FROM supplier)")
            parts[name] = f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}"

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in parts.items()) + "\n"
