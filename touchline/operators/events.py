"""Match events to player-match and player-season facts: one scan with conditional aggregates for all categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.core import DEF_THIRD, MID_THIRD, enters_box, enters_final_third, has_qualifier, in_box, pct
from touchline.operators.tables import most_frequent

# Event types of the feed.
PASS_TYPES = ["Pass", "BlockedPass", "OffsidePass"]
SHOT_TYPES = ["MissedShots", "SavedShot", "Goal", "ShotOnPost"]
GOAL_MOUTH = ["GoalMouthY", "GoalMouthZ"]
KEYS = ["game_id", "player", "team", "player_id"]

QUALIFIER = T.StructType([T.StructField("type", T.StructType([T.StructField("displayName", T.StringType())])), T.StructField("value", T.StringType())])
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("minute", T.IntegerType()),
        T.StructField("second", T.IntegerType()),
        T.StructField("teamId", T.LongType()),
        T.StructField("playerId", T.LongType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("endX", T.DoubleType()),
        T.StructField("endY", T.DoubleType()),
        T.StructField("type", T.StructType([T.StructField("displayName", T.StringType())])),
        T.StructField("outcomeType", T.StructType([T.StructField("displayName", T.StringType())])),
        T.StructField("isTouch", T.BooleanType()),
        T.StructField("isGoal", T.BooleanType()),
        T.StructField("isShot", T.BooleanType()),
        T.StructField("qualifiers", T.ArrayType(QUALIFIER)),
    ]
)


def flatten_events(raw: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Nested feed rows (game_id and RAW_SCHEMA) to flat events; names by (player_id, player) and (team_id, team)."""
    flat = raw.select(
        "game_id", "minute", "second", F.col("teamId").alias("team_id"), F.col("playerId").alias("player_id"), "x", "y", F.col("endX").alias("end_x"), F.col("endY").alias("end_y"),
        F.col("type.displayName").alias("type"), F.col("outcomeType.displayName").alias("outcome_type"),
        F.coalesce("isTouch", F.lit(False)).alias("is_touch"), F.coalesce("isGoal", F.lit(False)).alias("is_goal"), F.coalesce("isShot", F.lit(False)).alias("is_shot"), "qualifiers",
    )
    return flat.join(players, "player_id", "left").join(teams, "team_id", "left")


def name_dictionary(df: DataFrame, column: str) -> DataFrame:
    """(player_id, player) of a JSON object that maps ids to names."""
    return df.select(F.explode(F.from_json(column, "map<string,string>")).alias("k", "player")).select(F.col("k").cast("long").alias("player_id"), "player")


def usable(events: DataFrame) -> DataFrame:
    """Rows of matches that have at least one typed event."""
    return events.join(events.groupBy("game_id").agg(F.count("type").alias("_n")).where("_n > 0").select("game_id"), "game_id", "left_semi")


def _is(types: list[str] | str) -> Column:
    return F.col("type").isin([types] if isinstance(types, str) else types)


def _n(p: Column) -> Column:
    return F.count_if(F.coalesce(p, F.lit(False)))


def match_stats(events: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """All twelve categories of player-match counts in one aggregation."""
    ok = F.col("outcome_type") == "Successful"
    passes, done = _is(PASS_TYPES), _is("Pass") & ok
    touch, shot = F.col("is_touch"), _is(SHOT_TYPES)
    on_target = _is("Goal") | (_is("SavedShot") & has_qualifier("qualifiers", GOAL_MOUTH))
    x = F.col("x")
    zone = {"def_3rd": x <= DEF_THIRD, "mid_3rd": (x > DEF_THIRD) & (x <= MID_THIRD)}
    # a missing x falls to the attacking third
    att = ~F.coalesce(x <= MID_THIRD, F.lit(False))
    zones = lambda name, p: [_n(p & z).alias(f"{name}_{k}") for k, z in zone.items()] + [_n(p & att).alias(f"{name}_att_3rd")]
    agg = [
        _n(passes).alias("passes"), _n(done).alias("passes_completed"),
        F.count(F.when(touch, x)).alias("touches"), *zones("touches", touch),
        _n(touch & in_box("x", "y", False)).alias("touches_def_pen_area"), _n(touch & in_box("x", "y", True)).alias("touches_att_pen_area"),
        _n(_is("TakeOn")).alias("take_ons"), _n(_is("TakeOn") & ok).alias("take_ons_won"), _n(_is("Dispossessed")).alias("dispossessed"),
        _n(_is("Tackle")).alias("tackles"), _n(_is("Tackle") & ok).alias("tackles_won"), *zones("tackles", _is("Tackle")),
        _n(_is("Interception")).alias("interceptions"), *zones("interceptions", _is("Interception")),
        _n(_is("Clearance")).alias("clearances"), _n(_is("Challenge")).alias("dribbled_past"), _n(_is("Error")).alias("errors"),
        _n(done & enters_final_third("end_x")).alias("final_third_entries"), _n(done & enters_box("end_x", "end_y")).alias("pen_area_entries"),
        _n(_is("Aerial")).alias("aerials"), _n(_is("Aerial") & ok).alias("aerials_won"),
        _n(shot).alias("shots"), _n(on_target).alias("shots_on_target"),
    ]
    return with_percentages(events.dropna(subset=["player"]).groupBy(*keys).agg(*agg))


def with_percentages(stats: DataFrame) -> DataFrame:
    """Percentages from summed numerators and denominators, never averaged."""
    for name, top, bottom in (("passes_pct", "passes_completed", "passes"), ("take_ons_won_pct", "take_ons_won", "take_ons"), ("aerial_duel_win_pct", "aerials_won", "aerials"), ("shots_on_target_pct", "shots_on_target", "shots")):
        stats = stats.withColumn(name, pct(top, bottom))
    return stats


def season_stats(matches: DataFrame, keys: list[str], name: str = "player") -> DataFrame:
    """Roll player-match rows up by identity keys: sums, distinct matches, commonest name, recomputed percentages."""
    parts = [c for c, t in matches.dtypes if t == "bigint" and c not in (*keys, "game_id", "player_id", "team_id")]
    total = matches.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts], F.count_distinct("game_id").alias("matches_with_data"))
    return with_percentages(total.join(most_frequent(matches, keys, name), keys))


def qualifier_names(events: DataFrame) -> DataFrame:
    return events.select(F.explode("qualifiers").alias("q")).select(F.col("q.type.displayName").alias("name")).distinct()


def qualifier_overlap(events: DataFrame, group: list[str]) -> DataFrame:
    """(a, b, n): how often two qualifiers of a group stand on one event."""
    tags = F.array_sort(F.array_intersect(F.transform("qualifiers", lambda q: q["type"]["displayName"]), F.array(*[F.lit(g) for g in group])))
    one = events.select(tags.alias("t")).select("t", F.explode("t").alias("a"))
    return one.select("a", F.explode("t").alias("b")).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


def paired_at_moment(events: DataFrame) -> DataFrame:
    """Events of two teams at the same second, first with first, second with second, in id order."""
    w = Window.partitionBy("game_id", "minute", "second", "team_id").orderBy("event_id")
    e = events.withColumn("_r", F.row_number().over(w))
    a, b = e.alias("a"), e.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("game_id", "minute", "second", "_r")]
    return a.join(b, same[0] & same[1] & same[2] & same[3] & (F.col("a.team_id") < F.col("b.team_id"))).select(F.col("a.event_id").alias("event_a"), F.col("b.event_id").alias("event_b"), F.col("a.game_id").alias("game_id"))


def opposite_event(events: DataFrame, name: str = "OppositeRelatedEvent") -> DataFrame:
    """Each event with the event that its qualifier refers to within the match and other team."""
    ref = F.element_at(F.filter("qualifiers", lambda q: q["type"]["displayName"] == name), 1)["value"].try_cast("long")
    e = events.withColumn("opposite_id", ref)
    other = events.select("game_id", F.col("event_id").alias("opposite_id"), F.col("team_id").alias("_team"), F.col("type").alias("opposite_type"))
    return e.join(other, ["game_id", "opposite_id"], "left").where(F.col("_team").isNull() | (F.col("_team") != F.col("team_id"))).drop("_team")
