"""Season schedules: validation, regular-season matches by sequential caps, manifests."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.tables import most_frequent

REQUIRED = ["game_id", "date", "home_team", "away_team"]


def validate(schedule: DataFrame) -> None:
    """Raises if columns are missing, dates or teams are NULL or ids repeat."""
    if lost := [c for c in REQUIRED if c not in schedule.columns]:
        raise ValueError(f"missing columns: {lost}")
    r = schedule.agg(F.count_if(F.expr("date is null or home_team is null or away_team is null")).alias("nulls"), F.count("*").alias("n"), F.count_distinct("game_id").alias("ids")).first()
    if r.nulls or r.n != r.ids:
        raise ValueError(f"{r.nulls} rows without date or team, {r.n - r.ids} repeated ids")


def capped(schedule: DataFrame, cap: int | None = 34, season: str = "season_id") -> DataFrame:
    """Rows in date order (ties by id) while both clubs are below cap; `regular` says which stay.

    The two counters of a match interact, so this is sequential by nature: one bounded group (a season) per task.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["date", "game_id"], kind="mergesort")
        seen: Counter = Counter()
        keep = []
        for h, a in zip(pdf["home_team"], pdf["away_team"], strict=True):
            ok = cap is None or (seen[h] < cap and seen[a] < cap)
            keep.append(ok)
            if ok:
                seen[h] += 1
                seen[a] += 1
        return pdf.assign(regular=keep)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schedule.schema) + ", regular boolean"
    return schedule.groupBy(season).applyInPandas(run, schema)


def matches_per_club(schedule: DataFrame, season: str = "season_id") -> DataFrame:
    both = schedule.select(season, F.col("home_team").alias("team")).unionByName(schedule.select(season, F.col("away_team").alias("team")))
    return both.groupBy(season, "team").agg(F.count("*").alias("matches"))


def verify_caps(regular: DataFrame, cap: int | None, exact: bool = True) -> DataFrame:
    """Clubs that break the rule: other than cap matches, or more than cap when a season was cut short."""
    n = matches_per_club(regular)
    return n.where("false") if cap is None else n.where(F.col("matches") != cap if exact else F.col("matches") > cap)


def stage_label(schedule: DataFrame) -> DataFrame:
    return schedule.withColumn("stage", F.coalesce(F.nullif(F.trim("stage"), F.lit("")), F.lit("unlabelled")))


def off_stage(schedule: DataFrame, season: str = "season_id") -> DataFrame:
    """Matches whose stage isn't their season's commonest one."""
    modal = most_frequent(schedule, [season], "stage").withColumnRenamed("stage", "modal")
    return schedule.join(modal, season).where(~F.col("stage").eqNullSafe(F.col("modal")))


def duplicate_fixtures(schedule: DataFrame, files: DataFrame) -> DataFrame:
    """Fixtures listed twice, with the number of match files that exist for each row's id."""
    w = Window.partitionBy("season_id", "stage", "home_team", "away_team")
    twice = schedule.withColumn("n", F.count("*").over(w)).where("n > 1")
    return twice.join(files.select("game_id", F.lit(True).alias("has_file")).distinct(), "game_id", "left").withColumn("has_file", F.coalesce("has_file", F.lit(False)))


def diagnose(schedule: DataFrame, meetings: int = 2) -> DataFrame:
    """Pairs of clubs that met more or less often than they should."""
    pair = schedule.select("season_id", F.least("home_team", "away_team").alias("a"), F.greatest("home_team", "away_team").alias("b"))
    return pair.groupBy("season_id", "a", "b").agg(F.count("*").alias("met")).where(F.col("met") != meetings)


def manifest(schedule: DataFrame, cap: int | None) -> DataFrame:
    """(season_id, game_id, status)."""
    return capped(schedule, cap).select("season_id", "game_id", F.when(F.col("regular"), "regular").otherwise("excluded").alias("status"))


def stale_rows(existing: DataFrame, written: DataFrame, keys: list[str], play_off: DataFrame | None = None) -> DataFrame:
    """Loaded rows that the latest run did not write; with play_off, only those of its keys."""
    stale = existing.join(written.select(*keys), keys, "left_anti")
    return stale if play_off is None else stale.join(play_off.select(*keys).distinct(), keys, "left_semi")
