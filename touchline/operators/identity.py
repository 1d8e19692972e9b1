"""Identity resolution: crosswalk loads, contradictions, upserts, history, collisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.core import loose_club
from touchline.functions.fuzzy import band, jaro_winkler, pair_hint, token_sort_ratio, working_confidence
from touchline.operators.tables import insert_if_absent


def score_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Jaro-Winkler, token sort, confidence, band and hint of normalized name pairs."""
    scored = pairs.withColumn("jaro_winkler", jaro_winkler(a, b)).withColumn("token_sort", token_sort_ratio(a, b))
    return scored.withColumn("working_confidence", working_confidence("jaro_winkler", "token_sort")).withColumn("band", band("working_confidence")).withColumn("match_hint", pair_hint(a, b))


def exact_matches(scored: DataFrame, a: str, b: str) -> DataFrame:
    return scored.where("working_confidence = 1.0").select(a, b).distinct().withColumns({"match_method": F.lit("exact_normalized"), "verified": F.lit(False)})


def reviewed_matches(queue: DataFrame, a: str, b: str) -> DataFrame:
    """Rows that a person decided to be a match; blank notes are NULL."""
    yes = F.lower(F.trim("decision")) == "match"
    return queue.where(yes).select(a, b, F.nullif(F.trim("notes"), F.lit("")).alias("notes")).withColumns({"match_method": F.lit("reviewed"), "verified": F.lit(True)})


def without_contradictions(matches: DataFrame, a: str, b: str, both: bool = True) -> DataFrame:
    """Drop names matched to several partners, on one side or on both."""
    many_a = matches.groupBy(a).agg(F.count_distinct(b).alias("n")).where("n > 1").select(a)
    out = matches.join(many_a, a, "left_anti")
    if both:
        many_b = matches.groupBy(b).agg(F.count_distinct(a).alias("n")).where("n > 1").select(b)
        out = out.join(many_b, b, "left_anti")
    return out


def identity_upsert(players: DataFrame, crosswalk: DataFrame, matches: DataFrame, a: str, b: str, sources: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """(players, crosswalk): ids are reused by a's name or made after the largest; both source rows are added once.

    New ids come from ranks of the new names only, the few that no run has seen before.
    """
    known = crosswalk.where(F.col("source") == sources[0]).select("player_id", F.col("source_name").alias(a))
    fresh = matches.select(a).distinct().join(known, a, "left_anti")
    top = players.agg(F.coalesce(F.max("player_id"), F.lit(0)).alias("_top"))
    made = fresh.crossJoin(F.broadcast(top)).withColumn("player_id", F.col("_top") + F.row_number().over(Window.orderBy(a))).select("player_id", a)
    ids = known.unionByName(made)
    rows = matches.join(ids, a)
    new = rows.select("player_id", F.lit(sources[0]).alias("source"), F.col(a).alias("source_name")).unionByName(rows.select("player_id", F.lit(sources[1]).alias("source"), F.col(b).alias("source_name"))).distinct()
    return players.unionByName(made.select("player_id", F.col(a).alias("canonical_name"))), insert_if_absent(crosswalk, new, ["player_id", "source", "source_name"])


def attach_only(crosswalk: DataFrame, links: DataFrame) -> DataFrame:
    return insert_if_absent(crosswalk, links, ["player_id", "source", "source_name"])


def alias_candidates(names: DataFrame, clubs: DataFrame) -> DataFrame:
    """Club names that equal a known club's name exactly."""
    return names.join(clubs, names["source_name"] == clubs["club_name"]).select("club_id", "source", "source_name").distinct()


def loose_alias_pairs(names: DataFrame, clubs: DataFrame) -> DataFrame:
    """Name pairs equal or contained after loosening: an equi-join for equality, a word index for containment.

    A contained name shares its first word with the longer one, so both are keyed by words instead of a nested loop.
    """
    a = names.select("source_name").distinct().withColumn("_a", loose_club("source_name")).where("_a <> ''")
    b = clubs.select("club_id", "club_name").distinct().withColumn("_b", loose_club("club_name")).where("_b <> ''")
    words = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    met = a.withColumn("_w", words("_a")).join(b.withColumn("_w", words("_b")), "_w")
    return met.where(F.contains("_a", "_b") | F.contains("_b", "_a")).select("source_name", "club_id", "club_name").distinct()


def history(stats: list[tuple[str, DataFrame]], crosswalk: DataFrame, aliases: DataFrame, players: DataFrame) -> DataFrame:
    """Distinct (player_id, club_id, season_id) from every source; a canonical birth year, if known, must agree."""
    out = None
    for source, df in stats:
        links = crosswalk.where(F.col("source") == source).select("player_id", F.col("source_name").alias("player_name")).distinct()
        clubs = aliases.where(F.col("source") == source).select("club_id", F.col("source_name").alias("team")).distinct()
        rows = df.join(links, "player_name").join(clubs, "team").join(players, "player_id", "left")
        if "born" in df.columns:
            rows = rows.where(F.col("canonical_born").isNull() | (F.col("canonical_born") == F.col("born")))
        rows = rows.select("player_id", "club_id", "season_id")
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def collisions(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several values, listed in order."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("found")).where(F.size("found") > 1)
