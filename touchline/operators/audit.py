"""Data audits: coverage in one scan, outliers, constants, gap annotation, and the check engine with its catalogue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.core import any_of, unpivot

# Fixed values of the audits.
Z_FLAG, MIN_NINETIES = 5.0, 5.0
EXPECTED_CLUBS, MATCHES, SHORT_SEASON, SHORT_MATCHES = 18, 34, 2019, 26
MINUTES_LOW, MINUTES_HIGH, WS_TOLERANCE, WS_FIRST = 0.85, 1.10, 4, 2013
LOW_COVERAGE = 80.0
#: Columns whose rate has another denominator than the nineties, with its floor; columns without a usable spread.
DENOMINATORS = {"fbref_minutes_per_sub": ("fbref_substitute_appearances", 3), "fbref_minutes_per_start": ("fbref_starts", 3)}
NO_SPREAD = ("fbref_on_off",)


def coverage(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """(group, column_name, total, non_null, pct): one aggregation for all columns, then a narrow unpivot."""
    wide = df.groupBy(*group).agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in columns]) if group else df.agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in columns])
    long = wide.unpivot([*group, "total"], columns, "column_name", "non_null")
    return long.withColumn("pct", F.round(100.0 * F.col("non_null") / F.nullif(F.col("total"), F.lit(0)), 1))


def cell_coverage(df: DataFrame, group: list[str], columns: list[str], scoped: dict[str, Column] | None = None) -> DataFrame:
    """Share of filled cells per group; a scoped column counts only where its condition holds (keepers)."""
    scoped = scoped or {}
    in_scope = lambda c: F.coalesce(scoped.get(c, F.lit(True)), F.lit(False))
    filled = sum((F.when(in_scope(c) & F.col(c).isNotNull(), 1).otherwise(0) for c in columns), F.lit(0))
    cells = sum((F.when(in_scope(c), 1).otherwise(0) for c in columns), F.lit(0))
    out = df.groupBy(*group).agg(F.sum(filled).cast("long").alias("non_null_cells"), F.sum(cells).cast("long").alias("total_cells"))
    return out.withColumn("pct", F.round(100.0 * F.col("non_null_cells") / F.nullif(F.col("total_cells"), F.lit(0)), 1))


def outliers(df: DataFrame, ids: list[str], group: str, columns: list[str], z: float = Z_FLAG, floors: dict[str, tuple[str, float]] | None = None, least: tuple[str, float] | None = None, excluded: tuple[str, ...] = ()) -> DataFrame:
    """Values more than z sample deviations from their group's mean, all columns in one pass of partial aggregates.

    The mean is that of all values; a value is flagged only if its row reaches the least sample (a column and a floor) and the
    floor of its column's own denominator. Excluded columns are never flagged.
    """
    floors, columns = floors or {}, [c for c in columns if c not in excluded]
    sound = F.coalesce(F.col(least[0]) >= least[1], F.lit(False)) if least else F.lit(True)
    names = [f"~{c}" for c in columns]
    reached = [(sound & F.coalesce(F.col(floors[c][0]) >= floors[c][1], F.lit(False)) if c in floors else sound).alias(n) for c, n in zip(columns, names, strict=True)]
    wide = df.select(*ids, group, *columns, *reached)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"), F.col(f"`{n}`").alias("sound")) for c, n in zip(columns, names, strict=True)])).alias("s")
    long = wide.select(*ids, group, pairs).select(*ids, group, "s.*").where("value is not null")
    stats = long.groupBy(group, "column_name").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd")).where("sd > 0")
    far = long.where("sound").drop("sound").join(stats, [group, "column_name"])
    return far.withColumn("z", (F.col("value") - F.col("mean")) / F.col("sd")).where(F.abs("z") > z)


def excluded_noise(df: DataFrame, ids: list[str], group: str, columns: list[str], least: tuple[str, float], z: float = Z_FLAG) -> DataFrame:
    """(column_name, excluded): how many values beyond z the least sample keeps from being flagged."""
    every = outliers(df, ids, group, columns, z)
    kept = outliers(df, ids, group, columns, z, least=least)
    return every.groupBy("column_name").agg(F.count("*").alias("n")).join(kept.groupBy("column_name").agg(F.count("*").alias("k")), "column_name", "left").select("column_name", (F.col("n") - F.coalesce("k", F.lit(0))).alias("excluded"))


def merge_flags(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Reviewed flags and their explanations stay; unreviewed ones are replaced by the new run's."""
    kept = old.where("reviewed")
    return kept.unionByName(new.join(kept.select(*keys), keys, "left_anti").withColumns({"reviewed": F.lit(False), "explanation": F.lit(None).cast("string")}).select(*old.columns))


def constants(df: DataFrame, group: str, columns: list[str], least: int) -> DataFrame:
    """(group, column_name, kind): empty, constant or sparse columns per group; -0.0 equals 0.0."""
    aggs = [a for c in columns for a in (F.count(c).alias(f"{c}~n"), F.min(F.col(c) + F.lit(0)).alias(f"{c}~lo"), F.max(F.col(c) + F.lit(0)).alias(f"{c}~hi"))]
    wide = df.groupBy(group).agg(F.count("*").alias("rows"), *aggs)
    long = wide.select(group, "rows", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}~n").alias("n"), F.col(f"{c}~lo").cast("double").alias("lo"), F.col(f"{c}~hi").cast("double").alias("hi")) for c in columns])).alias("s")).select(group, "rows", "s.*")
    kind = F.when(F.col("n") == 0, "empty").when((F.col("n") >= least) & (F.col("lo") == F.col("hi")), "constant").when(F.col("n") < least, "sparse")
    return long.where(F.col("rows") >= least).withColumn("kind", kind).where("kind is not null").select(group, "column_name", "kind", F.when(F.col("kind") == "constant", F.col("lo")).alias("value"))


def merge_findings(found: DataFrame, group: str) -> DataFrame:
    """Columns that share kind, value and the very list of groups become one finding."""
    by = found.groupBy("column_name", "kind", "value").agg(F.array_sort(F.collect_set(group)).alias("groups"))
    return by.groupBy("kind", "value", "groups").agg(F.array_sort(F.collect_list("column_name")).alias("columns"))


def density(df: DataFrame, season: str, team: str, share: float = 0.5) -> DataFrame:
    """Teams with fewer rows than share of their season's average."""
    n = df.groupBy(season, team).agg(F.count("*").alias("n"))
    return n.withColumn("mean_n", F.avg("n").over(Window.partitionBy(season))).where(F.col("n") < share * F.col("mean_n"))


def gap_tier(domain: Column, season: Column, pct: Column) -> Column:
    """struct<tier, reason> of a season's coverage of a column; the first rule that holds, NULL where none does.

    Columns of the event feed before its first season are explained whatever their coverage; two shapes of low coverage are likely
    explained; any other below LOW_COVERAGE is unexplained.
    """
    rule = lambda tier, reason: F.struct(F.lit(tier).alias("tier"), F.lit(reason).cast("string").alias("reason"))
    return (
        F.when((domain == "ws") & (season < WS_FIRST), rule("explained", "no event feed before its first season"))
        .when((domain == "fbref") & season.between(2010, 2017) & (pct < 10), rule("likely_explained", "historical gap of 2010 to 2017"))
        .when((domain == "ws") & (season >= WS_FIRST) & pct.between(20, 60), rule("likely_explained", "baseline gap of the crosswalk"))
        .when(pct < LOW_COVERAGE, rule("unexplained", None))
    )


def blended_tier(domain: Column, pct: Column) -> Column:
    """The tier of coverage over all seasons (by team or player): season rules cannot tell, so low coverage is only marked."""
    return F.when(domain.isin("ws", "fbref") & (pct < LOW_COVERAGE), "unexplained_blended")


@dataclass(frozen=True)
class Check:
    """A named invariant: a frame of violations made from tables; NULL comparisons never violate.

    A check of single rows has their predicate instead, so that all such checks of a table share one aggregation.
    """

    name: str
    severity: str
    table: str
    violations: Callable[[dict[str, DataFrame]], DataFrame]
    allowed: int = 0
    note: str = ""
    others: tuple[str, ...] = ()
    predicate: Callable[[DataFrame], Column] | None = None


def _count_rows(checks: list[Check], table: DataFrame) -> dict[str, int]:
    """Violations of the row checks of a table whose predicate its columns allow, in one aggregation."""
    sound = {}
    for c in checks:
        try:
            made = F.count_if(c.predicate(table)).alias(c.name)
            table.select(c.predicate(table))
            sound[c.name] = made
        except Exception:  # noqa: BLE001  graded as ERROR by the check's own run
            continue
    return table.agg(*sound.values()).first().asDict() if sound else {}


def run_checks(checks: list[Check], tables: dict[str, DataFrame], only: list[str] | None = None, sample: int = 5) -> list[dict]:
    """PASS, KNOWN (up to the allowed number), FAIL or WARN by severity, SKIPPED without one of its tables, ERROR on a failure.

    One aggregation for the row checks of a table, one for each other check; only `sample` violating rows of a check that
    has any reach the driver.
    """
    if unknown := set(only or []) - {c.name for c in checks}:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    chosen = [c for c in checks if not only or c.name in only]
    counted: dict[str, int] = {}
    for name in dict.fromkeys(c.table for c in chosen if c.predicate and c.table in tables):
        counted |= _count_rows([c for c in chosen if c.predicate and c.table == name], tables[name])
    out = []
    for c in chosen:
        row = {"name": c.name, "severity": c.severity, "violations": None, "sample": []}
        if not {c.table, *c.others} <= set(tables):
            out.append(row | {"status": "SKIPPED"})
            continue
        try:
            bad = c.violations(tables)
            n = counted[c.name] if c.name in counted else bad.count()
            status = "PASS" if n == 0 else "KNOWN" if n <= c.allowed else "FAIL" if c.severity == "error" else "WARN"
            out.append(row | {"status": status, "violations": n, "sample": [r.asDict() for r in bad.limit(sample).collect()] if n else []})
        except Exception as e:  # noqa: BLE001  a broken check is a finding, not the end of the run
            out.append(row | {"status": "ERROR", "note": str(e).splitlines()[0][:200]})
    return out


def exit_code(results: list[dict]) -> int:
    return int(any(r["status"] in ("FAIL", "ERROR") for r in results))


def where(name: str, severity: str, predicate: str | Column, allowed: int = 0, table: str = "master", note: str = "") -> Check:
    return rows(name, severity, lambda df: F.expr(predicate) if isinstance(predicate, str) else predicate, allowed, table, note)


def rows(name: str, severity: str, predicate: Callable[[DataFrame], Column], allowed: int = 0, table: str = "master", note: str = "") -> Check:
    """A check of single rows whose predicate depends on the table's columns."""
    return Check(name, severity, table, lambda t: t[table].where(predicate(t[table])), allowed, note, predicate=predicate)


def _having(name: str, severity: str, keys: list[str], aggs: Callable[[], list[Column]], having: str, table: str = "master", before: str = "true") -> Check:
    return Check(name, severity, table, lambda t: t[table].where(before).groupBy(*keys).agg(*aggs()).where(having))


def _missing(name: str, table: str, other: str, keys: list[str], severity: str = "error") -> Check:
    return Check(name, severity, table, lambda t: t[table].join(t[other].select(*keys).distinct(), keys, "left_anti"), others=(other,))


def _le(small: str, big: str, slack: str = "") -> str:
    return f"{small} > {big}{slack}"


#: Columns that the checks range over (fixed values).
COUNTS = [
    "fbref_matches_played", "fbref_minutes", "fbref_starts", "fbref_goals", "fbref_assists", "fbref_goals_plus_assists", "fbref_non_penalty_goals",
    "fbref_penalty_goals", "fbref_penalty_attempts", "fbref_shots", "fbref_shots_on_target", "fbref_yellow_cards", "fbref_red_cards",
    "fbref_second_yellow_cards", "fbref_fouls_committed", "fbref_fouls_drawn", "fbref_offsides", "fbref_crosses", "fbref_interceptions",
    "fbref_tackles_won", "fbref_own_goals", "gk_goals_against", "gk_shots_on_target_against", "gk_saves", "gk_wins", "gk_draws", "gk_losses",
    "gk_clean_sheets", "gk_penalty_kicks_faced", "gk_penalty_kicks_allowed", "gk_penalty_kicks_saved", "ws_matches_with_data", "ws_passes",
    "ws_passes_completed", "ws_touches", "ws_touches_def_3rd", "ws_touches_mid_3rd", "ws_touches_att_3rd", "ws_touches_def_pen_area",
    "ws_touches_att_pen_area", "ws_take_ons", "ws_take_ons_won", "ws_dispossessed", "ws_tackles", "ws_tackles_won", "ws_tackles_def_3rd",
    "ws_tackles_mid_3rd", "ws_tackles_att_3rd", "ws_interceptions", "ws_interceptions_def_3rd", "ws_interceptions_mid_3rd",
    "ws_interceptions_att_3rd", "ws_clearances", "ws_dribbled_past", "ws_errors", "ws_final_third_entries", "ws_pen_area_entries", "ws_aerials",
    "ws_aerials_won",
]
PERCENTS = [
    "fbref_minutes_pct", "fbref_shots_on_target_pct", "gk_save_pct", "gk_clean_sheet_pct", "gk_penalty_kick_save_pct", "ws_passes_pct",
    "ws_take_ons_won_pct", "ws_aerial_duel_win_pct", "ws_ground_duel_win_pct",
]
PER90 = [
    ("ws_passes", "ws_passes_per90"), ("ws_touches", "ws_touches_per90"), ("ws_tackles", "ws_tackles_per90"), ("ws_aerials", "ws_aerials_per90"),
    ("ws_take_ons", "ws_take_ons_per90"), ("ws_clearances", "ws_clearances_per90"),
]
EXPECTED = f"(CASE WHEN season_id = {SHORT_SEASON} THEN {SHORT_MATCHES} ELSE {MATCHES} END * 990)"


def _rate(rate: str, top: str, bottom: str) -> str:
    return f"{bottom} > 0 AND {rate} IS NOT NULL AND ABS({rate} - 100.0 * {top} / {bottom}) > 0.2"


def _percentiles(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("pct_")]


def catalogue(clustering: list[str]) -> list[Check]:
    """The fifty invariants over master, percentiles, archetypes, centroids, transfers and the two sources."""
    n = lambda: [F.count("*").alias("n")]
    return [
        _having("duplicate_player_season_team", "error", ["player_id", "season_id", "team"], n, "n > 1", before="player_id is not null"),
        _having("one_birth_year_per_player", "warn", ["player_id"], lambda: [F.count_distinct("fbref_born").alias("n")], "n > 1", before="player_id is not null"),
        where("born_plausible", "error", "fbref_born < 1960 OR fbref_born > season_id - 14", 2),
        _having("clubs_per_season", "error", ["season_id"], lambda: [F.count_distinct("team").alias("n")], f"n <> {EXPECTED_CLUBS}"),
        _having("team_season_minutes", "warn", ["team", "season_id"], lambda: [F.sum("fbref_minutes").alias("minutes")], f"minutes NOT BETWEEN {MINUTES_LOW} * {EXPECTED} AND {MINUTES_HIGH} * {EXPECTED}"),
        where("nineties_match_minutes", "error", "ABS(fbref_nineties * 90 - fbref_minutes) > 5"),
        where("starts_le_matches", "error", _le("fbref_starts", "fbref_matches_played")),
        where("minutes_le_matches_cap", "error", _le("fbref_minutes", "fbref_matches_played * 120")),
        where("cards_le_matches", "error", "fbref_yellow_cards > fbref_matches_played OR fbref_red_cards > fbref_matches_played", 1),
        where("second_yellow_le_red", "warn", _le("fbref_second_yellow_cards", "fbref_red_cards")),
        rows("non_negative_counts", "error", lambda df: any_of(COUNTS, "{c} < 0")),
        rows("percent_columns_in_range", "error", lambda df: any_of(PERCENTS, "{c} < 0 OR {c} > 100")),
        where("points_per_match_range", "error", "fbref_points_per_match < 0 OR fbref_points_per_match > 3"),
        where("goals_identity", "error", "fbref_goals <> fbref_non_penalty_goals + fbref_penalty_goals"),
        where("goals_plus_assists_identity", "error", "fbref_goals_plus_assists <> fbref_goals + fbref_assists"),
        where("penalty_goals_le_attempts", "error", _le("fbref_penalty_goals", "fbref_penalty_attempts")),
        where("shots_on_target_le_shots", "error", _le("fbref_shots_on_target", "fbref_shots")),
        where("goals_le_shots", "warn", _le("fbref_goals - fbref_penalty_goals", "fbref_shots")),
        where("np_goals_per90_matches_count", "warn", "fbref_nineties >= 5 AND ABS(fbref_non_penalty_goals_per90 - fbref_non_penalty_goals / fbref_nineties) > 0.03"),
        where("ws_passes_completed_le_passes", "error", _le("ws_passes_completed", "ws_passes")),
        where("ws_take_ons_won_le_take_ons", "error", _le("ws_take_ons_won", "ws_take_ons")),
        where("ws_tackles_won_le_tackles", "error", _le("ws_tackles_won", "ws_tackles")),
        where("ws_aerials_won_le_aerials", "error", _le("ws_aerials_won", "ws_aerials")),
        where("ws_touch_zones_sum", "error", "ws_touches IS NOT NULL AND ABS(ws_touches_def_3rd + ws_touches_mid_3rd + ws_touches_att_3rd - ws_touches) > GREATEST(2, 0.02 * ws_touches)"),
        where("ws_penalty_area_touches_le_touches", "error", _le("ws_touches_def_pen_area + ws_touches_att_pen_area", "ws_touches")),
        where("ws_tackle_zones_le_tackles", "error", _le("ws_tackles_def_3rd + ws_tackles_mid_3rd + ws_tackles_att_3rd", "ws_tackles")),
        where("ws_interception_zones_le_interceptions", "error", _le("ws_interceptions_def_3rd + ws_interceptions_mid_3rd + ws_interceptions_att_3rd", "ws_interceptions")),
        where("ws_passes_pct_matches_counts", "error", _rate("ws_passes_pct", "ws_passes_completed", "ws_passes")),
        where("ws_take_ons_pct_matches_counts", "error", _rate("ws_take_ons_won_pct", "ws_take_ons_won", "ws_take_ons")),
        where("ws_aerial_pct_matches_counts", "error", _rate("ws_aerial_duel_win_pct", "ws_aerials_won", "ws_aerials")),
        where("ws_per90_sign_consistent", "error", " OR ".join(f"({c} = 0 AND {r} > 0) OR ({c} > 0 AND {r} = 0)" for c, r in PER90)),
        where("ws_matches_le_fbref_matches", "error", _le("ws_matches_with_data", "fbref_matches_played", " + 2")),
        where("gk_saves_le_shots_faced", "error", _le("gk_saves", "gk_shots_on_target_against")),
        where("gk_clean_sheets_le_matches", "error", _le("gk_clean_sheets", "fbref_matches_played")),
        where("gk_results_le_matches", "error", _le("gk_wins + gk_draws + gk_losses", "fbref_matches_played")),
        where("gk_penalties_saved_le_faced", "error", _le("gk_penalty_kicks_saved", "gk_penalty_kicks_faced")),
        where("outfielders_with_keeper_stats", "warn", "split_part(fbref_position, ',', 1) <> 'GK' AND fbref_position <> '' AND gk_goals_against IS NOT NULL"),
        where("height_range", "error", "tm_height_cm < 150 OR tm_height_cm > 215", 2),
        rows("percentile_columns_in_range", "error", lambda df: any_of(_percentiles(df), "{c} < 0 OR {c} > 100"), table="percentiles"),
        _having("percentiles_unique_key", "error", ["player_id", "season_id"], n, "n > 1", "percentiles"),
        _missing("percentiles_have_stats", "percentiles", "master", ["player_id", "season_id"]),
        _missing("archetypes_have_percentiles", "archetypes", "percentiles", ["player_id", "season_id"]),
        _having("centroids_complete", "error", ["archetype_id"], n, f"n <> {len(clustering)}", "centroids"),
        _missing("ws_team_names_match_fbref", "ws_source", "fbref_source", ["season_id", "team"]),
        where("ws_player_names_not_numeric", "error", "player_name RLIKE '^[0-9.]+$'", table="ws_source"),
        Check("ws_season_present", "error", "fbref_source", lambda t: t["fbref_source"].where(f"season_id >= {WS_FIRST}").join(t["ws_source"].select("season_id").distinct(), "season_id", "left_anti").groupBy("season_id").count(), others=("ws_source",)),
        _having("ws_team_coverage", "warn", ["team", "season_id"], lambda: [F.max("ws_matches_with_data").alias("a"), F.max("fbref_matches_played").alias("b")], f"a < b - {WS_TOLERANCE}"),
        Check("percentile_vector_complete", "error", "percentiles", lambda t: t["percentiles"].where(f"season_id >= {WS_FIRST}").where(any_of([f"pct_{f}" for f in clustering], "{c} IS NULL"))),
        where("transfer_fee_range", "error", "fee_amount < 0 OR fee_amount > 150", table="transfers"),
        where("transfer_season_range", "error", "season_id NOT BETWEEN 1990 AND 2027", table="transfers"),
    ]
