"""Transfer-spend context: value-based season windows, buyer context, league context, market index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.tables import pick_best

# Fee kinds that count as paid, and the least number of fees for a share.
PAID = ["permanent_transfer", "paid_loan"]
LEAST_COUNT = 3


def _paid(transfers: DataFrame, direction: str) -> DataFrame:
    return transfers.where((F.col("direction") == direction) & F.col("fee_type").isin(PAID) & F.col("fee_amount").isNotNull())


def share(part: str | Column, whole: str | Column, count: str | Column | None = None) -> Column:
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    out = F.round(100.0 * part / F.nullif(whole, F.lit(0)), 1)
    return out if count is None else F.when((F.col(count) if isinstance(count, str) else count) >= LEAST_COUNT, out)


def club_windows(transfers: DataFrame) -> DataFrame:
    """Per club and season with a paid arrival: sums and counts of that season, trailing 5, the season before, the 5 before.

    Fees are summed per club-season first, so the windows run over one row a season and a hot club is pre-aggregated.
    """
    by = _paid(transfers, "in").groupBy("own_club_id", "season_id").agg(F.sum("fee_amount").alias("_s"), F.count("fee_amount").alias("_c"))
    w = Window.partitionBy("own_club_id").orderBy("season_id")
    over = lambda c, a, b: F.sum(c).over(w.rangeBetween(a, b))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return by.select(
        "own_club_id", "season_id", F.col("_s").alias("season_paid_total"), F.col("_c").alias("season_paid_count"),
        over("_s", -4, 0).alias("trailing_5yr_paid_total"), over("_c", -4, 0).alias("trailing_5yr_paid_count"),
        zero(over("_s", -1, -1)).alias("prior_season_paid_total"), zero(over("_c", -1, -1)).alias("prior_season_paid_count"),
        zero(over("_s", -5, -1)).alias("prior_5yr_paid_total"), zero(over("_c", -5, -1)).alias("prior_5yr_paid_count"),
    )


def transfer_spend_context(transfers: DataFrame) -> DataFrame:
    """Each paid arrival with its club's trailing five seasons."""
    w = club_windows(transfers).select("own_club_id", "season_id", F.col("trailing_5yr_paid_total").alias("trailing_5yr_spend"), F.col("trailing_5yr_paid_count").alias("trailing_5yr_transfer_count"))
    own = _paid(transfers, "in").select("transfer_id", "player_id", "player_name", "own_club_id", "season_id", "fee_amount")
    return own.join(w, ["own_club_id", "season_id"]).withColumn("pct_of_5yr_club_spend", share("fee_amount", "trailing_5yr_spend", "trailing_5yr_transfer_count"))


def buyer_spend_context(sales: DataFrame, buyer_transfers: DataFrame) -> DataFrame:
    """One row per paid sale with the buyer's own fee (an equal fee first) and the buyer's windows, NULL where unknown."""
    s = _paid(sales, "out").select("transfer_id", "player_id", "player_name", F.col("own_club_id").alias("seller_club_id"), F.col("counterparty_club_id").alias("buyer_club_id"), F.col("counterparty_club_name").alias("buyer_club_name"), "season_id", "fee_amount")
    b = _paid(buyer_transfers, "in").select(F.col("own_club_id").alias("_buyer"), F.col("counterparty_club_id").alias("_seller"), F.col("player_id").alias("_player"), F.col("season_id").alias("_season"), F.col("fee_amount").alias("buyer_page_fee"), F.col("transfer_id").alias("_tid"))
    on = (F.col("buyer_club_id") == F.col("_buyer")) & (F.col("seller_club_id") == F.col("_seller")) & (F.col("player_id") == F.col("_player")) & (F.col("season_id") == F.col("_season"))
    page = pick_best(s.join(b, on), ["transfer_id"], [(F.col("buyer_page_fee") == F.col("fee_amount")).desc(), F.col("_tid").asc()]).select("transfer_id", "buyer_page_fee")
    w = club_windows(buyer_transfers).withColumnRenamed("own_club_id", "buyer_club_id")
    out = s.join(page, "transfer_id", "left").join(w, ["buyer_club_id", "season_id"], "left")
    return (
        out.withColumn("buyer_context_available", F.col("buyer_page_fee").isNotNull() & F.col("season_paid_total").isNotNull())
        .withColumn("pct_of_buyer_season_spend", share("buyer_page_fee", "season_paid_total"))
        .withColumn("pct_of_buyer_5yr_spend", share("buyer_page_fee", "trailing_5yr_paid_total", "trailing_5yr_paid_count"))
    )


def buyer_league_context(spend: DataFrame, league_clubs: DataFrame, status: DataFrame, home: str = "NL1") -> DataFrame:
    """The buyer's league in the sale's season and the one before: its code, the home league, OTHER, or NULL if unknown."""
    first = league_clubs.agg(F.min("season_id").alias("_first"))
    leagues = league_clubs.select(F.col("club_id").alias("buyer_club_id"), "season_id", "league_code")
    home_clubs = status.where("was_home").select(F.col("club_id").alias("buyer_club_id"), "season_id", F.lit(True).alias("_home")).distinct()
    out = spend.crossJoin(F.broadcast(first))
    for suffix, lag in (("that", 0), ("prev", 1)):
        key = ["buyer_club_id", "_s"]
        at = lambda d, lag=lag: d.withColumn("_s", F.col("season_id") + lag).drop("season_id")
        out = out.withColumn("_s", F.col("season_id")).join(at(leagues).withColumnRenamed("league_code", "_code"), key, "left").join(at(home_clubs), key, "left")
        unknown = F.col("buyer_club_id").isNull() | (F.lit(lag == 1) & (F.col("season_id") - 1 < F.col("_first")))
        out = (
            out.withColumn(f"buyer_league_{suffix}_season", F.when(~unknown, F.coalesce("_code", F.when(F.col("_home"), home), F.lit("OTHER"))))
            .withColumn(f"buyer_in_big5_{suffix}_season", F.when(~unknown, F.col("_code").isNotNull()))
            .drop("_code", "_home", "_s")
        )
    return out.drop("_first")


def filter_reason(buyer: str, total: str, least: float = 10.0, home: str = "is_home") -> Column:
    """Why a counterparty is left out of the buyer list; the first rule that holds."""
    from touchline.functions.core import first_match, reserve_side

    return first_match([(F.col(home), "home_league"), (F.col(total) < least, "under_least_total"), (reserve_side(buyer), "reserve_side")], "keep")


def market_index(spend: DataFrame) -> DataFrame:
    """Exact median and mean fee per season."""
    return spend.groupBy("season_id").agg(F.median("fee_amount").alias("median_fee"), F.avg("fee_amount").alias("mean_fee"))


def mirrored_pairs(transfers: DataFrame) -> DataFrame:
    """Pairs of rows of one player and season that contradict: both clubs claim the same direction of one move."""
    a = transfers.select(*[F.col(c).alias(f"a_{c}") for c in ("transfer_id", "player_id", "season_id", "own_club_id", "counterparty_club_id", "direction")])
    b = transfers.select(*[F.col(c).alias(f"b_{c}") for c in ("transfer_id", "player_id", "season_id", "own_club_id", "counterparty_club_id", "direction")])
    on = (F.col("a_player_id") == F.col("b_player_id")) & (F.col("a_season_id") == F.col("b_season_id")) & (F.col("a_own_club_id") == F.col("b_counterparty_club_id")) & (F.col("a_counterparty_club_id") == F.col("b_own_club_id"))
    return a.join(b, on).where("a_transfer_id < b_transfer_id and a_direction = b_direction")


def membership_grid(league_clubs: DataFrame, leagues: DataFrame, seasons: DataFrame) -> DataFrame:
    """Every expected league and season with the number of clubs found."""
    n = league_clubs.groupBy("league_code", "season_id").agg(F.count_distinct("club_id").alias("clubs"))
    return leagues.crossJoin(F.broadcast(seasons)).join(n, ["league_code", "season_id"], "left").withColumn("clubs", F.coalesce("clubs", F.lit(0)))


def continuity(league_clubs: DataFrame) -> DataFrame:
    """Clubs retained from the season before and new ones, per league and season."""
    before = league_clubs.select("league_code", "club_id", (F.col("season_id") + 1).alias("season_id"), F.lit(1).alias("kept")).distinct()
    both = league_clubs.select("league_code", "club_id", "season_id").distinct().join(before, ["league_code", "club_id", "season_id"], "left")
    return both.groupBy("league_code", "season_id").agg(F.count("kept").alias("retained"), F.count_if(F.col("kept").isNull()).alias("new"))
