"""Functions, operators and plans against small fixtures and hand-made expectations."""

import time
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.functions import core as C
from touchline.functions import fuzzy as Z
from touchline.operators import audit, events, identity, schedule, spend, tables
from touchline.plans import archetypes, percentiles, signals, squared
from touchline.queries import modeling, sources
from touchline.sources import html_tables

EVENT = "game_id long, minute int, second int, team_id long, team string, player_id long, player string, x double, y double, end_x double, end_y double, type string, outcome_type string, is_touch boolean, qualifiers array<struct<type:struct<displayName:string>,value:string>>"


def test_fee_kinds(spark):
    texts = ["€15.00m", "€500k", "free transfer", "End of loan", "?", "-", "", None, "Loan fee €2.50m", "Loan fee", "swap"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", C.fee("t").alias("f")).orderBy("i").collect()
    assert [r.f.type for r in got] == ["permanent_transfer", "permanent_transfer", "free_transfer", "loan_ended", "unknown_historical", "unknown", "empty_cell", "empty_cell", "paid_loan", "paid_loan_undisclosed", "unrecognized: swap"]
    assert [r.f.amount for r in got][:3] == [15.0, 0.5, 0.0]


def test_match_stats(spark):
    mouth = [(("GoalMouthY",), "1")]
    rows = [
        (1, 1, 1, 1, "A", 7, "P", 33.3, 50.0, 70.0, 50.0, "Pass", "Successful", True, None),
        (1, 1, 2, 1, "A", 7, "P", 66.6, 50.0, 83.0, 21.1, "Pass", "Unsuccessful", True, None),
        (1, 1, 3, 1, "A", 7, "P", None, None, None, None, "BlockedPass", "Successful", True, None),
        (1, 1, 4, 1, "A", 7, "P", 90.0, 50.0, None, None, "SavedShot", "Successful", True, mouth),
        (1, 1, 5, 1, "A", 7, "P", 90.0, 50.0, None, None, "SavedShot", "Successful", True, None),
        (1, 1, 6, 1, "A", None, None, 90.0, 50.0, None, None, "Goal", "Successful", True, None),
    ]
    r = events.match_stats(spark.createDataFrame(rows, EVENT)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.passes, r.passes_completed, r.passes_pct) == (3, 1, 33.3)
    assert (r.touches, r.touches_def_3rd, r.touches_mid_3rd, r.touches_att_3rd) == (4, 1, 1, 3)
    assert (r.shots, r.shots_on_target, r.final_third_entries, r.pen_area_entries) == (2, 1, 1, 0)


def test_season_stats_recompute_percentages(spark):
    rows = [(g, 1, 1, 1, "A", 7, f"P{g}" if g == 3 else "P", 50.0, 50.0, 50.0, 50.0, "Pass", "Successful" if g < 3 else "Unsuccessful", True, None) for g in (1, 2, 3)]
    s = events.season_stats(events.match_stats(spark.createDataFrame(rows, EVENT)), ["player_id", "team"]).first()
    assert (s.passes, s.passes_pct, s.matches_with_data, s.player) == (3, 66.7, 3, "P")


def test_spend_windows(spark):
    schema = "transfer_id long, player_id long, player_name string, own_club_id long, counterparty_club_id long, counterparty_club_name string, season_id int, fee_amount double, direction string, fee_type string"
    buys = [(i, i, "p", 1, 2, "c", s, f, "in", k) for i, (s, f, k) in enumerate([(2015, 10.0, "permanent_transfer"), (2015, 5.0, "paid_loan"), (2016, 0.0, "free_transfer"), (2019, 20.0, "permanent_transfer"), (2020, 1.0, "permanent_transfer")])]
    got = {r.season_id: r for r in spend.club_windows(spark.createDataFrame(buys, schema)).collect()}
    assert set(got) == {2015, 2019, 2020}
    assert (got[2019].trailing_5yr_paid_total, got[2019].trailing_5yr_paid_count, got[2019].prior_season_paid_total, got[2019].prior_5yr_paid_total) == (35.0, 3, 0.0, 15.0)
    assert (got[2020].trailing_5yr_paid_total, got[2020].prior_5yr_paid_total) == (21.0, 35.0)
    sales = [(100, 3, "p", 2, 1, "x", 2019, 20.0, "out", "permanent_transfer"), (101, 9, "q", 2, 99, "y", 2019, 3.0, "out", "permanent_transfer")]
    out = {r.transfer_id: r for r in spend.buyer_spend_context(spark.createDataFrame(sales, schema), spark.createDataFrame(buys, schema)).collect()}
    assert out[100].buyer_context_available and out[100].buyer_page_fee == 20.0 and out[100].pct_of_buyer_season_spend == 100.0
    assert not out[101].buyer_context_available and out[101].season_paid_total is None


def test_percentile_ranks(spark):
    for values, want in (([10, 20, 30, 40], [12.5, 37.5, 62.5, 87.5]), ([5, 5, 9], [33.3, 33.3, 83.3]), ([1, None, 3], [25.0, None, 75.0])):
        df = spark.createDataFrame([(i, "g", None if v is None else float(v)) for i, v in enumerate(values)], "i int, g string, v double")
        got = df.withColumn("p", F.bround(percentiles.mean_percentile_rank("v", ["g"]), 1)).orderBy("i").collect()
        assert [r.p for r in got] == want


def test_small_group_and_constant(spark):
    df = spark.createDataFrame([(i, "g", 1.0) for i in range(30)] + [(i, "h", float(i)) for i in range(29)] + [(i, "k", float(i)) for i in range(30)], "i int, g string, value double")
    got = percentiles.rank_long(df, ["g"]).groupBy("g").agg(F.count("pct").alias("n")).collect()
    assert {r.g: r.n for r in got} == {"g": 0, "h": 0, "k": 30}


def test_planted_clusters(spark):
    rng = np.random.default_rng(1)
    feats = percentiles.CLUSTERING
    centres = [np.full(len(feats), 15), np.full(len(feats), 85), np.array([20] * 11 + [80] * (len(feats) - 11)), np.array([80] * 11 + [20] * (len(feats) - 11))]
    x = np.clip(np.vstack([c + rng.normal(0, 6, (60, len(feats))) for c in centres]), 0, 100)
    rows = [(i, 2020, *map(float, v)) for i, v in enumerate(x)] + [(999, 2020, None, *map(float, x[0][1:]))]
    df = spark.createDataFrame(rows, "player_id int, season_id int, " + ", ".join(f"pct_{f} double" for f in feats))
    got = {r.player_id: r for r in archetypes.fit_archetypes(df, 4, starts=5)[0].collect()}
    assert archetypes.adjusted_rand([got[i].archetype_id for i in range(240)], np.repeat(range(4), 60)) > 0.99
    assert got[999].archetype_id == got[0].archetype_id and got[999].features_used == len(feats) - 1


def test_archetypes_left_with_the_tasks(spark, tmp_path, monkeypatch):
    """No row reaches the driver beyond HELD; the clusters are found, however the rows are dealt."""
    rng = np.random.default_rng(7)
    feats = percentiles.CLUSTERING
    x = np.clip(np.vstack([rng.uniform(10, 90, len(feats)) + rng.normal(0, 3, (50 + 10 * i, len(feats))) for i in range(4)]), 0, 100)
    df = spark.createDataFrame([(i, 2020, *map(float, v)) for i, v in enumerate(x)], "player_id int, season_id int, " + ", ".join(f"pct_{f} double" for f in feats))
    monkeypatch.setattr(archetypes, "HELD", 0)
    monkeypatch.setattr(archetypes, "matrix", None)
    got = []
    for parts in (1, 5):
        out, centres = archetypes.fit_archetypes(df.repartition(parts), 4, starts=3, scratch=f"{tmp_path}/{parts}")
        got.append((out.orderBy("player_id").collect(), sorted(centres.collect())))
    assert got[0] == got[1]
    assert [r.archetype_id for r in got[0][0]] == np.repeat([4, 3, 2, 1], [50, 60, 70, 80]).tolist()


def test_choose_k_and_ward():
    assert archetypes.choose_k([(6, 0.8, 100), (7, 0.79, 70), (8, 0.78, 10)]) == 7
    x = np.vstack([np.random.default_rng(0).normal(c, 0.1, (10, 2)) for c in (0, 5, 9)])
    assert archetypes.adjusted_rand(archetypes.ward_labels(x, 3), np.repeat(range(3), 10)) == 1.0


def _plain_lloyd(x, k, rng, steps=100):
    c = [x[rng.integers(len(x))]]
    d = ((x - c[0]) ** 2).sum(1)
    while len(c) < k:
        c.append(x[rng.choice(len(x), p=d / d.sum())])
        d = np.minimum(d, ((x - c[-1]) ** 2).sum(1))
    m = np.array(c)
    for _ in range(steps):
        lab = ((x**2).sum(1)[:, None] - 2 * x @ m.T + (m**2).sum(1)).argmin(1)
        new = np.array([x[lab == j].mean(0) for j in range(k)])
        moved, m = np.abs(new - m).max(), new
        if moved < 1e-6:
            break
    return m


def test_k_means_steps():
    """The same centres as by plain steps, for less than two thirds of their time (they took as long before)."""
    x = np.random.default_rng(3).normal(size=(40_000, 48))
    began = time.process_time()
    want = _plain_lloyd(x, 12, np.random.default_rng(4))
    plain, began = time.process_time() - began, time.process_time()
    got = archetypes.lloyd(x, 12, np.random.default_rng(4), 1)[0]
    assert np.allclose(got, want, atol=1e-9) and time.process_time() - began < plain * 2 / 3


def test_ward_rounds(spark, monkeypatch):
    """12,000 rows took over 14 s by chains; copies, and rounds spread over tasks, give the same tree."""
    x = np.random.default_rng(6).normal(size=(12_000, 16))
    began = time.process_time()
    labels = archetypes.ward_labels(x, 5)
    assert time.process_time() - began < 8 and len(np.unique(labels)) == 5
    some = np.vstack([x[:300], np.repeat(x[:1], 200, 0), x[7:9]])
    want = archetypes.ward_labels(some, 6)
    assert len(set(want[300:500]) | {want[0]}) == 1 and want[500] == want[7]
    monkeypatch.setattr(archetypes, "SPREAD_PAIRS", 0)
    assert np.array_equal(archetypes.ward_labels(some, 6, spark), want)


def test_signal_models():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = x @ [1.0, -2.0, 0.0] + 0.1 * rng.normal(size=300)
    assert np.corrcoef(signals.ridge(x[:200], y[:200])(x[200:]), y[200:])[0, 1] > 0.99
    assert np.corrcoef(signals.boosted(x[:200], y[:200], False)(x[200:]), y[200:])[0, 1] > 0.8
    c = (y > 0).astype(float)
    assert signals.auc(c[200:], signals.logistic(x[:200], c[:200])(x[200:])) > 0.97
    assert (signals.logistic(x, np.ones(300))(x) == 1).all()
    folds = signals.grouped_folds(np.repeat(np.arange(20), 3), 5, 2, 1)
    assert all(not set(a // 3) & set(b // 3) for a, b in folds) and len(folds) == 10


def test_boosting_takes_equal_rows_together():
    """The time follows the distinct binned rows: 300,000 rows of 200 kinds took over 10 s when each row was counted."""
    rng = np.random.default_rng(5)
    x, y = np.tile(rng.normal(size=(200, 8)), (1500, 1)), rng.normal(size=300_000)
    for classify, t in ((False, y), (True, (y > 0).astype(float))):
        began = time.process_time()
        p = signals.boosted(x, t, classify)(x[:400])
        assert time.process_time() - began < 5 and np.array_equal(p[:200], p[200:])


def test_threshold_fits_go_over_distinct_rows(spark):
    """The losses are those of a fit over each sale; a kernel gets one row for equal sales, not 40."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(6000):
        k = i % 150
        rows.append(((i * 7919) % 6000, k, 2018 + i // 150 % 5, int(rng.random() < 0.2 + 0.004 * k), None if k % 11 == 0 else float(k % 13), float(k % 50) ** 2, "abc"[k % 3] if k % 7 else None))
    sales = spark.createDataFrame(rows, "transfer_id long, player_id long, sale_season int, y int, a double, c double, b string")
    arms = [signals.Arm("one", ("a", "c"), ("b",)), signals.Arm("two", ("c",))]
    want = signals.player_losses(signals.out_of_fold(sales, arms, "y", True, splits=3, repeats=2), True).toPandas()
    want["one_model"] = want.model + want.scheme
    got = dict(signals.threshold_losses(sales, arms, "y", splits=3, repeats=2))
    assert set(got) == {(m, s) for m in ("linear", "boosted") for s in ("grouped", "time")}
    for (model, scheme), part in got.items():
        both = part.merge(want[want.one_model == model + scheme], on=["arm", "player_id"], suffixes=("", "_row"))
        assert len(both) == len(part) == 300 and (both.n == both.n_row).all() and np.allclose(both.loss, both.loss_row, rtol=1e-9)
        assert all((np.diff(p.player_id) > 0).all() for _, p in part.groupby("arm", observed=True))
    cells, players = signals.sale_cells(sales, arms, "y")
    assert players.tolist() == [*range(150)] and len(cells.code) == 6000 and cells.n.sum() == 6000 and len(cells.points[1][0]) == 50
    part = np.random.default_rng(0).permutation(6000) % 3
    assert np.array_equal(cells.parts(np.ones(len(cells.n), bool)), np.stack([np.bincount(cells.code[part == f], minlength=len(cells.n)) for f in range(3)], 1))


def test_outgrew_signal_never_fits_sale_by_sale(spark, tmp_path, monkeypatch):
    """compare() took a driver's row and a fit's row for every sale: 900,000 orders did not end in time."""
    orders = [(i, i % 60, datetime(1994 + i % 3, 1, 1), 1000.0 * (i * 37 % 101)) for i in range(1800)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i % 3, float(i * 13 % 59), "xyz"[i % 3]) for i in range(60)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(modeling.S, "out_of_fold", None)
    got = modeling.outgrew_signal(spark, str(tmp_path)).collect()
    assert [(r.arm, r.model, r.scheme) for r in got] == [(a, m, "grouped") for m in ("boosted", "linear") for a in ("controls", "style")]
    assert all(0.5 < r.error < 0.9 for r in got)


def _fee_sales(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(4000):
        k = i % 150
        rows.append(((i * 7919) % 4000, k, 2018 + i // 150 % 5, float(rng.normal() + 0.02 * k), None if k % 11 == 0 else float(k % 13) + float(rng.integers(0, 3)), float(rng.normal() * 3 + k), "abc"[k % 3] if k % 7 else None, 3.0))
    return spark.createDataFrame(rows, "transfer_id long, player_id long, sale_season int, y double, a double, c double, b string, d double").repartition(3)


@pytest.mark.parametrize("gather,splitters,sample", [(1_000_000, 2047, 4096), (500, 20, 64)])
def test_fee_fits_leave_sales_with_the_tasks(spark, monkeypatch, gather, splitters, sample):
    """compare() brought every sale to the driver: 9,000,000 orders took more than its memory. The losses are those of the fits sale by sale."""
    sales = _fee_sales(spark)
    arms = [signals.Arm("one", ("a", "c"), ("b",)), signals.Arm("two", ("c", "d"))]
    want = signals.player_losses(signals.out_of_fold(sales, arms, "y", False, splits=3, repeats=1), False).toPandas()
    want["one_model"] = want.model + want.scheme
    for name, value in (("GATHER", gather), ("SPLITTERS", splitters), ("SAMPLE", sample)):
        monkeypatch.setattr(squared, name, value)
    monkeypatch.setattr(signals, "out_of_fold", None)
    errors = signals.compare(sales, arms, "one", "y", False, splits=3, repeats=1).set_index(["arm", "model", "scheme"]).error
    got = dict(squared.squared_losses(sales, arms, "y", splits=3, repeats=1))
    assert set(got) == {(m, s) for m in ("linear", "boosted") for s in ("grouped", "time")}
    for (model, scheme), part in got.items():
        both = part.merge(want[want.one_model == model + scheme], on=["arm", "player_id"], suffixes=("", "_row"))
        assert len(both) == len(part) == 300 and (both.n == both.n_row).all() and np.allclose(both.loss, both.loss_row, rtol=1e-9)
        for arm, own in part.groupby("arm", observed=True):
            assert (np.diff(own.player_id) > 0).all() and np.isclose(errors[arm, model, scheme], np.sqrt(own.loss.sum() / own.n.sum()), rtol=1e-9)


def test_cells_of_many_columns():
    """Keys beyond 64 bits are strings; tables and sorted keys count the same."""
    rng = np.random.default_rng(2)
    edges = [np.unique(rng.normal(size=31)) for _ in range(13)]
    for n in (2, 13):
        plan = squared.Cells(edges[:n], [0.0] * n, [True] + [False] * (n - 1), [300], [50], [[10] * 300], 100)
        assert (plan.bound >= 1 << 62) == (n == 13)
        codes = [rng.integers(0, m, 500) for m in plan.sizes]
        keys = plan.keys(codes)
        cell, bins = plan.columns(keys)
        gone = codes[0] == 32
        assert keys.dtype == plan.dtype and np.array_equal(cell[0], np.where(gone, plan.middle[0], codes[0])) and np.array_equal(cell[n] > 0, gone)
        assert all(np.array_equal(a, b) for a, b in zip(cell[1:n], codes[1:n], strict=True))
        assert all(np.array_equal(cell[n + 1 + i] > 0, codes[n] == i + 1) for i in range(300)) and all(c.max() < m for c, m in zip(cell, bins, strict=True))
    key, train, y = rng.integers(0, 50, 400), rng.random(400) < 0.8, rng.normal(size=400)
    one, two = squared.counted(key, train, y, 50), squared.counted(key, train, y, squared.TABLE + 1)
    assert all(np.allclose(a, b) for a, b in zip(one, two, strict=True))
    assert np.array_equal(squared.looked_up(key, one[0], one[2], 50), squared.looked_up(key, one[0], one[2], squared.TABLE + 1))


def test_weights_stand_for_equal_rows():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 40):
        x, n = rng.normal(size=size), rng.integers(1, 9, size)
        assert np.allclose(signals._quantiles(x, np.linspace(0, 1, 33), n), np.quantile(np.repeat(x, n), np.linspace(0, 1, 33)), rtol=1e-13, atol=0)
    df = pd.DataFrame({"a": [1.0, 2.0, np.nan, 7.0], "b": [3.0] * 4, "c": ["p", None, "q", "p"]})
    n = np.array([3, 1, 2, 6])
    one, rows = signals.Preprocess(["a", "b"], ["c"]).fit(df, n), signals.Preprocess(["a", "b"], ["c"]).fit(df.loc[np.repeat(range(4), n)])
    assert np.allclose(one.transform(df), rows.transform(df)) and one.flagged == rows.flagged == ["a"]
    v = pd.DataFrame({"arm": ["x"] * 9 + ["y"] * 9, "player_id": [*range(9)] * 2, "n": [*range(1, 10)] * 2, "loss": rng.random(18)})
    w = v[v.arm == "x"].merge(v[v.arm == "y"], on="player_id")[["n_x", "loss_x", "loss_y"]].to_numpy(float)
    draw = np.random.default_rng(signals.SEED_FEE)
    sums = np.array([w[draw.integers(0, 9, 9)].sum(0) for _ in range(1000)])
    gaps = (sums[:, 1] - sums[:, 2]) / sums[:, 0]
    assert np.allclose(signals.bootstrap_gap(v, "x", "y", True)[1:], np.quantile(gaps, [0.025, 0.975]))


def test_fits_one_a_partition(spark):
    rows = [(i, i % 40, 2018 + i % 5, float(i % 13), float(i % 7), "ab"[i % 2]) for i in range(400)]
    sales = spark.createDataFrame(rows, "transfer_id long, player_id long, sale_season int, y double, a double, b string")
    got = signals.out_of_fold(sales, [signals.Arm("one", ("a",)), signals.Arm("two", ("a",), ("b",))], "y", False, repeats=2)
    fits = got.withColumn("task", F.spark_partition_id()).groupBy("task", "arm", "model", "scheme", "fold").agg(F.count_distinct("row").alias("n")).collect()
    assert len(fits) == len({r.task for r in fits}) == 2 * 2 * 11
    assert sum(r.n for r in fits if r.scheme == "grouped") == 2 * 2 * 2 * 400 and {r.n for r in fits if r.scheme == "time"} == {80}


def test_leakage_guard(spark):
    df = spark.createDataFrame([(float(i), float(i) * 2, float(i % 3)) for i in range(20)], "y double, a double, b double")
    signals.leakage_guard(df, ["b"], "y")
    with pytest.raises(ValueError):
        signals.leakage_guard(df, ["a"], "y")
    with pytest.raises(ValueError):
        signals.leakage_guard(df, ["fee_amount"], "y")


def test_check_catalogue():
    checks = audit.catalogue(percentiles.CLUSTERING)
    assert len(checks) == 50 and sum(c.severity == "error" for c in checks) == 43 and len({c.name for c in checks}) == 50


def test_check_engine(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "k int, v int")
    checks = [audit.where("neg", "error", "v < 0", table="t"), audit.where("known", "error", "v < 0", 1, "t"), audit.where("gone", "warn", "v < 0", table="u"), audit.where("broken", "warn", "nope < 0", table="t")]
    got = audit.run_checks(checks, {"t": df})
    assert [r["status"] for r in got] == ["FAIL", "KNOWN", "SKIPPED", "ERROR"] and audit.exit_code(got) == 1 and audit.exit_code(got[1:3]) == 0
    with pytest.raises(ValueError):
        audit.run_checks(checks, {"t": df}, ["no"])


def test_schedule_caps(spark):
    clubs = [f"c{i}" for i in range(6)]
    rows, g = [], 0
    for r in range(4):
        for i in range(6):
            for j in range(6):
                if i != j and (r < 1 or i < 1):
                    rows.append((2020, g, datetime(2020, 1, 1 + g % 27), clubs[i], clubs[j]))
                    g += 1
    df = spark.createDataFrame(rows, "season_id int, game_id long, date timestamp, home_team string, away_team string")
    schedule.validate(df)
    kept = schedule.capped(df, 10).where("regular")
    assert schedule.verify_caps(kept, 10, exact=False).count() == 0
    seen = {c: 0 for c in clubs}
    want = set()
    for _, gid, _, h, a in sorted(rows, key=lambda r: (r[2], r[1])):
        if seen[h] < 10 and seen[a] < 10:
            want.add(gid)
            seen[h] += 1
            seen[a] += 1
    assert {r.game_id for r in kept.collect()} == want


def test_names():
    assert round(Z.winkler("martha", "marhta"), 4) == 0.9611 and Z.indel_ratio("ab", "ba") == 0.5 and Z.winkler("", "a") == 0.0


def test_contradictions_and_upsert(spark):
    m = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("c", "z"), ("d", "w")], "a string, b string")
    assert [r.a for r in identity.without_contradictions(m, "a", "b").collect()] == ["d"]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, tables.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, tables.insert_if_absent(old, new, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]


def test_transfer_pages(spark):
    row = "<tr><td><a href='/a/spieler/5'>P</a></td><td>20</td><td><a href='/b/verein/9/saison_id/2015'>X U21</a></td><td>€1.50m</td></tr>"
    head = "<tr><th>1</th><th>2</th><th>3</th><th>4</th></tr>"
    good = f"<h2>Arrivals 15/16</h2><table>{head}{row}</table>"
    lone = f"<table>{head}{row}</table>"
    pages = spark.createDataFrame([(1, good), (2, lone), (3, None), (4, "")], "k int, html string")
    rows = html_tables.transfer_rows(pages, ["k"])
    r = rows.where("k = 1").first()
    assert (r.direction, r.player_id, r.counterparty_club_id, r.season_id, r.fee_amount, r.is_internal_promotion) == ("in", 5, 9, 2015, 1.5, True)
    with pytest.raises(ValueError):
        html_tables.require_resolved(rows, ["k"])
    assert html_tables.require_resolved(rows.where("k = 1"), ["k"]).count() == 1


def test_evidence_as_in_its_sql(spark, tmp_path):
    """References that the SQL decodes, and how; two titles; white space; what the pattern leaves out."""
    titles = {'a &quot;b&quot; "c"': 'a \\"b\\" "c"', "x &amp;quot; y": 'x \\" y', "x &amp;amp;quot; y": "x &amp;quot; y", "a &lt; b &copy; &amp; c": "a &lt; b &copy; & c", "\u00a0 a\u2003b\t\n c ": "a\u2003b c", "q &amp\n": "q &amp", "q &amp": ..., "": None}
    rows = [(i, f"<title>{s}</title><p class='&quot;'>&quot;</p><svg><title>two</title></svg>") for i, s in enumerate(titles)]
    spark.createDataFrame([*rows, (99, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.title for r in sources.evidence(spark, str(tmp_path)).collect()}
    assert got == {i: v for i, v in enumerate(titles.values()) if v is not ...}


def test_islands_and_differences(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, "a")], "k int, o int, v string")
    got = tables.islands(df, ["k"], "o", "v").orderBy("first").collect()
    assert [(r.v, r.first, r.last) for r in got] == [("a", 1, 2), (None, 3, 3), ("a", 4, 4)]
    assert isinstance(pd.DataFrame(got), pd.DataFrame)


def test_signals_take_every_sale(spark, tmp_path, monkeypatch):
    orders = [(i, i % 7, datetime(1994 + i % 5, 1, 1), 1000.0 * i) for i in range(1, 120)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i % 3, 10.0 * i, "x") for i in range(7)], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    seen = []
    monkeypatch.setattr(modeling.S, "compare", lambda sales, arms, base, target, classify, **kw: seen.append((sales.count(), set(kw) - {"seed"})) or pd.DataFrame({"n": [0]}))
    modeling.fee_signal(spark, str(tmp_path))
    modeling.outgrew_signal(spark, str(tmp_path))
    assert seen == [(119, set())] * 2


def test_archetype_queries_take_every_vector(spark, tmp_path, monkeypatch):
    x = np.repeat(np.arange(5), 8)[:, None] * 10.0 + np.random.default_rng(1).normal(0, 0.1, (40, 3))
    spark.createDataFrame([(500 + i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    r = modeling.ward(spark, str(tmp_path)).collect()[0]
    assert (r.ari, r.smallest) == (1.0, 8)
    seen = []
    monkeypatch.setattr(modeling.A, "stability", lambda e, **kw: seen.append((e.count(), kw)))
    modeling.stability(spark, str(tmp_path))
    assert seen == [(40, {})]


def test_names_fold_every_accent(spark):
    """Against Unicode's decomposition, for all Latin letters with marks."""
    import unicodedata

    letters = [chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if chr(c).isalpha()]
    want = {c: "".join(x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x)) for c in letters}
    got = {r.c: r.n for r in spark.createDataFrame([(c,) for c in letters], "c string").select("c", C.plain_name("c").alias("n")).collect()}
    assert {c: (got[c], want[c]) for c in letters if got[c] != want[c]} == {}
    one = spark.createDataFrame([("  Où  Ždeněk Ştefan   Őry ",), ("José",)], "c string").select(C.plain_name("c").alias("n")).collect()
    assert [r.n for r in one] == ["ou zdenek stefan ory", "jose"]


def _season(n: int = 30) -> list[dict]:
    """Sound master rows: 18 clubs with so many players that their minutes add up."""
    rows = []
    for club in range(18):
        for p in range(n):
            rows.append({"player_id": club * 100 + p, "season_id": 2020, "team": f"t{club}", "fbref_born": 1995, "fbref_position": "FW", "tm_height_cm": 180, "fbref_nineties": 12.4, "fbref_points_per_match": 1.5, "fbref_non_penalty_goals_per90": 0.0, "fbref_substitute_appearances": 1}
                        | dict.fromkeys(audit.COUNTS, 0) | dict.fromkeys(audit.PERCENTS, 0.0) | dict.fromkeys([r for _, r in audit.PER90], 0.0)
                        | {"fbref_minutes": 1116, "fbref_matches_played": 30, "fbref_starts": 10, "ws_matches_with_data": 30, "gk_goals_against": None})
    return rows


@pytest.mark.parametrize(
    ("name", "change"),
    [
        ("born_plausible", {"fbref_born": 2015}), ("nineties_match_minutes", {"fbref_nineties": 20.0}), ("starts_le_matches", {"fbref_starts": 31}),
        ("cards_le_matches", {"fbref_yellow_cards": 31}), ("second_yellow_le_red", {"fbref_second_yellow_cards": 1}), ("non_negative_counts", {"ws_pen_area_entries": -1}),
        ("percent_columns_in_range", {"gk_penalty_kick_save_pct": 101.0}), ("points_per_match_range", {"fbref_points_per_match": 3.5}), ("shots_on_target_le_shots", {"fbref_shots_on_target": 1}),
        ("ws_passes_completed_le_passes", {"ws_passes_completed": 1}), ("ws_tackles_won_le_tackles", {"ws_tackles_won": 1}), ("ws_per90_sign_consistent", {"ws_clearances": 1}),
        ("ws_matches_le_fbref_matches", {"ws_matches_with_data": 33}), ("gk_saves_le_shots_faced", {"gk_saves": 1}), ("gk_clean_sheets_le_matches", {"gk_clean_sheets": 31}),
        ("gk_penalties_saved_le_faced", {"gk_penalty_kicks_saved": 1}), ("outfielders_with_keeper_stats", {"gk_goals_against": 1}), ("height_range", {"tm_height_cm": 300}), ("duplicate_player_season_team", {"player_id": 1, "team": "t0"}),
        ("clubs_per_season", {"team": "other"}), ("ws_team_coverage", {}), ("team_season_minutes", {}),
    ],
)
def test_validator_planted(spark, name, change):
    """Each check is silent on sound rows and reports the one that is broken; limits lie where they should."""
    rows = _season()
    if name == "team_season_minutes":
        for r in rows[:30]:
            r |= {"fbref_minutes": 900, "fbref_nineties": 10.0}
    elif name == "ws_team_coverage":
        for r in rows[:30]:
            r["ws_matches_with_data"] = 25
    else:
        rows[500 if "team" not in change else 5] |= change
    names = list(rows[0])
    kind = {"team": "string", "fbref_position": "string"} | dict.fromkeys([*audit.PERCENTS, *[r for _, r in audit.PER90], "fbref_nineties", "fbref_points_per_match", "fbref_non_penalty_goals_per90"], "double")
    df = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], ", ".join(f"{c} {kind.get(c, 'long')}" for c in names))
    checks = {c.name: c for c in audit.catalogue(percentiles.CLUSTERING)}
    sound = spark.createDataFrame([tuple(r[c] for c in names) for r in _season()], df.schema)
    assert audit.run_checks([checks[name]], {"master": sound})[0]["status"] == "PASS"
    got = audit.run_checks([checks[name]], {"master": df})[0]
    assert got["status"] in ("FAIL", "WARN", "KNOWN") and got["violations"] >= 1 and got["sample"], got
    assert audit.run_checks([checks["ws_team_names_match_fbref"]], {"ws_source": df})[0]["status"] == "SKIPPED"


def test_row_checks_share_one_aggregation(spark):
    df = spark.createDataFrame([(1, -1), (2, 5)], "a long, b long")
    some = [audit.where("x", "error", "b < 0", table="t"), audit.where("y", "warn", "a > 5", table="t"), audit.where("z", "error", "c < 0", table="t")]
    assert [(r["status"], r["violations"]) for r in audit.run_checks(some, {"t": df})] == [("FAIL", 1), ("PASS", 0), ("ERROR", None)]
