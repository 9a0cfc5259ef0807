"""Behaviour on small hand-made inputs."""

from __future__ import annotations

import datetime as dt
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from statspark import catalog
from statspark import fixtures as fx
from statspark.functions import metrics
from statspark.operators import features, learning, quality, rolling, transform, upsert
from statspark.plans import jobs
from statspark.schemas import BATTER, FACT, PITCHER, feature_names
from statspark.sources import landed, tables
from statspark.streaming import landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_feature_names():
    names = feature_names(BATTER)
    assert len(names) == 44 and names[0] == "bat_games_played_7" and names[22] == "bat_games_played_30"
    assert len(feature_names(PITCHER)) == 32 and len(FACT) == 67


def test_innings(spark):
    df = spark.createDataFrame([("0.0",), ("5.1",), (" 6 ",), ("",), ("junk",), (None,)], "t string")
    assert [r[0] for r in df.select(metrics.innings(F.col("t"))).collect()] == [0.0, 5.1, 6.0, 0.0, 0.0, 0.0]


def test_sections_empty_absent_null(spark):
    box = {"teams": {"home": {"players": {
        "ID1": {"person": {"id": 1}, "parentTeamId": 9, "position": {}, "stats": {"batting": {}, "fielding": {"chances": 2}}},
        "ID2": {"person": {"id": 2}, "parentTeamId": 9, "stats": {}},
        "ID3": {"person": {}, "parentTeamId": 9, "stats": {"batting": {"hits": 1}}},
        "ID4": {"person": {"id": 4}, "parentTeamId": 9, "position": {"code": "1", "name": "P"}, "stats": {"pitching": {"hits": "3", "era": "-.--"}}}}},
        "away": {"players": None}}}
    raw = spark.createDataFrame([(7, json.dumps(box)), (8, "not json"), (9, None)], "game_pk long, json string")
    got = transform.flatten(landed.boxscore_players(raw)).orderBy("player_id").collect()
    assert [(r.player_id, r.bat_hits, r.fld_chances, r.pit_hits, r.position_code) for r in got] == [(1, None, 2, None, ""), (4, None, None, 3, "1")]


def test_nearest_constants_tie_takes_lower(spark):
    lookup = {r.for_season: r.season for r in transform.nearest_constants(fx.constants(spark)).collect()}
    assert [lookup[y] for y in (1900, 1996, 1997, 1998, 1999, 2000, 2050)] == [1996, 1996, 1996, 1998, 1998, 2001, 2001]
    assert transform.nearest_constants(fx.constants(spark).limit(0)).count() == 0


def test_upsert_replaces_with_nulls_and_keeps_old(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, made int")
    new = spark.createDataFrame([(2, None, 99), (3, "c", 30)], "k int, v string, made int")
    once = upsert.upsert(old, new, ["k"], keep_old=("made",))
    assert rows(once) == [(1, "a", 10), (2, None, 20), (3, "c", 30)]
    assert rows(upsert.upsert(once, new, ["k"], keep_old=("made",))) == rows(once)
    assert rows(upsert.upsert(old, new.limit(0), ["k"])) == rows(old)


def test_upsert_last_wins_or_fails(spark):
    twice = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, o int")
    assert rows(upsert.last_wins(twice, ["k"], "o")) == [(1, "y")]
    with pytest.raises(Exception, match="keys occur twice"):
        upsert.last_wins(twice, ["k"]).collect()


def test_renamed_team_and_known_player(spark):
    games = spark.createDataFrame([(1, 5, 6, "A", "B"), (2, 6, 5, "B2", "A")], "game_pk long, home_team_id int, away_team_id int, home_team string, away_team string")
    teams = spark.createDataFrame([(5, "old", "AB"), (7, "C", "CC")], "team_id int, name string, abbreviation string")
    assert rows(upsert.upsert_teams(teams, games)) == [(5, "A", "AB"), (6, "B2", None), (7, "C", "CC")]
    players = spark.createDataFrame([(1, "Known")], "player_id int, full_name string")
    offered = spark.createDataFrame([(1,), (2,), (2,), (None,)], "player_id int")
    assert rows(upsert.insert_players(players, offered)) == [(1, "Known"), (2, "Unknown")]


def test_schedule_rules(spark):
    games = spark.createDataFrame([("1", "h", "a", "2024-01-01"), ("-1", "h", "a", "2024-01-01"), ("x", None, "a", None), (None, "h", "a", "d")], "game_id string, home_name string, away_name string, game_date string")
    found = quality.schedule_violations(games)
    assert rows(found.groupBy("key").agg(F.count("*"))) == [("-1", 1), ("x", 3), (None, 1)]
    with pytest.raises(quality.QualityError):
        quality.require(found)
    quality.require(quality.schedule_violations(games.limit(0)))
    assert quality.at_least(games.limit(0), 1).count() == 1 and quality.at_least(games, 1).count() == 0


def test_empty_section_is_a_section(spark):
    schema = "game_pk long, player_id int, team_id int, position_code string, position_name string, batting map<string,string>, pitching map<string,string>, fielding map<string,string>"
    players = spark.createDataFrame([(1, 1, 1, "", "", {}, None, None), (1, 2, 1, "", "", None, None, None)], schema)
    assert rows(quality.stats_violations(players)) == [("2", "no section")]


def test_freshness(spark):
    at = lambda h: dt.datetime(2024, 1, 31) - dt.timedelta(hours=h)
    audit = spark.createDataFrame([("a", at(1)), ("a", at(90)), ("b", at(25)), ("c", at(1)), ("c", None), ("d", at(24))], "pipeline_name string, loaded_at timestamp")
    status = {r.pipeline_name: r.status for r in quality.freshness(audit, "2024-01-31 00:00:00").collect()}
    assert status == {"a": "fresh", "b": "stale", "c": "none", "d": "fresh"}
    for name in ("b", "c", "missing"):
        with pytest.raises(quality.QualityError):
            quality.require_fresh(audit, name, "2024-01-31 00:00:00")
    quality.require_fresh(audit, "a", "2024-01-31 00:00:00")


@pytest.mark.parametrize(("scheduled", "loaded", "ok"), [(5, 5, True), (0, 0, True), (5, 3, False), (0, 1, False)])
def test_load_count(spark, scheduled, loaded, ok):
    assert quality.load_count(spark.range(scheduled), spark.range(loaded)).first()["ok"] is ok


def test_one_date_equals_all_dates(spark, sf_dir):
    raw, games, constants = fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), fx.constants(spark)
    fact = transform.enrich(raw, games, constants).cache()
    every = rolling.rolling_all_dates(fact, games, constants).cache()
    days = every.select("as_of_date").distinct().orderBy(F.xxhash64("as_of_date")).limit(3).collect()
    for day in (str(r.as_of_date) for r in days):
        want = rows(every.where(F.col("as_of_date") == day))
        assert want and rows(rolling.rolling_one_date(fact, games, constants, day)) == want


def test_wide(spark):
    long = spark.createDataFrame([(1, "2024-01-01", 7, 0.3), (1, "2024-01-01", 30, 0.4), (2, "2024-01-01", 30, 0.5)], "player_id int, d string, window_days int, bat_woba double")
    long = long.select("player_id", F.col("d").cast("date").alias("as_of_date"), "window_days", "bat_woba")
    assert [r[2:] for r in rows(features.wide(long, ["bat_woba"]))] == [(0.3, 0.4), (None, 0.5)]
    assert features.wide(long.limit(0), ["bat_woba"]).count() == 0


def test_roster_is_eight_days(spark):
    games = spark.createDataFrame([(1, "2024-01-01"), (2, "2023-12-25"), (3, "2023-12-24")], "game_pk long, d string")
    games = games.select("game_pk", F.col("d").cast("date").alias("game_date"))
    fact = spark.createDataFrame([(1, 101, 1), (2, 102, 2), (3, 103, 1), (1, 104, 5)], "game_pk long, player_id int, team_id int")
    schedule = spark.createDataFrame([(12345, 1, 2)], "game_pk long, home_team_id int, away_team_id int")
    assert rows(features.roster(schedule, fact, games, F.lit("2024-01-01").cast("date"))) == [(12345, 101), (12345, 102)]
    assert features.roster(schedule.limit(0), fact, games, F.lit("2024-01-01").cast("date")).count() == 0


def test_roster_pairs_are_distinct_without_a_distinct(spark):
    """Players of both teams, games listed twice and teams against themselves make one pair each; no aggregate runs over pairs."""
    games = spark.createDataFrame([(1, "2024-01-01")], "game_pk long, day string").select("game_pk", F.col("day").cast("date").alias("game_date"))
    fact = spark.createDataFrame([(1, 5, 10), (1, 5, 11), (1, 6, 11), (1, 7, None), (2, 8, 10)], "game_pk long, player_id long, team_id int")
    schedule = spark.createDataFrame([(3, 10, 11), (3, 10, 11), (3, 11, 12), (4, 11, 11), (5, None, 10)], "game_pk long, home_team_id int, away_team_id int")
    found = features.roster(schedule, fact, games, F.lit("2024-01-01").cast("date"))
    assert rows(found) == [(3, 5), (3, 6), (4, 5), (4, 6), (5, 5)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Join Inner")]


def test_roster_sums_only_recent_games(spark, sf_dir):
    """The join with the recent games stands below the shuffle by game."""
    plan = catalog.roster_for_schedule(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2



def closed_form(x, y, alpha=1.0):
    x = x.copy()
    for j in range(x.shape[1]):
        known = x[~np.isnan(x[:, j]), j]
        x[np.isnan(x[:, j]), j] = np.median(known) if len(known) else 0.0
    std = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(std == 0, 1, std)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return z @ w + y.mean()


def test_ridge_equals_closed_form(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 5))
    x[:, 3], x[::7, 1], x[:, 4] = 2.0, np.nan, np.nan
    y = x[:, 0] * 2 + rng.normal(size=40)
    names = list("abcde")
    data = [(*(None if np.isnan(v) else float(v) for v in row), float(t)) for row, t in zip(x, y)]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names) + ", label double")
    model = learning.train(df, names, "now", path=str(tmp_path / "m"))
    want = closed_form(x, y)
    got = [r.p for r in learning.score(model, df, "p").collect()]
    assert np.allclose(got, want, atol=1e-9)
    assert model.metadata["n_samples"] == 40 and abs(model.metadata["train_rmse"] - np.sqrt(((want - y) ** 2).mean())) < 1e-9
    again = learning.Model.load(str(tmp_path / "m"))
    assert np.allclose([r.p for r in learning.score(again, df.drop("b"), "p").collect()], closed_form_of(model, x))
    assert learning.train(df.limit(0), names, "now") == {"n_samples": 0, "trained_at": None}
    with pytest.raises(Exception):  # noqa: B017
        learning.Model.load(str(tmp_path / "none"))


def closed_form_of(model, x):
    x = x.copy()
    x[:, 1] = np.nan
    for j, n in enumerate("abcde"):
        x[np.isnan(x[:, j]), j] = model.medians[n]
    return x @ np.array(model.fitted.coefficients) + model.fitted.intercept


def test_model_queries_equal_closed_form(spark, sf_dir):
    metrics_ = {r.model: r for r in catalog.train_metrics(spark, sf_dir).collect()}
    day = catalog.rolling_one_date(spark, sf_dir).toPandas()
    want = {}
    for which, build, columns, digits in (("batter", catalog.training_batter, BATTER, 4), ("pitcher", catalog.training_pitcher, PITCHER, 2)):
        names = feature_names(columns)
        rows = build(spark, sf_dir).toPandas()
        x, y = rows[names].astype(float).to_numpy(), rows["label"].astype(float).to_numpy()
        middle = np.array([np.nan_to_num(np.nanmedian(c)) if (~np.isnan(c)).any() else 0.0 for c in x.T])
        x = np.where(np.isnan(x), middle, x)
        mean, std = x.mean(axis=0), np.where(x.std(axis=0) == 0, 1, x.std(axis=0))
        z = (x - mean) / std
        w = np.linalg.solve(z.T @ z + np.eye(len(names)), z.T @ (y - y.mean()))
        error = np.sqrt(((z @ w + y.mean() - y) ** 2).mean())
        assert metrics_[which].n_samples == len(y) and abs(metrics_[which].train_rmse - error) < 1e-6
        wide = {}
        for (player, n), part in day.groupby(["player_id", "window_days"]):
            for c in columns:
                wide.setdefault(player, {})[f"{c}_{n}"] = float(part[c].iloc[0]) if part[c].notna().any() else np.nan
        for player, values in wide.items():
            v = np.array([values.get(n, np.nan) for n in names])
            want[which, player] = float((np.where(np.isnan(v), middle, v) - mean) / std @ w + y.mean())
    got = catalog.predictions(spark, sf_dir).collect()
    assert {(r.game_pk, r.player_id) for r in got} == {tuple(r) for r in catalog.roster_for_schedule(spark, sf_dir).collect()}
    for r in got:
        for which, value, step in (("batter", r.pred_bat_woba, 1e-4), ("pitcher", r.pred_pit_fip, 1e-2)):
            assert (value is None) == ((which, r.player_id) not in want)
            assert value is None or abs(value - want[which, r.player_id]) <= step * 0.51


def test_gram_matrices_equal_linear_regression(spark):
    """The closed form against Spark's own solver, with nulls, a constant column and days added up."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)) * [1, 10, 100, 1, 0.01, 5] + [0, 5, -50, 0, 3, 7]
    x[:, 3] = 4.0
    hole = rng.random(x.shape) < 0.2
    y = x[:, 0] - 0.1 * x[:, 1] + rng.normal(size=300)
    names = list("abcdef")
    data = [(f"2001-01-{1 + i % 9:02}", *(None if h or j == 3 and i % 50 else float(v) for j, (v, h) in enumerate(zip(r, hs))), float(t)) for i, (r, hs, t) in enumerate(zip(x, hole, y))]
    rows = spark.createDataFrame(data, "date string, " + ", ".join(f"{n} double" for n in names) + ", label double").withColumn("game_date", F.col("date").cast("date")).repartition(5)
    products, counts = learning.grams(rows, names).cache(), learning.value_counts(rows, names, "game_date").cache()
    assert products.select("day").distinct().count() == 9 and products.count() == 9 * 14
    model = learning.train_from_sums(counts, products, names, "t", alpha=2.0)
    assert model.metadata["n_samples"] == 300
    middle = rows.agg(*(F.median(n).alias(n) for n in names)).first().asDict()
    assert model.medians == middle
    filled = VectorAssembler(inputCols=names, outputCol="features").transform(rows.fillna(middle))
    spread = rows.agg(F.stddev_pop("label")).first()[0]
    # Spark scales its penalty by the rows and the label's spread.
    fitted = LinearRegression(solver="normal", standardization=True, regParam=2.0 / 300 * spread, elasticNetParam=0.0).fit(filled)
    want = [r.prediction for r in fitted.transform(filled.orderBy("label")).collect()]
    got = [r.p for r in learning.score(model, rows.orderBy("label"), "p").collect()]
    assert np.allclose(got, want, atol=1e-6) and np.allclose(got, closed_form(np.array([[np.nan if v is None else v for v in r[1:7]] for r in data]), y, 2.0)[np.argsort(y)], atol=1e-9)
    some = learning.train_from_sums(counts.where("game_date < '2001-01-04'"), products.where("day < '2001-01-04'"), names, "t")
    part = learning.train(rows.where("game_date < '2001-01-04'"), names, "t")
    assert np.allclose(some.fitted.coefficients, part.fitted.coefficients) and some.medians == part.medians
    assert learning.train_from_sums(counts, products.limit(0), names, "t") == {"n_samples": 0, "trained_at": None}
    flat = learning.train(rows, names, "t", fit_intercept=False)
    assert abs(np.mean([r.p for r in learning.score(flat, rows, "p").collect()])) < 1e-9


def test_medians_by_ranks(spark):
    rows = [(1.0, 2.0, None, 5.0), (1.0, 4.0, None, None), (3.0, None, None, None), (7.0, 8.0, None, None), (7.0, 9.0, None, None)] * 7
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    assert tuple(learning.medians(df, list("abcd")).first()) == (3.0, 6.0, 0.0, 5.0)
    assert tuple(learning.medians(df.limit(0), ["a"]).first()) == (0.0,)


def test_orphans_by_bitmaps(spark):
    keys = [1, 2, 32_767, 32_768, 32_769, 65_536, 65_537, 10**12, 0, -1, -32_767, -32_768, -10**9]
    parents = spark.createDataFrame([(k,) for k in keys if k % 2] + [(None,)], "k long")
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([*keys, *keys, None, 3, -3, 40_000])], "k long, bits int")
    found = quality.orphans(rows, parents, "k")
    assert sorted(r.k for r in found.collect()) == sorted([k for k in keys if k % 2 == 0] * 2 + [3, -3, 40_000])
    assert found.columns == rows.columns and "Exchange hash" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in quality.orphans(rows, parents.limit(0), "k").collect()) == sorted(2 * keys + [3, -3, 40_000])


def test_latest_before(spark):
    day = lambda d: dt.date.fromisoformat(d)
    targets = spark.createDataFrame([(1, day("2001-05-02"), 0.1), (1, day("2001-05-02"), 0.2), (1, day("2002-04-01"), 0.3), (2, day("2001-05-01"), 0.4), (3, day("2001-05-01"), 0.5), (1, day("2000-01-01"), 0.6)], "player_id int, game_date date, label double")
    found = spark.createDataFrame([(1, day("2001-05-01"), 1.0), (1, day("2001-05-02"), None), (2, day("2001-05-01"), 3.0), (1, day("2000-09-30"), 4.0)], "player_id int, as_of_date date, x double")
    got = {(r.player_id, str(r.game_date), r.label): (str(r.as_of_date), r.x) for r in features.latest_before(targets, found).collect()}
    # The same day does not count; a found row counts with its nulls; a season's gap does not matter.
    assert got == {(1, "2001-05-02", 0.1): ("2001-05-01", 1.0), (1, "2001-05-02", 0.2): ("2001-05-01", 1.0), (1, "2002-04-01", 0.3): ("2001-05-02", None)}


def test_windows_by_differences(spark, sf_dir):
    """Any windows, against sums of the rows in reach."""
    fact = transform.enrich(fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), fx.constants(spark))
    days = rolling.daily(fact, fx.games(spark, sf_dir)).where("player_id % 3 = 0").cache()
    windows = (1, 3, 45, 400)
    got = {(r.player_id, r.as_of_date, r.window_days): (r.bat_hits, r.pit_hits, r[rolling.INNINGS], r[rolling.WEIGHTED]) for r in rolling.windowed(days, windows).collect()}
    own = {}
    for r in days.collect():
        own.setdefault(r.player_id, []).append(r)
    want = {}
    for player, rows_ in own.items():
        for r in rows_:
            for n in windows:
                near = [x for x in rows_ if r.game_date - dt.timedelta(days=n) < x.game_date <= r.game_date]
                if sum(x.bat_games_played + x.pit_games_played + x.fld_chances for x in near) > 0:
                    want[player, r.game_date, n] = tuple(sum(x[c] for x in near) for c in ("bat_hits", "pit_hits", rolling.INNINGS, rolling.WEIGHTED))
    assert len(want) > 3000 and got == want


def test_landed_types(spark):
    box = {"teams": {"home": {"players": {f"ID{i}": {"person": {"id": i}, "parentTeamId": 9, "stats": {"batting": {"hits": i, "babip": v, "home_run_rate": v}}} for i, v in enumerate([0.5, 1, ".300", True, None, {"a": 1}])}}}}
    raw = spark.createDataFrame([(7, json.dumps(box))], "game_pk long, json string")
    got = {r.player_id: (r.bat_hits, r.bat_babip, r.bat_home_run_rate) for r in transform.flatten(landed.boxscore_players(raw)).collect()}
    assert got == {0: (0, 0.5, 0.5), 1: (1, 1.0, 1.0), 2: (2, None, None), 3: (3, None, None), 4: (4, None, None), 5: (5, None, None)}


def test_jobs_from_landed_files(spark, sf_dir, tmp_path):
    games = fx.games(spark, sf_dir).where("game_date between date'2001-06-20' and date'2001-07-31'").cache()
    raw = fx.raw_fact(spark, sf_dir).join(games.select("game_pk"), "game_pk", "left_semi")
    schedule = str(tmp_path / "schedule")
    fx.schedule(games).write.json(schedule)
    boxes = tmp_path / "boxes"
    boxes.mkdir()
    for r in fx.boxscore_json(fx.players(raw)).collect():
        (boxes / f"{r.game_pk}.json").write_text(r.json)
    root, constants = str(tmp_path / "tables"), fx.constants(spark)
    days = [r.d for r in games.select(F.date_format("game_date", "MM/dd/yyyy").alias("d")).distinct().orderBy("d").limit(3).collect()]
    for day in [days[0], days[1], days[0]]:
        counts = jobs.run_daily_stats(spark, schedule, str(boxes), constants, root, day, "2001-07-31 02:00:00").first()
    assert counts["games"] > 0 and tables.read(spark, root, "dim_game").count() == games.where(F.date_format("game_date", "MM/dd/yyyy").isin(days[:2])).count()
    fact = tables.read(spark, root, "fact_game_state")
    assert quality.duplicate_keys(fact, ["game_pk", "player_id"]).count() == 0
    every = jobs.run_rolling_backfill(spark, root, constants)
    last = str(every.agg(F.max("as_of_date")).first()[0])
    with pytest.raises(Exception):  # noqa: B017  too few games to train on, and no model from before
        jobs.run_predictions(spark, fx.schedule(games), root, last, "2001-07-31 06:00:00", "t1")
    assert jobs.run_predictions(spark, fx.schedule(games).limit(0), root, last, "2001-07-31 06:00:00", "t1").count() == 0
    tables.write(spark, root, "dim_game", fx.games(spark, sf_dir))
    everything = transform.enrich(fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), constants)
    tables.write(spark, root, "fact_game_state", jobs.placed(everything, fx.games(spark, sf_dir)))
    last = str(jobs.run_rolling_backfill(spark, root, constants).agg(F.max("as_of_date")).first()[0])
    scored = jobs.run_predictions(spark, fx.schedule(games), root, last, "2001-07-31 06:00:00", "t1")
    assert scored.count() > 0 and spark.read.parquet(f"{root}/load_audit").count() == 5
    with pytest.raises(ValueError):
        jobs.run_daily_stats(spark, schedule, str(boxes), constants, root, "01/01/1950", "2001-07-31 02:00:00")
    assert landed.landed_readiness(spark, str(tmp_path / "nowhere"), days[0]).first()["status"] == "not_ready"


def test_only_the_files_of_the_games_are_opened(spark, tmp_path):
    for i in (7, 77, 8):
        (tmp_path / f"{i}.json").write_text(f'{{"teams": {i}}}')
    assert rows(landed.boxscores(spark, str(tmp_path), [7, 8, 9])) == [(7, '{"teams": 7}'), (8, '{"teams": 8}')]
    assert landed.boxscores(spark, str(tmp_path), [9]).count() == 0 == landed.boxscores(spark, str(tmp_path), []).count()
    assert landed.boxscores(spark, str(tmp_path)).count() == 3


def test_stream_follows_landing(spark, sf_dir, tmp_path):
    seen = []
    path = tmp_path / "in"
    path.mkdir()
    game = {"game_id": "1", "game_date": "2024-03-01", "home_name": "h", "away_name": "a"}
    (path / "a.json").write_text(json.dumps(game))
    handle = lambda df, _: seen.append(landing.affected_dates(df).agg(F.min("as_of_date"), F.max("as_of_date"), F.count("*")).first())
    for text in (None, json.dumps(game | {"game_date": "2024-02-01"})):
        if text:
            (path / "b.json").write_text(text)
        landing.follow(spark, str(path), str(tmp_path / "check"), handle).awaitTermination()
    assert [tuple(map(str, r)) for r in seen] == [("2024-03-01", "2024-03-30", "30"), ("2024-02-01", "2024-03-01", "30")]


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1] for line in plan.splitlines() if " Exchange hashpartitioning" in line]


@pytest.fixture
def without_broadcasts(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_wide_rows_are_shuffled_by_player_alone(spark, sf_dir, without_broadcasts):
    """Facts are not shuffled by game once they are wide, and the days of a player not once more for the windows."""
    raw, games, constants = fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), fx.constants(spark)
    fact = transform.enrich(raw, games, constants)
    assert not any("game_pk" in x and "REPARTITION" not in x and "l_" in x for x in shuffles(raw))
    every = shuffles(rolling.rolling_all_dates(fact, games, constants))
    assert sum("(player_id#" in x for x in every) == 1
    box = shuffles(fx.boxscore_json(fx.players(raw)))
    assert len(box) == len(shuffles(raw)) == 3  # lines and players by player, narrow lines by game


def test_wide_all_dates_makes_what_wide_does(spark, sf_dir):
    raw, games, constants = fx.raw_fact(spark, sf_dir), fx.games(spark, sf_dir), fx.constants(spark)
    fact = transform.enrich(raw, games, constants)
    for columns in (BATTER, PITCHER):
        want = features.wide(rolling.rolling_all_dates(fact, games, constants), columns)
        got = rolling.wide_all_dates(fact, games, constants, columns)
        assert got.dtypes == want.dtypes
        want, got = ({(r[0], r[1]): r for r in df.collect()} for df in (want, got))
        assert got == want and got
        next_day = {k for k in want if (k[0], k[1] + dt.timedelta(days=1)) in {(r.player_id, r.game_date) for r in rolling.daily(fact, games).select("player_id", "game_date").collect()}}
        followed = rolling.wide_all_dates(fact, games, constants, columns, followed=True).collect()
        assert {(r[0], r[1]): r for r in followed} == {k: want[k] for k in next_day}


def test_values_are_counted_in_the_tasks(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, 1.0, -0.0), (2, 1.0, 0.0), (None, 2.0, None), (None, 2.0, 3.0)], "day int, a double, b double")
    counts = learning.value_counts(df, ["a", "b"], "day")
    want = [(None, "a", 2.0, 2), (None, "b", 3.0, 1), (1, "a", 1.0, 2), (1, "b", 0.0, 1), (2, "a", 1.0, 1), (2, "b", 0.0, 1)]
    assert sorted(map(tuple, counts.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, learning.value_counts(df, ["a", "b"]).collect())) == [("a", 1.0, 3), ("a", 2.0, 2), ("b", 0.0, 2), ("b", 3.0, 1)]
    assert "Generate" not in counts._jdf.queryExecution().executedPlan().toString()
    got = {r.feature: (r.median, round(r["mean"], 6), round(r["std"], 6)) for r in learning.feature_statistics(df, ["a", "b"]).collect()}
    assert got == {"a": (1.0, 1.4, 0.489898), "b": (0.0, 0.6, 1.2)}


def test_games_of_a_day_far_apart_share_a_partition(spark, tmp_path):
    games = spark.range(300).select((F.col("id") * 2000).alias("game_pk"), F.lit(200106).alias("month"))
    tables.write(spark, str(tmp_path), "game_months", games)
    assert len(list((tmp_path / "game_months").glob("part=*"))) == 1


@pytest.mark.parametrize("name", ["upsert_fact", "rolling_all_dates"])
def test_generated_methods_stay_within_what_the_jit_compiles(spark, name):
    """HotSpot leaves methods of more than 8,000 bytes to the interpreter; Spark tells the longest one of each stage."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        text = plan.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000


def test_upsert_keeps_an_old_null_and_refuses_equal_keys(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k long, v string, at string")
    new = spark.createDataFrame([(1, "c", "new"), (3, None, "new")], "k long, v string, at string")
    got = upsert.upsert(old, new, ["k"], keep_old=("at",))
    assert sorted(map(tuple, got.collect())) == [(1, "c", None), (2, "b", "x"), (3, None, "new")]
    with pytest.raises(Exception, match="keys occur twice"):
        upsert.upsert(old, new.union(new), ["k"]).collect()
    ordered = new.withColumn("o", F.lit(None).cast("long")).union(new.selectExpr("k", "'last'", "at", "7L"))
    assert {r.k: r.v for r in upsert.upsert(old, ordered, ["k"], "o").collect()} == {1: "last", 2: "b", 3: "last"}
