"""Stored tables, the daily job and the stream: what they read, what they leave behind, what they do when games move."""

from __future__ import annotations

import json
import re
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from statspark import fixtures as fx
from statspark.operators import features, learning, quality, rolling, transform
from statspark.plans import jobs
from statspark.schemas import feature_names
from statspark.sources import tables

TABLES = ["dim_team", "dim_player", "dim_game", "game_months", "fact_game_state", "player_daily", "player_rolling_stats", "training_products", "training_values"]


def game(pk, date, home=1, away=2, **more):
    row = {"game_id": str(pk), "game_type": "R", "home_name": f"T{home}", "away_name": f"T{away}", "home_id": home, "away_id": away, "game_date": date, "venue_id": 5}
    return row | more


def box(pk, players=(11, 12, 13)):
    def player(i):
        n = (pk * 7 + i) % 5
        bat = {"gamesPlayed": 1, "atBats": 3 + n, "hits": n, "doubles": n % 2, "triples": 0, "homeRuns": 0, "baseOnBalls": i % 2, "hitByPitch": 0, "sacFlies": 0, "intentionalWalks": 0, "plateAppearances": 4 + n, "strikeOuts": 1, "babip": ".300" if n else 0.25, "home_run_rate": 0.5 * n}
        pit = {"gamesPlayed": 1, "inningsPitched": f"{n}.1", "hits": n, "homeRuns": 0, "baseOnBalls": 1, "hitByPitch": 0, "strikeOuts": n, "earnedRuns": 1, "outs": 3 * n + 1, "atBats": 9, "sacFlies": 0, "flyOuts": 2}
        stats = {"batting": bat, "pitching": pit if i % 2 else {}, "fielding": {"chances": n, "assists": 0, "errors": 0, "putOuts": n}}
        return {"person": {"id": i}, "parentTeamId": 1 + i % 2, "position": {"code": "1", "name": "P"}, "stats": stats}

    return json.dumps({"teams": {"home": {"players": {f"ID{i}": player(i) for i in players}}}})


def boxes(spark, *pks):
    return spark.createDataFrame([(pk, box(pk)) for pk in pks], "game_pk long, json string")


def landed(path, games):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{len(list(path.iterdir()))}.json").write_text("\n".join(map(json.dumps, games)))
    return str(path)


def contents(spark, root):
    jobs.refresh_training(spark, root)
    found = {}
    for name in (t for t in TABLES if tables.exists(spark, root, t)):
        rows = tables.read(spark, root, name, keep=True)
        found[name] = sorted((repr(tuple(r)) for r in rows.select(sorted(rows.columns)).collect()))
    return found


def scans(spark, action):
    """Location, partition filters and files read of every scan that an action runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    known = store.executionsCount()
    action()
    bus.waitUntilEmpty()
    found = []
    listed = store.executionsList(known, 100_000)
    for i in range(listed.size()):
        e = listed.apply(i)
        graph, metrics = store.planGraph(e.executionId()).allNodes(), store.executionMetrics(e.executionId())
        for k in range(graph.size()):
            node = graph.apply(k)
            if not node.name().startswith("Scan"):
                continue
            files = 0
            for m in (node.metrics().apply(j) for j in range(node.metrics().size())):
                value = metrics.get(m.accumulatorId())
                if m.name() == "number of files read" and value.isDefined():
                    files = int(value.get().replace(",", ""))
            place = re.search(r"Location: \w+(?:\(\d+ paths?\))?\[?\[?(\S+?)[\],]", node.desc())
            filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters|PartitionFilters: \[(.*?)\]", node.desc())
            found.append((place[1] if place else "", bool(filters and (filters[1] or filters[2])), files))
    return found


def history(spark, root, first, months):
    """Stored games and facts of so many months, one game a day for the first days of each."""
    games, pk = [], first * 1000
    for m in range(months):
        year, month = 2000 + (first + m) // 12, (first + m) % 12 + 1
        for d in (1, 2, 3, 8, 9):
            pk += 1
            games.append((pk, f"{year}-{month:02}-{d:02}", year, "R", 5, 1, 2, None))
    shape = "game_pk long, d string, season int, game_type string, venue_id int, home_team_id int, away_team_id int, winning_team string"
    rows = spark.createDataFrame(games, shape).withColumn("game_date", F.col("d").cast("date")).drop("d")
    players = jobs.flatten(jobs.landed.boxscore_players(boxes(spark, *(g[0] for g in games))))
    fact = jobs.enrich(players, rows, fx.constants(spark)).coalesce(1)
    tables.write(spark, root, "dim_game", rows.coalesce(1))
    tables.write(spark, root, "fact_game_state", jobs.placed(fact, rows).coalesce(1))
    tables.write(spark, root, "game_months", rows.select("game_pk", tables.month(F.col("game_date")).alias("month")).coalesce(1))
    jobs.run_rolling_backfill(spark, root, fx.constants(spark))


def test_a_load_reads_as_much_whatever_the_history(spark, tmp_path):
    read = {}
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)  # for whole paths in the plans
    schedule = landed(tmp_path / "in", [game(900_001, "2003-12-04"), game(900_002, "2003-12-04", 3, 4)])
    spark.createDataFrame([(pk, box(pk)) for pk in (900_001, 900_002)], "game_pk long, json string").coalesce(1).write.parquet(str(tmp_path / "boxes"))
    for months in (2, 4):
        root = str(tmp_path / f"t{months}")
        history(spark, root, 48 - months, months)
        load = lambda: jobs.run_daily_stats(spark, schedule, spark.read.parquet(str(tmp_path / "boxes")), fx.constants(spark), root, "12/04/2003", "2003-12-05 02:00:00")  # noqa: B023, E731
        found = scans(spark, load)
        stored = [(p, filtered, n) for p, filtered, n in found if f"/t{months}/" in p]
        assert len(stored) >= 8 and {p.rsplit("/", 1)[-1] for p, *_ in stored} >= {"fact_game_state", "dim_game", "player_daily"}
        assert all(filtered for p, filtered, _ in stored), [p for p, filtered, _ in stored if not filtered]
        read[months] = sum(n for *_, n in stored)
        assert sum("/boxes" in p for p, *_ in found) == 1 and sum(p.rstrip("/").endswith("/in") for p, *_ in found) == 1
    assert read[2] == read[4] > 0


def test_a_moved_game_leaves_its_old_date(spark, tmp_path):
    """Both games of June move to July, one after the other, so that June's partitions go."""
    given = (boxes(spark, 1, 2), fx.constants(spark))
    moved, fresh = str(tmp_path / "moved"), str(tmp_path / "fresh")
    before = landed(tmp_path / "before", [game(1, "2001-06-28"), game(2, "2001-06-28", 3, 4)])
    jobs.run_daily_stats(spark, before, *given, moved, "06/28/2001", "2001-07-03 02:00:00")
    for pk in (1, 2):
        after = landed(tmp_path / f"after{pk}", [game(pk, "2001-07-02", *((1, 2), (3, 4))[pk - 1])])
        jobs.run_daily_stats(spark, after, *given, moved, "07/02/2001", "2001-07-03 02:00:00", gate=False)
        parts = {r.part for r in tables.read(spark, moved, "fact_game_state", keep=True).select("part").distinct().collect()}
        assert parts == ({200106, 200107} if pk == 1 else {200107})
    both = landed(tmp_path / "both", [game(1, "2001-07-02"), game(2, "2001-07-02", 3, 4)])
    jobs.run_daily_stats(spark, both, *given, fresh, "07/02/2001", "2001-07-03 02:00:00")
    got, want = contents(spark, moved), contents(spark, fresh)
    assert got == want and len(got) >= 7


def test_a_failed_gate_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    jobs.run_daily_stats(spark, landed(tmp_path / "a", [game(1, "2001-06-28")]), boxes(spark, 1), fx.constants(spark), root, "06/28/2001", "x 02:00:00".replace("x", "2001-06-29"))
    before = contents(spark, root)
    cases = [
        ([game(2, "2001-06-29"), game(3, "2001-06-29", home_name=None)], boxes(spark, 2, 3), "missing home_name"),
        ([game(-2, "2001-06-29")], boxes(spark, -2), "invalid game_id"),
        ([game(2, "2001-06-29")], boxes(spark, 2).withColumn("json", F.lit('{"teams": {}}')), "at least 1 rows"),
    ]
    for i, (games, files, reason) in enumerate(cases):
        with pytest.raises(quality.QualityError, match=reason):
            jobs.run_daily_stats(spark, landed(tmp_path / f"b{i}", games), files, fx.constants(spark), root, "06/29/2001", "2001-06-30 02:00:00")
    with pytest.raises(FileNotFoundError):
        jobs.run_daily_stats(spark, str(tmp_path / "none"), boxes(spark, 1), fx.constants(spark), root, "06/29/2001", "2001-06-30 02:00:00")
    assert contents(spark, root) == before


def test_only_absence_means_no_table(spark, tmp_path):
    assert not tables.exists(spark, str(tmp_path), "dim_game")
    broken = tmp_path / "dim_game" / "part=1"
    broken.mkdir(parents=True)
    (broken / "x.parquet").write_text("not a table")
    with pytest.raises(Exception):  # noqa: B017
        tables.exists(spark, str(tmp_path), "dim_game")


def test_stream_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    root, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    games = [game(1, "2001-06-28"), game(2, "2001-06-29", 3, 4)]
    files, constants, at = boxes(spark, 1, 2), fx.constants(spark), "2001-06-30 02:00:00"
    path = tmp_path / "in"
    landed(path, games)
    run = lambda: jobs.follow_landing(spark, str(path), str(tmp_path / "check"), files, constants, root, at, files=1)
    load, loads = jobs.load_day, []

    def once(*args, **more):
        loads.append(args[5])
        if len(loads) == 2:
            raise OSError("lost")
        return load(*args, **more)

    monkeypatch.setattr(jobs, "load_day", once)
    with pytest.raises(StreamingQueryException):
        run().awaitTermination()
    assert not tables.exists(spark, root, jobs.BATCHES)
    run().awaitTermination()
    assert loads == ["06/28/2001", "06/29/2001", "06/28/2001", "06/29/2001"]
    assert [r.batch for r in spark.read.parquet(f"{root}/{jobs.BATCHES}").collect()] == [0]
    for date in ("06/28/2001", "06/29/2001"):
        jobs.run_daily_stats(spark, str(path), files, constants, plain, date, at)
    assert contents(spark, root) == contents(spark, plain)
    # A batch that comes again is passed over.
    before, n = contents(spark, root), len(loads)
    (tmp_path / "check" / "commits" / "0").unlink()
    (tmp_path / "check" / "commits" / ".0.crc").unlink(missing_ok=True)
    run().awaitTermination()
    assert len(loads) == n and contents(spark, root) == before


@pytest.fixture
def backfilled(spark, sf_dir, tmp_path):
    """A folder with games and facts to fill up from, eight players for each of the fixtures'."""
    root, games, constants = str(tmp_path), fx.games(spark, sf_dir), fx.constants(spark)
    tables.write(spark, root, "dim_game", games)
    copies = fx.raw_fact(spark, sf_dir).crossJoin(spark.range(8)).withColumn("player_id", F.col("player_id") + 100 * F.col("id")).drop("id")
    tables.write(spark, root, "fact_game_state", jobs.placed(transform.enrich(copies, games, constants), games))
    return root, constants


def test_a_day_is_added_up_in_one_task(spark, backfilled, monkeypatch):
    """A matrix is larger than the rows of many tasks, so tasks shuffle one for each day, and not one for each day that each met."""
    root, constants = backfilled
    added, made = learning._added, []

    def seen(parts, columns, *by):
        made.append((parts.count(), parts.select("day").distinct().count() * (2 * len(columns) + 2)))
        return added(parts, columns, *by)

    monkeypatch.setattr(learning, "_added", seen)
    large = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in large}
    for k, v in large.items():
        spark.conf.set(k, v)
    try:
        jobs.run_rolling_backfill(spark, root, constants)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(made) == 2 and all(0 < n == least for n, least in made)
    monkeypatch.undo()
    fact, games, stats = (tables.read(spark, root, t) for t in ("fact_game_state", "dim_game", "player_rolling_stats"))
    for model, (build, columns) in jobs.MODELS.items():
        names = ["player_id", "game_date", "label", *feature_names(columns)]
        span = (fact, games, stats, "1990-01-01", "2010-01-01")
        both = features.training_of_both(*span).withColumn("label", F.col(f"label_{model}")).where("label is not null")
        want, got = (sorted(map(repr, df.select(names).collect())) for df in (build(*span), both))
        assert got == want and got


def test_writes_leave_no_shuffle_files(spark, backfilled, tmp_path):
    """Shuffle files of one step do not wait for the driver's garbage collector while the next one fills the disk."""
    root, _ = backfilled
    files = lambda: {str(f) for f in Path(spark.conf.get("spark.local.dir")).rglob("shuffle_*.data")}
    before = files()
    days = rolling.daily(*(tables.read(spark, root, t) for t in ("fact_game_state", "dim_game")))
    stored = tables.write(spark, root, "player_daily", days)
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert stored.count() > 1000 and any("zstd" in f.name for f in (tmp_path / "player_daily").rglob("*.parquet"))
