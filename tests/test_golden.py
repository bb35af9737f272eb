"""Golden rows replayed from the reference's unit tests and seed data."""
import datetime as dt

from pyspark.sql import functions as F

from matchmart.plans import intermediate as I
from matchmart.plans import marts as M
from matchmart.plans import staging as S

MATCH_SCHEMA = ("match_id string, match_date date, home_team_id string, away_team_id string, "
                "home_goals int, away_goals int, competition_id string, loaded_at timestamp_ntz")


def _matches(spark, rows):
    d = dt.date(2024, 1, 1)
    ts = dt.datetime(2024, 1, 2)
    return spark.createDataFrame([(m, d, h, a, hg, ag, c, ts) for m, h, a, hg, ag, c in rows],
                                 MATCH_SCHEMA)


def test_stg_matches_unit_cases(spark):
    raw = _matches(spark, [("m1", "t1", "t2", 3, 1, "c1"), ("m2", "t1", "t2", 0, 2, "c1"),
                           ("m3", "t1", "t2", 1, 1, "c1"), ("m4", "t1", "t2", 4, 3, "c1"),
                           ("m5", "t1", "t2", 1, 0, None)])
    out = {r.match_id: r for r in S.stg_matches(raw).collect()}
    assert (out["m1"].match_result, out["m1"].total_goals) == ("HOME_WIN", 4)
    assert (out["m2"].match_result, out["m2"].total_goals) == ("AWAY_WIN", 2)
    assert (out["m3"].match_result, out["m3"].total_goals) == ("DRAW", 2)
    assert out["m4"].total_goals == 7
    assert out["m5"].competition_id == "UNKNOWN"


def test_stg_matches_null_goals_is_draw(spark):
    raw = _matches(spark, [("m1", "t1", "t2", None, None, "c1")])
    r = S.stg_matches(raw).first()
    assert r.match_result == "DRAW" and r.total_goals is None


def test_season_stats_unit_cases(spark):
    rows = [("t1", "T1", f"m{i}", dt.date(2024, 1, i + 1), 1, 1, 0, p, 1.0, 1.0)
            for i, p in enumerate([3, 1, 0, 3])]
    rows.append(("t2", "T2", "m9", dt.date(2024, 3, 1), 0, 1, -1, 0, 0.0, 0.0))
    tp = spark.createDataFrame(rows, "team_id string, team_name string, match_id string, "
                               "match_date date, goals_scored int, goals_conceded int, "
                               "goal_diff int, points int, rolling_points_avg double, "
                               "rolling_goals_avg double")
    out = {r.team_id: r for r in M.season_stats(tp).collect()}
    t1 = out["t1"]
    assert (t1.season, t1.total_matches, t1.wins, t1.draws, t1.losses) == (2024, 4, 2, 1, 1)
    assert float(t1.win_rate) == 0.5 and t1.total_points == 7
    assert out["t2"].total_matches == 1


def test_seed_matches_team_performance(spark):
    """Five seed matches; rolling form over the whole history of each team."""
    seed = [("m001", "2024-01-15", "t001", "t002", 2, 1), ("m002", "2024-01-22", "t003", "t004", 0, 0),
            ("m003", "2024-02-01", "t002", "t003", 1, 3), ("m004", "2024-02-08", "t004", "t001", 1, 2),
            ("m005", "2024-02-15", "t001", "t003", 1, 1)]
    raw = spark.createDataFrame(
        [(m, dt.date.fromisoformat(d), h, a, hg, ag, "c001", dt.datetime(2024, 3, 1))
         for m, d, h, a, hg, ag in seed], MATCH_SCHEMA)
    teams = spark.createDataFrame([(f"t00{i}", f"Team {i}", "BR", None, None) for i in range(1, 5)],
                                  "team_id string, team_name string, country string, "
                                  "founded_year bigint, updated_at timestamp_ntz")
    for strategy in ("chunked", "window"):
        tp = I.team_performance(S.stg_matches(raw), teams, strategy=strategy)
        t1 = tp.filter(F.col("team_id") == "t001").orderBy("match_date").collect()
        assert [r.points for r in t1] == [3, 3, 1]
        assert [round(r.rolling_points_avg, 6) for r in t1] == [3.0, 3.0, round(7 / 3, 6)]
        t3 = tp.filter(F.col("team_id") == "t003").orderBy("match_date").collect()
        assert [r.points for r in t3] == [1, 3, 1]
