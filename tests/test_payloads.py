"""JSON payload flatteners: paths, defaults and de-duplication rules."""
import datetime as dt
import json

from matchmart.sources import payloads as PL

PAYLOAD = ("payload_seq long, league_id long, league_name string, season long, "
           "fixture_id long, loaded_at timestamp_ntz, body string")
TS = dt.datetime(2024, 1, 1)


def test_teams_dedupe_rules(spark):
    p1 = [{"team": {"id": 1, "name": "A-first"}}, {"team": {"id": 1, "name": "A-last"}},
          {"team": {"name": "no id"}}, {"team": {"id": 2, "name": "B", "national": True}}]
    p2 = [{"team": {"id": 1, "name": "A-other-league"}}, {"team": {"id": 3, "name": "C"}}]
    df = spark.createDataFrame([(1, 10, "L", 2024, None, TS, json.dumps(p1)),
                                (2, 11, "M", 2024, None, TS, json.dumps(p2))], PAYLOAD)
    out = {r.team_id: r for r in PL.flatten_teams(df).collect()}
    assert out[1].team_name == "A-last"          # last in its payload, first payload wins
    assert out[2].is_national is True and out[3].is_national is False
    assert set(out) == {1, 2, 3}


def test_odds_market_and_bad_numbers(spark):
    doc = [{"bookmakers": [
        {"id": 1, "name": "B1", "bets": [{"name": "MATCH WINNER", "values": [
            {"value": "Home", "odd": "2.10"}, {"value": "Draw", "odd": "3.2"},
            {"value": "Away", "odd": "3.9"}, {"value": "Home", "odd": "2.20"}]}]},
        {"id": 2, "name": "B2", "bets": [{"name": "Match Winner", "values": [
            {"value": "Home", "odd": "abc"}, {"value": "Draw", "odd": "3.0"}]}]},
        {"id": 3, "name": "B3", "bets": [{"name": "Match Winner", "values": []},
                                          {"name": "Over/Under", "values": [{"value": "Over", "odd": "1.9"}]}]},
    ]}]
    df = spark.createDataFrame([(None, None, None, None, 77, TS, json.dumps(doc))], PAYLOAD)
    rows = PL.flatten_odds(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.odds_id, r.bookmaker_id) == (77001, 1)
    assert float(r.odd_home) == 2.2 and float(r.odd_away) == 3.9   # duplicate label: last wins


def test_fixtures_missing_paths_are_null(spark):
    doc = [{"fixture": {"id": 5, "date": "2024-02-03T15:00:00", "status": {"short": "FT"}},
            "teams": {"home": {"id": 1}, "away": {"id": 2}}, "goals": {"home": 1}}]
    df = spark.createDataFrame([(1, 9, "L", 2024, None, TS, json.dumps(doc))], PAYLOAD)
    r = PL.flatten_fixtures(df).first()
    assert (r.fixture_id, r.status, r.home_goals, r.away_goals, r.venue_name) == (5, "FT", 1, None, None)
    assert r.match_date == dt.datetime(2024, 2, 3, 15, 0)


def test_standings_groups_flattened(spark):
    e = lambda rank, tid: {"rank": rank, "points": 10 - rank, "team": {"id": tid},
                           "all": {"played": 3, "goals": {"for": 4, "against": 2}}}
    doc = [{"league": {"standings": [[e(1, 7), e(2, 8)], [e(1, 9)]]}}]
    df = spark.createDataFrame([(1, 39, "L", 2024, None, TS, json.dumps(doc))], PAYLOAD)
    rows = sorted(PL.flatten_standings(df).collect(), key=lambda r: r.team_id)
    assert [r.team_id for r in rows] == [7, 8, 9]
    assert rows[0].standing_id == 39 * 10_000_000 + 2024 * 1000 + 1


def test_price_that_does_not_fit_is_dropped_alone(spark):
    from matchmart.sources import payloads as PL
    def book(i, home):
        return ('{"id": %d, "name": "B", "bets": [{"name": "Match Winner", "values": [{"value": "Home", "odd": "%s"},'
                '{"value": "Draw", "odd": "3.1"}, {"value": "Away", "odd": "2.5"}]}]}' % (i, home))
    body = '[{"bookmakers": [%s, %s]}]' % (book(1, "1e9"), book(2, "1.8"))
    docs = spark.createDataFrame([(None, None, None, 7, None, body)],
                                 "league_id long, league_name string, season long, fixture_id long, loaded_at timestamp_ntz, body string")
    out = PL.flatten_odds(docs).collect()
    assert [(r.bookmaker_id, float(r.odd_home)) for r in out] == [(2, 1.8)]


def test_rows_and_rejects_of_one_parse(spark):
    from matchmart.sources import payloads as PL
    schema = ("payload_seq long, league_id long, league_name string, season long, fixture_id long, "
              "loaded_at timestamp_ntz, body string")
    import datetime as dt
    t = dt.datetime(2024, 1, 1)

    def quote(book, home):
        return ('{"id": %d, "name": "B", "bets": [{"name": "Match Winner", "values": [{"value": "Home", "odd": "%s"}, '
                '{"value": "Draw", "odd": "3.0"}, {"value": "Away", "odd": "4.0"}]}]}' % (book, home))
    bodies = {1: '[{"bookmakers": [%s, %s]}]' % (quote(1, "1.5"), quote(2, "n/a")), 2: '[{"bookmakers": [', 3: None,
              4: "not json", 5: "[]"}
    p = spark.createDataFrame([(None, None, None, None, f, t, b) for f, b in bodies.items()], schema)
    rows, rejects = PL.split(p, "odds")
    assert [(r.fixture_id, r.bookmaker_id) for r in rows.collect()] == [(1, 1)]
    assert sorted((r.fixture_id, r.bookmaker_id, r.reason) for r in rejects.collect()) == [
        (1, 2, "price is not a number"), (2, None, "document does not parse"), (3, None, "no document"),
        (4, None, "document does not parse")]
    fx = p.where("fixture_id in (2, 4, 5)")
    for kind in ("fixtures", "standings", "teams"):
        rows, rejects = PL.split(fx, kind)
        assert rows.count() == 0 and sorted(r.fixture_id for r in rejects.collect()) == [2, 4]
