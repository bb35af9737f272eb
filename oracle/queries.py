"""Oracle SQL per registered query key (DuckDB)."""

from .adapters import with_raw
from .intermediate import ALL_INTERMEDIATE
from .marts import ALL_MARTS, LEAGUE_TYPE, sk
from .ml import ALL_ML, FEATS, METRIC_COLS
from .ml import D as ML_D
from .staging import ALL_STAGING

_BASE = ALL_STAGING + ALL_INTERMEDIATE + ALL_MARTS + ALL_ML
_SQL: dict[str, str] = {}


def sql(name: str, body: str, *extra_ctes: str) -> None:
    _SQL[name] = with_raw(*_BASE, *extra_ctes) + body


def registry() -> dict[str, str]:
    return dict(_SQL)


_DEC = "::DOUBLE"

sql("stg_fixtures", "SELECT * FROM stg_fixtures")
sql("stg_odds", f"""SELECT * REPLACE (odd_home{_DEC} AS odd_home, odd_draw{_DEC} AS odd_draw,
  odd_away{_DEC} AS odd_away, raw_prob_home{_DEC} AS raw_prob_home,
  raw_prob_draw{_DEC} AS raw_prob_draw, raw_prob_away{_DEC} AS raw_prob_away,
  overround{_DEC} AS overround, implied_prob_home{_DEC} AS implied_prob_home,
  implied_prob_draw{_DEC} AS implied_prob_draw, implied_prob_away{_DEC} AS implied_prob_away)
  FROM stg_odds""")
sql("stg_standings", "SELECT * FROM stg_standings")
sql("stg_teams_football", "SELECT * FROM stg_teams_football")
sql("stg_matches", "SELECT * FROM stg_matches")
sql("stg_teams", "SELECT * FROM stg_teams")
sql("appearances", "SELECT * FROM appearances")
sql("team_form", "SELECT * FROM team_form")
sql("team_form_chunked", "SELECT * FROM team_form")
sql("rolling_avg", "SELECT * FROM team_form")
sql("last_n_per_pair", "SELECT * FROM h2h_last5")
sql("h2h_stats", "SELECT * FROM head_to_head")
sql("odds_consensus", "SELECT * FROM odds_consensus")
sql("venue_advantage", "SELECT * FROM venue_advantage")
sql("match_features", "SELECT * FROM match_features")
sql("team_performance", "SELECT * FROM team_performance")
sql("team_performance_chunked", "SELECT * FROM team_performance")

sql("union_distinct", "SELECT * FROM all_leagues")
sql("league_seasons", "SELECT * FROM league_seasons")
sql("league_stats", "SELECT * FROM league_stats")
sql("dim_league", "SELECT * FROM dim_league")
sql("union_all_aggs", "SELECT * FROM side_participation")
sql("team_participation", "SELECT * FROM team_participation")
sql("dim_enrich", "SELECT * FROM team_enrich")
sql("dim_team_football", "SELECT * FROM dim_team_football")
sql("dim_team", "SELECT * FROM dim_team")
sql("latest_per_key", "SELECT * FROM latest_standings")
sql("fct_standings", "SELECT * FROM fct_standings")
sql("role_playing_dim", """SELECT fixture_id, home_team_id, away_team_id, league_id,
  home_team_sk, away_team_sk, league_type FROM fct_match_features""")
sql("fct_match_features", "SELECT * FROM fct_match_features")
sql("season_stats", "SELECT * FROM season_stats")
sql("match_facts_legacy", "SELECT * FROM match_facts_legacy")
sql("left_join_2key", """SELECT fixture_id, home_team_id, away_team_id, home_avg_points_l5,
  home_win_rate_l10, away_avg_points_l5, away_win_rate_l10 FROM match_features""")
sql("join_normalized_pair", """SELECT f.fixture_id, least(f.home_team_id, f.away_team_id) AS team_a_id,
  greatest(f.home_team_id, f.away_team_id) AS team_b_id, h.h2h_total_matches, h.h2h_avg_goals
  FROM stg_fixtures f LEFT JOIN head_to_head h
  ON least(f.home_team_id, f.away_team_id) = h.team_a_id
 AND greatest(f.home_team_id, f.away_team_id) = h.team_b_id""")
sql("join_agg_lookup", """SELECT fixture_id, odds_implied_prob_home, bookmaker_count,
  venue_total_matches, venue_home_win_rate FROM match_features""")
sql("inner_join_facts", """SELECT p.fixture_id, p.hybrid_home_prob, p.model_version, f.league_id,
  f.match_result FROM raw_predictions p JOIN stg_fixtures f ON p.fixture_id = f.fixture_id""")
sql("not_null_filter", """SELECT fixture_id, venue_name, home_goals, away_goals FROM raw_fixtures
  WHERE venue_name IS NOT NULL AND home_goals IS NOT NULL AND away_goals IS NOT NULL""")
sql("membership", """SELECT fixture_id, status, match_date FROM raw_fixtures
  WHERE status NOT IN ('FT', 'AET', 'PEN', 'CANC', 'AWD', 'WO', 'ABD', 'PST')""")
sql("range_predicate", """SELECT odds_id, odd_home::DOUBLE AS odd_home, odd_draw::DOUBLE AS odd_draw,
  odd_away::DOUBLE AS odd_away FROM raw_odds
  WHERE odd_home > 1 AND odd_draw BETWEEN 3 AND 4 AND odd_away <= 5""")
sql("points_case", "SELECT fixture_id, team_id, perspective, points::BIGINT AS points, is_win::BIGINT AS is_win FROM appearances")
sql("league_type", f"""SELECT league_id, league_name, {LEAGUE_TYPE.format(c='league_name')} AS league_type
  FROM (SELECT DISTINCT league_id, league_name FROM stg_fixtures)""")
sql("rank_movement", """SELECT standing_id, team_id, league_id, season, updated_at,
  coalesce(rank_change, 0) AS rank_change,
  CASE WHEN rank_change < 0 THEN 'UP' WHEN rank_change > 0 THEN 'DOWN' ELSE 'SAME' END AS rank_movement
  FROM stg_standings""")
sql("encode_target", """SELECT fixture_id, match_result, match_result_encoded,
  CASE match_result_encoded WHEN 0 THEN 'HOME_WIN' WHEN 1 THEN 'DRAW' WHEN 2 THEN 'AWAY_WIN' END AS match_result_decoded
  FROM (SELECT fixture_id, match_result,
    CASE WHEN match_result = 'HOME_WIN' THEN 0 WHEN match_result = 'DRAW' THEN 1
         WHEN match_result = 'AWAY_WIN' THEN 2 END::BIGINT AS match_result_encoded FROM stg_fixtures)""")
sql("has_odds", """SELECT fixture_id, bookmaker_count,
  coalesce(bookmaker_count > 0, false) AS has_odds FROM match_features""")
PRED_SQL = """(SELECT fixture_id, hybrid_home_prob::DECIMAL(6,4) AS hh, hybrid_draw_prob::DECIMAL(6,4) AS hd,
    hybrid_away_prob::DECIMAL(6,4) AS ha FROM raw_predictions)"""
PRED_RULE = """CASE WHEN hh >= hd AND hh >= ha THEN 'HOME_WIN'
  WHEN ha >= hd AND ha > hh THEN 'AWAY_WIN' ELSE 'DRAW' END"""
sql("predicted_result", f"""SELECT fixture_id, hh::DOUBLE AS hybrid_home_prob, hd::DOUBLE AS hybrid_draw_prob,
  ha::DOUBLE AS hybrid_away_prob, {PRED_RULE} AS predicted_result FROM {PRED_SQL}""")
sql("is_correct", f"""SELECT p.fixture_id, {PRED_RULE} AS predicted_result, f.match_result AS actual_result,
  CASE WHEN f.match_result IS NOT NULL AND {PRED_RULE} = f.match_result THEN true
       WHEN f.match_result IS NOT NULL THEN false ELSE NULL END AS is_correct
  FROM {PRED_SQL} p LEFT JOIN stg_fixtures f ON p.fixture_id = f.fixture_id""")
sql("feature_diffs", """SELECT fixture_id, form_diff_points_l5, form_diff_points_l10,
  home_attack_vs_away_defense_l5, away_attack_vs_home_defense_l5 FROM fct_match_features""")
sql("null_default", """SELECT fixture_id, h2h_total_matches, venue_total_matches, venue_home_win_rate,
  home_avg_points_l10, odds_implied_prob_home FROM match_features""")
sql("fn_dow", "SELECT fixture_id, match_date, dayofweek(match_date)::BIGINT AS day_of_week FROM raw_fixtures")
sql("fn_safe_div", """SELECT standing_id, team_id, updated_at, goals_for, lose,
  round(goals_for::DOUBLE / nullif(lose, 0), 3) AS goals_per_loss FROM stg_standings""")
sql("fn_pair", """SELECT fixture_id, least(home_team_id, away_team_id) AS team_a_id,
  greatest(home_team_id, away_team_id) AS team_b_id FROM raw_fixtures""")
sql("surrogate_key", f"""SELECT team_id, team_code, founded, {sk('team_id', 'team_code', 'founded')} AS sk
  FROM raw_teams_football""")


def _fail(check, model, column, key, value):
    return (f"SELECT '{check}' AS \"check\", '{model}' AS model, '{column}' AS \"column\", "
            f"{key}::VARCHAR AS key, {value}::VARCHAR AS value")


_NN = ["fixture_id", "league_id", "season", "match_date", "status", "home_team_id",
       "away_team_id", "match_result", "total_goals"]
sql("dq_not_null", " UNION ALL ".join(
    _fail("not_null", "stg_fixtures", c, "fixture_id", c) + f" FROM stg_fixtures WHERE {c} IS NULL"
    for c in _NN))
sql("dq_unique", " UNION ALL ".join([
    _fail("unique", "stg_fixtures", "fixture_id", "fixture_id", "n")
    + " FROM (SELECT fixture_id, count(*) AS n FROM stg_fixtures WHERE fixture_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    _fail("unique", "dim_team_football", "team_id", "team_id", "n")
    + " FROM (SELECT team_id, count(*) AS n FROM dim_team_football WHERE team_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    _fail("unique", "dim_league", "league_id", "league_id", "n")
    + " FROM (SELECT league_id, count(*) AS n FROM dim_league WHERE league_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    _fail("unique", "stg_fixtures", "venue_name", "venue_name", "n")
    + " FROM (SELECT venue_name, count(*) AS n FROM stg_fixtures WHERE venue_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
]))
sql("dq_accepted_values", " UNION ALL ".join([
    _fail("accepted_values", "stg_fixtures", "status", "fixture_id", "status")
    + " FROM stg_fixtures WHERE status IS NOT NULL AND status NOT IN ('FT','AET','PEN')",
    _fail("accepted_values", "stg_fixtures", "match_result", "fixture_id", "match_result")
    + " FROM stg_fixtures WHERE match_result IS NOT NULL AND match_result NOT IN ('HOME_WIN','AWAY_WIN','DRAW')",
    _fail("accepted_values", "dim_league", "league_type", "league_id", "league_type")
    + " FROM dim_league WHERE league_type IS NOT NULL AND league_type NOT IN ('DOMESTIC_LEAGUE','CUP','INTERNATIONAL')",
    _fail("accepted_values", "stg_standings", "form", "standing_id", "form")
    + " FROM stg_standings WHERE form IS NOT NULL AND form NOT IN ('','M1','M3','M5','M7','M9')",
]))
sql("dq_relationships", " UNION ALL ".join([
    _fail("relationships", "match_features", "home_team_id", "fixture_id", "home_team_id")
    + " FROM match_features WHERE home_team_id IS NOT NULL AND home_team_id NOT IN (SELECT team_id FROM stg_teams_football WHERE team_id IS NOT NULL)",
    _fail("relationships", "match_features", "away_team_id", "fixture_id", "away_team_id")
    + " FROM match_features WHERE away_team_id IS NOT NULL AND away_team_id NOT IN (SELECT team_id FROM stg_teams_football WHERE team_id IS NOT NULL)",
    _fail("relationships", "match_features", "league_id", "fixture_id", "league_id")
    + " FROM match_features WHERE league_id IS NOT NULL AND league_id NOT IN (SELECT league_id FROM dim_league WHERE league_id IS NOT NULL)",
    _fail("relationships", "stg_standings", "team_id", "standing_id", "team_id")
    + " FROM stg_standings WHERE team_id IS NOT NULL AND team_id NOT IN (SELECT team_id FROM dim_team_football WHERE team_id IS NOT NULL)",
]))
sql("dq_between", " UNION ALL ".join([
    _fail("between", "stg_standings", "rank", "standing_id", "rank")
    + " FROM stg_standings WHERE rank IS NOT NULL AND (rank < 1 OR rank > 30)",
    _fail("between", "stg_standings", "points", "standing_id", "points")
    + " FROM stg_standings WHERE points IS NOT NULL AND points < 0",
    _fail("between", "stg_standings", "played", "standing_id", "played")
    + " FROM stg_standings WHERE played IS NOT NULL AND (played < 0 OR played > 60)",
    _fail("between", "team_form", "win_rate_l5", "fixture_id", "win_rate_l5")
    + " FROM team_form WHERE win_rate_l5 IS NOT NULL AND (win_rate_l5 < 0 OR win_rate_l5 > 1)",
    _fail("between", "team_form", "avg_points_l10", "fixture_id", "avg_points_l10")
    + " FROM team_form WHERE avg_points_l10 IS NOT NULL AND (avg_points_l10 < 0 OR avg_points_l10 > 3)",
    _fail("between", "stg_fixtures", "total_goals", "fixture_id", "total_goals")
    + " FROM stg_fixtures WHERE total_goals IS NOT NULL AND (total_goals < 0 OR total_goals > 8)",
]))
_NOW = "TIMESTAMP '2001-08-02 20:00:00'"


def _fresh(src, table, col):
    return (f"SELECT '{src}' AS source, max_loaded_at, age_hours, CASE WHEN max_loaded_at IS NULL THEN 'error' "
            f"WHEN age_hours > 24 THEN 'error' WHEN age_hours > 12 THEN 'warn' ELSE 'pass' END AS status "
            f"FROM (SELECT max_loaded_at, round((epoch({_NOW}) - epoch(max_loaded_at)) / 3600.0, 3) AS age_hours "
            f"FROM (SELECT max({col})::TIMESTAMP AS max_loaded_at FROM {table}))")


sql("source_freshness", " UNION ALL ".join([
    _fresh("fixtures", "raw_fixtures", "loaded_at"), _fresh("odds", "raw_odds", "loaded_at"),
    _fresh("standings", "raw_standings", "loaded_at"),
    _fresh("teams_football", "raw_teams_football", "updated_at"), _fresh("matches", "raw_matches", "loaded_at"),
    _fresh("teams", "raw_teams", "updated_at"), _fresh("team_roster", "roster_v1", "updated_at")]))
sql("assert_goals_non_negative", """SELECT match_id, home_goals, away_goals FROM match_facts_legacy
  WHERE home_goals < 0 OR away_goals < 0""")
sql("assert_win_rate_0_1", "SELECT team_id, win_rate FROM season_stats WHERE win_rate < 0 OR win_rate > 1")
sql("row_count_deviation", """SELECT 'team_roster' AS model, p AS previous_rows, c AS current_rows,
  round(abs(c - p)::DOUBLE / nullif(p, 0), 6) AS deviation,
  CASE WHEN p = 0 OR abs(c - p)::DOUBLE / nullif(p, 0) > 0.2 THEN 'fail' ELSE 'pass' END AS status
  FROM (SELECT (SELECT count(*) FROM roster_v2)::BIGINT AS c, (SELECT count(*) FROM roster_v1)::BIGINT AS p)""")


sql("mat_view", "SELECT * FROM stg_fixtures")
sql("mat_ephemeral", "SELECT * FROM head_to_head")
sql("mat_table", "SELECT * FROM dim_league")
_PRED_COLS = """fixture_id, poisson_home_prob, poisson_draw_prob, poisson_away_prob, gb_home_prob,
  gb_draw_prob, gb_away_prob, hybrid_home_prob, hybrid_draw_prob, hybrid_away_prob,
  expected_home_goals, expected_away_goals, confidence_score"""
sql("incremental_merge", f"""
  SELECT * FROM (
    SELECT {_PRED_COLS}, model_version, predicted_at FROM raw_predictions
    WHERE predicted_at < TIMESTAMP '2000-01-01 00:00:00'
      AND fixture_id NOT IN (
        SELECT fixture_id FROM raw_predictions
        WHERE predicted_at > (SELECT max(predicted_at) FROM raw_predictions
                              WHERE predicted_at < TIMESTAMP '2000-01-01 00:00:00') - INTERVAL 30 DAY)
    UNION ALL
    SELECT {_PRED_COLS}, 'v-next' AS model_version, predicted_at FROM raw_predictions
    WHERE predicted_at > (SELECT max(predicted_at) FROM raw_predictions
                          WHERE predicted_at < TIMESTAMP '2000-01-01 00:00:00') - INTERVAL 30 DAY)""")
sql("sync_all_columns", """
  SELECT team_id, team_name, team_code, country, founded_year, is_national, venue_id, venue_name,
    venue_city, venue_country, venue_capacity, updated_at, NULL::VARCHAR AS team_code_lower
  FROM stg_teams_football WHERE team_id % 2 = 0
  UNION ALL
  SELECT team_id, team_name, team_code, country, founded_year, is_national, venue_id, venue_name,
    venue_city, venue_country, venue_capacity, updated_at, lower(team_code) AS team_code_lower
  FROM stg_teams_football WHERE team_id % 2 = 1""")
_SK2 = sk("player_id", "updated_at")
sql("scd2_snapshot", f"""
  SELECT s1.player_id, s1.team_id, s1.player_name, s1.position, s1.updated_at, s1.dbt_scd_id,
    s1.dbt_updated_at, s1.dbt_valid_from,
    CASE WHEN v2.player_id IS NULL THEN TIMESTAMP '2024-03-01 00:00:00'
         WHEN v2.updated_at > s1.dbt_updated_at THEN v2.updated_at END AS dbt_valid_to
  FROM s1 LEFT JOIN roster_v2 v2 ON s1.player_id = v2.player_id
  UNION ALL
  SELECT v2.*, {sk("v2.player_id", "v2.updated_at")}, v2.updated_at, v2.updated_at, NULL::TIMESTAMP
  FROM roster_v2 v2 LEFT JOIN s1 ON s1.player_id = v2.player_id
  WHERE s1.player_id IS NULL OR v2.updated_at > s1.dbt_updated_at""",
    f"""s1 AS (
    SELECT *, {_SK2} AS dbt_scd_id, updated_at AS dbt_updated_at, updated_at AS dbt_valid_from,
      NULL::TIMESTAMP AS dbt_valid_to FROM roster_v1)""")
sql("keyed_upsert", """
  SELECT * FROM raw_fixtures WHERE match_date < TIMESTAMP '2000-01-01 00:00:00'
    AND match_date < TIMESTAMP '1999-07-01 00:00:00'
  UNION ALL
  SELECT * REPLACE (loaded_at + INTERVAL 7 DAY AS loaded_at) FROM raw_fixtures
  WHERE match_date >= TIMESTAMP '1999-07-01 00:00:00'""")
sql("keyed_upsert_partial", """
  SELECT odds_id, fixture_id, bookmaker_id, bookmaker_name, market_name, odd_home::DOUBLE AS odd_home,
    odd_draw::DOUBLE AS odd_draw, odd_away::DOUBLE AS odd_away, loaded_at
  FROM raw_odds WHERE loaded_at < TIMESTAMP '2000-01-01 00:00:00'
    AND odds_id NOT IN (SELECT odds_id FROM raw_odds WHERE loaded_at >= TIMESTAMP '1999-07-01 00:00:00')
  UNION ALL
  SELECT n.odds_id, n.fixture_id, n.bookmaker_id,
    n.bookmaker_name || ' (new)' AS bookmaker_name, n.market_name,
    (n.odd_home + 0.05)::DECIMAL(10,4)::DOUBLE AS odd_home, n.odd_draw::DOUBLE AS odd_draw,
    n.odd_away::DOUBLE AS odd_away, n.loaded_at + INTERVAL 1 DAY AS loaded_at
  FROM raw_odds n
  WHERE n.loaded_at >= TIMESTAMP '1999-07-01 00:00:00'""")
sql("insert_if_absent", """
  SELECT * FROM roster_v1
  UNION ALL
  SELECT * FROM roster_v2 WHERE player_id NOT IN (SELECT player_id FROM roster_v1)""")


sql("scan_raw", """SELECT fixture_id, league_id, season, match_date, status, home_team_id, away_team_id,
  home_goals, away_goals FROM raw_fixtures WHERE status IN ('FT', 'AET', 'PEN')""")
sql("seed_competitions", """
  SELECT m.competition_id, s.competition_name, s.country, s.tier, m.matches
  FROM (SELECT competition_id, count(*)::BIGINT AS matches FROM stg_matches GROUP BY 1) m
  LEFT JOIN (VALUES ('c001', 'Brasileirão Série A', 'Brazil', '1'),
                    ('c002', 'Copa do Brasil', 'Brazil', 'Cup'),
                    ('c003', 'Libertadores', 'South America', 'Continental'),
                    ('c004', 'Sul-Americana', 'South America', 'Continental'))
    s(competition_id, competition_name, country, tier) ON m.competition_id = s.competition_id""")
_FEATS = ["home_avg_points_l5", "home_avg_goals_scored_l5", "home_avg_goals_conceded_l5",
          "home_win_rate_l5", "home_avg_points_l10", "away_avg_points_l5", "away_avg_goals_scored_l5",
          "away_avg_goals_conceded_l5", "away_win_rate_l5", "away_avg_points_l10", "h2h_home_wins",
          "h2h_draws", "h2h_avg_goals", "odds_implied_prob_home", "odds_implied_prob_draw",
          "odds_implied_prob_away"]
sql("load_features", f"""SELECT fixture_id, league_id, season, match_date, match_result, {", ".join(_FEATS)}
  FROM fct_match_features WHERE match_result IS NOT NULL
  AND {" AND ".join(c + " IS NOT NULL" for c in _FEATS)}""")
sql("upcoming_fixtures", """SELECT fixture_id, match_date, status, home_team_id, away_team_id FROM raw_fixtures
  WHERE match_date >= TIMESTAMP '2001-06-01 00:00:00' AND match_date <= TIMESTAMP '2001-06-08 00:00:00'
  AND status NOT IN ('FT', 'AET', 'PEN', 'CANC', 'AWD', 'WO', 'ABD', 'PST')""")
sql("flatten_fixtures", """SELECT * REPLACE (max(loaded_at) OVER (PARTITION BY league_id, season,
  floor(fixture_id / 50)) AS loaded_at) FROM raw_fixtures""")
sql("flatten_standings", """SELECT league_id * 10000000 + season * 1000 + rank AS standing_id, league_id,
  league_name, season, team_id, team_name, rank, points, played, win, draw, lose, goals_for, goals_against,
  goals_for - goals_against AS goal_diff, form, updated_at, updated_at AS loaded_at FROM raw_standings""")
sql("flatten_teams", """SELECT t.team_id, t.team_name, t.team_code, t.country, t.founded,
  coalesce(t.is_national AND t.is_national, false) AS is_national, t.logo_url, t.venue_name, t.venue_capacity,
  TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM raw_teams_football t
  WHERE t.team_id IN (SELECT home_team_id FROM raw_fixtures UNION SELECT away_team_id FROM raw_fixtures)""")
sql("flatten_odds", """SELECT odds_id, fixture_id, bookmaker_id, bookmaker_name, 'Match Winner' AS market_name,
  odd_home::DOUBLE AS odd_home, odd_draw::DOUBLE AS odd_draw, odd_away::DOUBLE AS odd_away, loaded_at
  FROM raw_odds WHERE market_name = 'Match Winner'""")
sql("surrogate_int", """SELECT 'standing' AS kind, league_id * 10000000 + season * 1000 + rank AS id, team_id AS ref
  FROM raw_standings UNION ALL
  SELECT 'odds', fixture_id * 1000 + bookmaker_id, fixture_id FROM raw_odds""")
sql("league_filter", """SELECT req.league_name, m.api_league_id::BIGINT AS api_league_id
  FROM req LEFT JOIN lmap m ON req.league_name = m.league_name""",
    """req AS (SELECT DISTINCT league_name FROM stg_fixtures
               UNION ALL SELECT 'Premier League' UNION ALL SELECT 'UEFA Champions League')""",
    """lmap AS (SELECT * FROM (VALUES ('Brasileirao Serie A', 71), ('Premier League', 39), ('La Liga', 140),
    ('Serie A Italy', 135), ('Bundesliga', 78), ('Ligue 1', 61), ('Eredivisie', 88), ('Primeira Liga', 94),
    ('Liga Profesional Argentina', 128), ('Liga MX', 262), ('MLS', 253), ('UEFA Champions League', 2),
    ('UEFA Europa League', 3), ('Copa Libertadores', 13), ('Copa Sulamericana', 11), ('FIFA World Cup', 1),
    ('Copa America', 9), ('UEFA Euro', 4)) v(league_name, api_league_id))""")


sql("feature_matrix", "SELECT * FROM feature_matrix")
sql("temporal_split", """SELECT fixture_id, match_date, rn <= floor(n * 0.8::DOUBLE) AS is_train FROM (
  SELECT fixture_id, match_date, row_number() OVER (ORDER BY match_date::DATE, fixture_id) AS rn,
    count(*) OVER () AS n FROM feature_matrix)""")
sql("poisson_fallback", f"""SELECT team_id, round(attack, {ML_D}) AS attack, round(defence, {ML_D}) AS defence,
  round(home_advantage, {ML_D}) AS home_advantage, round(intercept, {ML_D}) AS intercept FROM pf_teams""")
sql("expected_goals", f"""SELECT fixture_id, home_team_id, away_team_id,
  round(mu_h, {ML_D}) AS expected_home_goals, round(mu_a, {ML_D}) AS expected_away_goals FROM pf_eg""")
sql("outcome_probs", "SELECT * FROM pf_probs")
sql("hybrid_blend", """SELECT fixture_id, hybrid_home_prob, hybrid_draw_prob, hybrid_away_prob,
  CASE WHEN hybrid_home_prob >= hybrid_draw_prob AND hybrid_home_prob >= hybrid_away_prob THEN 'HOME_WIN'
       WHEN hybrid_draw_prob >= hybrid_away_prob THEN 'DRAW' ELSE 'AWAY_WIN' END AS predicted_result,
  greatest(hybrid_home_prob, hybrid_draw_prob, hybrid_away_prob) AS confidence_score FROM hb""")
sql("fct_predictions", "SELECT * FROM fct_predictions")
sql("classification_metrics", f"SELECT {METRIC_COLS} FROM ev")
sql("flat_bet_roi", f"SELECT n_matches, n_correct, n_wrong, flat_bet_roi FROM (SELECT {METRIC_COLS} FROM ev)")
sql("confusion_matrix", """SELECT actual_result,
  count(*) FILTER (WHERE predicted_result = 'HOME_WIN')::BIGINT AS HOME_WIN,
  count(*) FILTER (WHERE predicted_result = 'DRAW')::BIGINT AS DRAW,
  count(*) FILTER (WHERE predicted_result = 'AWAY_WIN')::BIGINT AS AWAY_WIN
  FROM ev GROUP BY actual_result""")
sql("champion_gate", f"""SELECT 'stored-predictions' AS model_version, accuracy, 0.5::DOUBLE AS baseline_accuracy,
  accuracy > 0.5 AS registered FROM (SELECT {METRIC_COLS} FROM ev)""")
sql("distinct_versions", "SELECT DISTINCT model_version FROM raw_predictions WHERE model_version IS NOT NULL")
sql("metrics_by_group", f"""SELECT league_id, {METRIC_COLS},
  CASE WHEN grouping(league_id) = 1 THEN 'overall' ELSE 'league' END AS scope
  FROM ev GROUP BY ROLLUP (league_id)""")
sql("eval_report", f"""SELECT league_id, {METRIC_COLS},
  list(DISTINCT model_version ORDER BY model_version) FILTER (WHERE model_version IS NOT NULL) AS model_versions,
  CASE WHEN grouping(league_id) = 1 THEN 'overall' ELSE 'league' END AS scope,
  NULL::BIGINT AS filter_league, NULL::VARCHAR AS filter_since
  FROM ev GROUP BY ROLLUP (league_id)""")
sql("conditional_count", """SELECT league_id, season,
  sum(CASE WHEN match_result = 'HOME_WIN' THEN 1 ELSE 0 END)::BIGINT AS home_wins,
  sum(CASE WHEN match_result = 'DRAW' THEN 1 ELSE 0 END)::BIGINT AS draws,
  count(*) FILTER (WHERE match_result = 'AWAY_WIN')::BIGINT AS away_wins
  FROM stg_fixtures GROUP BY league_id, season""")

sql("dropna_features", f"""SELECT fixture_id, league_id, season, match_result,
  {", ".join(FEATS)}
  FROM fct_match_features WHERE match_result IS NOT NULL AND
  {" AND ".join(c + " IS NOT NULL" for c in FEATS)}""")
sql("lag_rank", """SELECT standing_id, team_id, league_id, season, updated_at, rank, prev_rank, rank_change
  FROM stg_standings""")
sql("order_by_date", """SELECT fixture_id, match_date, league_id, match_result FROM feature_matrix_full
  ORDER BY match_date, fixture_id""", f"""feature_matrix_full AS (SELECT * FROM fct_match_features
  WHERE match_result IS NOT NULL AND
  {" AND ".join(c + " IS NOT NULL" for c in FEATS)})""")
sql("top_n_per_group", """SELECT league_id, season, team_id, points, goal_difference, position FROM (
  SELECT *, row_number() OVER (PARTITION BY league_id, season, updated_at
    ORDER BY points DESC, goal_difference DESC, team_id ASC)::BIGINT AS position FROM latest_standings)
  WHERE position <= 3""")
sql("incremental_stream", "SELECT * FROM raw_predictions")

sql("model_params_io", f"""SELECT team_id, round(attack, {ML_D}) AS attack, round(defence, {ML_D}) AS defence,
  round(home_advantage, {ML_D}) AS home_advantage, round(intercept, {ML_D}) AS intercept FROM pf_teams""")
# At the maximum of the likelihood the expected goals of every team are the observed ones.
sql("poisson_balance", """SELECT team_id, sum(gf)::BIGINT AS scored, sum(ga)::BIGINT AS conceded,
  sum(gf)::DOUBLE AS expected_scored, sum(ga)::DOUBLE AS expected_conceded FROM pf_app GROUP BY team_id""")

_FORM = ["avg_points_l5", "avg_goals_scored_l5", "avg_goals_conceded_l5", "win_rate_l5", "avg_points_l10"]
_ODDS = [f for f in FEATS if f.startswith("odds_")]
sql("upcoming_features", f"""SELECT u.fixture_id, u.league_id, u.season, u.match_date, u.home_team_id, u.away_team_id,
  {", ".join(f"coalesce({s}.{c}, 0)::DOUBLE AS {s}_{c}" for s in ("home", "away") for c in _FORM)},
  coalesce(h2h_home_wins, 0) AS h2h_home_wins, coalesce(h2h_draws, 0) AS h2h_draws,
  coalesce(h2h_avg_goals, 0) AS h2h_avg_goals, {", ".join(_ODDS)}
FROM upcoming u
  ASOF LEFT JOIN last_form home ON u.home_team_id = home.team_id AND u.match_date > home.match_date
  ASOF LEFT JOIN last_form away ON u.away_team_id = away.team_id AND u.match_date > away.match_date
  LEFT JOIN odds_consensus o ON o.fixture_id = u.fixture_id
  LEFT JOIN head_to_head ON [team_a_id, team_b_id] = list_sort([u.home_team_id, u.away_team_id])""",
    """
upcoming AS (SELECT * FROM raw_fixtures WHERE status NOT IN ('FT', 'AET', 'PEN', 'CANC', 'AWD', 'WO', 'ABD', 'PST')),
last_form AS (SELECT * FROM team_form
  QUALIFY row_number() OVER (PARTITION BY team_id, match_date ORDER BY fixture_id DESC) = 1)""")


# --- declared tests: one select per model and one per foreign key, from the same declarations -----------------

def _declared() -> str:
    from matchmart.plans.declared import MODELS
    table = {"raw_team_roster": "roster_v1", "int_team_form": "team_form", "int_head_to_head": "head_to_head",
             "int_match_features": "match_features", "fct_team_season_stats": "season_stats",
             "fct_match_predictions": "match_facts_legacy"}
    out = []
    for model, d in MODELS.items():
        for c in d.checks():
            if c.kind == "not_null":
                bad = f"SELECT count(*) FROM {{t}} WHERE {c.column} IS NULL"
            elif c.kind == "unique":
                bad = (f"SELECT count(*) FROM (SELECT {c.column} FROM {{t}} WHERE {c.column} IS NOT NULL "
                       f"GROUP BY {c.column} HAVING count(*) > 1)")
            elif c.kind == "between":
                limits = [f"{c.column} {op} {v}" for op, v in (("<", c.min_value), (">", c.max_value)) if v is not None]
                bad = f"SELECT count(*) FROM {{t}} WHERE {' OR '.join(limits)}"
            elif c.kind == "accepted_values":
                bad = f"SELECT count(*) FROM {{t}} WHERE {c.column} NOT IN {c.values}"
            else:
                parent = table.get(c.parent, c.parent)
                bad = (f"SELECT count(*) FROM {{t}} x WHERE x.{c.column} IS NOT NULL AND NOT EXISTS "
                       f"(SELECT 1 FROM {parent} p WHERE p.{c.parent_column} = x.{c.column})")
            out.append(f"SELECT '{model}' AS model, '{c.column}' AS \"column\", '{c.kind}' AS \"check\", "
                       f"({bad.format(t=table.get(model, model))})::BIGINT AS failures")
    return "SELECT *, CASE failures WHEN 0 THEN 'pass' ELSE 'fail' END AS status FROM (" + " UNION ALL ".join(out) + ")"


sql("dq_summary", _declared())

_DAMAGED = """
docs AS (
  SELECT DISTINCT 'fixtures' AS kind, fixture_id // 50 AS payload_seq, league_id, season, NULL::BIGINT AS fixture_id,
    max(loaded_at) OVER (PARTITION BY league_id, season, fixture_id // 50) AS loaded_at, (fixture_id // 50) % 7 = 3 AS cut
  FROM raw_fixtures
  UNION ALL SELECT DISTINCT 'standings', NULL, league_id, season, NULL, updated_at, (season + league_id) % 7 = 3
  FROM raw_standings
  UNION ALL SELECT DISTINCT 'teams', season * 100 + league_id, league_id, season, NULL, TIMESTAMP '2024-01-01',
    (season * 100 + league_id) % 7 = 3
  FROM raw_fixtures
  UNION ALL SELECT DISTINCT 'odds', NULL, NULL, NULL, fixture_id, loaded_at, fixture_id % 23 = 7 FROM raw_odds
)"""
sql("payload_rejects", """SELECT * EXCLUDE (cut), NULL::BIGINT AS bookmaker_id, 'document does not parse' AS reason
  FROM docs WHERE cut
  UNION ALL SELECT 'odds', NULL, NULL, NULL, fixture_id, loaded_at, bookmaker_id, 'price is not a number'
  FROM raw_odds WHERE fixture_id % 29 = 5 AND fixture_id % 23 <> 7 AND market_name = 'Match Winner'""", _DAMAGED)
sql("payload_rows", """
  SELECT 'fixtures' AS kind, season, count(*) AS count FROM raw_fixtures WHERE (fixture_id // 50) % 7 <> 3 GROUP BY season
  UNION ALL SELECT 'standings', season, count(*) FROM raw_standings WHERE (season + league_id) % 7 <> 3 GROUP BY season
  UNION ALL SELECT 'teams', NULL, count(DISTINCT team_id) FROM raw_teams_football t JOIN
    (SELECT unnest([home_team_id, away_team_id]) AS team_id, season * 100 + league_id AS doc FROM raw_fixtures) f
    USING (team_id) WHERE doc % 7 <> 3
  UNION ALL SELECT 'odds', NULL, count(*) FROM raw_odds
    WHERE fixture_id % 23 <> 7 AND fixture_id % 29 <> 5 AND market_name = 'Match Winner'""")

sql("booster_only_blend", """SELECT fixture_id, gb_home_prob AS hybrid_home_prob, gb_draw_prob AS hybrid_draw_prob,
  gb_away_prob AS hybrid_away_prob, ['HOME_WIN', 'DRAW', 'AWAY_WIN'][list_position([gb_home_prob, gb_draw_prob,
  gb_away_prob], greatest(gb_home_prob, gb_draw_prob, gb_away_prob))] AS predicted_result,
  greatest(gb_home_prob, gb_draw_prob, gb_away_prob) AS confidence_score FROM raw_predictions""")
