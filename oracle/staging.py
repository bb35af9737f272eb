"""Oracle CTEs for the staging models (DuckDB SQL)."""

STG_FIXTURES = """
stg_fixtures AS (
  SELECT fixture_id, league_id, league_name, season, round,
    match_date::TIMESTAMP AS match_date,
    match_date::DATE AS match_day,
    year(match_date)::BIGINT AS match_year,
    month(match_date)::BIGINT AS match_month,
    dayofweek(match_date)::BIGINT AS day_of_week,
    status, home_team_id, home_team_name, away_team_id, away_team_name,
    coalesce(home_goals, 0) AS home_goals,
    coalesce(away_goals, 0) AS away_goals,
    coalesce(home_goals_ht, 0) AS home_goals_ht,
    coalesce(away_goals_ht, 0) AS away_goals_ht,
    coalesce(home_goals, 0) + coalesce(away_goals, 0) AS total_goals,
    CASE WHEN home_goals > away_goals THEN 'HOME_WIN'
         WHEN away_goals > home_goals THEN 'AWAY_WIN'
         WHEN home_goals = away_goals THEN 'DRAW' END AS match_result,
    venue_name, referee, loaded_at
  FROM raw_fixtures
  WHERE status IN ('FT', 'AET', 'PEN')
)"""

STG_ODDS = """
stg_odds_src AS (
  SELECT odds_id, fixture_id, bookmaker_id, bookmaker_name, market_name,
    odd_home::DECIMAL(10,4) AS odd_home, odd_draw::DECIMAL(10,4) AS odd_draw,
    odd_away::DECIMAL(10,4) AS odd_away, loaded_at::TIMESTAMP AS loaded_at
  FROM raw_odds
  WHERE fixture_id IS NOT NULL AND odd_home > 1 AND odd_draw > 1 AND odd_away > 1
),
stg_odds_raw AS (
  SELECT *,
    round(1.0 / odd_home, 6)::DECIMAL(18,6) AS raw_prob_home,
    round(1.0 / odd_draw, 6)::DECIMAL(18,6) AS raw_prob_draw,
    round(1.0 / odd_away, 6)::DECIMAL(18,6) AS raw_prob_away,
    round((1.0 / odd_home + 1.0 / odd_draw + 1.0 / odd_away), 6)::DECIMAL(18,6) AS overround
  FROM stg_odds_src
),
stg_odds AS (
  SELECT odds_id, fixture_id, bookmaker_id, bookmaker_name, market_name,
    odd_home, odd_draw, odd_away, raw_prob_home, raw_prob_draw, raw_prob_away, overround,
    round(raw_prob_home / overround, 6)::DECIMAL(18,6) AS implied_prob_home,
    round(raw_prob_draw / overround, 6)::DECIMAL(18,6) AS implied_prob_draw,
    round(raw_prob_away / overround, 6)::DECIMAL(18,6) AS implied_prob_away,
    loaded_at
  FROM stg_odds_raw
)"""

STG_STANDINGS = """
stg_standings_src AS (
  SELECT standing_id, league_id, league_name, season, team_id, team_name,
    rank::BIGINT AS rank, points::BIGINT AS points, played::BIGINT AS played,
    win::BIGINT AS win, draw::BIGINT AS draw, lose::BIGINT AS lose,
    goals_for::BIGINT AS goals_for, goals_against::BIGINT AS goals_against,
    goals_for::BIGINT - goals_against::BIGINT AS goal_difference,
    coalesce(form, '') AS form, status, description,
    updated_at::TIMESTAMP AS updated_at, loaded_at
  FROM raw_standings
  WHERE team_id IS NOT NULL AND league_id IS NOT NULL AND season IS NOT NULL
),
stg_standings AS (
  SELECT *,
    lag(rank) OVER (PARTITION BY team_id, league_id, season ORDER BY updated_at, standing_id) AS prev_rank,
    rank - lag(rank) OVER (PARTITION BY team_id, league_id, season ORDER BY updated_at, standing_id) AS rank_change
  FROM stg_standings_src
)"""

STG_TEAMS_FOOTBALL = """
stg_teams_football AS (
  SELECT team_id, team_name, coalesce(team_code, '') AS team_code, country,
    founded AS founded_year, is_national::BOOLEAN AS is_national, logo_url,
    venue_id, venue_name, venue_city, venue_country,
    venue_capacity::BIGINT AS venue_capacity, updated_at::TIMESTAMP AS updated_at
  FROM raw_teams_football
  WHERE team_id IS NOT NULL AND team_name IS NOT NULL
)"""

STG_MATCHES = """
stg_matches AS (
  SELECT match_id, match_date::DATE AS match_date, home_team_id, away_team_id,
    home_goals::BIGINT AS home_goals, away_goals::BIGINT AS away_goals,
    coalesce(competition_id, 'UNKNOWN') AS competition_id,
    (home_goals + away_goals)::BIGINT AS total_goals,
    CASE WHEN home_goals > away_goals THEN 'HOME_WIN'
         WHEN home_goals < away_goals THEN 'AWAY_WIN' ELSE 'DRAW' END AS match_result,
    loaded_at::TIMESTAMP AS loaded_at
  FROM raw_matches
  WHERE match_id IS NOT NULL AND match_date IS NOT NULL
)"""

STG_TEAMS = """
stg_teams AS (
  SELECT team_id, trim(team_name) AS team_name,
    coalesce(trim(country), 'UNKNOWN') AS country,
    founded_year::BIGINT AS founded_year, updated_at::TIMESTAMP AS updated_at
  FROM raw_teams
  WHERE team_id IS NOT NULL AND team_name IS NOT NULL
)"""

ALL_STAGING = [STG_FIXTURES, STG_ODDS, STG_STANDINGS, STG_TEAMS_FOOTBALL, STG_MATCHES, STG_TEAMS]
