"""The adapter formulas of ``matchmart.sources.adapters`` written as DuckDB SQL.

``with_raw(body)`` prefixes a query body with CTEs named ``raw_*`` that compute
the canonical raw inputs from the pre-registered driver views.
"""

RAW_FIXTURES = """
raw_fixtures AS (
  SELECT
    o_orderkey::BIGINT AS fixture_id,
    (o_orderkey % 6 + 1)::BIGINT AS league_id,
    CASE o_orderkey % 6 WHEN 0 THEN 'Alpha League' WHEN 1 THEN 'Bravo Cup'
      WHEN 2 THEN 'Copa Norte' WHEN 3 THEN 'Champions Series'
      WHEN 4 THEN 'Nations Trophy' WHEN 5 THEN 'Delta League' END AS league_name,
    year(o_orderdate)::BIGINT AS season,
    'Round ' || month(o_orderdate)::VARCHAR AS round,
    o_orderdate AS match_date,
    st AS status,
    (o_custkey % 40 + 1)::BIGINT AS home_team_id,
    'Team ' || (o_custkey % 40 + 1)::VARCHAR AS home_team_name,
    ((o_custkey % 40 + 1 + o_orderkey % 39) % 40 + 1)::BIGINT AS away_team_id,
    'Team ' || ((o_custkey % 40 + 1 + o_orderkey % 39) % 40 + 1)::VARCHAR AS away_team_name,
    CASE WHEN NOT ng THEN p1 % 5 END AS home_goals,
    CASE WHEN NOT ng THEN p2 % 4 END AS away_goals,
    CASE WHEN NOT ng THEN p1 % 5 - (p1 % 5) % 2 END AS home_goals_ht,
    CASE WHEN NOT ng THEN (p2 % 4) % 2 END AS away_goals_ht,
    CASE WHEN o_orderkey % 17 <> 0 THEN 'Stadium ' || (o_custkey % 40 % 25)::VARCHAR END AS venue_name,
    'Ref ' || (o_orderkey % 31)::VARCHAR AS referee,
    o_orderdate + INTERVAL 1 DAY AS loaded_at
  FROM (
    SELECT *,
      floor(o_totalprice)::BIGINT AS p1,
      floor(o_totalprice / 7)::BIGINT AS p2,
      CASE WHEN o_orderstatus = 'F' THEN 'FT'
           WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'AET'
           WHEN o_orderstatus = 'P' THEN 'PEN' ELSE 'NS' END AS st,
      (o_orderstatus NOT IN ('F', 'P') OR o_orderkey % 97 = 0) AS ng
    FROM orders
  ) o
)"""

RAW_ODDS = """
raw_odds AS (
  SELECT
    fixture_id * 1000 + b AS odds_id,
    fixture_id,
    b AS bookmaker_id,
    'Book ' || b::VARCHAR AS bookmaker_name,
    CASE WHEN fixture_id % 11 = 0 THEN 'Goals Over/Under' ELSE 'Match Winner' END AS market_name,
    ((90 + (fixture_id * 7 + b * 13) % 400) / 100.0)::DOUBLE::DECIMAL(10,4) AS odd_home,
    ((250 + (fixture_id * 3 + b * 7) % 200) / 100.0)::DOUBLE::DECIMAL(10,4) AS odd_draw,
    ((110 + (fixture_id * 11 + b * 5) % 600) / 100.0)::DOUBLE::DECIMAL(10,4) AS odd_away,
    loaded_at
  FROM raw_fixtures, (SELECT range::BIGINT AS b FROM range(1, 4)) bk
  WHERE fixture_id % 5 <> 0
)"""

RAW_STANDINGS = """
raw_standings_app AS (
  SELECT league_id, league_name, season, date_trunc('month', match_date) AS updated_at,
         home_team_id AS team_id, home_goals AS gf, away_goals AS ga
  FROM raw_fixtures
  WHERE status IN ('FT','AET','PEN') AND home_goals IS NOT NULL AND away_goals IS NOT NULL
  UNION ALL
  SELECT league_id, league_name, season, date_trunc('month', match_date),
         away_team_id, away_goals, home_goals
  FROM raw_fixtures
  WHERE status IN ('FT','AET','PEN') AND home_goals IS NOT NULL AND away_goals IS NOT NULL
),
raw_standings_agg AS (
  SELECT team_id, league_id, season, updated_at,
    max(league_name) AS league_name,
    sum(CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END)::BIGINT AS points,
    count(*)::BIGINT AS played,
    sum(CASE WHEN gf > ga THEN 1 ELSE 0 END)::BIGINT AS win,
    sum(CASE WHEN gf = ga THEN 1 ELSE 0 END)::BIGINT AS draw,
    sum(CASE WHEN gf < ga THEN 1 ELSE 0 END)::BIGINT AS lose,
    sum(gf)::BIGINT AS goals_for,
    sum(ga)::BIGINT AS goals_against
  FROM raw_standings_app
  GROUP BY team_id, league_id, season, updated_at
),
raw_standings AS (
  SELECT league_id * 10000000 + season * 1000 + rank AS standing_id,
    league_id, league_name, season, team_id, 'Team ' || team_id::VARCHAR AS team_name,
    rank, points, played, win, draw, lose, goals_for, goals_against,
    CASE WHEN month(updated_at) % 2 = 1 THEN 'M' || month(updated_at)::VARCHAR END AS form,
    NULL::VARCHAR AS status, NULL::VARCHAR AS description,
    updated_at, updated_at + INTERVAL 1 DAY AS loaded_at
  FROM (
    SELECT *, row_number() OVER (PARTITION BY league_id, season, updated_at
      ORDER BY points DESC, goals_for - goals_against DESC, team_id ASC)::BIGINT AS rank
    FROM raw_standings_agg
  ) r
)"""

RAW_TEAMS_FOOTBALL = """
raw_teams_football AS (
  SELECT
    (c_custkey + 1)::BIGINT AS team_id,
    'Team ' || (c_custkey + 1)::VARCHAR AS team_name,
    CASE WHEN c_custkey % 4 <> 0 THEN 'T' || (c_custkey + 1)::VARCHAR END AS team_code,
    n_name AS country,
    CASE WHEN c_custkey % 9 <> 0 THEN 1880 + 3 * (c_custkey % 40) END::BIGINT AS founded,
    (c_custkey % 13 = 0) AS is_national,
    'https://img.example/logo.png' AS logo_url,
    (c_custkey % 25)::BIGINT AS venue_id,
    'Stadium ' || (c_custkey % 25)::VARCHAR AS venue_name,
    'Capital' AS venue_city,
    n_name AS venue_country,
    (10000 + 500 * c_custkey)::BIGINT AS venue_capacity,
    TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

RAW_PREDICTIONS = """
raw_predictions AS (
  SELECT fixture_id,
    z / s AS poisson_home_prob, x / s AS poisson_draw_prob, y / s AS poisson_away_prob,
    y / s AS gb_home_prob, z / s AS gb_draw_prob, x / s AS gb_away_prob,
    x / s AS hybrid_home_prob, y / s AS hybrid_draw_prob, z / s AS hybrid_away_prob,
    (fixture_id * 7 % 30) / 10.0 AS expected_home_goals,
    (fixture_id * 11 % 25) / 10.0 AS expected_away_goals,
    greatest(x, y, z) / s AS confidence_score,
    'v' || (fixture_id % 2 + 1)::VARCHAR AS model_version,
    loaded_at AS predicted_at
  FROM (
    SELECT fixture_id, loaded_at,
      (fixture_id * 7 % 50 + 1)::DOUBLE AS x,
      (fixture_id * 11 % 40 + 1)::DOUBLE AS y,
      (fixture_id * 13 % 45 + 1)::DOUBLE AS z,
      (fixture_id * 7 % 50 + 1)::DOUBLE + (fixture_id * 11 % 40 + 1)::DOUBLE
        + (fixture_id * 13 % 45 + 1)::DOUBLE AS s
    FROM raw_fixtures
  ) p
)"""

RAW_MATCHES = """
raw_matches AS (
  SELECT 'm' || fixture_id::VARCHAR AS match_id,
    match_date::DATE AS match_date,
    't' || home_team_id::VARCHAR AS home_team_id,
    't' || away_team_id::VARCHAR AS away_team_id,
    home_goals, away_goals,
    CASE WHEN fixture_id % 13 <> 0 THEN 'c' || lpad(league_id::VARCHAR, 3, '0') END AS competition_id,
    loaded_at
  FROM raw_fixtures WHERE status IN ('FT','AET','PEN')
)"""

RAW_TEAMS = """
raw_teams AS (
  SELECT 't' || (c_custkey + 1)::VARCHAR AS team_id,
    CASE WHEN c_custkey % 3 = 0 THEN '  Team ' || (c_custkey + 1)::VARCHAR || ' '
         ELSE 'Team ' || (c_custkey + 1)::VARCHAR END AS team_name,
    CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS country,
    CASE WHEN c_custkey % 9 <> 0 THEN 1880 + 3 * (c_custkey % 40) END::BIGINT AS founded_year,
    TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

RAW_ROSTER = """
roster_v1 AS (
  SELECT c_custkey::VARCHAR AS player_id, 't' || (c_custkey % 40 + 1)::VARCHAR AS team_id,
    c_name AS player_name, c_mktsegment AS position,
    TIMESTAMP '2024-01-01 00:00:00' AS updated_at
  FROM customer WHERE c_custkey % 26 <> 25
),
roster_v2 AS (
  SELECT c_custkey::VARCHAR AS player_id,
    't' || (CASE WHEN c_custkey % 10 = 0 THEN (c_custkey + 1) % 40 + 1
                 ELSE c_custkey % 40 + 1 END)::VARCHAR AS team_id,
    c_name AS player_name, c_mktsegment AS position,
    CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
         ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
  FROM customer WHERE c_custkey % 25 <> 7
)"""

ALL_RAW = ",".join([RAW_FIXTURES, RAW_ODDS, RAW_STANDINGS, RAW_TEAMS_FOOTBALL,
                    RAW_PREDICTIONS, RAW_MATCHES, RAW_TEAMS, RAW_ROSTER])


def with_raw(*ctes: str) -> str:
    """Return ``WITH <all raw CTEs>, <ctes...>`` ready for a final SELECT."""
    parts = [ALL_RAW] + [c.strip().rstrip(",") for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n"
