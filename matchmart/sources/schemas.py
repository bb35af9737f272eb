"""Canonical raw schemas (what the staging models select) and the nested
payload schemas of the four API documents.  Scans always pass a schema, so no
job ever infers types from data."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, B = T.LongType(), T.StringType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW = {
    "fixtures": _st(("fixture_id", L), ("league_id", L), ("league_name", S), ("season", L),
                    ("round", S), ("match_date", TS), ("status", S), ("home_team_id", L),
                    ("home_team_name", S), ("away_team_id", L), ("away_team_name", S),
                    ("home_goals", L), ("away_goals", L), ("home_goals_ht", L),
                    ("away_goals_ht", L), ("venue_name", S), ("referee", S), ("loaded_at", TS)),
    "odds": _st(("odds_id", L), ("fixture_id", L), ("bookmaker_id", L), ("bookmaker_name", S),
                ("market_name", S), ("odd_home", T.DecimalType(10, 4)),
                ("odd_draw", T.DecimalType(10, 4)), ("odd_away", T.DecimalType(10, 4)),
                ("loaded_at", TS)),
    "standings": _st(("standing_id", L), ("league_id", L), ("league_name", S), ("season", L),
                     ("team_id", L), ("team_name", S), ("rank", L), ("points", L), ("played", L),
                     ("win", L), ("draw", L), ("lose", L), ("goals_for", L),
                     ("goals_against", L), ("form", S), ("status", S), ("description", S),
                     ("updated_at", TS), ("loaded_at", TS)),
    "teams_football": _st(("team_id", L), ("team_name", S), ("team_code", S), ("country", S),
                          ("founded", L), ("is_national", B), ("logo_url", S), ("venue_id", L),
                          ("venue_name", S), ("venue_city", S), ("venue_country", S),
                          ("venue_capacity", L), ("updated_at", TS)),
}

# Seed file schema (every column text; tier mixes "1" and "Cup").
SEED_COMPETITIONS = _st(("competition_id", S), ("competition_name", S), ("country", S),
                        ("tier", S))

# --- API payload documents -------------------------------------------------------------

_HOME_AWAY_L = _st(("home", L), ("away", L))
_ID_NAME = _st(("id", L), ("name", S))

FIXTURE_ITEM = _st(
    ("fixture", _st(("id", L), ("date", S), ("referee", S),
                    ("status", _st(("long", S), ("short", S))),
                    ("venue", _st(("name", S))))),
    ("league", _st(("round", S))),
    ("teams", _st(("home", _ID_NAME), ("away", _ID_NAME))),
    ("goals", _HOME_AWAY_L),
    ("score", _st(("halftime", _HOME_AWAY_L))),
)

STANDING_ENTRY = _st(
    ("rank", L), ("points", L), ("goalsDiff", L), ("form", S), ("team", _ID_NAME),
    ("all", _st(("played", L), ("win", L), ("draw", L), ("lose", L),
                ("goals", _st(("for", L), ("against", L))))),
)
STANDINGS_ITEM = _st(("league", _st(("standings", T.ArrayType(T.ArrayType(STANDING_ENTRY))))))

TEAM_ITEM = _st(
    ("team", _st(("id", L), ("name", S), ("code", S), ("country", S), ("founded", L),
                 ("national", B), ("logo", S))),
    ("venue", _st(("name", S), ("capacity", L))),
)

ODDS_VALUE = _st(("value", S), ("odd", S))
_BET = _st(("name", S), ("values", T.ArrayType(ODDS_VALUE)))
_BOOKMAKER = _st(("id", L), ("name", S), ("bets", T.ArrayType(_BET)))
ODDS_ITEM = _st(("bookmakers", T.ArrayType(_BOOKMAKER)))

# One API response: its items as JSON text plus the call context.
PAYLOAD = _st(("payload_seq", L), ("league_id", L), ("league_name", S), ("season", L),
              ("fixture_id", L), ("loaded_at", TS), ("body", S))
