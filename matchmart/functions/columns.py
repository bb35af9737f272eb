"""Column helpers: every function returns a ``Column`` built from built-in
Spark expressions, so everything stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values --------------------------------------------------------------
HOME_WIN, DRAW, AWAY_WIN = "HOME_WIN", "DRAW", "AWAY_WIN"
# Target encoding (fixed order, not data-dependent): HOME_WIN 0, DRAW 1, AWAY_WIN 2.
FINISHED_STATUSES = ["FT", "AET", "PEN"]
TERMINAL_STATUSES = ["FT", "AET", "PEN", "CANC", "AWD", "WO", "ABD", "PST"]
# League classification keywords, checked in this order.
CUP_KEYWORDS = ["cup", "copa", "coupe", "pokal", "taça"]
INTERNATIONAL_KEYWORDS = ["champions", "europa", "conference", "world cup", "nations"]
# Surrogate-key null placeholder (public dbt_utils convention).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# ---------------------------------------------------------------------------


def ts_lit(v) -> Column:
    """TIMESTAMP_NTZ literal from text or a datetime, built from its text so the
    session time zone never shifts it."""
    if hasattr(v, "isoformat"):
        v = v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return F.lit(None if v is None else str(v)).cast("timestamp_ntz")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def match_result(home_goals, away_goals, else_draw: bool = False) -> Column:
    """3-way result.  ``else_draw=True`` is the legacy rule (null goals -> DRAW);
    otherwise null goals give a null result."""
    h, a = col(home_goals), col(away_goals)
    expr = F.when(h > a, HOME_WIN).when(a > h, AWAY_WIN)
    return expr.otherwise(DRAW) if else_draw else expr.when(h == a, DRAW)


def points(result, win_value: str) -> Column:
    """3/1/0 points from the perspective whose win is ``win_value``."""
    r = col(result)
    return F.when(r == win_value, 3).when(r == DRAW, 1).otherwise(0)


def win_flag(result, win_value: str) -> Column:
    return F.when(col(result) == win_value, 1).otherwise(0)


def dow_sunday0(c) -> Column:
    """Day of week with Sunday = 0 (Spark's ``dayofweek`` is Sunday = 1)."""
    return F.dayofweek(col(c)) - 1


def safe_div(num, den) -> Column:
    """num / nullif(den, 0) -- never raises under ANSI mode."""
    return col(num) / F.nullif(col(den), F.lit(0))


def pair_low(a, b) -> Column:
    return F.least(col(a), col(b))


def pair_high(a, b) -> Column:
    return F.greatest(col(a), col(b))


def surrogate_key(*cols) -> Column:
    """md5 of '-'-joined text of the columns with a fixed null placeholder."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def remove_overround(*odds) -> dict[str, Column]:
    """Raw probabilities 1/odd (6 places), their sum (overround, 6 places) and
    the margin-free implied probabilities (raw / overround, 6 places), all
    computed in DECIMAL like the reference."""
    one = F.lit(1).cast("decimal(2,1)")
    raws = [F.round(one / col(o), 6) for o in odds]
    over = F.round(sum((one / col(o) for o in odds[1:]), one / col(odds[0])), 6)
    return {"raw": raws, "overround": over}


def league_type(name) -> Column:
    n = F.lower(col(name))
    cup = None
    for kw in CUP_KEYWORDS:
        cup = n.contains(kw) if cup is None else (cup | n.contains(kw))
    intl = None
    for kw in INTERNATIONAL_KEYWORDS:
        intl = n.contains(kw) if intl is None else (intl | n.contains(kw))
    return F.when(cup, "CUP").when(intl, "INTERNATIONAL").otherwise("DOMESTIC_LEAGUE")


def rank_movement(rank_change) -> Column:
    r = col(rank_change)
    return F.when(r < 0, "UP").when(r > 0, "DOWN").otherwise("SAME")


def encode_target(result) -> Column:
    r = col(result)
    return (F.when(r == HOME_WIN, 0).when(r == DRAW, 1).when(r == AWAY_WIN, 2))


def decode_target(code) -> Column:
    c = col(code)
    return F.when(c == 0, HOME_WIN).when(c == 1, DRAW).when(c == 2, AWAY_WIN)


def predicted_result_sql(home, draw, away) -> Column:
    """SQL tie rule: HOME wins every tie, AWAY beats DRAW on a tie."""
    h, d, a = col(home), col(draw), col(away)
    return (F.when((h >= d) & (h >= a), HOME_WIN)
            .when((a >= d) & (a > h), AWAY_WIN)
            .otherwise(DRAW))


def predicted_result_argmax(home, draw, away) -> Column:
    """First-maximum rule over (HOME, DRAW, AWAY) (array argmax order)."""
    h, d, a = col(home), col(draw), col(away)
    return (F.when((h >= d) & (h >= a), HOME_WIN)
            .when(d >= a, DRAW)
            .otherwise(AWAY_WIN))


def is_correct(predicted, actual) -> Column:
    """Three-valued: NULL while the actual result is unknown."""
    p, a = col(predicted), col(actual)
    return F.when(a.isNull(), F.lit(None).cast("boolean")).otherwise(p == a)


def has_odds(bookmaker_count) -> Column:
    return F.coalesce(col(bookmaker_count) > 0, F.lit(False))
