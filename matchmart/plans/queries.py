"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Every query reads the driver tables of ``sf_dir``
through the adapters, so its work grows with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..ml import boosting as MB
from ..ml import features as MF
from ..ml import hybrid as MH
from ..ml import metrics as MM
from ..ml import poisson as MP
from ..ml import train as MT
from ..operators import quality as Q
from ..operators import sinks as K
from ..operators.joins import Lookup
from ..operators.manifest import ManifestStore
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sources import payloads as PL
from ..sources import scan as SC
from . import intermediate as I
from . import marts as M
from .context import Context, normalize

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Context], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return normalize(fn(Context(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def registry() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


# --- staging -----------------------------------------------------------------

@query("stg_fixtures")
def q_stg_fixtures(c: Context) -> DataFrame:
    """Finished fixtures, date parts, null goals -> 0, result w/o ELSE."""
    return c.stg_fixtures


@query("stg_odds")
def q_stg_odds(c: Context) -> DataFrame:
    """Valid quotes with overround and implied probabilities."""
    return c.stg_odds


@query("stg_standings")
def q_stg_standings(c: Context) -> DataFrame:
    """Typed standings with previous rank / rank change."""
    return c.stg_standings


@query("stg_teams_football")
def q_stg_teams_football(c: Context) -> DataFrame:
    """Typed team dimension source."""
    return c.stg_teams_football


@query("stg_matches")
def q_stg_matches(c: Context) -> DataFrame:
    """Legacy matches, ELSE DRAW result rule, UNKNOWN competition."""
    return c.stg_matches


@query("stg_teams")
def q_stg_teams(c: Context) -> DataFrame:
    """Trimmed legacy team names, UNKNOWN country."""
    return c.stg_teams


# --- intermediate --------------------------------------------------------------

@query("appearances")
def q_appearances(c: Context) -> DataFrame:
    """One row per team per finished fixture (single-scan unpivot)."""
    return I.appearances(c.stg_fixtures)


@query("team_form")
def q_team_form(c: Context) -> DataFrame:
    """Rolling 5/10-match form per (team, league, season); hot keys (if
    any) take the chunked window, the rest the plain window."""
    return I.team_form(c.stg_fixtures, strategy="auto")


@query("team_form_chunked")
def q_team_form_chunked(c: Context) -> DataFrame:
    """W02 with every key on the chunked (halo) window path."""
    return I.team_form(c.stg_fixtures, strategy="chunked")


@query("rolling_avg")
def q_rolling_avg(c: Context) -> DataFrame:
    """The rolling-average operator; hot keys take the chunked window."""
    return I.team_form(c.stg_fixtures, strategy="auto")


@query("last_n_per_pair")
def q_last_n_per_pair(c: Context) -> DataFrame:
    """Last five meetings of every pair (row_number <= 5)."""
    return I.h2h_last_n(c.stg_fixtures, 5)


@query("h2h_stats")
def q_h2h_stats(c: Context) -> DataFrame:
    """Per-pair statistics over the last five meetings."""
    return I.head_to_head(c.stg_fixtures, 5)


@query("odds_consensus")
def q_odds_consensus(c: Context) -> DataFrame:
    """Bookmaker-average implied probabilities per fixture."""
    return I.odds_consensus(c.stg_odds)


@query("venue_advantage")
def q_venue_advantage(c: Context) -> DataFrame:
    """Per (venue, home team) home record."""
    return I.venue_advantage(c.stg_fixtures)


@query("match_features")
def q_match_features(c: Context) -> DataFrame:
    """The full per-fixture feature vector (flagship)."""
    return I.match_features(c.stg_fixtures, c.stg_odds)


@query("team_performance")
def q_team_performance(c: Context) -> DataFrame:
    """Legacy rolling form per team across all competitions."""
    return I.team_performance(c.stg_matches, c.stg_teams)


@query("team_performance_chunked")
def q_team_performance_chunked(c: Context) -> DataFrame:
    """W06 with every team on the chunked (halo) window path."""
    return I.team_performance(c.stg_matches, c.stg_teams, strategy="chunked")


# --- marts ---------------------------------------------------------------------


@query("union_distinct")
def q_union_distinct(c: Context) -> DataFrame:
    """Leagues from fixtures UNION leagues from standings."""
    return M.all_leagues(c.stg_fixtures, c.stg_standings)


@query("league_seasons")
def q_league_seasons(c: Context) -> DataFrame:
    """Season range, count and sorted distinct list per league."""
    return M.league_seasons(c.stg_fixtures)


@query("league_stats")
def q_league_stats(c: Context) -> DataFrame:
    """Per-league match count, goals and result rates."""
    return M.league_stats(c.stg_fixtures)


@query("dim_league")
def q_dim_league(c: Context) -> DataFrame:
    """The league dimension (with P11 league_type)."""
    return c.dim_league


@query("union_all_aggs")
def q_union_all_aggs(c: Context) -> DataFrame:
    """UNION ALL of home-side and away-side aggregates."""
    return M.side_participation(c.stg_fixtures)


@query("team_participation")
def q_team_participation(c: Context) -> DataFrame:
    """Two-level participation aggregate per team."""
    return M.team_participation(c.stg_fixtures)


@query("dim_enrich")
def q_dim_enrich(c: Context) -> DataFrame:
    """Team rows left-joined to aggregates, zero defaults."""
    return M.team_enrich(c.stg_teams_football, c.stg_fixtures)


@query("dim_team_football")
def q_dim_team_football(c: Context) -> DataFrame:
    """Team dimension with surrogate key and participation."""
    return c.dim_team_football


@query("dim_team")
def q_dim_team(c: Context) -> DataFrame:
    """Legacy team dimension."""
    return M.dim_team(c.stg_teams)


@query("latest_per_key")
def q_latest_per_key(c: Context) -> DataFrame:
    """Latest standings snapshot per (team, league, season)."""
    return M.latest_standings(c.stg_standings)


@query("fct_standings")
def q_fct_standings(c: Context) -> DataFrame:
    """Current standings with ratios, movement and dimensions."""
    return M.fct_standings(c.stg_standings, c.dim_team_football, c.dim_league)


@query("role_playing_dim")
def q_role_playing_dim(c: Context) -> DataFrame:
    """Team dimension joined twice plus the league dimension."""
    j = M.role_playing_dims(c.match_features, c.dim_team_football, c.dim_league)
    return j.select("fixture_id", "home_team_id", "away_team_id", "league_id",
                    "home_team_sk", "away_team_sk", "league_type")


@query("fct_match_features")
def q_fct_match_features(c: Context) -> DataFrame:
    """The feature fact table."""
    return c.fct_match_features


@query("season_stats")
def q_season_stats(c: Context) -> DataFrame:
    """Legacy per-team per-year statistics."""
    return M.season_stats(c.team_performance.drop("perspective"))


@query("match_facts_legacy")
def q_match_facts_legacy(c: Context) -> DataFrame:
    """Legacy match fact with form indices."""
    return M.match_facts_legacy(c.stg_matches, c.team_performance)


@query("left_join_2key")
def q_left_join_2key(c: Context) -> DataFrame:
    """Fixtures left-joined to the form of each side on (fixture, team)."""
    return c.match_features.select(
        "fixture_id", "home_team_id", "away_team_id",
        "home_avg_points_l5", "home_win_rate_l10", "away_avg_points_l5", "away_win_rate_l10")


@query("join_normalized_pair")
def q_join_normalized_pair(c: Context) -> DataFrame:
    """Fixtures joined to pair statistics on least/greatest team ids."""
    from . import intermediate as I2
    h = I2.head_to_head(c.stg_fixtures)
    f = c.stg_fixtures.withColumns({"team_a_id": C.pair_low("home_team_id", "away_team_id"),
                                    "team_b_id": C.pair_high("home_team_id", "away_team_id")})
    return Lookup(h).join(f, {"team_a_id": "team_a_id", "team_b_id": "team_b_id"},
                          {c: c for c in ("h2h_total_matches", "h2h_avg_goals")}, "fixture_id").select(
        "fixture_id", "team_a_id", "team_b_id", "h2h_total_matches", "h2h_avg_goals")


@query("join_agg_lookup")
def q_join_agg_lookup(c: Context) -> DataFrame:
    """Fixtures left-joined to pre-aggregated odds and venue tables."""
    return c.match_features.select(
        "fixture_id", "odds_implied_prob_home", "bookmaker_count",
        "venue_total_matches", "venue_home_win_rate")


@query("inner_join_facts")
def q_inner_join_facts(c: Context) -> DataFrame:
    """Predictions inner-joined to finished fixtures."""
    p = c.raw.predictions.select("fixture_id", "hybrid_home_prob", "model_version")
    f = c.stg_fixtures.select("fixture_id", "league_id", "match_result")
    return p.join(f, "fixture_id", "inner")


# --- predicates and scalar functions ------------------------------------------------------

@query("not_null_filter")
def q_not_null_filter(c: Context) -> DataFrame:
    """Conjunction of IS NOT NULL predicates."""
    return c.raw.fixtures.filter(F.col("venue_name").isNotNull() & F.col("home_goals").isNotNull()
                                 & F.col("away_goals").isNotNull()).select(
        "fixture_id", "venue_name", "home_goals", "away_goals")


@query("membership")
def q_membership(c: Context) -> DataFrame:
    """Status NOT IN the terminal list (literal list)."""
    return c.raw.fixtures.filter(~F.col("status").isin(*C.TERMINAL_STATUSES)).select(
        "fixture_id", "status", "match_date")


@query("range_predicate")
def q_range_predicate(c: Context) -> DataFrame:
    """Strict and inclusive range predicates on odds."""
    o = c.raw.odds
    return o.filter((F.col("odd_home") > 1) & F.col("odd_draw").between(3, 4)
                    & (F.col("odd_away") <= 5)).select("odds_id", "odd_home", "odd_draw", "odd_away")


@query("points_case")
def q_points_case(c: Context) -> DataFrame:
    """P10: perspective-dependent points and win flag."""
    from . import intermediate as I2
    return I2.appearances(c.stg_fixtures).select("fixture_id", "team_id", "perspective",
                                                 "points", "is_win")


@query("league_type")
def q_league_type(c: Context) -> DataFrame:
    """Ordered keyword classification of league names."""
    return c.stg_fixtures.select("league_id", "league_name").distinct().withColumn(
        "league_type", C.league_type("league_name"))


@query("rank_movement")
def q_rank_movement(c: Context) -> DataFrame:
    """Rank change sign as UP/DOWN/SAME, null change -> 0 / SAME."""
    s = c.stg_standings
    return s.select("standing_id", "team_id", "league_id", "season", "updated_at",
                    F.coalesce("rank_change", F.lit(0)).alias("rank_change"),
                    C.rank_movement("rank_change").alias("rank_movement"))


@query("encode_target")
def q_encode_target(c: Context) -> DataFrame:
    """Result -> 0/1/2 and back."""
    f = c.stg_fixtures.select("fixture_id", "match_result",
                              C.encode_target("match_result").alias("match_result_encoded"))
    return f.withColumn("match_result_decoded", C.decode_target("match_result_encoded"))


@query("has_odds")
def q_has_odds(c: Context) -> DataFrame:
    """Bookmaker count > 0 as a boolean, null -> false."""
    return c.match_features.select("fixture_id", "bookmaker_count",
                                   C.has_odds("bookmaker_count").alias("has_odds"))


@query("predicted_result")
def q_predicted_result(c: Context) -> DataFrame:
    """SQL tie rule over rounded hybrid probabilities."""
    p = c.raw.predictions.select(
        "fixture_id", *[F.col(f"hybrid_{s}_prob").cast("decimal(6,4)").alias(f"hybrid_{s}_prob")
                        for s in ("home", "draw", "away")])
    return p.withColumn("predicted_result", C.predicted_result_sql(
        "hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob"))


@query("is_correct")
def q_is_correct(c: Context) -> DataFrame:
    """Three-valued correctness; NULL while the actual result is unknown."""
    p = c.raw.predictions.select(
        "fixture_id", *[F.col(f"hybrid_{s}_prob").cast("decimal(6,4)").alias(f"hybrid_{s}_prob")
                        for s in ("home", "draw", "away")])
    p = p.withColumn("predicted_result", C.predicted_result_sql(
        "hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob"))
    f = c.stg_fixtures.select("fixture_id", F.col("match_result").alias("actual_result"))
    j = p.join(f, "fixture_id", "left")
    return j.select("fixture_id", "predicted_result", "actual_result",
                    C.is_correct("predicted_result", "actual_result").alias("is_correct"))


@query("feature_diffs")
def q_feature_diffs(c: Context) -> DataFrame:
    """Form differentials and attack-vs-defence features."""
    return c.fct_match_features.select(
        "fixture_id", "form_diff_points_l5", "form_diff_points_l10",
        "home_attack_vs_away_defense_l5", "away_attack_vs_home_defense_l5")


@query("null_default")
def q_null_default(c: Context) -> DataFrame:
    """coalesce(x, 0) on left-joined features; odds stay null."""
    return c.match_features.select(
        "fixture_id", "h2h_total_matches", "venue_total_matches", "venue_home_win_rate",
        "home_avg_points_l10", "odds_implied_prob_home")


@query("fn_dow")
def q_fn_dow(c: Context) -> DataFrame:
    """day of week with Sunday = 0."""
    return c.raw.fixtures.select("fixture_id", "match_date",
                                 C.dow_sunday0("match_date").alias("day_of_week"))


@query("fn_safe_div")
def q_fn_safe_div(c: Context) -> DataFrame:
    """division guarded by nullif (denominator often 0)."""
    s = c.stg_standings
    return s.select("standing_id", "team_id", "updated_at", "goals_for", "lose",
                    F.round(C.safe_div("goals_for", "lose"), 3).alias("goals_per_loss"))


@query("fn_pair")
def q_fn_pair(c: Context) -> DataFrame:
    """least/greatest pair normalisation."""
    return c.raw.fixtures.select("fixture_id",
                                 C.pair_low("home_team_id", "away_team_id").alias("team_a_id"),
                                 C.pair_high("home_team_id", "away_team_id").alias("team_b_id"))


@query("surrogate_key")
def q_surrogate_key(c: Context) -> DataFrame:
    """md5 surrogate key over several columns, with null placeholder."""
    t = c.raw.teams_football
    return t.select("team_id", "team_code", "founded",
                    C.surrogate_key("team_id", "team_code", "founded").alias("sk"))


# --- data quality ------------------------------------------------------------------------


# The clock used by the freshness query (a parameter, not now()).
FRESHNESS_NOW = "2001-08-02 20:00:00"


@query("dq_not_null")
def q_dq_not_null(c: Context) -> DataFrame:
    """Q01: not_null checks on the fixture staging model (one scan)."""
    checks = [Q.not_null(x) for x in ("fixture_id", "league_id", "season", "match_date",
                                      "status", "home_team_id", "away_team_id",
                                      "match_result", "total_goals")]
    return Q.row_level_failures(c.stg_fixtures, "stg_fixtures", "fixture_id", checks)


@query("dq_unique")
def q_dq_unique(c: Context) -> DataFrame:
    """Q02: unique keys of staging and mart models (nulls ignored)."""
    from functools import reduce
    parts = [Q.unique_failures(c.stg_fixtures, "stg_fixtures", "fixture_id"),
             Q.unique_failures(c.dim_team_football, "dim_team_football", "team_id"),
             Q.unique_failures(c.dim_league, "dim_league", "league_id"),
             Q.unique_failures(c.stg_fixtures.select("venue_name"), "stg_fixtures", "venue_name")]
    return reduce(DataFrame.unionByName, parts)


@query("dq_accepted_values")
def q_dq_accepted_values(c: Context) -> DataFrame:
    """Q03: accepted values (null passes) on fixtures, leagues and standings."""
    from functools import reduce
    parts = [
        Q.row_level_failures(c.stg_fixtures, "stg_fixtures", "fixture_id", [
            Q.accepted_values("status", ["FT", "AET", "PEN"]),
            Q.accepted_values("match_result", ["HOME_WIN", "AWAY_WIN", "DRAW"])]),
        Q.row_level_failures(c.dim_league, "dim_league", "league_id", [
            Q.accepted_values("league_type", ["DOMESTIC_LEAGUE", "CUP", "INTERNATIONAL"])]),
        Q.row_level_failures(c.stg_standings, "stg_standings", "standing_id", [
            Q.accepted_values("form", ["", "M1", "M3", "M5", "M7", "M9"])]),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("dq_relationships")
def q_dq_relationships(c: Context) -> DataFrame:
    """Q04: foreign keys of the feature fact and standings (left-anti joins)."""
    from functools import reduce
    f = c.match_features
    parts = [
        Q.relationship_failures(f, "match_features", "home_team_id", c.stg_teams_football,
                                "team_id", "fixture_id"),
        Q.relationship_failures(f, "match_features", "away_team_id", c.stg_teams_football,
                                "team_id", "fixture_id"),
        Q.relationship_failures(f, "match_features", "league_id", c.dim_league,
                                "league_id", "fixture_id"),
        Q.relationship_failures(c.stg_standings, "stg_standings", "team_id",
                                c.dim_team_football, "team_id", "standing_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("dq_between")
def q_dq_between(c: Context) -> DataFrame:
    """Q05: inclusive range checks; rank 1..30 fails by design on this data."""
    from functools import reduce
    parts = [
        Q.row_level_failures(c.stg_standings, "stg_standings", "standing_id", [
            Q.between("rank", 1, 30), Q.between("points", 0, None),
            Q.between("played", 0, 60)]),
        Q.row_level_failures(c.team_form, "team_form", "fixture_id", [
            Q.between("win_rate_l5", 0, 1), Q.between("avg_points_l10", 0, 3)]),
        Q.row_level_failures(c.stg_fixtures, "stg_fixtures", "fixture_id", [
            Q.between("total_goals", 0, 8)]),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("source_freshness")
def q_source_freshness(c: Context) -> DataFrame:
    """Q06: age of the newest load of each of the seven sources: pass / warn > 12 h / error > 24 h."""
    from . import declared as D
    raw = c.raw
    return D.freshness({"raw_matches": raw.matches, "raw_teams": raw.teams, "raw_team_roster": raw.roster(1),
                        "raw_fixtures": raw.fixtures, "raw_standings": raw.standings,
                        "raw_teams_football": raw.teams_football, "raw_odds": raw.odds}, FRESHNESS_NOW)


@query("dq_summary")
def q_dq_summary(c: Context) -> DataFrame:
    """Q01-Q05: the whole build, and every declared test on its written tables."""
    from .build import materialize_all
    root = scratch_dir(c.spark, "build")
    materialize_all(c.spark, c.sf_dir, root=root)
    return K.TableStore(c.spark, root).read("dq_summary").drop("run_ts")


@query("assert_goals_non_negative")
def q_assert_goals_non_negative(c: Context) -> DataFrame:
    """Q07: legacy match facts with negative goals (expected empty)."""
    m = M.match_facts_legacy(c.stg_matches, c.team_performance)
    return m.filter((F.col("home_goals") < 0) | (F.col("away_goals") < 0)).select(
        "match_id", "home_goals", "away_goals")


@query("assert_win_rate_0_1")
def q_assert_win_rate_0_1(c: Context) -> DataFrame:
    """Q08: season stats with a win rate outside [0, 1] (expected empty)."""
    s = M.season_stats(c.team_performance.drop("perspective"))
    return s.filter((F.col("win_rate") < 0) | (F.col("win_rate") > 1)).select("team_id", "win_rate")


@query("row_count_deviation")
def q_row_count_deviation(c: Context) -> DataFrame:
    """Q09: roster row count of the new load vs the previous one (20 % rule)."""
    return Q.row_count_deviation(c.raw.roster(2), c.raw.roster(1), "team_roster")


# --- sinks and materialisation ---------------------------------------------------------------


# The load boundaries that split each table into a first load
# and a later delivery (the union of both always covers the whole table).
FIRST_LOAD_BEFORE = "2000-01-01 00:00:00"
REDELIVERY_FROM = "1999-07-01 00:00:00"
SNAPSHOT_RUN_TS = "2024-03-01 00:00:00"
# Fixture ids per part of a stored table: ids grow with time, so a delivery touches the last parts.
ID_WIDTH = 1 << 16


@query("mat_view")
def q_mat_view(c: Context) -> DataFrame:
    """Staging model registered as a lazy view and read through it."""
    return K.as_view(c.stg_fixtures, "stg_fixtures")


@query("mat_ephemeral")
def q_mat_ephemeral(c: Context) -> DataFrame:
    """An inlined (ephemeral) intermediate model: no materialisation, its
    plan is inlined into the consumer (cached only when fan-out > 1)."""
    return K.ephemeral(I.head_to_head(c.stg_fixtures), fan_out=1)


@query("mat_table")
def q_mat_table(c: Context) -> DataFrame:
    """dim_league rebuilt as a new table version, pointer switched, then
    registered in the catalog with statistics (ANALYZE) and read through it."""
    store = K.TableStore(c.spark, scratch_dir(c.spark, "tables"))
    store.write(c.dim_league, "dim_league")
    return store.register("dim_league", analyze=True)


@query("incremental_merge")
def q_incremental_merge(c: Context) -> DataFrame:
    """First load, then a re-scored delivery merged past the watermark
    (30-day look-back) replacing rows by fixture_id."""
    p, store = c.raw.predictions, ManifestStore(c.spark)
    store.merge_incremental(p.filter(F.col("predicted_at") < F.lit(FIRST_LOAD_BEFORE)), "predictions",
                            ["fixture_id"], "predicted_at", width=ID_WIDTH)
    store.merge_incremental(p.withColumn("model_version", F.lit("v-next")), "predictions", ["fixture_id"],
                            "predicted_at", lookback="30 days")
    return store.read("predictions")


@query("sync_all_columns")
def q_sync_all_columns(c: Context) -> DataFrame:
    """Target gains the batch's new column and loses the removed one."""
    t = c.stg_teams_football
    batch = t.drop("logo_url").withColumn("team_code_lower", F.lower("team_code"))
    later = batch.filter(F.col("team_id") % 2 == 1)
    return K.sync_all_columns(t.filter(F.col("team_id") % 2 == 0), later).unionByName(later)


@query("scd2_snapshot")
def q_scd2_snapshot(c: Context) -> DataFrame:
    """Type-2 roster history after two loads (hard deletes closed)."""
    store = ManifestStore(c.spark)
    store.snapshot(c.raw.roster(1), "roster", "player_id", "updated_at", SNAPSHOT_RUN_TS)
    store.snapshot(c.raw.roster(2), "roster", "player_id", "updated_at", SNAPSHOT_RUN_TS)
    return store.read("roster")


@query("keyed_upsert")
def q_keyed_upsert(c: Context) -> DataFrame:
    """Fixtures re-delivered a week later replace the stored rows by key."""
    fx = c.raw.fixtures
    target = fx.filter(F.col("match_date") < F.lit(FIRST_LOAD_BEFORE))
    batch = fx.filter(F.col("match_date") >= F.lit(REDELIVERY_FROM)).withColumn(
        "loaded_at", F.col("loaded_at") + F.expr("INTERVAL 7 DAYS"))
    batch = K.dedupe_latest(batch, ["fixture_id"], [F.col("loaded_at").desc()])
    store = ManifestStore(c.spark)
    store.upsert(target, "fixtures", ["fixture_id"], width=ID_WIDTH)
    store.upsert(batch, "fixtures", ["fixture_id"])
    return store.read("fixtures")


@query("keyed_upsert_partial")
def q_keyed_upsert_partial(c: Context) -> DataFrame:
    """K07 (odds form): on conflict names, prices and load time change, the ids stay."""
    o = c.raw.odds
    target = o.filter(F.col("loaded_at") < F.lit(FIRST_LOAD_BEFORE))
    batch = (o.filter(F.col("loaded_at") >= F.lit(REDELIVERY_FROM))
             .withColumn("bookmaker_name", F.concat(F.col("bookmaker_name"), F.lit(" (new)")))
             .withColumn("odd_home", (F.col("odd_home") + F.lit(0.05)).cast("decimal(10,4)"))
             .withColumn("loaded_at", F.col("loaded_at") + F.expr("INTERVAL 1 DAY")))
    store = ManifestStore(c.spark)
    store.upsert(target, "odds", ["odds_id"])
    store.upsert(batch, "odds", ["odds_id"], update_cols=["bookmaker_name", "market_name", "odd_home", "odd_draw",
                                                          "odd_away", "loaded_at"])
    return store.read("odds")


@query("insert_if_absent")
def q_insert_if_absent(c: Context) -> DataFrame:
    """The second roster load adds only unseen players."""
    store = ManifestStore(c.spark)
    store.insert_if_absent(c.raw.roster(1), "roster", ["player_id"])
    store.insert_if_absent(c.raw.roster(2), "roster", ["player_id"])
    return store.read("roster")


# --- sources ---------------------------------------------------------------------------------


# Clocks used as parameters by the upcoming-fixture queries.
UPCOMING_NOW = "2001-06-01 00:00:00"


@query("scan_raw")
def q_scan_raw(c: Context) -> DataFrame:
    """Raw fixtures written once, then read back with the declared schema,
    a pushed-down filter and a pruned projection."""
    store = K.TableStore(c.spark, scratch_dir(c.spark, "tables"))
    path = store.write(c.raw.fixtures, "raw_fixtures")
    return SC.scan_raw(c.spark, path, "fixtures",
                       filters=[F.col("status").isin(*C.FINISHED_STATUSES)],
                       columns=["fixture_id", "league_id", "season", "match_date", "status",
                                "home_team_id", "away_team_id", "home_goals", "away_goals"])


@query("seed_competitions")
def q_seed_competitions(c: Context) -> DataFrame:
    """CSV seed (4 rows, broadcast) joined to legacy matches."""
    seed = SC.read_seed(c.spark)
    m = c.stg_matches.groupBy("competition_id").agg(F.count(F.lit(1)).alias("matches"))
    return m.join(F.broadcast(seed), "competition_id", "left").select(
        "competition_id", "competition_name", "country", "tier", "matches")


@query("load_features")
def q_load_features(c: Context) -> DataFrame:
    """Feature rows (all leagues and seasons; the optional league/season
    filters are covered by the tests), known target, null features dropped."""
    f = SC.load_features(c.fct_match_features)
    return f.select("fixture_id", "league_id", "season", "match_date", "match_result",
                    *SC.FEATURE_COLUMNS)


@query("upcoming_fixtures")
def q_upcoming_fixtures(c: Context) -> DataFrame:
    """Non-terminal fixtures within 7 days of a given clock (inclusive)."""
    u = SC.upcoming_fixtures(c.raw.fixtures, UPCOMING_NOW, days=7)
    return u.select("fixture_id", "match_date", "status", "home_team_id", "away_team_id")


@query("flatten_fixtures")
def q_flatten_fixtures(c: Context) -> DataFrame:
    """Fixture JSON documents -> flat raw fixture rows."""
    return PL.flatten_fixtures(PL.build_fixture_payloads(c.raw.fixtures))


@query("flatten_standings")
def q_flatten_standings(c: Context) -> DataFrame:
    """Standings documents (array of groups) -> one row per entry."""
    return PL.flatten_standings(PL.build_standings_payloads(c.raw.standings))


@query("flatten_teams")
def q_flatten_teams(c: Context) -> DataFrame:
    """Team documents per league -> one row per team (first league wins)."""
    return PL.flatten_teams(PL.build_team_payloads(c.raw.teams_football, c.raw.fixtures))


@query("flatten_odds")
def q_flatten_odds(c: Context) -> DataFrame:
    """bookmaker/bet documents -> 1X2 rows (market matched case-insensitively)."""
    return PL.flatten_odds(PL.build_odds_payloads(c.raw.odds))


@query("payload_rejects")
def q_payload_rejects(c: Context) -> DataFrame:
    """Documents that do not parse and prices that are no numbers, from payloads of which some are damaged."""
    fx, st, tm, od = PL.damaged_payloads(c.raw)
    from functools import reduce
    return reduce(DataFrame.unionByName, [PL.split(p, kind)[1] for p, kind in (
        (fx, "fixtures"), (st, "standings"), (tm, "teams"), (od, "odds"))])


@query("payload_rows")
def q_payload_rows(c: Context) -> DataFrame:
    """The rows that the same payloads give, counted by source and season (damaged documents are left out)."""
    fx, st, tm, od = (PL.split(p, k)[0] for p, k in zip(PL.damaged_payloads(c.raw), ("fixtures", "standings", "teams", "odds")))
    none = F.lit(None).cast("long").alias("season")
    parts = [fx.select(F.lit("fixtures").alias("kind"), "season"), st.select(F.lit("standings").alias("kind"), "season"),
             tm.select(F.lit("teams").alias("kind"), none), od.select(F.lit("odds").alias("kind"), none)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy("kind", "season").count()


@query("surrogate_int")
def q_surrogate_int(c: Context) -> DataFrame:
    """Deterministic integer ids for standings and odds in LONG."""
    s = c.raw.standings.select(F.lit("standing").alias("kind"),
                               PL.standing_id("league_id", "season", "rank").alias("id"),
                               F.col("team_id").alias("ref"))
    o = c.raw.odds.select(F.lit("odds").alias("kind"), PL.odds_id("fixture_id", "bookmaker_id").alias("id"),
                          F.col("fixture_id").alias("ref"))
    return s.unionByName(o)


@query("league_filter")
def q_league_filter(c: Context) -> DataFrame:
    """League names seen in the data resolved against the fixed mapping;
    unresolved names are reported with a null id."""
    requested = c.stg_fixtures.select("league_name").distinct().unionByName(
        c.spark.createDataFrame([("Premier League",), ("UEFA Champions League",)], "league_name string"))
    resolved, unknown = SC.league_filter(c.spark, requested)
    return resolved.unionByName(unknown.withColumn("api_league_id", F.lit(None).cast("long")))


# --- machine learning ------------------------------------------------------------------------


# Output precision of floating-point model outputs compared with
# the oracle (exp/log differ in the last bit between engines).
ML_DIGITS = 10
PREDICTED_AT = "2001-08-02 00:00:00"

# The match tables that the feature fact is derived from.
MODEL_INPUTS = ("nation", "customer", "supplier", "part", "orders", "lineitem")


def _inputs_digest(c: Context) -> str:
    """A digest of the input files' names, sizes and times (their content is not read)."""
    files = (c.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([f"{c.sf_dir}/{t}.parquet" for t in MODEL_INPUTS])
             .agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "length", F.col("modificationTime").cast("long")))).first())
    return f"{files[0]}-{files[1] & (2**64 - 1):016x}"


def _trained(c: Context) -> MT.TrainResult:
    """The model of this data, from its tables in the store; trained first where there is none yet."""
    store = K.TableStore(c.spark, f"{ensure_checkpoint_dir(c.spark)}/models/{_inputs_digest(c)}")
    found = MT.load_model(store)
    if found is None:
        MT.save_model(store, MT.train(c.fct_match_features))
        found = MT.load_model(store)
    return found


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({x: F.round(F.col(x), ML_DIGITS) for x in cols})


@query("feature_matrix")
def q_feature_matrix(c: Context) -> DataFrame:
    """The 16 model features with nulls dropped and the encoded target."""
    return MF.feature_matrix(c.fct_match_features)


@query("temporal_split")
def q_temporal_split(c: Context) -> DataFrame:
    """First 80 % of feature rows in (date, fixture) order are training rows."""
    fm = MF.feature_matrix(SC.load_features(c.fct_match_features))
    # the split only needs (date, id): cut the lineage on that narrow frame so
    # the feature plan runs once for the histogram passes and the result
    keys = fm.select("fixture_id", "match_date").checkpoint()
    return MF.temporal_split(keys)


@query("poisson_fallback")
def q_poisson_fallback(c: Context) -> DataFrame:
    """Closed-form attack/defence parameters per team."""
    p = MP.fit_fallback(c.stg_fixtures)
    t = p.teams.withColumns({"home_advantage": F.lit(p.home_advantage),
                             "intercept": F.lit(p.intercept)})
    return _round(t, ["attack", "defence", "home_advantage", "intercept"])


@query("expected_goals")
def q_expected_goals(c: Context) -> DataFrame:
    """Expected goals per finished fixture from the closed-form parameters."""
    p = MP.fit_fallback(c.stg_fixtures)
    f = c.stg_fixtures.select("fixture_id", "home_team_id", "away_team_id")
    return _round(MP.expected_goals(f, p), ["expected_home_goals", "expected_away_goals"])


@query("outcome_probs")
def q_outcome_probs(c: Context) -> DataFrame:
    """home/draw/away probabilities from the 7x7 Poisson score grid."""
    p = MP.fit_fallback(c.stg_fixtures)
    f = c.stg_fixtures.select("fixture_id", "home_team_id", "away_team_id")
    out = MP.outcome_probs(MP.expected_goals(f, p)).drop("expected_home_goals", "expected_away_goals")
    return _round(out, ["poisson_home_prob", "poisson_draw_prob", "poisson_away_prob"])


@query("hybrid_blend")
def q_hybrid_blend(c: Context) -> DataFrame:
    """0.3 * Poisson + 0.7 * booster, row-normalised, class by argmax."""
    p = c.raw.predictions.select("fixture_id", *[f"{m}_{s}_prob" for m in ("poisson", "gb")
                                                 for s in MH.SIDES])
    out = MH.decide(MH.blend(p))
    return out.select("fixture_id", "hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob",
                      "predicted_result", "confidence_score")


@query("booster_only_blend")
def q_booster_only_blend(c: Context) -> DataFrame:
    """M10 without a goal model: the booster's probabilities decide alone."""
    p = c.raw.predictions.select("fixture_id", *[f"gb_{s}_prob" for s in MH.SIDES])
    return MH.decide(MH.blend(p, poisson_prefix=None)).select(
        "fixture_id", "hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob", "predicted_result", "confidence_score")


@query("fct_predictions")
def q_fct_predictions(c: Context) -> DataFrame:
    """Prediction fact (SQL tie rule, three-valued correctness)."""
    return MH.fct_predictions(c.raw.predictions, c.stg_fixtures)


def _eval_rows(c: Context) -> DataFrame:
    return MM.evaluation_rows(MH.fct_predictions(c.raw.predictions, c.stg_fixtures))


@query("classification_metrics")
def q_classification_metrics(c: Context) -> DataFrame:
    """Accuracy, log loss, Brier score and counts of the stored predictions."""
    return MM.classification_metrics(_eval_rows(c))


@query("flat_bet_roi")
def q_flat_bet_roi(c: Context) -> DataFrame:
    """(correct - wrong) / n."""
    return MM.classification_metrics(_eval_rows(c)).select("n_matches", "n_correct", "n_wrong",
                                                           "flat_bet_roi")


@query("confusion_matrix")
def q_confusion_matrix(c: Context) -> DataFrame:
    """3x3 actual x predicted counts."""
    return MM.confusion_matrix(_eval_rows(c))


@query("champion_gate")
def q_champion_gate(c: Context) -> DataFrame:
    """Register the model when accuracy beats 0.50."""
    return MM.champion_gate(MM.classification_metrics(_eval_rows(c)), "stored-predictions")


@query("distinct_versions")
def q_distinct_versions(c: Context) -> DataFrame:
    """Distinct non-null model versions."""
    return MM.distinct_versions(c.raw.predictions)


@query("metrics_by_group")
def q_metrics_by_group(c: Context) -> DataFrame:
    """A10: per-league and overall metrics from one rollup."""
    return MM.metrics_by_group(_eval_rows(c))


@query("eval_report")
def q_eval_report(c: Context) -> DataFrame:
    """Evaluation report (overall + per league blocks, model versions,
    filters) written as a JSON table version and read back."""
    return MM.save_report(MM.eval_report(_eval_rows(c)), K.TableStore(c.spark, scratch_dir(c.spark, "tables")))


@query("conditional_count")
def q_conditional_count(c: Context) -> DataFrame:
    """Conditional sums per league and season."""
    r = F.col("match_result")
    return c.stg_fixtures.groupBy("league_id", "season").agg(
        F.sum(F.when(r == C.HOME_WIN, 1).otherwise(0)).cast("long").alias("home_wins"),
        F.sum(F.when(r == C.DRAW, 1).otherwise(0)).cast("long").alias("draws"),
        F.count_if(r == C.AWAY_WIN).cast("long").alias("away_wins"))


# --- R-checked ML queries (iterative / library models) ------------------------------------

@query("poisson_fit")
def q_poisson_fit(c: Context) -> DataFrame:
    """Maximum-likelihood attack/defence per team (+ globals as columns)."""
    p = MP.fit_mle(c.stg_fixtures)
    return p.teams.withColumns({"home_advantage": F.lit(p.home_advantage),
                                "intercept": F.lit(p.intercept), "method": F.lit(p.method)})


@query("poisson_balance")
def q_poisson_balance(c: Context) -> DataFrame:
    """Goals per team, observed and expected by the maximum-likelihood fit (equal at the optimum)."""
    return MP.goal_balance(c.stg_fixtures, MP.fit_mle(c.stg_fixtures))


@query("model_params_io")
def q_model_params_io(c: Context) -> DataFrame:
    """Fitted parameters written as a table version and read back."""
    p = MP.fit_fallback(c.stg_fixtures)
    store = K.TableStore(c.spark, scratch_dir(c.spark, "tables"))
    t = p.teams.withColumns({"home_advantage": F.lit(p.home_advantage),
                             "intercept": F.lit(p.intercept)})
    store.write(t, "poisson_params")
    return _round(store.read("poisson_params"), ["attack", "defence", "home_advantage", "intercept"])


@query("boosted_classifier")
def q_boosted_classifier(c: Context) -> DataFrame:
    """Test-set probabilities of the three-class boosted model and hybrid."""
    r = _trained(c)
    return r.test_scored.select("fixture_id", "gb_home_prob", "gb_draw_prob", "gb_away_prob",
                                "hybrid_home_prob", "hybrid_draw_prob", "hybrid_away_prob",
                                "predicted_result", "actual_result")


@query("isotonic_calibration")
def q_isotonic_calibration(c: Context) -> DataFrame:
    """Test-period booster probabilities before and after the per-class
    isotonic calibration (fitted on the last slice of the training period)."""
    r = _trained(c)
    test = r.test_scored.select("fixture_id", *r.booster.features, "label")
    before = MB.predict_booster(r.booster.raw(), test, prefix="raw").select(
        "fixture_id", "raw_home_prob", "raw_draw_prob", "raw_away_prob")
    after = r.test_scored.select("fixture_id", "gb_home_prob", "gb_draw_prob", "gb_away_prob")
    return before.join(after, "fixture_id")


@query("kfold_accuracy")
def q_kfold_accuracy(c: Context) -> DataFrame:
    """Stratified 5-fold (no shuffle) accuracy over the training rows, mean and population std."""
    fm = MF.feature_matrix(SC.load_features(c.fct_match_features))
    fm = MF.temporal_split(fm.checkpoint()).filter("is_train").drop("is_train")
    folded = MF.stratified_folds(fm).checkpoint()
    return MB.fold_accuracy(folded).agg(F.avg("accuracy").alias("cv_accuracy_mean"),
                                        F.stddev_pop("accuracy").alias("cv_accuracy_std"),
                                        F.count(F.lit(1)).alias("folds"))


@query("feature_importance")
def q_feature_importance(c: Context) -> DataFrame:
    """Share of the mean split gain of each feature over all trees."""
    return MB.feature_importance(_trained(c).booster, c.spark)


@query("feature_ranking")
def q_feature_ranking(c: Context) -> DataFrame:
    """Importances ranked descending."""
    imp = MB.feature_importance(_trained(c).booster, c.spark)
    from pyspark.sql import Window
    return imp.withColumn("rank", F.row_number().over(
        Window.orderBy(F.col("importance").desc(), F.col("feature"))))  # 16 rows


@query("upcoming_features")
def q_upcoming_features(c: Context) -> DataFrame:
    """Features of not-yet-played fixtures; each team's last form strictly before kick-off (as-of join)."""
    return MT.upcoming_features(c.raw.fixtures, c.team_form, c.stg_fixtures, c.stg_odds).select(
        "fixture_id", "league_id", "season", "match_date", "home_team_id", "away_team_id", *SC.FEATURE_COLUMNS)


@query("predict_batch")
def q_predict_batch(c: Context) -> DataFrame:
    """Predictions for every not-yet-played fixture, upserted by fixture."""
    r = _trained(c)
    feats = MT.upcoming_features(c.raw.fixtures, c.team_form, c.stg_fixtures, c.stg_odds)
    batch = MT.predict_batch(feats, r.poisson, r.booster, r.model_version, PREDICTED_AT)
    store = K.TableStore(c.spark, scratch_dir(c.spark, "tables"))
    store.upsert(batch, "predictions", ["fixture_id"])
    return store.read("predictions")


# --- remaining inventory keys --------------------------------------------------------------

@query("dropna_features")
def q_dropna_features(c: Context) -> DataFrame:
    """Feature rows with a null in any feature or the target removed."""
    f = SC.load_features(c.fct_match_features)
    return f.select("fixture_id", "league_id", "season", "match_result", *SC.FEATURE_COLUMNS)


@query("lag_rank")
def q_lag_rank(c: Context) -> DataFrame:
    """Previous rank and rank change per (team, league, season) snapshot."""
    return c.stg_standings.select("standing_id", "team_id", "league_id", "season", "updated_at",
                                  "rank", "prev_rank", "rank_change")


@query("order_by_date")
def q_order_by_date(c: Context) -> DataFrame:
    """Feature rows in chronological order (range-partitioned global sort)."""
    f = SC.load_features(c.fct_match_features, ordered=True)
    return f.select("fixture_id", "match_date", "league_id", "match_result")


@query("top_n_per_group")
def q_top_n_per_group(c: Context) -> DataFrame:
    """Top three of every current league table (points, goal difference)."""
    from ..operators.windows import top_n
    cur = M.latest_standings(c.stg_standings)
    return top_n(cur, ["league_id", "season", "updated_at"],
                 [F.col("points").desc(), F.col("goal_difference").desc(), F.col("team_id").asc()],
                 3, rank_col="position").select("league_id", "season", "team_id", "points",
                                                "goal_difference", "position")


@query("incremental_stream")
def q_incremental_stream(c: Context) -> DataFrame:
    """ST1: prediction files arriving in two deliveries merged by a streaming
    job (availableNow trigger, newest row of each key wins, keyed upsert)."""
    from pyspark.sql import types as T

    from ..streaming.incremental import run_incremental_stream
    base = scratch_dir(c.spark, "stream")
    src, ckpt = f"{base}/incoming", f"{base}/_checkpoint"
    p = c.raw.predictions
    p.filter(F.col("predicted_at") < F.lit(FIRST_LOAD_BEFORE)).write.parquet(f"{src}/part=1")
    p.filter(F.col("predicted_at") >= F.lit(FIRST_LOAD_BEFORE)).write.parquet(f"{src}/part=2")
    store = ManifestStore(c.spark, f"{base}/tables")
    schema = T.StructType(p.schema.fields + [T.StructField("part", T.IntegerType())])
    run_incremental_stream(c.spark, src, schema, store, "predictions",
                           ["fixture_id"], "predicted_at", ckpt)
    return store.read("predictions").drop("part")


@query("model_registry")
def q_model_registry(c: Context) -> DataFrame:
    """M17 (trained model): gate the hybrid's test accuracy against 0.50 and
    append accepted versions to the registry table (idempotent)."""
    r = _trained(c)
    hybrid = r.metrics.filter(F.col("model") == "hybrid")
    gate = MM.champion_gate(hybrid, r.model_version)
    store = K.TableStore(c.spark, scratch_dir(c.spark, "tables"))
    MM.register_champion(gate, store, PREDICTED_AT)
    return MM.register_champion(gate, store, PREDICTED_AT)  # second run adds no row
