"""Measured lookups: broadcast, plain and salted joins give the same rows; no fact shuffle on few keys."""
import pytest
from pyspark.sql import functions as F

from matchmart.operators.joins import SALTS, Lookup


@pytest.fixture(scope="module")
def fact(spark):
    rows = [(i, 0 if i % 3 == 0 else i % 11, None if i % 17 == 0 else f"v{i % 4}") for i in range(3000)]
    return spark.createDataFrame(rows, "fixture_id long, team long, venue string").cache()


@pytest.fixture(scope="module")
def table(spark):
    rows = [(t, f"v{v}", t * 10.0 + v, f"name {t}") for t in range(9) for v in range(3)]
    return spark.createDataFrame(rows, "team_id long, venue_name string, x double, name string")


@pytest.mark.parametrize("limit,hot", [(1 << 20, None), (0, None), (0, 200)])
def test_all_ways_equal_a_left_join(spark, fact, table, limit, hot):
    keys = {"team": "team_id", "venue": "venue_name"}
    got = Lookup(table).join(fact, keys, {"x": "x", "n": "name"}, "fixture_id", limit=limit, hot_key_rows=hot)
    assert got.columns == ["fixture_id", "team", "venue", "x", "n"]
    want = {(t, v): (x, n) for t, v, x, n in map(tuple, table.collect())}
    rows = got.collect()
    assert len(rows) == 3000
    assert all((r.x, r.n) == want.get((r.team, r.venue), (None, None)) for r in rows)


def test_measure(spark, table):
    one = Lookup(table)
    assert one.rows == 27 and 27 * 40 < one.bytes < 27 * 80


def test_hot_key_is_dealt(spark, fact, table):
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        small = table.where("venue_name = 'v0'")
        out = Lookup(small).join(fact, {"team": "team_id"}, {"x": "x"}, "fixture_id", limit=0, hot_key_rows=500)
        counts = [r["count"] for r in out.where("team = 0 and x is not null").withColumn("p", F.spark_partition_id())
                  .groupBy("p").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert SALTS > 8 and sum(counts) > 1000 and len(counts) == 8 and max(counts) < 0.3 * sum(counts)


@pytest.mark.parametrize("key", ["match_features", "fct_match_features", "join_normalized_pair", "expected_goals"])
def test_no_fact_shuffle_on_league_team_or_pair(spark, key):
    from matchmart.plans.queries import registry
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry()[key](spark, "/root/testdata/sf0.001")
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    for line in dealt:
        keys = line.split("hashpartitioning(")[1].split("#")[0]
        assert keys in ("fixture_id", "team_id"), line  # team_id: the form window by (team, league, season)
