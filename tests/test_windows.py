"""The chunked (skew-safe) window strategy equals the plain Window strategy."""
import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchmart.operators.windows import lag_by, rolling_avg, top_n

SCHEMA = "k long, ts timestamp_ntz, id long, v long"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(seed, n_keys, n_rows, hot_share, n_days):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n_rows):
        k = 0 if rnd.random() < hot_share else rnd.randrange(1, n_keys + 1)
        day = rnd.randrange(n_days)
        rows.append((k, base + dt.timedelta(days=day, hours=rnd.randrange(3)), i,
                     rnd.choice([None, rnd.randrange(10)])))
    return rows


def _compare(spark, rows, n, include_current):
    df = _frame(spark, rows)
    specs = {"a": ("v", n), "b": ("v", max(1, n // 2))}
    w = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="window", include_current=include_current)
    c = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="chunked", include_current=include_current)
    key = ["k", "id"]
    pw = w.orderBy(*key).toPandas()
    pc = c.orderBy(*key).toPandas()
    assert len(pw) == len(pc) == len(rows)
    for col in ("a", "b"):
        x, y = pw[col].fillna(-1.0).round(12).tolist(), pc[col].fillna(-1.0).round(12).tolist()
        assert x == y, col


def test_chunked_equals_window_hot_key(spark):
    # one key holds ~60 % of rows, many rows per day, sparse days elsewhere
    _compare(spark, _rows(1, 20, 3000, 0.6, 40), 10, True)


def test_chunked_equals_window_sparse_days(spark):
    # days with one row each: the halo must reach back over several chunks
    _compare(spark, _rows(2, 3, 400, 0.3, 380), 10, True)


def test_chunked_leak_free_frame(spark):
    _compare(spark, _rows(3, 5, 800, 0.5, 60), 5, False)


@settings(max_examples=3, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 12), days=st.integers(1, 30))
def test_chunked_property(spark, seed, n, days):
    _compare(spark, _rows(seed, 4, 200, 0.5, days), n, True)


def test_lag_chunked_equals_window(spark):
    df = _frame(spark, _rows(4, 6, 1500, 0.5, 25))
    a = lag_by(df, {"p": "v"}, ["k"], ["ts", "id"], strategy="window").orderBy("k", "id").toPandas()
    b = lag_by(df, {"p": "v"}, ["k"], ["ts", "id"], strategy="chunked").orderBy("k", "id").toPandas()
    assert a["p"].fillna(-1).tolist() == b["p"].fillna(-1).tolist()


def test_top_n_keeps_first_n(spark):
    df = _frame(spark, _rows(5, 3, 300, 0.5, 30))
    out = top_n(df, ["k"], [F.col("ts").desc(), F.col("id").desc()], 5, rank_col="r").toPandas()
    pdf = df.toPandas().sort_values(["k", "ts", "id"], ascending=[True, False, False])
    exp = pdf.groupby("k").head(5)
    assert sorted(out["id"]) == sorted(exp["id"])
    assert out.groupby("k")["r"].max().max() <= 5


def test_auto_strategy_splits_hot_keys(spark):
    rows = _rows(6, 10, 2000, 0.6, 50)
    df = _frame(spark, rows)
    specs = {"a": ("v", 10)}
    w = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="window").orderBy("k", "id").toPandas()
    a = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="auto", hot_key_rows=500) \
        .orderBy("k", "id").toPandas()
    assert w["a"].fillna(-1).round(12).tolist() == a["a"].fillna(-1).round(12).tolist()


def test_auto_refines_chunks_for_huge_days(spark):
    # 3 days only, so each day of the hot key exceeds the (tiny) threshold and
    # the chunks are refined to (day, id bucket)
    rows = _rows(8, 5, 1500, 0.7, 3)
    df = _frame(spark, rows)
    specs = {"a": ("v", 10), "b": ("v", 3)}
    w = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="window").orderBy("k", "id").toPandas()
    a = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="auto", hot_key_rows=100) \
        .orderBy("k", "id").toPandas()
    for col in ("a", "b"):
        assert w[col].fillna(-1).round(12).tolist() == a[col].fillna(-1).round(12).tolist()
    lw = lag_by(df, {"p": "v"}, ["k"], ["ts", "id"], strategy="window").orderBy("k", "id").toPandas()
    la = lag_by(df, {"p": "v"}, ["k"], ["ts", "id"], strategy="auto", hot_key_rows=100) \
        .orderBy("k", "id").toPandas()
    assert lw["p"].fillna(-1).tolist() == la["p"].fillna(-1).tolist()


def test_auto_refines_date_only_with_id_buckets(spark):
    rows = [(k, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), i, v)
            for (k, _, i, v), d in zip(_rows(9, 4, 1200, 0.7, 2), [i % 2 for i in range(1200)])]
    df = _frame(spark, rows)
    specs = {"a": ("v", 10)}
    w = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="window").orderBy("k", "id").toPandas()
    a = rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="auto", hot_key_rows=50) \
        .orderBy("k", "id").toPandas()
    assert w["a"].fillna(-1).round(12).tolist() == a["a"].fillna(-1).round(12).tolist()


def test_chunked_spreads_a_hot_key_over_tasks(spark):
    """The plain window puts a hot key into one task; the chunked window
    spreads it over the shuffle partitions (one chunk per day)."""
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep 8 visible partitions
    try:
        rows = _rows(11, 10, 4000, 0.8, 60)
        df = _frame(spark, rows)
        specs = {"a": ("v", 5)}

        def share_of_busiest(out):
            # tag first: a filter is not pushed below a nondeterministic projection
            hot = out.withColumn("p", F.spark_partition_id()).filter(F.col("k") == 0)
            # aggregate the window column too, else pruning removes the window
            counts = [r["n"] for r in hot.groupBy("p").agg(F.count("a").alias("n"),
                                                           F.sum("a").alias("s")).collect()]
            return max(counts) / sum(counts), len(counts)

        plain_share, plain_parts = share_of_busiest(
            rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="window"))
        chunk_share, chunk_parts = share_of_busiest(
            rolling_avg(df, specs, ["k"], ["ts", "id"], strategy="chunked"))
        assert plain_parts == 1 and plain_share == 1.0
        assert chunk_parts >= 6 and chunk_share < 0.35
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_hot_day_with_string_ids_spreads_over_ranges(spark):
    """All rows of the hot key stand at one midnight and have text ids: ranges of the id, equal to the plain window."""
    from matchmart.operators.windows import with_ranges
    rnd = random.Random(12)
    day = dt.datetime(2024, 1, 1)
    rows = [("hot" if rnd.random() < 0.7 else f"k{rnd.randrange(5)}", day + dt.timedelta(days=rnd.choice([0, 0, 0, 1])),
             f"m{rnd.random():.9f}", rnd.choice([None, rnd.randrange(10)])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id string, v long")
    specs = {"a": ("v", 7), "b": ("v", 2)}
    w, a = (rolling_avg(df, specs, ["k"], ["ts", "id"], **o).orderBy("k", "id").toPandas()
            for o in ({"strategy": "window"}, {"hot_key_rows": 100}))
    for c in ("a", "b"):
        assert w[c].fillna(-1).round(12).tolist() == a[c].fillna(-1).round(12).tolist()
    ranged = with_ranges(df.where("k = 'hot'").withColumn("d", F.to_date("ts")), ["k"], ["ts", "id"], "d", 100, "r")
    sizes = [r["count"] for r in ranged.groupBy("d", "r").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 300
