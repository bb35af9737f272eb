"""Keyed writes, incremental loads, SCD2 and the versioned store."""
import datetime as dt

import pytest

from pyspark.sql import functions as F

from matchmart.operators import sinks as K
from matchmart.operators.manifest import ManifestStore
from matchmart.sources.adapters import Raw

SF = "/root/testdata/sf0.01"


def _kv(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, ts timestamp_ntz")


def test_upsert_batch_wins_and_is_idempotent(spark):
    t = _kv(spark, [(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 1, 1))])
    b = _kv(spark, [(2, "B", dt.datetime(2024, 1, 2)), (3, "C", dt.datetime(2024, 1, 2))])
    once = K.keyed_upsert(t, b, ["k"])
    twice = K.keyed_upsert(once, b, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.v for r in once.collect()} == {1: "a", 2: "B", 3: "C"}


def test_partial_upsert_keeps_other_columns(spark):
    t = spark.createDataFrame([(1, "keep", 1.0)], "k long, name string, price double")
    b = spark.createDataFrame([(1, "new", 2.0), (2, "n2", 3.0)], "k long, name string, price double")
    out = {r.k: r for r in K.keyed_upsert(t, b, ["k"], update_cols=["price"]).collect()}
    assert (out[1].name, out[1].price) == ("keep", 2.0)
    assert (out[2].name, out[2].price) == ("n2", 3.0)


def test_insert_if_absent(spark):
    t = _kv(spark, [(1, "a", dt.datetime(2024, 1, 1))])
    b = _kv(spark, [(1, "x", dt.datetime(2024, 1, 2)), (2, "y", dt.datetime(2024, 1, 2))])
    out = {r.k: r.v for r in K.insert_if_absent(t, b, ["k"]).collect()}
    assert out == {1: "a", 2: "y"}


def test_incremental_twice_equals_once(spark):
    src = _kv(spark, [(i, str(i), dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(10)])
    first = K.incremental_merge(src.filter("k < 5"), None, ["k"], "ts")
    once = K.incremental_merge(src, first, ["k"], "ts")
    twice = K.incremental_merge(src, once, ["k"], "ts")
    assert sorted(once.collect()) == sorted(twice.collect()) == sorted(src.collect())


def test_incremental_empty_target_loads_everything(spark):
    src = _kv(spark, [(1, "a", dt.datetime(2024, 1, 1))])
    empty = src.limit(0)
    assert K.incremental_merge(src, empty, ["k"], "ts").count() == 1


def test_scd2_change_set_and_invariants(spark):
    raw = Raw(spark, SF)
    s1 = K.scd2_snapshot(None, raw.roster(1), "player_id", "updated_at", "2024-03-01 00:00:00")
    s2 = K.scd2_snapshot(s1, raw.roster(2), "player_id", "updated_at", "2024-03-01 00:00:00").cache()
    closed = s2.filter(F.col("dbt_valid_to").isNotNull())
    keys = [r.c_custkey for r in spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey").collect()]
    one, two = {c for c in keys if c % 26 != 25}, {c for c in keys if c % 25 != 7}
    changed = {c for c in one & two if c % 10 == 0}
    assert closed.count() == len(changed) + len(one - two)
    assert s2.count() == len(one) + len(changed) + len(two - one)
    # at most one open row per key; deleted keys have none
    open_rows = s2.filter(F.col("dbt_valid_to").isNull()).groupBy("player_id").count()
    assert open_rows.filter("count > 1").count() == 0
    assert open_rows.count() == raw.roster(2).count()
    # replay with an unchanged source is a no-op
    s3 = K.scd2_snapshot(s2, raw.roster(2), "player_id", "updated_at", "2024-04-01 00:00:00")
    assert sorted(map(tuple, s3.collect())) == sorted(map(tuple, s2.collect()))


def test_table_store_versions_and_pointer(spark):
    store = K.TableStore(spark)
    name = f"t_{dt.datetime.now().strftime('%H%M%S%f')}"
    df1 = spark.range(5).withColumnRenamed("id", "k")
    p1 = store.write(df1, name)
    assert store.current(name) == p1 and store.read(name).count() == 5
    p2 = store.upsert(spark.range(3, 8).withColumnRenamed("id", "k"), name, ["k"])
    assert p2 != p1 and store.read(name).count() == 8
    # the previous version is untouched
    assert spark.read.parquet(p1).count() == 5


def test_sync_all_columns(spark):
    t = spark.createDataFrame([(1, "a", "x")], "k long, old string, keep string")
    b = spark.createDataFrame([(2, "y", 1.5)], "k long, keep string, new double")
    out = K.sync_all_columns(t, b)
    assert out.columns == ["k", "keep", "new"]
    assert {r.k: r.new for r in out.collect()} == {1: None}


def test_materialize_all_writes_every_model(spark):
    from matchmart.plans.build import materialize_all
    store_root = K.TableStore(spark).root + f"/build-{dt.datetime.now().strftime('%H%M%S%f')}"
    paths = materialize_all(spark, "/root/testdata/sf0.001", root=store_root)
    assert {"stg_fixtures", "int_team_form", "fct_match_features", "dq_failures"} <= set(paths)
    fct = spark.read.parquet(paths["fct_match_features"])
    stg = spark.read.parquet(paths["stg_fixtures"])
    assert fct.count() == stg.count() > 0
    assert spark.read.parquet(paths["dq_failures"]).count() == 0


def test_partitioned_table_prunes_by_season(spark):
    from matchmart.plans.build import materialize_all
    root = K.TableStore(spark).root + f"/build-p-{dt.datetime.now().strftime('%H%M%S%f')}"
    paths = materialize_all(spark, "/root/testdata/sf0.001", root=root)
    fct = spark.read.parquet(paths["fct_match_features"]).filter(F.col("season") == 1997)
    plan = fct._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "(season" in plan
    assert fct.count() > 0


def test_register_computes_statistics(spark):
    store = K.TableStore(spark)
    name = f"stats_{dt.datetime.now().strftime('%H%M%S%f')}"
    store.write(spark.range(123).withColumnRenamed("id", "k"), name)
    t = store.register(name)
    assert t.count() == 123
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {store.table_name(name)}").collect()}
    assert "123 rows" in desc.get("Statistics", "")


def test_partial_upsert_keeps_a_stored_null(spark):
    t = spark.createDataFrame([(1, None, 1.0)], "k long, name string, price double")
    b = spark.createDataFrame([(1, "new", 2.0)], "k long, name string, price double")
    out = K.keyed_upsert(t, b, ["k"], update_cols=["price"]).first()
    assert (out.name, out.price) == (None, 2.0)


def test_null_keys_fail_the_write(spark):
    t = spark.createDataFrame([(1, "a")], "k long, v string")
    b = spark.createDataFrame([(None, "b"), (2, "c")], "k long, v string")
    for write in (lambda: K.keyed_upsert(t, b, ["k"]), lambda: K.keyed_upsert(t, b, ["k"], update_cols=["v"]),
                  lambda: K.insert_if_absent(t, b, ["k"])):
        with pytest.raises(Exception, match="null in key column k"):
            write().collect()


def test_pointer_is_overwritten_not_removed(spark):
    store = K.TableStore(spark)
    name = f"ptr_{dt.datetime.now().strftime('%H%M%S%f')}"
    store.write(spark.range(5).withColumnRenamed("id", "k"), name)
    before = store.current(name)
    with pytest.raises(RuntimeError, match="another job"):
        store.write(spark.range(1).withColumnRenamed("id", "k"), name, based_on=f"{before}-older")
    assert store.current(name) == before and store.read(name).count() == 5
    store.merge_incremental(spark.range(3, 9).withColumnRenamed("id", "k"), name, ["k"], "k")
    assert sorted(r.k for r in store.read(name).collect()) == list(range(9))


def test_snapshot_in_the_store(spark):
    raw = Raw(spark, SF)
    store = K.TableStore(spark)
    name = f"snap_{dt.datetime.now().strftime('%H%M%S%f')}"
    store.snapshot(raw.roster(1), name, "player_id", "updated_at", "2024-03-01 00:00:00")
    store.snapshot(raw.roster(2), name, "player_id", "updated_at", "2024-03-01 00:00:00")
    again = sorted(map(tuple, store.read(name).collect()), key=str)
    store.snapshot(raw.roster(2), name, "player_id", "updated_at", "2024-04-01 00:00:00")
    assert sorted(map(tuple, store.read(name).collect()), key=str) == again


def test_stream_keeps_late_rows_and_corrections(spark):
    from pyspark.sql import types as T

    from matchmart.session import scratch_dir
    from matchmart.streaming.incremental import run_incremental_stream
    base = scratch_dir(spark, "late-stream")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()),
                           T.StructField("ts", T.TimestampNTZType())])
    store = ManifestStore(spark, f"{base}/tables")
    day = dt.datetime(2024, 1, 10)
    deliveries = [
        [(1, "first", day), (2, "only", day)],
        [(1, "corrected", day + dt.timedelta(hours=6)), (3, "late", day - dt.timedelta(days=5))],
        [(1, "older", day - dt.timedelta(hours=1))],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/incoming")
        run_incremental_stream(spark, f"{base}/incoming", schema, store, "t", ["k"], "ts", f"{base}/checkpoint")
    assert {r.k: r.v for r in store.read("t").collect()} == {1: "corrected", 2: "only", 3: "late"}
