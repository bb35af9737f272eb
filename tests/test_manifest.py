"""Manifest tables: touched parts only, commits between writers, refused batches, history, replays."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from matchmart.operators import sinks as K
from matchmart.operators.manifest import ManifestStore
from matchmart.sources.adapters import Raw

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)


def kv(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, ts timestamp_ntz")


def rows(store, name="t"):
    return sorted(map(tuple, store.read(name).collect()), key=str)


def test_untouched_parts_keep_their_files(spark):
    store = ManifestStore(spark)
    first = store.upsert(kv(spark, [(i, "a", DAY) for i in range(100)]), "t", ["k"], width=10)
    second = store.upsert(kv(spark, [(97, "b", DAY), (104, "c", DAY)]), "t", ["k"])
    assert set(first["parts"]) == {str(i) for i in range(10)} and set(second["parts"]) == {str(i) for i in range(11)}
    assert [p for p in first["parts"] if first["parts"][p] != second["parts"][p]] == ["9"]
    got = {r[0]: r[1] for r in rows(store)}
    assert got == {**{i: "a" for i in range(100)}, 97: "b", 104: "c"}
    # the earlier manifest still reads the earlier table
    assert store._load(store.manifest("t", 1)).count() == 100


def test_hash_parts_equal_the_plain_upsert(spark):
    store = ManifestStore(spark, buckets=7)
    old = spark.createDataFrame([(i, str(j), float(i)) for i in range(12) for j in range(3)], "a long, b string, x double")
    new = spark.createDataFrame([(i, "1", -1.0) for i in range(8, 15)], "a long, b string, x double")
    store.upsert(old, "t", ["a", "b"])
    store.upsert(new, "t", ["a", "b"])
    assert rows(store) == sorted(map(tuple, K.keyed_upsert(old, new, ["a", "b"]).collect()), key=str)
    partial = spark.createDataFrame([(1, "1", 5.0), (99, "9", 9.0)], "a long, b string, x double")
    before = store.read("t")
    expected = sorted(map(tuple, K.keyed_upsert(before, partial, ["a", "b"], ["x"]).collect()), key=str)
    store.upsert(partial, "t", ["a", "b"], update_cols=["x"])
    assert rows(store) == expected


def test_bad_batches_are_refused(spark):
    store = ManifestStore(spark)
    for write in (store.upsert, store.insert_if_absent):
        with pytest.raises(ValueError, match="several rows of one key"):
            write(kv(spark, [(1, "a", DAY), (1, "b", DAY)]), "t", ["k"])
        with pytest.raises(Exception, match="null in key column k"):
            write(kv(spark, [(None, "a", DAY)]), "t", ["k"])
    assert store.read("t") is None


def test_insert_adds_folders_only(spark):
    store = ManifestStore(spark, buckets=4)
    first = store.insert_if_absent(kv(spark, [(i, "a", DAY) for i in range(20)]), "t", ["k"])
    second = store.insert_if_absent(kv(spark, [(i, "b", DAY) for i in range(15, 25)]), "t", ["k"])
    assert all(second["parts"][p]["files"][0] == e["files"][0] for p, e in first["parts"].items())
    assert sum(e["rows"] for e in second["parts"].values()) == 25
    assert {r[0]: r[1] for r in rows(store)} == {i: "a" if i < 20 else "b" for i in range(25)}
    assert store.insert_if_absent(kv(spark, [(3, "c", DAY)]), "t", ["k"])["number"] == second["number"]


def test_columns_follow_the_batch(spark):
    store = ManifestStore(spark, buckets=3)
    store.upsert(spark.createDataFrame([(i, "x", "y") for i in range(9)], "k long, gone string, kept string"), "t", ["k"])
    store.upsert(spark.createDataFrame([(1, "z", 2.5)], "k long, kept string, added double"), "t", ["k"])
    t = store.read("t")
    assert t.columns == ["k", "kept", "added"]
    assert {r.k: (r.kept, r.added) for r in t.collect()} == {**{i: ("y", None) for i in range(9)}, 1: ("z", 2.5)}
    store.upsert(spark.createDataFrame([(2, 7, 2.5)], "k long, kept long, added double"), "t2", ["k"])
    store.upsert(spark.createDataFrame([(3, "w", 1.0)], "k long, kept string, added double"), "t2", ["k"])
    assert sorted((r.k, r.kept) for r in store.read("t2").collect()) == [(2, "7"), (3, "w")]


def test_concurrent_writers_lose_no_row(spark):
    store = ManifestStore(spark, buckets=5)
    store.upsert(kv(spark, [(0, "start", DAY)]), "t", ["k"])
    failures = []

    def deliver(w):
        try:
            own = ManifestStore(spark, store.root, buckets=5)
            for j in range(3):
                own.upsert(kv(spark, [(100 * w + 10 * j + i, f"{w}", DAY) for i in range(4)] + [(7, f"{w}.{j}", DAY)]), "t", ["k"])
        except Exception as e:  # noqa: BLE001
            failures.append(e)

    threads = [threading.Thread(target=deliver, args=(w,)) for w in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failures
    got = rows(store)
    assert {r[0] for r in got} == {0, 7} | {100 * w + 10 * j + i for w in range(1, 5) for j in range(3) for i in range(4)}
    assert len(got) == 2 + 48 and store.manifest("t")["number"] == 13


def test_a_taken_number_is_not_overwritten(spark):
    store = ManifestStore(spark)
    m = store.upsert(kv(spark, [(1, "a", DAY)]), "t", ["k"])
    assert not store._commit("t", {**m, "parts": {}})
    assert store.manifest("t") == m


def test_incremental_reads_the_watermark_from_the_manifest(spark):
    src = kv(spark, [(i, str(i), DAY + dt.timedelta(days=i)) for i in range(40)])
    store = ManifestStore(spark)
    first = store.merge_incremental(src.where("k < 25"), "t", ["k"], "ts", width=10)
    assert store.watermark("t", "ts") == DAY + dt.timedelta(days=24)
    second = store.merge_incremental(src.withColumn("v", F.lit("new")), "t", ["k"], "ts", lookback="2 days")
    assert first["parts"]["0"] == second["parts"]["0"] and first["parts"]["1"] == second["parts"]["1"]
    assert {r[0]: r[1] for r in rows(store)} == {i: str(i) if i < 23 else "new" for i in range(40)}
    third = store.merge_incremental(src, "t", ["k"], "ts")
    assert third["parts"] == second["parts"]


def test_history_equals_the_plain_snapshot_and_touches_changes_only(spark):
    raw, store = Raw(spark, SF), ManifestStore(spark, buckets=16)
    run = "2024-03-01 00:00:00"
    one = K.scd2_snapshot(None, raw.roster(1), "player_id", "updated_at", run)
    two = K.scd2_snapshot(one, raw.roster(2), "player_id", "updated_at", run)
    store.snapshot(raw.roster(1), "h", "player_id", "updated_at", run)
    second = store.snapshot(raw.roster(2), "h", "player_id", "updated_at", run)
    assert rows(store, "h") == sorted(map(tuple, two.select(*store.read("h").columns).collect()), key=str)
    assert store.snapshot(raw.roster(2), "h", "player_id", "updated_at", run)["number"] == second["number"]
    key = raw.roster(2).first()["player_id"]
    third = store.snapshot(raw.roster(2).where(F.col("player_id") != F.lit(key)), "h", "player_id", "updated_at", run)
    changed = {p for p in third["parts"] if third["parts"][p] != second["parts"].get(p)}
    assert len(changed) == 2 and len({int(p) // 2 for p in changed}) == 1
    closed = next(p for p in changed if int(p) % 2)
    assert third["parts"][closed]["files"][:-1] == second["parts"].get(closed, {"files": []})["files"]


def test_replayed_epoch_is_skipped(spark):
    store = ManifestStore(spark)
    store.upsert(kv(spark, [(1, "a", DAY)]), "t", ["k"], epoch=("s", 4))
    store.upsert(kv(spark, [(1, "again", DAY)]), "t", ["k"], epoch=("s", 4))
    store.upsert(kv(spark, [(2, "b", DAY)]), "t", ["k"], epoch=("s", 5))
    assert [(r[0], r[1]) for r in rows(store)] == [(1, "a"), (2, "b")]


def test_newer_rows_stay(spark):
    store = ManifestStore(spark)
    store.upsert(kv(spark, [(1, "late", DAY + dt.timedelta(days=5)), (2, "x", DAY)]), "t", ["k"])
    store.upsert(kv(spark, [(1, "old", DAY), (2, "y", DAY)]), "t", ["k"], newer="ts")
    assert {r[0]: r[1] for r in rows(store)} == {1: "late", 2: "y"}
