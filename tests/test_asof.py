"""As-of join equals a brute-force search."""
import datetime as dt
import random

from matchmart.operators.asof import asof_join


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = [(rnd.randrange(4), base + dt.timedelta(hours=rnd.randrange(24 * 20)), i, float(i))
            for i in range(600)]
    probes = [(p, rnd.randrange(5), base + dt.timedelta(hours=rnd.randrange(24 * 22)))
              for p in range(300)]
    # some probes exactly at a data timestamp (must not match that row)
    probes += [(1000 + i, k, t) for i, (k, t, _, _) in enumerate(data[:20])]
    d = spark.createDataFrame(data, "k long, t timestamp_ntz, seq long, val double")
    p = spark.createDataFrame(probes, "pid long, k long, pt timestamp_ntz")
    out = asof_join(p, d, ["k"], "pt", "t", ["val"], probe_key=["pid"], tie_col="seq")
    got = {r.pid: r.val for r in out.collect()}
    assert len(got) == len(probes)
    for pid, k, pt in probes:
        cands = [(t, seq, v) for kk, t, seq, v in data if kk == k and t < pt]
        exp = max(cands)[2] if cands else None
        assert got[pid] == exp, (pid, k, pt)


def test_hot_key_is_cut_into_ranges(spark):
    """One key and one midnight hold most rows: the ranges of that day answer like a search, over many tasks."""
    from pyspark.sql import functions as F
    rnd = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    times = [base] * 6 + [base + dt.timedelta(days=d, minutes=m) for d in range(3) for m in (0, 5, 700)]
    data = [(0 if rnd.random() < 0.8 else 1, rnd.choice(times), i, float(i)) for i in range(500)]
    probes = [(f"p{i:04d}", 0 if rnd.random() < 0.8 else 1, rnd.choice(times)) for i in range(1500)]
    d = spark.createDataFrame(data, "k long, t timestamp_ntz, seq long, val double")
    p = spark.createDataFrame(probes, "pid string, k long, pt timestamp_ntz")
    out = asof_join(p, d, ["k"], "pt", "t", ["val"], probe_key=["pid"], tie_col="seq", hot_key_rows=50)
    got = {r.pid: r.val for r in out.collect()}
    assert len(got) == len(probes)
    for pid, k, pt in probes:
        cands = [(t, seq, v) for kk, t, seq, v in data if kk == k and t < pt]
        assert got[pid] == (max(cands)[2] if cands else None), (pid, k, pt)
    from matchmart.operators.windows import with_ranges
    both = p.select("k", F.col("pt").alias("t"), "pid").withColumn("day", F.to_date("t"))
    sizes = [r["count"] for r in with_ranges(both, ["k"], ["t", "pid"], "day", 50, "r").groupBy("k", "day", "r").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) < 150
