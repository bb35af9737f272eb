"""Results do not depend on the session time zone (DST gaps included)."""
from pyspark.sql import functions as F

from matchmart.operators import quality as Q
from matchmart.sources import payloads as PL
from matchmart.sources.adapters import Raw


def test_payload_roundtrip_and_freshness_under_dst_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        raw = Raw(spark, "/root/testdata/sf0.01").fixtures
        flat = PL.flatten_fixtures(PL.build_fixture_payloads(raw))
        diff = flat.select("fixture_id", "match_date").exceptAll(raw.select("fixture_id", "match_date"))
        assert diff.count() == 0
        df = spark.createDataFrame([("1995-10-14 20:00:00",)], "t string").select(
            F.col("t").cast("timestamp_ntz").alias("loaded_at"))
        # the wall-clock interval spans the 1995-10-15 DST switch: still 13 hours
        r = Q.source_freshness(df, "s", "loaded_at", "1995-10-15 09:00:00").first()
        assert r.age_hours == 13.0 and r.status == "warn"
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
