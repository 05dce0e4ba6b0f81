"""Joins with keys that hold a large share of the rows."""

from collections import Counter

from pyspark.sql import functions as F

from funnelforge.operators import joins


def sizes(df, *on):
    """Rows by reducer of a shuffle on these columns."""
    parts = df.repartition(32, *on).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    return sorted(r["count"] for r in parts)


def rows(spark):
    return spark.range(30_000).selectExpr(
        "concat('e', id) AS event_id",
        "CASE WHEN id % 3 = 0 THEN 'kiosk' WHEN id % 3 = 1 THEN concat('d', id % 500) END AS device")


def test_hot_keys_are_measured(spark):
    hot = joins.hot_keys(rows(spark), F.col("device"))
    assert set(hot) == {"kiosk"} and 50 < hot["kiosk"] <= joins.MOST_SALTS
    assert joins.hot_keys(rows(spark).limit(0), F.col("device")) == {}
    assert joins.hot_keys(rows(spark).withColumn("device", F.lit(None).cast("string")), F.col("device")) == {}


def test_salted_join_is_the_plain_join_over_even_tasks(spark):
    left = rows(spark)
    right = spark.range(400).selectExpr("concat('d', id) AS device", "concat('u', id) AS user").unionByName(
        spark.createDataFrame([("kiosk", "u_kiosk"), (None, "nobody")], "device string, user string"))
    hot = joins.hot_keys(left, F.col("device"))
    got = joins.left_join_spread_nulls(left, F.col("device"), F.col("event_id"), right, "device", hot)
    want = left.join(right, "device", "left")
    assert got.select("event_id", "device", "user").exceptAll(want.select("event_id", "device", "user")).isEmpty()
    assert got.count() == want.count() == left.count()
    # what the exchange of the left side deals out
    size, skew = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        def largest(hot):
            df = joins.left_join_spread_nulls(left, F.col("device"), F.col("event_id"), right, "device", hot)
            n = Counter(r[0] for r in df.select(F.spark_partition_id()).collect())
            return max(n.values()) / sorted(n.values())[len(n) // 2]

        assert largest(None) > 4
        assert largest(hot) < 3
    finally:
        for k, v in (("spark.sql.autoBroadcastJoinThreshold", size), ("spark.sql.adaptive.skewJoin.enabled", skew),
                     ("spark.sql.adaptive.coalescePartitions.enabled", coalesce), ("spark.sql.shuffle.partitions", shuffles)):
            spark.conf.set(k, v)


def test_records_keep_the_order_of_each_key(spark, raw_events):
    from event_docs import doc

    from funnelforge.sources import sinks
    docs = [doc(event_id="evt_" + f"{i:032x}", ts=f"2025-01-{1 + i * 7 % 28:02d}T00:00:00Z", user="usr_" + f"{i % 3:012x}") for i in range(60)]
    docs += [doc(event_id="evt_" + f"{i:032x}", user=None, anon=None) for i in range(100, 140)] + ["{", docs[0]]
    got = sinks.ordered_records(raw_events(docs), 4).withColumn("position", F.monotonically_increasing_id())
    rows = got.collect()
    assert len(rows) == 102
    assert {(r.key, r.n, r.violations) for r in sinks.order_report(got).collect()} == {
        ("usr_" + "0" * 12, 21, 0), ("usr_" + f"{1:012x}", 20, 0), ("usr_" + f"{2:012x}", 20, 0), ("", 41, 0)}
    times = [r.value.split('"event_ts":"')[1][:10] for r in sorted(rows, key=lambda r: r.position) if r.key == "usr_" + f"{1:012x}"]
    assert times == sorted(times)
    swapped = got.withColumn("position", F.when(F.col("sequence") == 5, F.col("position") + 1.5).otherwise(F.col("position")))
    assert all(r.violations == (3 if r.key else 0) for r in sinks.order_report(swapped).collect())
    lost = got.where("sequence <> 7 OR key = ''")
    assert all(r.violations == (1 if r.key else 0) for r in sinks.order_report(lost).collect())
