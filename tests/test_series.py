"""Series, the hourly store, suppression of hot keys and dealt match keys, against brute force."""

import os
import random
from collections import Counter

from pyspark.sql import functions as F

from chainflow.operators import dedup, hourly_store, lookups, series


def test_suppression_of_a_hot_key_is_spread_and_equals_the_scan(spark):
    rng = random.Random(7)
    rows = [("hot", rng.randint(0, 60_000), rng.randint(0, 99)) for _ in range(20_000)]
    rows += [(k, rng.randint(0, 60_000), i) for i in range(400) for k in ("a", None)] + [("t", 5, 3), ("t", 5, 1), ("t", None, 0)]
    df = spark.createDataFrame(rows, "k string, ts long, n long").repartition(7)
    for interval, segment in ((30, None), (30, 45), (700, 100), (1, 10), (5000, 3600)):
        want, last = [], {}
        for k, ts, n in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1], r[2])):
            if k not in last or ts - last[k] >= interval:
                want.append((k, ts, n))
                last[k] = ts
        out = dedup.suppress_recent(df, ["k"], "ts", interval, ["n"], segment)
        assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert dedup.suppress_recent(df, ["k"], "ts", 0, ["n"]).count() == len(rows) - 1
    assert dedup.suppress_recent(df.limit(0), ["k"], "ts", 30).collect() == []


def test_store_replaces_touched_hours_and_reads_two_days(spark, scratch):
    path = os.path.join(scratch, "hours")
    hours = spark.range(0, 24 * 9).select(F.lit("1").alias("chainId"), (F.col("id") * 3600).alias("window_start"),
                                          F.col("id").alias("tx_count"))
    hourly_store.update_hours(hours, path)
    again = hours.filter(F.col("window_start").between(3 * 86400 + 7200, 3 * 86400 + 10800)).withColumn("tx_count", F.lit(-1).cast("long"))
    hourly_store.update_hours(again.unionByName(again.withColumn("chainId", F.lit("2"))), path)
    stored = hourly_store.read_hours(spark, path, hours.withColumn("day", hourly_store.day_of(F.col("window_start"))).schema)
    assert stored.count() == 24 * 9 + 2
    assert sorted((r.chainId, r.window_start) for r in stored.filter("tx_count = -1").collect()) == [
        (c, 3 * 86400 + s) for c in "12" for s in (7200, 10800)]
    end = 5 * 86400 + 7000
    day = hourly_store.last_day(stored, end)
    assert sorted(r.window_start for r in day.collect()) == [x for x in range(0, 24 * 9 * 3600, 3600) if end - 86400 <= x <= end]
    read = {f.split("day=")[1].split("/")[0] for f in day.select(F.input_file_name().alias("f")).toPandas()["f"]}
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert read == {"4", "5"} and "PartitionFilters: [isnotnull(day" in plan


def test_series_ranges_and_pages(spark):
    tx = spark.createDataFrame(
        [("1", t, f"a{t // 7000 % 7}", f"b{t // 7000 % 3}", "0x12", "1", "5", "21000", "5") for t in range(0, 40 * 86400, 7000)],
        'chainId string, blockTimestamp long, `from` string, `to` string, input string, txStatus string, gasPrice string, '
        'receiptGasUsed string, receiptEffectiveGasPrice string')
    blocks = spark.createDataFrame([], "chainId string, blockNumber string, blockTimestamp long, txCount int, gasUsed string, "
                                       "gasLimit string, feesSpent string")
    points = series.metric_series(tx, blocks).cache()
    assert {r.metric for r in points.select("metric").distinct().collect()} == set(series.SERIES) - {"gasUsed", "feesPaid"}
    value = {(r.metric, r.interval, r.timestamp): r.value for r in points.collect()}
    week = 4 * 86400  # the first Monday after the epoch's Thursday
    assert value["activeAddresses", "week", week] == 10 and value["activeSenders", "month", 0] == 7
    assert value["cumulativeTxCount", "month", 31 * 86400] == len(range(0, 40 * 86400, 7000))
    assert value["avgTps", "month", 0] == len(range(0, 31 * 86400, 7000)) / (31 * 86400)
    assert value["maxGps", "day", 86400] == 21000
    days = [t for m, g, t in sorted(value) if (m, g) == ("txCount", "day")]
    got, token = [], None
    while True:
        rows, token = series.page(points, "1", "txCount", "day", 7, token, start=86400, end=20 * 86400)
        got.append([r.timestamp for r in rows])
        if token is None:
            break
    assert sum(got, []) == [d for d in days if 86400 <= d <= 20 * 86400] and [len(p) for p in got] == [7, 7, 6]
    paged = series.paged(series.in_range(points, start=86400), 7).filter("metric = 'txCount' AND interval = 'day'")
    assert {r.timestamp: r.page for r in paged.collect()} == {d: i // 7 for i, d in enumerate(days[1:])}


def test_heavy_match_keys_are_dealt_out(spark):
    messages = spark.range(500).select(F.col("id").alias("offset"), F.when(F.col("id") % 10 < 9, "t").otherwise("u").alias("type"),
                                       (F.col("id") % 3).cast("string").alias("chainId"), F.col("id").alias("at"))
    subs = [("a", "t", "1", 0), ("b", "", "*", 0), ("c", "*", "2", 0), ("a", "u", "", 250), ("d", "t", "9", 0)]
    table = spark.createDataFrame(subs, "clientId string, subTopic string, subChain string, subTime long")

    def meets(topic, chain, m):
        return topic in ("", "*", m.type) and chain in ("", "*", m.chainId)

    rows = messages.collect()
    latest = {c: (t, x) for c, t, x, _ in subs}
    for part_rows in (10, 60, 10_000):
        got = lookups.fanout_subscriptions(messages, lookups.resolve_subscriptions(table), part_rows=part_rows)
        assert sorted((r.clientId, r.offset) for r in got.collect()) == sorted(
            (c, m.offset) for c, (t, x) in latest.items() for m in rows if meets(t, x, m))
        over_time = lookups.fanout_subscriptions(messages, lookups.subscription_periods(table), time_col="at", part_rows=part_rows)
        assert over_time.columns == ["offset", "type", "chainId", "at", "clientId"]
        assert sorted((r.clientId, r.offset) for r in over_time.collect()) == sorted(
            (c, m.offset) for c, t, x, since in subs for m in rows
            if meets(t, x, m) and m.at >= since and not (c == "a" and since == 0 and m.at >= 250))


def test_few_subscribers_are_broadcast_as_lists(spark, monkeypatch):
    """A message is shuffled once, without its match keys; many subscribers are joined by parts, with the same result."""
    monkeypatch.setattr(lookups, "LIST_ROWS", 3)
    messages = spark.createDataFrame([(i, t, c, i) for i in range(90) for t, c in [("t", "1"), ("t", None), (None, "2"), ("u", "2")]],
                                     "offset long, type string, chainId string, at long").repartition(3)
    rows = [(f"c{i}", ("t", "u", "*", "", None)[i % 5], ("1", "2", "*", "7")[i % 4], at) for i in range(40) for at in (0, i, i)]
    subs = spark.createDataFrame([*rows, (None, "t", "1", 5), ("n", "t", "1", None)],
                                 "clientId string, subTopic string, subChain string, subTime long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = ([lookups.fanout_subscriptions(messages, table, time_col=at, part_rows=40, small_rows=most)
                      for table, at in ((lookups.resolve_subscriptions(subs), None), (lookups.subscription_periods(subs), "at"))]
                     for most in (1000, 0))
        assert all("_part" not in df._jdf.queryExecution().toString() for df in few)
        for a, b, periods in zip(few, many, (False, True)):
            table = lookups.subscription_periods(subs).collect() if periods else lookups.resolve_subscriptions(subs).collect()
            want = Counter((m.offset, m.type, m.chainId, s.clientId) for m in messages.collect() for s in table
                           if s.subTopic in ("", "*", None) or s.subTopic == m.type
                           if s.subChain in ("", "*", None) or s.subChain == m.chainId
                           if not periods or s.validFrom is not None and s.validFrom <= m.at and (s.validTo is None or m.at < s.validTo))
            for got in (a, b):
                assert Counter((r.offset, r.type, r.chainId, r.clientId) for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_are_dealt_over_tasks(spark, monkeypatch):
    """One key with all messages and all subscribers is many tasks, by the pairs that it makes."""
    monkeypatch.setattr(lookups, "TASK_PAIRS", 50_000)
    messages = spark.range(2000).select(F.col("id").alias("offset"), F.lit("t").alias("type"), F.lit("1").alias("chainId")).coalesce(1)
    subs = spark.range(300).select(F.concat(F.lit("c"), "id").alias("clientId"), F.lit("*").alias("subTopic"), F.lit("").alias("subChain"))
    got = lookups.fanout_subscriptions(messages, subs).groupBy(F.spark_partition_id()).count().collect()
    assert len(got) == 12 and sum(r["count"] for r in got) == 600_000 and max(r["count"] for r in got) < 100_000


def test_series_plan_holds_the_hourly_rollup_once(spark):
    tx = spark.createDataFrame(
        [("1", t, "a", "b", "0x12", "1", "5", "21000", "5") for t in range(0, 40 * 86400, 7000)],
        'chainId string, blockTimestamp long, `from` string, `to` string, input string, txStatus string, gasPrice string, '
        'receiptGasUsed string, receiptEffectiveGasPrice string')
    blocks = spark.createDataFrame([], "chainId string, blockNumber string, blockTimestamp long, txCount int, gasUsed string, "
                                       "gasLimit string, feesSpent string")
    aggregates = [series.metric_series(tx, blocks, grains)._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [")
                  for grains in (series.GRAINS[:1], series.GRAINS)]
    assert aggregates[0] == aggregates[1]


def test_window_hourly_has_every_hour(spark, scratch):
    from __spark_entry__ import queries
    days = 3
    spark.range(0, days * 24).selectExpr(
        "id AS event_id", "id % 2 AS user_id", "timestamp_seconds(1704067200 + id * 3600) AS ts", "'view' AS event_type",
        "1.5D AS value", "'{}' AS props").write.parquet(os.path.join(scratch, "events.parquet"))
    hours = queries()["window_hourly"](spark, scratch).select("chainId", "window_start").collect()
    assert sorted(map(tuple, hours), key=lambda r: r[1]) == [(str(h % 2), 1704067200 + h * 3600) for h in range(days * 24)]
