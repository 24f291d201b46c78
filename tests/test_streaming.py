"""Batch/stream equivalence on file sources with trigger(availableNow)."""

import os

from chainflow.operators import dedup as D
from chainflow.sources.fixtures import Fixtures
from chainflow.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_suppress_recent_stream_equals_batch(spark, scratch):
    s = Fixtures(spark, SF).sightings
    src = os.path.join(scratch, "src")
    # Land four time-ordered files one after another: state crosses batches.
    lo, hi = s.agg({"blockTimestamp": "min"}).first()[0], s.agg({"blockTimestamp": "max"}).first()[0]
    step = (hi - lo) // 4 + 1
    for i in range(4):
        part = s.filter((s.blockTimestamp >= lo + i * step) & (s.blockTimestamp < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(src)
    stream = jobs.file_stream(spark, src, s.schema, max_files=1)
    out = jobs.suppress_recent_stream(stream, ["chainId", "blockNumber"], "blockTimestamp", 600,
                                      tiebreak=["txHash"], watermark="100000 days")
    jobs.run_available_now(out, os.path.join(scratch, "sink"), os.path.join(scratch, "ckpt"))
    got = spark.read.parquet(os.path.join(scratch, "sink"))
    want = D.suppress_recent(s, ["chainId", "blockNumber"], "blockTimestamp", 600, ["txHash"])
    cols = ["chainId", "blockNumber", "blockTimestamp", "txHash"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_window_stream_counts_equal_batch(spark, scratch):
    from chainflow.operators import metrics as M
    tx = Fixtures(spark, SF).transactions
    src = os.path.join(scratch, "tx")
    tx.write.parquet(src)
    stream = jobs.file_stream(spark, src, tx.schema)
    out = jobs.window_counts_stream(stream, "1 hour")
    jobs.run_available_now(out, os.path.join(scratch, "w"), os.path.join(scratch, "wc"))
    got = spark.read.parquet(os.path.join(scratch, "w")).select("chainId", "window_start", "tx_count")
    want = M.tx_counts(M.tx_features(tx), 3600, 3600).select("chainId", "window_start", "tx_count")
    # append mode emits windows closed by the watermark; all but the newest ones
    g, w = set(map(tuple, got.collect())), set(map(tuple, want.collect()))
    assert g and g <= w


def test_dedup_stream(spark, scratch):
    rows = [("m1", 10), ("m2", 11), ("m1", 40), ("m3", 50)]
    df = spark.createDataFrame(rows, "messageId string, receivedAt long")
    src = os.path.join(scratch, "env")
    df.write.parquet(src)
    out = jobs.dedup_stream(jobs.file_stream(spark, src, df.schema))
    jobs.run_available_now(out, os.path.join(scratch, "d"), os.path.join(scratch, "dc"))
    got = sorted(r.messageId for r in spark.read.parquet(os.path.join(scratch, "d")).collect())
    assert got == ["m1", "m2", "m3"]


def test_webhook_fanout_foreach_batch(spark, scratch):
    from chainflow.plans.fanout_queries import webhook_envelopes
    env = webhook_envelopes(Fixtures(spark, SF))
    src = os.path.join(scratch, "wh")
    env.write.parquet(src)
    sink = os.path.join(scratch, "out")
    q = jobs.micro_batches(jobs.file_stream(spark, src, env.schema), jobs.webhook_fanout_batch(sink),
                           os.path.join(scratch, "whc"), available_now=True)
    q.awaitTermination()
    n = spark.read.parquet(os.path.join(sink, "erc20")).count()
    assert n == env.selectExpr("sum(size(event.transaction.erc20Transfers))").first()[0]


def test_heads_to_blocks_stream_equals_batch(spark, scratch):
    from __spark_entry__ import queries
    QUERIES = queries()
    from chainflow.sources import feeds
    fx = Fixtures(spark, SF)
    raw = feeds.newheads_raw(fx)
    src = os.path.join(scratch, "heads")
    raw.write.parquet(src)
    out = jobs.heads_to_blocks_stream(jobs.file_stream(spark, src, raw.schema), fx.blocks)
    jobs.run_available_now(out, os.path.join(scratch, "hb"), os.path.join(scratch, "hbc"))
    got = spark.read.parquet(os.path.join(scratch, "hb"))
    want = QUERIES["heads_to_blocks"](spark, SF)
    cols = ["hash", "blockNumber", "blockTimestamp", "chainId"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_live_fanout_stream_equals_batch(spark, scratch):
    from __spark_entry__ import queries
    QUERIES = queries()
    fx = Fixtures(spark, SF)
    msgs = fx.topic_messages
    src = os.path.join(scratch, "msgs")
    msgs.write.parquet(src)
    out = jobs.live_fanout_stream(jobs.file_stream(spark, src, msgs.schema), fx.subscriptions)
    jobs.run_available_now(out, os.path.join(scratch, "lf"), os.path.join(scratch, "lfc"))
    got = spark.read.parquet(os.path.join(scratch, "lf"))
    want = QUERIES["live_fanout"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_dynamic_chains_foreach_batch(spark, scratch):
    fx = Fixtures(spark, SF)
    ev = fx.event_log
    src = os.path.join(scratch, "ev")
    ev.write.parquet(src)
    table = os.path.join(scratch, "chains")
    q = jobs.micro_batches(jobs.file_stream(spark, src, ev.schema), jobs.dynamic_chains_batch(table, ["0", "1"]),
                           os.path.join(scratch, "evc"), available_now=True)
    q.awaitTermination()
    got = sorted(r.chainId for r in jobs.latest_chain_table(spark, table).collect())
    seen = {r.chainId for r in ev.filter(ev.event_type.startswith("chain.")).select("chainId").collect()}
    assert got == sorted(seen | {"0", "1"})


def test_cumulative_stream_update_mode(spark, scratch):
    tx = Fixtures(spark, SF).transactions
    src = os.path.join(scratch, "ctx")
    lo = tx.agg({"blockTimestamp": "min"}).first()[0]
    tx.filter(tx.blockTimestamp < lo + 86400 * 10).write.parquet(src)
    tx.filter(tx.blockTimestamp >= lo + 86400 * 10).write.mode("append").parquet(src)
    seen = []
    q = jobs.micro_batches(jobs.cumulative_stream(jobs.file_stream(spark, src, tx.schema, max_files=1)),
                           lambda df, i: seen.extend(map(tuple, df.select("chainId", "total_txs").collect())),
                           os.path.join(scratch, "cc"), available_now=True, mode="update")
    q.awaitTermination()
    final = {}
    for chain, n in seen:
        final[chain] = max(final.get(chain, 0), n)
    want = {r.chainId: r["count"] for r in tx.groupBy("chainId").count().collect()}
    assert final == want


def test_chain_continuity_ranges(spark):
    from chainflow.operators import timeline as W
    rows = [("a", "1", "h1", "h0"), ("a", "2", "h2", "h1"), ("a", "500000", "h5", "h4")]
    df = spark.createDataFrame(rows, "chainId string, blockNumber string, blockHash string, parentHash string")
    assert [tuple(r) for r in W.chain_continuity(df, ranges=True).collect()] == [("a", 3, 499999)]


def test_first_seen_stream_equals_batch(spark, scratch):
    from chainflow.operators import metrics as M
    tx = Fixtures(spark, SF).transactions
    src = os.path.join(scratch, "fs")
    mid = tx.agg({"blockTimestamp": "avg"}).first()[0]
    tx.filter(tx.blockTimestamp >= mid).write.parquet(src)          # later half lands first
    tx.filter(tx.blockTimestamp < mid).write.mode("append").parquet(src)
    latest = {}

    def keep(df, _):
        for r in df.collect():
            latest[(r.chainId, r.address)] = r.first_ts

    q = jobs.micro_batches(jobs.first_seen_stream(jobs.file_stream(spark, src, tx.schema, max_files=1)),
                           keep, os.path.join(scratch, "fsc"), available_now=True, mode="update")
    q.awaitTermination()
    want = {(r.chainId, r.item): r.first_ts for r in M.first_seen(M.tx_features(tx)).collect()}
    assert latest == want


def test_heads_join_blocks_both_streaming(spark, scratch):
    from chainflow.sources import decode, feeds
    fx = Fixtures(spark, SF)
    heads = decode.newheads_filter(decode.decode_newheads(feeds.newheads_raw(fx))).select("hash", "receivedAt")
    hsrc, bsrc = os.path.join(scratch, "h"), os.path.join(scratch, "b")
    heads.write.parquet(hsrc)
    fx.blocks.write.parquet(bsrc)
    out = jobs.heads_join_blocks_streams(jobs.file_stream(spark, hsrc, heads.schema),
                                         jobs.file_stream(spark, bsrc, fx.blocks.schema), watermark="1 hour")
    jobs.run_available_now(out, os.path.join(scratch, "hj"), os.path.join(scratch, "hjc"))
    got = sorted(map(tuple, spark.read.parquet(os.path.join(scratch, "hj")).collect()))
    from __spark_entry__ import queries
    want = sorted(map(tuple, queries()["heads_join_blocks"](spark, SF).select("hash", "blockNumber", "chainId").collect()))
    assert got == want


def test_observe_counters(spark, scratch):
    from chainflow.sources import decode, feeds
    raw = feeds.webhook_raw(Fixtures(spark, SF))
    src = os.path.join(scratch, "raw")
    raw.write.parquet(src)
    decoded = decode.decode_webhook(jobs.file_stream(spark, src, raw.schema), feeds.WEBHOOK_SECRET)
    q = jobs.observe_counters(decoded.select("deliveryKey", "is_corrupt", "signature_valid")) \
        .writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, "oc")) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    m = q.lastProgress["observedMetrics"]["ingest"]
    batch = decode.decode_webhook(raw, feeds.WEBHOOK_SECRET).agg(
        {"deliveryKey": "count"}).first()[0]
    assert int(m["messages"]) == batch
    assert int(m["processed"]) + int(m["errors"]) == batch


def test_distinct_senders_stream_exact(spark, scratch):
    from chainflow.operators import metrics as M
    tx = Fixtures(spark, SF).transactions
    src = os.path.join(scratch, "ds")
    tx.write.parquet(src)
    out = jobs.distinct_senders_stream(jobs.file_stream(spark, src, tx.schema), "30 minutes", "5 minutes")
    jobs.run_available_now(out, os.path.join(scratch, "dso"), os.path.join(scratch, "dsc"))
    got = set(map(tuple, spark.read.parquet(os.path.join(scratch, "dso")).collect()))
    want = set(map(tuple, M.address_counts(M.tx_features(tx), 1800, 300)
                   .select("chainId", "window_start", "active_senders").collect()))
    assert got and got <= want   # every closed window is exact
