"""Operators against brute force on small literal inputs."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainflow.operators import dedup as D
from chainflow.operators import lookups as J
from chainflow.operators import timeline as W


def _brute_suppress(rows, interval):
    out, last = [], {}
    for k, ts, tb in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if k not in last or ts - last[k] >= interval:
            out.append((k, ts, tb))
            last[k] = ts
    return sorted(out)


def test_suppress_recent_boundary(spark):
    rows = [("a", 0, "x"), ("a", 599, "y"), ("a", 600, "z"), ("a", 1199, "w"), ("a", 1200, "v"),
            ("b", 5, "x"), ("b", 5, "y")]
    df = spark.createDataFrame(rows, "k string, ts long, tb string")
    got = sorted(tuple(r) for r in D.suppress_recent(df, ["k"], "ts", 600, ["tb"]).collect())
    # equal to the interval emits; last *emitted*, not last seen, counts
    assert got == [("a", 0, "x"), ("a", 600, "z"), ("a", 1200, "v"), ("b", 5, "x")]
    rnd = random.Random(7)
    rows = [(f"k{rnd.randrange(5)}", rnd.randrange(5000), f"t{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k string, ts long, tb string")
    got = sorted(tuple(r) for r in D.suppress_recent(df, ["k"], "ts", 300, ["tb"]).collect())
    assert got == _brute_suppress(rows, 300)


def test_segmented_lag_and_running_sum(spark):
    rnd = random.Random(3)
    rows = [(f"c{rnd.randrange(3)}", n, rnd.randrange(100)) for n in rnd.sample(range(2000), 600)]
    df = spark.createDataFrame(rows, "key string, n long, v long")
    w = Window.partitionBy("key").orderBy("n")
    want = df.select("key", "n", F.lag("v").over(w).alias("p"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("r"))
    got = W.segmented_lag(df, "key", "n", "v", "p", segment=37)
    got = W.segmented_running_sum(got, "key", "n", "v", "r", segment=37).select("key", "n", "p", "r")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_fanout_subscriptions_matches_or_join(spark):
    msgs = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(
        [("blocks", "0"), ("blocks", "1"), ("logs", "1"), ("transactions", "2"), ("logs", "0")])],
        "id long, type string, chainId string")
    subs = spark.createDataFrame([("c1", "blocks", "0"), ("c2", "*", "1"), ("c3", "transactions", ""),
                                  ("c4", "", "*"), ("c5", "logs", "*")], "clientId string, subTopic string, subChain string")
    got = sorted(map(tuple, J.fanout_subscriptions(msgs, subs).select("clientId", "id").collect()))
    want = []
    for cid, st, sc in map(tuple, subs.collect()):
        for i, t, c in map(tuple, msgs.collect()):
            if (st in ("", "*") or st == t) and (sc in ("", "*") or sc == c):
                want.append((cid, i))
    assert got == sorted(want)


def test_keyset_page_and_drain(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "k")
    p1 = W.keyset_page(df, "k", 100).collect()
    assert [r.k for r in p1] == list(range(100)) and {r.next_token for r in p1} == {99}
    p3 = W.keyset_page(df, "k", 100, after=199).collect()
    assert [r.k for r in p3] == list(range(200, 250)) and {r.next_token for r in p3} == {None}
    pages = W.drain_pages(df, "k", 100).groupBy("page").count().orderBy("page").collect()
    assert [(r.page, r["count"]) for r in pages] == [(0, 100), (1, 100), (2, 50)]


def test_chain_continuity(spark):
    rows = [("a", "1", "h1", "h0"), ("a", "2", "h2", "h1"), ("a", "5", "h5", "h4"), ("a", "6", "h6", "XX")]
    df = spark.createDataFrame(rows, "chainId string, blockNumber string, blockHash string, parentHash string")
    got = sorted(map(tuple, W.chain_continuity(df).collect()))
    assert got == [("a", 3, "missing"), ("a", 4, "missing"), ("a", 6, "parent_mismatch")]


BLOCKS = "chainId string, blockNumber string, blockHash string, parentHash string"


def test_chain_forks(spark):
    rows = [("a", "1", "A1", "?"), ("a", "2", "A2", "A1"), ("a", "2", "B2", "A1"), ("a", "3", "A3", "A2"),
            ("a", "3", "B3", "B2"), ("a", "3", "B3", "B2"), ("a", "4", "B4", "B3"), ("a", "5", "X5", "lost"),
            ("a", "7", "D7", "X6"), ("a", "8", "D8", "D7"), ("a", "8", "C8", None), ("b", "2", "A2", "A1"),
            (None, "1", "A1", None), ("a", "x", "A1", None), ("a", "9", None, "C8")]
    got = {(r.chainId, r.blockNumber, r.blockHash): (r.link, r.status)
           for r in W.chain_forks(spark.createDataFrame(rows, BLOCKS)).collect()}
    assert got == {
        ("a", 1, "A1"): ("start", "canonical"), ("a", 2, "A2"): ("linked", "orphan"),
        ("a", 2, "B2"): ("linked", "canonical"), ("a", 3, "A3"): ("linked", "orphan"),
        ("a", 3, "B3"): ("linked", "canonical"), ("a", 4, "B4"): ("linked", "canonical"),
        ("a", 5, "X5"): ("broken", "canonical"), ("a", 7, "D7"): ("start", "canonical"),
        ("a", 8, "D8"): ("linked", "orphan"), ("a", 8, "C8"): ("broken", "canonical"),
        ("b", 2, "A2"): ("start", "canonical")}
    assert W.chain_forks(spark.createDataFrame([], BLOCKS)).isEmpty()


def test_chain_forks_against_a_walk(spark):
    rnd = random.Random(5)
    rows = []
    for n in range(120):
        if n % 41 == 40:
            continue
        for k in range(3 if n % 50 < 37 else 1):
            up = rnd.choice([f"{n - 1}-0", f"{n - 1}-1", f"{n - 1}-2", "lost"])
            rows.append(("a", str(n), f"{n}-{k}", up))
    least, parent = {}, {}
    for _, n, h, up in rows:
        least[int(n)] = min(h, least.get(int(n), h))
        parent[h] = up
    want = set()
    for n in sorted(least, reverse=True):
        at = least[n] if n + 1 not in least else (parent[at] if parent[at] in parent else least[n])
        want.add(at)
    got = W.chain_forks(spark.createDataFrame(rows, BLOCKS)).collect()
    assert len(got) == len(rows)
    assert {r.blockHash for r in got if r.status == "canonical"} == want


def test_snapshot_changes(spark):
    cur = spark.createDataFrame([("a", "1", None), ("b", "2", 5), ("c", "3", None)], "k string, x string, y long")
    prev = spark.createDataFrame([("a", "1", None), ("b", "2", 6)], "k string, x string, y long")
    got = sorted(map(tuple, J.snapshot_changes(cur, prev, "k", "e").collect()))
    assert got == [("b", "e.updated"), ("c", "e.created")]


def test_keyset_pages_per_group(spark):
    rnd = random.Random(11)
    rows = [(f"g{rnd.randrange(3)}", n) for n in rnd.sample(range(100000), 900)]
    df = spark.createDataFrame(rows, "g string, k long")
    got = W.keyset_pages(df, "g", "k", 50, segment=997).collect()
    for g in ("g0", "g1", "g2"):
        keys = sorted(k for gg, k in rows if gg == g)
        page = sorted(r.k for r in got if r.g == g)
        assert page == keys[:50]
        assert {r.next_token for r in got if r.g == g} == {keys[49]}


def test_exact_and_approx_median(spark):
    from chainflow.operators import metrics as M
    rnd = random.Random(5)
    rows = [("c", t, str(25_000_000_000 + 1_000_000 * rnd.randrange(20))) for t in range(0, 3600, 7)]
    tx = spark.createDataFrame(rows, "chainId string, blockTimestamp long, gasPrice string") \
        .selectExpr("*", "'0x1' AS `from`", "'0x2' AS `to`", "'1' AS txStatus", "'0x' AS input",
                    "'21000' AS receiptGasUsed", "gasPrice AS receiptEffectiveGasPrice")
    blocks = spark.createDataFrame([("c", "1", 10, 1, "21000", "8000000", "1")],
                                   "chainId string, blockNumber string, blockTimestamp long, txCount int, "
                                   "gasUsed string, gasLimit string, feesSpent string")
    exact = {r.window_start: r.median_gas_price for r in M.gas(tx, blocks, 1800, 300).collect()}
    approx = {r.window_start: r.median_gas_price for r in M.gas(tx, blocks, 1800, 300, exact_median=False).collect()}
    import statistics
    for ws, m in exact.items():
        prices = [float(p) for _, t, p in rows if ws <= t < ws + 1800]
        assert m == statistics.median(prices)
        assert abs(approx[ws] - m) <= 1_000_000
