"""The nested feed: what is shuffled, how often a body is made and parsed, and odd keys."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from chainflow.plans.fanout_queries import webhook_envelopes
from chainflow.sources import feeds
from chainflow.sources.fixtures import Fixtures


def _tables(spark, path):
    """Orders 1 and 2 (twice), one without lines, one of no key; lines of an order that is not there."""
    order = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_returnflag string, l_linestatus string")
    at = datetime(2024, 1, 1)
    spark.createDataFrame([(k, 7, "O", 10.0, at, "1-URGENT") for k in (1, 2, 2, 3, None)], order).write.parquet(
        os.path.join(path, "orders.parquet"))
    spark.createDataFrame([(1, 5, 3, 2, 1.0, 2.5, "N", "F"), (1, 6, 3, 1, 1.0, 2.5, "R", "O"), (2, 7, 4, 1, 1.0, None, None, None),
                           (9, 5, 3, 1, 1.0, 2.5, "N", "F"), (None, 5, 3, 1, 1.0, 2.5, "N", "F")], line).write.parquet(
        os.path.join(path, "lineitem.parquet"))
    return Fixtures(spark, path)


def test_nested_children_by_log_index_also_of_repeated_orders(spark, scratch):
    tx = feeds.transactions_nested(_tables(spark, scratch))
    rows = sorted((r._orderKey or 0, [x.logIndex for x in r.logs], [x.logIndex for x in r.erc20Transfers],
                   [x.tokenId for x in r.erc1155Transfers], len(r.internalTransactions)) for r in tx.collect())
    assert rows == [(0, [], [], [], 0), (1, [0, 1], [1], ["6"], 1), (2, [0, 1], [], ["7", "7"], 0),
                    (2, [0, 1], [], ["7", "7"], 0), (3, [], [], [], 0)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_strings_are_made_above_the_window(spark, scratch):
    fx = _tables(spark, scratch)
    for df in (fx.children, feeds.child_rows(fx, "erc20", ("chainId",)), feeds.transactions_nested(fx)):
        plan = _plan(df)
        window = next(i for i, line in enumerate(plan) if " Window [" in line)
        assert not any("sha2(" in line or "lpad(" in line for line in plan[window:] if "o_totalprice" not in line
                       and line.index("+-" if "+-" in line else ":") > plan[window].index("Window"))


def test_a_body_is_made_and_parsed_once(spark, scratch):
    logs = webhook_envelopes(_tables(spark, scratch)).select(F.explode("event.transaction.logs").alias("log")).filter(
        F.col("log.topic0") != "")
    plan = "\n".join(_plan(logs))
    assert plan.count("from_json(") == 1 and plan.count("StructsToJsonEvaluator(") == 1
    assert logs.count() == 6


def test_lines_are_shuffled_and_sorted_once(spark, scratch):
    fx = _tables(spark, scratch)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (fx.children, feeds.transactions_nested(fx)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert (plan.count("Exchange hashpartitioning("), plan.count("- Sort [")) == (2, 2), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_children_of_repeated_orders_take_each_order_s_customer_and_have_their_own_index(spark, scratch):
    at = datetime(2024, 1, 1)
    fx = _tables(spark, scratch)
    fx._cache["orders"] = spark.createDataFrame([(1, c, "O", 10.0, at, "1-URGENT") for c in (8, 7)], fx.orders.schema)
    want = sorted((i, "0x" + str(c).rjust(40, "0")) for i, c in enumerate((7, 8, 7, 8)))
    assert sorted((r.logIndex, r.to) for r in fx.children.select("logIndex", "to").collect()) == want
    nested = feeds.transactions_nested(fx).select(F.explode("logs.logIndex").alias("i")).collect()
    assert sorted(r.i for r in nested) == [0, 0, 1, 1, 2, 2, 3, 3]


def test_more_rows_are_dealt_over_more_tasks(spark, scratch, monkeypatch):
    """What a task sorts is bounded by a number of rows, not by the session's number of partitions."""
    from chainflow.sources import fixtures

    fx = _tables(spark, scratch)
    want = [sorted(map(str, df.collect())) for df in (fx.children, feeds.transactions_nested(fx))]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        fx = Fixtures(spark, scratch)
        for df, rows in zip((fx.children, feeds.transactions_nested(fx)), want, strict=True):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count(", 5), REPARTITION_BY_NUM") == 2 and plan.count("Exchange hashpartitioning(") == 2, plan
            assert sorted(map(str, df.collect())) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_what_a_task_sorts_is_bounded_also_where_the_session_has_more_partitions(spark, scratch, monkeypatch):
    """Partitions that Spark joined up by their shuffled size were sorted in one task, and spilled."""
    from chainflow.sources import fixtures

    _tables(spark, scratch)
    keys = range(40)
    spark.createDataFrame([(k, 5, 3, n, 1.0, 2.5, "N", "F") for k in keys for n in (1, 2)], spark.read.parquet(
        f"{scratch}/lineitem.parquet").schema).write.mode("overwrite").parquet(f"{scratch}/lineitem.parquet")
    orders = spark.read.parquet(f"{scratch}/orders.parquet")
    spark.createDataFrame([(k, 7, "O", 10.0, datetime(2024, 1, 1), "1-URGENT") for k in keys], orders.schema).write.mode(
        "overwrite").parquet(f"{scratch}/orders.parquet")
    monkeypatch.setattr(fixtures, "ROWS_A_TASK", 16)
    for df in (Fixtures(spark, scratch).children, feeds.transactions_nested(Fixtures(spark, scratch))):
        tasks = df.rdd.getNumPartitions()
        assert tasks == 5 < int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted((r.orderKey, r.logIndex) for r in Fixtures(spark, scratch).children.collect()) == [(k, i) for k in keys for i in (0, 1)]


def test_an_order_s_strings_are_made_once_an_order(spark, scratch):
    """Hash, receiver and time of children come from the order, not from an expression run for each line."""
    line = next(x for x in _plan(feeds.transactions_nested(_tables(spark, scratch))) if "flatten(transform(" in x)
    made = line[line.index("flatten(transform("):]
    assert "sha2(" not in made and "o_custkey" not in made and "unix_micros(" not in made


def test_counted_small_sides_are_broadcast(spark):
    from chainflow.operators import lookups

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tx = spark.createDataFrame([("t1", "0xA", "0xb", "0x")], "txHash string, from string, to string, input string").select(
            "*", *(F.array().cast("array<struct<from:string,to:string>>").alias(c) for c in (
                "erc20Transfers", "erc721Transfers", "erc1155Transfers", "internalTransactions")),
            F.array().cast("array<struct<address:string>>").alias("logs"))
        watch = spark.createDataFrame([("0xa",), ("0xz",), ("0xa",), (None,)], "address string")
        pairs = lookups.tx_semi_watchlist(tx, watch)
        assert "BroadcastHashJoin" in pairs._jdf.queryExecution().executedPlan().toString()
        assert [(r.txHash, r.address) for r in pairs.collect()] == [("t1", "0xa")]
        assert lookups.small(watch, 3) is watch  # more rows than may be: the planner decides
        moves = spark.createDataFrame([("0xA", "10"), ("0xq", "7")], "tokenAddress string, value string")
        prices = spark.createDataFrame([("0xa", 1, 2.0)], "address string, decimals int, price double")
        priced = lookups.transfers_join_prices(moves, prices)
        assert "BroadcastHashJoin" in priced._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.tokenAddress, r.valueUsd) for r in priced.collect()) == [("0xA", 2.0), ("0xq", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
