"""Registered joins, set operations, routing, ordered operators, filters, dedup."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chainflow.functions import scalar as C
from chainflow.operators import dedup as D
from chainflow.operators import fanout as P
from chainflow.operators import filters as FL
from chainflow.operators import lookups as J
from chainflow.operators import routing as K
from chainflow.operators import timeline as W
from chainflow.plans import metric_queries as _Q
from chainflow.plans.duck import DELIVERIES, arity, part, vwd
from chainflow.plans.metric_queries import oracle
from chainflow.plans.registry import query
from chainflow.session import checkpoint_dir
from chainflow.sources import block_store, decode, feeds
from chainflow.sources.feeds import TRANSFER_SINGLE_TOPIC, WEBHOOK_SECRET
from chainflow.sources.fixtures import Fixtures

SEED_CHAINS = ["0", "1"]
SUPPRESS_INTERVAL = 600
PAGE = 100
# Test topic configuration: subnets/blockchains topics unset (their events
# drop, K03) and the performance family unset (falls back to metrics, K04).
TOPICS = K.TopicConfig(names={"subnets": "", "blockchains": "", "metrics.performance": ""})


def _topic_values() -> str:
    rows = K.topic_rows(TOPICS)
    vals = ", ".join(f"('{e}', '{t}', '{f}')" for e, t, f in rows)
    return (f"tm AS (SELECT event_type, coalesce(nullif(configured, ''), fallback) AS topic "
            f"FROM (VALUES {vals}) v(event_type, configured, fallback))")


def _heads(fx):
    return decode.newheads_filter(decode.decode_newheads(feeds.newheads_raw(fx)))


# --- joins ------------------------------------------------------------------

@query("heads_join_blocks", oracle("""
SELECT blockHash AS hash, chainId, blockNumber, blockTimestamp FROM blocks
WHERE cast(blockNumber AS bigint) % 50 <> 0 AND cast(blockNumber AS bigint) % 89 <> 0""", ("blocks",)))
def q_heads_join_blocks(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    heads = _heads(fx).select("hash")
    return J.heads_join_blocks(heads, fx.blocks).select("hash", "chainId", "blockNumber",
                                                         "blockTimestamp")


@query("heads_to_blocks", oracle("""
SELECT blockHash AS hash, blockNumber, blockTimestamp, chainId FROM blocks
WHERE cast(blockNumber AS bigint) % 50 <> 0 AND cast(blockNumber AS bigint) % 89 <> 0""", ("blocks",)))
def q_heads_to_blocks(spark, sf_dir):
    """T11 (batch form): heads -> blocks, stamped with the head stream's chain."""
    fx = Fixtures(spark, sf_dir)
    heads = _heads(fx).select("hash", F.substring("subscription", len(feeds.HEADS_SUBSCRIPTION) + 1, 64)
                              .alias("streamChain"))
    blocks = fx.blocks.select("blockHash", "blockNumber", "blockTimestamp")
    joined = J.heads_join_blocks(heads, blocks)
    return joined.select("hash", "blockNumber", "blockTimestamp", F.col("streamChain").alias("chainId"))


@query("chains_join_detail", oracle("""
SELECT c.chainId, c.chainName, d.rpcUrl, d.isTestnet, d.tokenSymbol
FROM chains c JOIN chain_details d ON c.chainId = d.chainId""", ("chains", "chain_details")))
def q_chains_join_detail(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    details = fx.chain_details.select("chainId", "rpcUrl", "isTestnet", "tokenSymbol")
    return J.chains_join_detail(fx.chains.select("chainId", "chainName"), details)


@query("subnets_join_detail", oracle("""
SELECT s.subnetId, d.n_blockchains FROM subnets s LEFT JOIN (
  SELECT s2.subnetId, cast(count(*) AS int) AS n_blockchains
  FROM subnets s2 JOIN blockchains b ON s2.regionKey = b.regionKey GROUP BY s2.subnetId) d
  ON s.subnetId = d.subnetId
WHERE s.subnetId <> ''""", ("subnets", "blockchains")))
def q_subnets_join_detail(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    listed = FL.nonempty_id(fx.subnets.select("subnetId"))
    detail = feeds.subnets_nested(fx).select("subnetId", F.size("blockchains").alias("n_blockchains"))
    return J.subnets_join_detail(listed, detail)


_CHAIN_EVENTS = "SELECT chainId FROM event_log WHERE event_type LIKE 'chain.%'"


def _monitored(spark, fx):
    seen = fx.event_log.filter(F.col("event_type").startswith("chain.")).select("chainId")
    return J.chain_set(spark, SEED_CHAINS, seen)


@query("chain_set_union", oracle(f"""
SELECT DISTINCT chainId FROM (SELECT '0' AS chainId UNION ALL SELECT '1' UNION ALL {_CHAIN_EVENTS}) s""",
                                 ("event_log",)))
def q_chain_set_union(spark, sf_dir):
    return _monitored(spark, Fixtures(spark, sf_dir))


@query("blocks_semi_chains", oracle(f"""
SELECT chainId, blockNumber, blockHash FROM blocks
WHERE chainId IN (SELECT '0' UNION ALL SELECT '1' UNION ALL {_CHAIN_EVENTS})""", ("blocks", "event_log")))
def q_blocks_semi_chains(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return J.blocks_semi_chains(fx.blocks.select("chainId", "blockNumber", "blockHash"),
                                _monitored(spark, fx))


@query("chain_set", oracle("""
SELECT txHash, chainId FROM transactions WHERE chainId IN ('0', '1')""", ("transactions",)))
def q_chain_set(spark, sf_dir):
    """only transactions of the configured chains (a static chain set)."""
    tx = Fixtures(spark, sf_dir).transactions.select("txHash", "chainId")
    return J.blocks_semi_chains(tx, J.chain_set(spark, SEED_CHAINS))


_SUBS_LATEST = """latest AS (SELECT clientId, arg_max(subTopic, subTime) AS subTopic,
  arg_max(subChain, subTime) AS subChain FROM subscriptions GROUP BY clientId)"""
_MSGS = f"""msgs AS (SELECT "offset", {part('topic', 2)} AS type, {part('topic', 3)} AS chainId,
  "value", eventTime FROM topic_messages WHERE {arity('topic')} >= 3)"""


@query("resubscribe", oracle("SELECT clientId, subTopic, subChain FROM latest",
                             ("subscriptions",), [_SUBS_LATEST]))
def q_resubscribe(spark, sf_dir):
    return J.resolve_subscriptions(Fixtures(spark, sf_dir).subscriptions)


_MATCH = """(l.subTopic = m.type OR l.subTopic IN ('', '*')) AND (l.subChain = m.chainId OR l.subChain IN ('', '*'))"""


@query("fanout_subscriptions", oracle(f"""SELECT l.clientId, m."offset", m.type, m.chainId FROM msgs m JOIN latest l ON {_MATCH}""",
                                      ("subscriptions", "topic_messages"), [_SUBS_LATEST, _MSGS]))
def q_fanout_subscriptions(spark, sf_dir):
    """Every message against the clients' current subscriptions."""
    fx = Fixtures(spark, sf_dir)
    msgs = P.stamp_live(FL.topic_arity_filter(fx.topic_messages), F.col("eventTime")).select("offset", "type", "chainId")
    return J.fanout_subscriptions(msgs, J.resolve_subscriptions(fx.subscriptions)).select("clientId", "offset", "type", "chainId")


@query("live_fanout", oracle(f"""
SELECT l.clientId, m."offset", '{{"type":"' || m.type || '","chainId":"' || m.chainId || '","data":'
  || to_json(m."value") || ',"timestamp":' || cast(m.eventTime AS varchar) || '}}' AS envelope
FROM msgs m JOIN periods l ON {_MATCH} AND m.eventTime >= l.subTime AND (l.until IS NULL OR m.eventTime < l.until)""",
                             ("subscriptions", "topic_messages"), [_MSGS, """periods AS (
  SELECT *, lead(subTime) OVER (PARTITION BY clientId ORDER BY subTime) AS until FROM subscriptions)"""]))
def q_live_fanout(spark, sf_dir):
    """T12 (batch form): F03 -> P10 -> P11 -> J05, each message by the subscription that a client had at its time.

    An envelope is made once a message, not once a subscriber.
    """
    fx = Fixtures(spark, sf_dir)
    msgs = P.stamp_live(FL.topic_arity_filter(fx.topic_messages), F.col("eventTime"))
    sent = P.live_envelope(msgs, data_col="value").select("offset", "type", "chainId", "eventTime", "envelope")
    return J.fanout_subscriptions(sent, J.subscription_periods(fx.subscriptions), time_col="eventTime") \
        .select("clientId", "offset", "envelope")


_PARTICIPANTS = """parts AS (
  SELECT txHash, lower("from") AS address FROM orders_tx UNION
  SELECT txHash, lower("to") FROM orders_tx UNION
  SELECT t.txHash, lower(c."from") FROM children c JOIN orders_tx t ON c.orderKey = t.orderKey UNION
  SELECT t.txHash, lower(c."to") FROM children c JOIN orders_tx t ON c.orderKey = t.orderKey UNION
  SELECT t.txHash, lower(c.tokenAddress) FROM children c JOIN orders_tx t ON c.orderKey = t.orderKey)"""


@query("watch_addresses", oracle("""
SELECT txHash, address FROM parts WHERE address IN (SELECT lower(address) FROM watch_addresses)""",
                                 ("orders_tx", "children", "watch_addresses"), [_PARTICIPANTS]))
def q_watch_addresses(spark, sf_dir):
    """(transaction, watched address) pairs of address activity."""
    fx = Fixtures(spark, sf_dir)
    return J.tx_semi_watchlist(feeds.transactions_nested(fx), fx.watch_addresses)


@query("tx_semi_watchlist", oracle("""
SELECT DISTINCT txHash FROM parts WHERE address IN (SELECT lower(address) FROM watch_addresses)""",
                                   ("orders_tx", "children", "watch_addresses"), [_PARTICIPANTS]))
def q_tx_semi_watchlist(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return J.tx_semi_watchlist(feeds.transactions_nested(fx), fx.watch_addresses) \
        .select("txHash").distinct()


@query("tx_participants", oracle("""
SELECT txHash, cast(count(*) AS int) AS n_participants FROM parts
WHERE address IS NOT NULL AND address <> '' GROUP BY txHash""", ("orders_tx", "children"), [_PARTICIPANTS]))
def q_tx_participants(spark, sf_dir):
    """Distinct addresses touched by each transaction."""
    from chainflow.functions import scalar as C
    nested = feeds.transactions_nested(Fixtures(spark, sf_dir))
    return nested.select("txHash", F.size(C.tx_participants()).alias("n_participants"))


@query("events_join_topics", oracle("""
SELECT e.eventId, e.event_type, tm.topic FROM event_log e JOIN tm ON e.event_type = tm.event_type""",
                                    ("event_log",), [_topic_values()]))
def q_events_join_topics(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return J.events_join_topics(fx.event_log.select("eventId", "event_type"), K.topic_map(spark, TOPICS))


@query("unmapped_drop", oracle("""
SELECT eventId, event_type FROM event_log WHERE event_type NOT IN (SELECT event_type FROM tm)""",
                               ("event_log",), [_topic_values()]))
def q_unmapped_drop(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return J.unmapped_events(fx.event_log.select("eventId", "event_type"), K.topic_map(spark, TOPICS))


@query("route_events", oracle("""
SELECT e.eventId, tm.topic, e.chainId AS key, e.data AS value
FROM event_log e JOIN tm ON e.event_type = tm.event_type WHERE tm.topic <> ''""",
                              ("event_log",), [_topic_values()]))
def q_route_events(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    routed = K.route_events(fx.event_log, K.topic_map(spark, TOPICS))
    return routed.select("eventId", "topic", F.col("chainId").alias("key"), F.col("data").alias("value"))


@query("drop_empty_topic", oracle("""
SELECT e.eventId, e.event_type FROM event_log e JOIN tm ON e.event_type = tm.event_type
WHERE tm.topic = ''""", ("event_log",), [_topic_values()]))
def q_drop_empty_topic(spark, sf_dir):
    """The messages K03 discards (configured topic empty)."""
    fx = Fixtures(spark, sf_dir)
    joined = J.events_join_topics(fx.event_log.select("eventId", "event_type"), K.topic_map(spark, TOPICS))
    return K.empty_topic_rejects(joined).select("eventId", "event_type")


@query("events_by_topic", oracle("""
SELECT tm.topic, count(*) AS events FROM event_log e JOIN tm ON e.event_type = tm.event_type
WHERE tm.topic <> '' GROUP BY tm.topic""", ("event_log",), [_topic_values()]))
def q_events_by_topic(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return K.events_by_topic(K.route_events(fx.event_log, K.topic_map(spark, TOPICS)))


@query("metric_topic_fallback", oracle("""
SELECT event_type, topic FROM tm WHERE event_type LIKE 'metrics.%'""", (), [_topic_values()]))
def q_metric_topic_fallback(spark, sf_dir):
    """Family topics with fallback, for the metric event types routed in this run."""
    fx = Fixtures(spark, sf_dir)
    present = fx.event_log.filter(F.col("event_type").startswith("metrics.")).select("event_type").distinct()
    return K.topic_map(spark, TOPICS).join(present, "event_type", "left_semi")


@query("route_metric_long", f"""
SELECT chainId, metric, timestamp, CASE
  WHEN metric IN ('activeAddresses', 'txCount') THEN 'chain.metrics.activity'
  WHEN metric IN ('avgGasPrice', 'feesPaid') THEN 'chain.metrics.gas'
  ELSE 'chain.metrics' END AS topic
FROM (SELECT chainId, window_start AS timestamp, metric FROM (
  UNPIVOT (SELECT chainId, window_start, 1 AS activeAddresses, 1 AS txCount, 1 AS avgTps,
    1 AS avgGasPrice, 1 AS feesPaid FROM (SELECT DISTINCT chainId, blockTimestamp - blockTimestamp % 3600
    AS window_start FROM ({oracle('SELECT * FROM transactions', ('transactions',))}) t) w)
  ON activeAddresses, txCount, avgTps, avgGasPrice, feesPaid INTO NAME metric VALUE v) u) q""")
def q_route_metric_long(spark, sf_dir):
    """Hourly long metric rows, each to its family topic (performance falls back)."""
    from chainflow.plans.metric_queries import hourly
    h = hourly(spark, sf_dir).select(
        "chainId", "window_start", F.col("active_addresses").alias("activeAddresses"),
        F.col("tx_count").alias("txCount"), F.col("avg_tps").alias("avgTps"),
        F.col("avg_gas_price").alias("avgGasPrice"), F.col("fees_paid").alias("feesPaid"))
    long = P.metric_long_rows(h, ["chainId", "window_start"],
                              ["activeAddresses", "txCount", "avgTps", "avgGasPrice", "feesPaid"])
    return K.route_metric_long(long, TOPICS).select(
        "chainId", "metric", F.col("window_start").alias("timestamp"), "topic")


@query("encode_payload", oracle("""
SELECT 'chain.blocks' AS topic, chainId AS key, CAST(to_json(struct_pack(chainId := chainId,
  blockNumber := blockNumber, blockTimestamp := blockTimestamp, blockHash := blockHash,
  txCount := txCount)) AS VARCHAR) AS value FROM blocks""", ("blocks",)))
def q_encode_payload(spark, sf_dir):
    blocks = Fixtures(spark, sf_dir).blocks.withColumn("topic", F.lit(TOPICS.topic("blocks")))
    return K.encode_payload(blocks, ["chainId", "blockNumber", "blockTimestamp", "blockHash", "txCount"])


_SINK_SQL = """
SELECT 'chain.blocks' AS topic, chainId AS key, CAST(to_json(struct_pack(chainId := chainId,
  blockNumber := blockNumber, blockHash := blockHash)) AS VARCHAR) AS value FROM blocks
UNION ALL SELECT 'chain.transactions', chainId, CAST(to_json(struct_pack(txHash := txHash,
  chainId := chainId, value := value)) AS VARCHAR) FROM transactions
UNION ALL SELECT 'chain.chains', chainId, CAST(to_json(struct_pack(chainId := chainId,
  chainName := chainName)) AS VARCHAR) FROM chains
UNION ALL SELECT 'chain.validators', nodeId, CAST(to_json(struct_pack(nodeId := nodeId,
  stakeAmount := stakeAmount)) AS VARCHAR) FROM validators
UNION ALL SELECT 'chain.delegators', nodeId, CAST(to_json(struct_pack(delegator := delegator,
  nodeId := nodeId)) AS VARCHAR) FROM delegators
UNION ALL SELECT 'chain.bridges', sourceChain, CAST(to_json(struct_pack(id := id, amount := amount)) AS VARCHAR)
  FROM bridge_txs"""


@query("sink_payloads", oracle(_SINK_SQL, ("blocks", "transactions", "chains", "validators",
                                           "delegators", "bridge_txs")))
def q_sink_payloads(spark, sf_dir):
    """Every entity encoded to its topic, one (topic, key, value) stream."""
    fx = Fixtures(spark, sf_dir)
    t = lambda df, ent: df.withColumn("topic", F.lit(TOPICS.topic(ent)))
    return J.union_all(
        K.encode_payload(t(fx.blocks, "blocks"), ["chainId", "blockNumber", "blockHash"]),
        K.encode_payload(t(fx.transactions, "transactions"), ["txHash", "chainId", "value"]),
        K.encode_payload(t(fx.chains, "chains"), ["chainId", "chainName"]),
        K.encode_payload(t(fx.validators, "validators"), ["nodeId", "stakeAmount"], key="nodeId"),
        K.encode_payload(t(fx.delegators, "delegators"), ["delegator", "nodeId"], key="nodeId"),
        K.encode_payload(t(fx.bridge_txs, "bridges"), ["id", "amount"], key="sourceChain"))


@query("primary_network_union", oracle("""
SELECT 'chain.validators' AS topic, nodeId AS key FROM validators
UNION ALL SELECT 'chain.delegators', nodeId FROM delegators""", ("validators", "delegators")))
def q_primary_network_union(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    v = fx.validators.select(F.lit(TOPICS.topic("validators")).alias("topic"), F.col("nodeId").alias("key"))
    d = fx.delegators.select(F.lit(TOPICS.topic("delegators")).alias("topic"), F.col("nodeId").alias("key"))
    return J.union_all(v, d)


@query("delegators_join_validators", oracle("""
SELECT d.delegator, d.nodeId, d.stakeAmount, v.stakeAmount AS validatorStake, v.uptime AS validatorUptime
FROM delegators d LEFT JOIN validators v ON d.nodeId = v.nodeId""", ("delegators", "validators")))
def q_delegators_join_validators(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return J.delegators_join_validators(fx.delegators.select("delegator", "nodeId", "stakeAmount"),
                                        fx.validators)


@query("transfers_join_prices", oracle("""
SELECT c.transactionHash, c.logIndex, t.price IS NOT NULL AS priced,
  cast(c.value AS double) / pow(10.0, t.decimals) * t.price AS valueUsd
FROM children c LEFT JOIN tokens t ON lower(c.tokenAddress) = lower(t.address) WHERE c.kind = 'erc20'""",
                                       ("children", "tokens")))
def q_transfers_join_prices(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    transfers = feeds.child_rows(fx, "erc20").select(
        "transactionHash", "logIndex", "value", F.col("erc20Token.address").alias("tokenAddress"))
    return J.transfers_join_prices(transfers, fx.tokens).select(
        "transactionHash", "logIndex", F.col("price").isNotNull().alias("priced"), "valueUsd")


@query("children_join_parent", oracle("""
SELECT c.transactionHash, c.logIndex, t."from" AS parentFrom, t.chainId AS parentChainId
FROM children c JOIN orders_tx t ON c.transactionHash = t.txHash WHERE c.kind = 'erc20'""",
                                      ("children", "orders_tx")))
def q_children_join_parent(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    transfers = feeds.child_rows(fx, "erc20").select("transactionHash", "logIndex")
    parents = fx.orders_tx.select("txHash", "from", "chainId")
    return J.children_join_parent(transfers, parents).select(
        "transactionHash", "logIndex", "parentFrom", "parentChainId")


def _prev_validators(df):
    """Previous snapshot: validators with s_suppkey % 10 = 0 did not exist, and
    those with % 3 = 0 had a different stake."""
    key = F.regexp_extract("nodeId", r"(\d+)$", 1).cast("bigint")
    return df.filter(key % 10 != 0).withColumn(
        "stakeAmount", F.when(key % 3 == 0, F.concat("stakeAmount", F.lit("1"))).otherwise(F.col("stakeAmount")))


@query("snapshot_changes", oracle("""
SELECT c.nodeId, CASE WHEN p.nodeId IS NULL THEN 'validator.created' ELSE 'validator.updated' END AS event_type
FROM validators c LEFT JOIN (
  SELECT nodeId, startTime, endTime, CASE WHEN cast(substr(nodeId, 8) AS bigint) % 3 = 0
    THEN stakeAmount || '1' ELSE stakeAmount END AS stakeAmount, uptime
  FROM validators WHERE cast(substr(nodeId, 8) AS bigint) % 10 <> 0) p ON c.nodeId = p.nodeId
WHERE p.nodeId IS NULL OR c.stakeAmount IS DISTINCT FROM p.stakeAmount
  OR c.startTime IS DISTINCT FROM p.startTime OR c.endTime IS DISTINCT FROM p.endTime
  OR c.uptime IS DISTINCT FROM p.uptime""", ("validators",)))
def q_snapshot_changes(spark, sf_dir):
    cur = Fixtures(spark, sf_dir).validators
    return J.snapshot_changes(cur, _prev_validators(cur), "nodeId", "validator")


# --- set operations -----------------------------------------------------------

@query("blockchains_union", oracle("""
SELECT b.blockchainId, b.vmId, b.subnetId FROM subnets s JOIN blockchains b ON s.regionKey = b.regionKey
UNION ALL SELECT blockchainId, vmId, subnetId FROM blockchains""", ("subnets", "blockchains")))
def q_blockchains_union(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    from_details = P.explode_subnet_chains(feeds.subnets_nested(fx)).select(
        "blockchainId", "vmId", F.col("blockchainSubnetId").alias("subnetId"))
    return J.union_all(from_details, fx.blockchains.select("blockchainId", "vmId", "subnetId"))


@query("subnets_union", oracle("""
SELECT subnetId, 'list' AS src FROM subnets WHERE subnetId <> ''
UNION ALL SELECT subnetId, 'detail' FROM subnets WHERE subnetId <> ''""", ("subnets",)))
def q_subnets_union(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    listed = FL.nonempty_id(fx.subnets).select("subnetId", F.lit("list").alias("src"))
    details = FL.nonempty_id(feeds.subnets_nested(fx)).select("subnetId", F.lit("detail").alias("src"))
    return J.union_all(listed, details)


#: Wire names of the five hourly chain metrics.
_CHAIN_METRICS = {"active_addresses": "activeAddresses", "tx_count": "txCount", "avg_tps": "avgTps",
                  "avg_gas_price": "avgGasPrice", "fees_paid": "feesPaid"}


@query("metrics_union", f"""
SELECT 'staking' AS type, CAST(NULL AS VARCHAR) AS chainId, metric, CAST(NULL AS BIGINT) AS timestamp, value FROM (
  SELECT 'validatorCount' AS metric, cast(validator_count AS double) AS value FROM ({_Q._STAKING_SQL}) a UNION ALL
  SELECT 'delegatorCount', cast(delegator_count AS double) FROM ({_Q._STAKING_SQL}) b UNION ALL
  SELECT 'totalStaked', cast(total_staked AS double) FROM ({_Q._STAKING_SQL}) c) s
UNION ALL SELECT 'teleporter', NULL, metric, NULL, value FROM (
  SELECT 'activeTeleporterBridges' AS metric, cast(active_bridges AS double) AS value FROM ({_Q._BRIDGE_SQL}) a UNION ALL
  SELECT 'teleporterTransactions', cast(bridge_tx_count AS double) FROM ({_Q._BRIDGE_SQL}) b UNION ALL
  SELECT 'totalBridgedBtc', cast(total_bridged AS double) FROM ({_Q._BRIDGE_SQL}) c) b
UNION ALL SELECT 'chain', chainId,
  CASE metric {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _CHAIN_METRICS.items())} END, timestamp, value
FROM ({_Q._long_sql(_Q._LAST_DAY_SQL)}) h""")
def q_metrics_union(spark, sf_dir):
    """One collection as a long stream: staking, bridge and the chains' last day (missing columns NULL)."""
    st = _Q._staking(spark, sf_dir).select(
        F.lit("staking").alias("type"),
        F.expr("stack(3, 'validatorCount', cast(validator_count AS double), 'delegatorCount', cast(delegator_count AS double), "
               "'totalStaked', cast(total_staked AS double)) AS (metric, value)"))
    bridge = P.bridge_metric_rows(_Q._bridge(spark, sf_dir), 0).drop("timestamp")
    hours = _Q.store.last_day(*_Q.stored_hours(spark, sf_dir)).withColumnsRenamed(_CHAIN_METRICS)
    chain = P.metric_long_rows(hours, ["chainId", "window_start"], list(_CHAIN_METRICS.values())).select(
        F.lit("chain").alias("type"), "chainId", "metric", F.col("window_start").alias("timestamp"), "value")
    return J.union_all(st, bridge, chain, allow_missing=True)


# --- ordered operators ----------------------------------------------------------

@query("cumulative_tx", oracle("""
SELECT chainId, blockNumber, cast(sum(txCount) OVER (PARTITION BY chainId ORDER BY cast(blockNumber AS bigint)
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS cumulativeTransactions FROM blocks""",
                               ("blocks",)))
def q_cumulative_tx(spark, sf_dir):
    return W.cumulative_tx(Fixtures(spark, sf_dir).blocks).select(
        "chainId", "blockNumber", "cumulativeTransactions")


@query("block_gap_seconds", oracle("""
SELECT chainId, blockNumber, blockTimestamp - lag(blockTimestamp) OVER (PARTITION BY chainId
  ORDER BY cast(blockNumber AS bigint)) AS gapSeconds FROM blocks""", ("blocks",)))
def q_block_gap_seconds(spark, sf_dir):
    return W.block_gaps(Fixtures(spark, sf_dir).blocks).select("chainId", "blockNumber", "gapSeconds")


@query("go_duration", oracle("""
SELECT chainId, blockNumber, CASE WHEN g IS NULL THEN NULL
  WHEN g >= 3600 THEN cast(g // 3600 AS varchar) || 'h' || cast((g % 3600) // 60 AS varchar) || 'm'
    || cast(g % 60 AS varchar) || 's'
  WHEN g >= 60 THEN cast(g // 60 AS varchar) || 'm' || cast(g % 60 AS varchar) || 's'
  ELSE cast(g AS varchar) || 's' END AS gap_text
FROM (SELECT chainId, blockNumber, blockTimestamp - lag(blockTimestamp) OVER (PARTITION BY chainId
  ORDER BY cast(blockNumber AS bigint)) AS g FROM blocks) q""", ("blocks",)))
def q_go_duration(spark, sf_dir):
    """Block gaps as Go duration text."""
    from chainflow.functions import scalar as C
    gaps = W.block_gaps(Fixtures(spark, sf_dir).blocks)
    return gaps.select("chainId", "blockNumber", C.go_duration("gapSeconds").alias("gap_text"))


@query("first_seen", oracle("""
SELECT chainId, address, min(ts) AS first_ts FROM (
  SELECT chainId, "from" AS address, blockTimestamp AS ts FROM transactions UNION ALL
  SELECT chainId, "to", blockTimestamp FROM transactions) a
WHERE address IS NOT NULL AND address <> '' GROUP BY chainId, address""", ("transactions",)))
def q_first_seen(spark, sf_dir):
    from chainflow.operators import metrics as M
    feat = M.tx_features(Fixtures(spark, sf_dir).transactions)
    return M.first_seen(feat).select("chainId", F.col("item").alias("address"), "first_ts")


@query("chain_continuity", oracle("""
SELECT chainId, unnest(generate_series(prev + 1, n - 1)) AS blockNumber, 'missing' AS kind
FROM (SELECT chainId, cast(blockNumber AS bigint) AS n, lag(cast(blockNumber AS bigint)) OVER (
  PARTITION BY chainId ORDER BY cast(blockNumber AS bigint)) AS prev FROM blocks) q
WHERE n - prev > 1""", ("blocks",)))
def q_chain_continuity(spark, sf_dir):
    return W.chain_continuity(Fixtures(spark, sf_dir).blocks)


# The oracle walks every stretch back from its tip, block by block.
@query("chain_forks", oracle("""
SELECT chainId, n AS blockNumber, blockHash, link, CASE WHEN onWay THEN 'canonical' ELSE 'orphan' END AS status
FROM (
  WITH RECURSIVE r AS MATERIALIZED (
    SELECT chainId, cast(blockNumber AS bigint) AS n, blockHash, min(parentHash) AS parentHash
    FROM block_reports GROUP BY ALL),
  h AS MATERIALIZED (SELECT chainId, n, min(blockHash) AS least FROM r GROUP BY ALL),
  b AS MATERIALIZED (
    SELECT r.*, CASE WHEN h.n IS NULL THEN 'start' WHEN p.n IS NULL THEN 'broken' ELSE 'linked' END AS link,
      coalesce(p.blockHash, h.least) AS up
    FROM r LEFT JOIN h ON h.chainId = r.chainId AND h.n = r.n - 1
    LEFT JOIN r AS p ON p.chainId = r.chainId AND p.n = r.n - 1 AND p.blockHash = r.parentHash),
  walk AS (
    SELECT chainId, n, least AS blockHash FROM h
    WHERE NOT EXISTS (SELECT 1 FROM h AS x WHERE x.chainId = h.chainId AND x.n = h.n + 1)
    UNION ALL
    SELECT b.chainId, b.n - 1, b.up FROM walk JOIN b USING (chainId, n, blockHash) WHERE b.link <> 'start')
  SELECT b.*, walk.n IS NOT NULL AS onWay FROM b LEFT JOIN walk USING (chainId, n, blockHash)
) q""", ("block_reports",)))
def q_chain_forks(spark, sf_dir):
    return W.chain_forks(Fixtures(spark, sf_dir).block_reports)


def _pages_sql(desc: bool, after: int | None) -> str:
    cond = f"WHERE cast(blockNumber AS bigint) > {after}" if after is not None else ""
    d = "DESC" if desc else ""
    edge = "min(n)" if desc else "max(n)"
    return oracle(f"""
SELECT chainId, blockNumber, blockHash, CASE WHEN total > {PAGE} THEN {edge} OVER (PARTITION BY chainId) END
  AS next_token
FROM (SELECT chainId, blockNumber, blockHash, cast(blockNumber AS bigint) AS n,
        row_number() OVER (PARTITION BY chainId ORDER BY cast(blockNumber AS bigint) {d}) AS rn,
        count(*) OVER (PARTITION BY chainId) AS total
      FROM blocks {cond}) q
WHERE rn <= {PAGE}""", ("blocks",))


def _pages(spark, sf_dir, desc=False, after=None):
    b = Fixtures(spark, sf_dir).blocks.withColumn("n", F.col("blockNumber").cast("bigint"))
    return W.keyset_pages(b, "chainId", "n", PAGE, after=after, descending=desc) \
        .select("chainId", "blockNumber", "blockHash", "next_token")


PAGE_TOKEN = 946804  # a page token: block numbers of January 2024 start at 946704


@query("keyset_page", _pages_sql(False, None))
def q_keyset_page(spark, sf_dir):
    """The first page of every chain's blocks in number order, with next tokens."""
    return _pages(spark, sf_dir)


@query("sort_order", _pages_sql(True, None))
def q_sort_order(spark, sf_dir):
    """The same pages in descending order."""
    return _pages(spark, sf_dir, desc=True)


@query("scan_blocks_page", _pages_sql(False, PAGE_TOKEN))
def q_scan_blocks_page(spark, sf_dir):
    """Every chain's block page after a page token."""
    return _pages(spark, sf_dir, after=PAGE_TOKEN)


@query("drain_pages", oracle(f"""
SELECT chainId, blockNumber, (row_number() OVER (PARTITION BY chainId ORDER BY cast(blockNumber AS bigint)) - 1)
  // {PAGE} AS page FROM blocks""", ("blocks",)))
def q_drain_pages(spark, sf_dir):
    """Every page of every chain at once (page = (rank - 1) div 100)."""
    b = Fixtures(spark, sf_dir).blocks.select("chainId", "blockNumber")
    return W.drain_pages(b, "blockNumber", PAGE, partition="chainId")


@query("micro_batch", oracle("""
SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY eventId) - 1) // 100 AS batch,
  eventId FROM event_log""", ("event_log",)))
def q_micro_batch(spark, sf_dir):
    """T08 (deterministic batch form): 100-event batches per event type."""
    ev = Fixtures(spark, sf_dir).event_log.select("event_type", "eventId")
    return W.drain_pages(ev, "eventId", 100, partition="event_type").withColumnRenamed("page", "batch")


# --- filters ----------------------------------------------------------------------

@query("nonempty_id", oracle("SELECT subnetId, subnetName FROM subnets WHERE subnetId <> ''", ("subnets",)))
def q_nonempty_id(spark, sf_dir):
    return FL.nonempty_id(Fixtures(spark, sf_dir).subnets).select("subnetId", "subnetName")


@query("topic_arity", oracle(f"""
SELECT "offset", topic FROM topic_messages WHERE {arity('topic')} >= 3""", ("topic_messages",)))
def q_topic_arity(spark, sf_dir):
    return FL.topic_arity_filter(Fixtures(spark, sf_dir).topic_messages).select("offset", "topic")


@query("quarantine_json", oracle("""
SELECT "offset", topic FROM topic_messages WHERE NOT json_valid("value")""", ("topic_messages",)))
def q_quarantine_json(spark, sf_dir):
    """messages whose payload does not parse leave the main flow."""
    msgs = Fixtures(spark, sf_dir).topic_messages.withColumn(
        "is_corrupt", F.try_parse_json("value").isNull())
    _, bad = decode.split_corrupt(msgs)
    return bad.select("offset", "topic")


_T0, _T1 = 1704844800, 1705708800  # 2024-01-10 and 2024-01-20, UTC


@query("time_range", oracle(f"""
SELECT txHash, blockTimestamp FROM transactions WHERE blockTimestamp >= {_T0} AND blockTimestamp < {_T1}""",
                            ("transactions",)))
def q_time_range(spark, sf_dir):
    tx = Fixtures(spark, sf_dir).transactions.select("txHash", "blockTimestamp")
    return FL.time_range(tx, "blockTimestamp", _T0, _T1)


@query("block_range", oracle("""
SELECT chainId, blockNumber FROM blocks
WHERE cast(blockNumber AS bigint) BETWEEN 947000 AND 947500""", ("blocks",)))
def q_block_range(spark, sf_dir):
    return FL.block_range(Fixtures(spark, sf_dir).blocks.select("chainId", "blockNumber"), 947000, 947500)


def _stored_blocks(spark, sf_dir) -> str:
    path = f"{checkpoint_dir(spark).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    block_store.write_blocks(Fixtures(spark, sf_dir).blocks, path)
    return path


@query("stored_block_range", oracle("""
SELECT chainId, cast(blockNumber AS bigint) AS number, blockHash FROM blocks
WHERE cast(blockNumber AS bigint) BETWEEN 947000 AND 947500""", ("blocks",)))
def q_stored_block_range(spark, sf_dir):
    """F07 over the stored blocks: bounds reach the scan."""
    return block_store.read_numbers(spark, _stored_blocks(spark, sf_dir), 947000, 947500) \
        .select("chainId", "number", "blockHash")


@query("stored_time_range", oracle(f"""
SELECT chainId, blockNumber, blockTimestamp FROM blocks
WHERE blockTimestamp >= {_T0} AND blockTimestamp < {_T1}""", ("blocks",)))
def q_stored_time_range(spark, sf_dir):
    """F06 over the stored blocks: other days are not listed."""
    return block_store.read_times(spark, _stored_blocks(spark, sf_dir), _T0, _T1) \
        .select("chainId", "blockNumber", "blockTimestamp")


@query("stored_block_page", _pages_sql(False, PAGE_TOKEN))
def q_stored_block_page(spark, sf_dir):
    """S03 over the stored blocks: the page token reaches the scan."""
    rows = block_store.read_numbers(spark, _stored_blocks(spark, sf_dir), PAGE_TOKEN + 1)
    return W.keyset_pages(rows, "chainId", "number", PAGE, after=PAGE_TOKEN) \
        .select("chainId", "blockNumber", "blockHash", "next_token")


@query("event_signature", oracle(f"""
SELECT t.txHash, c.logIndex FROM children c JOIN {DELIVERIES} t ON c.orderKey = t.orderKey
WHERE c.kind = 'erc1155'""", ("children", "orders_tx")))
def q_event_signature(spark, sf_dir):
    """webhook log rows whose topic0 is TransferSingle."""
    from chainflow.plans.fanout_queries import webhook_envelopes
    logs = P.explode_logs(webhook_envelopes(Fixtures(spark, sf_dir)))
    return FL.event_signature(logs, [TRANSFER_SINGLE_TOPIC]).select("txHash", "logIndex")


@query("signature_gate", oracle("""
SELECT t.orderKey AS deliveryKey FROM orders_tx t JOIN (SELECT 1 AS copy UNION ALL SELECT 2 AS copy) r
  ON r.copy = 1 OR t.orderKey % 10 = 0
WHERE t.orderKey % 11 <> 0 AND t.orderKey % 13 <> 0""", ("orders_tx",)))
def q_signature_gate(spark, sf_dir):
    """F11 with enforcement on: only deliveries with a valid HMAC signature."""
    d = decode.decode_webhook(feeds.webhook_raw(Fixtures(spark, sf_dir)), WEBHOOK_SECRET)
    return FL.signature_gate(d, enforce=True).select("deliveryKey")


# --- dedup ------------------------------------------------------------------------

_SUPPRESS_SQL = f"""WITH RECURSIVE s AS (
  SELECT chainId, blockNumber, blockTimestamp AS ts, txHash,
    row_number() OVER (PARTITION BY chainId, blockNumber ORDER BY blockTimestamp, txHash) AS rn
  FROM sightings),
r AS (
  SELECT chainId, blockNumber, rn, ts, txHash, ts AS last_emit, true AS emitted FROM s WHERE rn = 1
  UNION ALL
  SELECT s.chainId, s.blockNumber, s.rn, s.ts, s.txHash,
    CASE WHEN s.ts - r.last_emit >= {SUPPRESS_INTERVAL} THEN s.ts ELSE r.last_emit END,
    s.ts - r.last_emit >= {SUPPRESS_INTERVAL}
  FROM r JOIN s ON s.chainId = r.chainId AND s.blockNumber = r.blockNumber AND s.rn = r.rn + 1)
SELECT chainId, blockNumber, ts AS blockTimestamp, txHash FROM r WHERE emitted"""


def _suppress_oracle():
    from chainflow.sources.fixtures import DUCK, _closure, view_sql
    views = ", ".join(f"{n} AS ({view_sql(n, DUCK)})" for n in _closure(["sightings"]))
    return _SUPPRESS_SQL.replace("WITH RECURSIVE s AS (", f"WITH RECURSIVE {views}, s AS (", 1)


@query("suppress_recent", _suppress_oracle())
def q_suppress_recent(spark, sf_dir):
    s = Fixtures(spark, sf_dir).sightings
    return D.suppress_recent(s, ["chainId", "blockNumber"], "blockTimestamp", SUPPRESS_INTERVAL,
                             tiebreak=["txHash"])


CHAIN_POLL = 30  # seconds within which a chain is not published again


def _recent_skip_oracle():
    from chainflow.sources.fixtures import DUCK, _closure, view_sql
    views = ", ".join(f"{n} AS ({view_sql(n, DUCK)})" for n in _closure(["event_log"]))
    return f"""WITH RECURSIVE {views}, s AS (
  SELECT chainId, eventTime, eventId, row_number() OVER (PARTITION BY chainId ORDER BY eventTime, eventId) AS rn FROM event_log),
r AS (
  SELECT chainId, rn, eventTime, eventId, eventTime AS published, true AS emitted FROM s WHERE rn = 1
  UNION ALL
  SELECT s.chainId, s.rn, s.eventTime, s.eventId,
    CASE WHEN s.eventTime - r.published >= {CHAIN_POLL} THEN s.eventTime ELSE r.published END,
    s.eventTime - r.published >= {CHAIN_POLL}
  FROM r JOIN s ON s.chainId = r.chainId AND s.rn = r.rn + 1)
SELECT chainId, eventTime, eventId FROM r WHERE emitted"""


@query("recent_skip", _recent_skip_oracle())
def q_recent_skip(spark, sf_dir):
    """chain events of a chain that was published within the poll interval are skipped; the key is the chain."""
    seen = Fixtures(spark, sf_dir).event_log.select("chainId", "eventTime", "eventId")
    return D.suppress_recent(seen, ["chainId"], "eventTime", CHAIN_POLL, tiebreak=["eventId"])


@query("dedup_message", oracle("""
SELECT cast(orderKey AS varchar) AS messageId, txHash FROM orders_tx WHERE orderKey % 97 <> 0""",
                               ("orders_tx",)))
def q_dedup_message(spark, sf_dir):
    from chainflow.plans.fanout_queries import webhook_envelopes
    env = webhook_envelopes(Fixtures(spark, sf_dir)).select(
        "messageId", F.col("event.transaction.txHash").alias("txHash"), "receivedAt")
    return D.dedup_message(env, "messageId", first_by="receivedAt").drop("receivedAt")


# --- streaming rows in batch form (T09, T10) -------------------------------------

@query("dynamic_chains", oracle(f"""
SELECT b.chainId, b.blockNumber FROM blocks b JOIN (
  SELECT chainId, min(since) AS since FROM (
    SELECT '0' AS chainId, cast(-1 AS bigint) AS since UNION ALL SELECT '1', -1
    UNION ALL SELECT chainId, eventTime FROM event_log WHERE event_type LIKE 'chain.%') s
  GROUP BY chainId) c ON b.chainId = c.chainId AND b.blockTimestamp >= c.since""",
                                ("blocks", "event_log")))
def q_dynamic_chains(spark, sf_dir):
    """T09 (batch form): a block is synced once its chain is monitored —
    seed chains always, others from their first chain event on."""
    fx = Fixtures(spark, sf_dir)
    seed = spark.createDataFrame([(c, -1) for c in SEED_CHAINS], "chainId string, since bigint")
    seen = fx.event_log.filter(F.col("event_type").startswith("chain.")).select(
        "chainId", F.col("eventTime").alias("since"))
    since = seed.unionByName(seen).groupBy("chainId").agg(F.min("since").alias("since"))
    b = fx.blocks.select("chainId", "blockNumber", "blockTimestamp")
    return b.join(since, "chainId").filter(F.col("blockTimestamp") >= F.col("since")) \
        .select("chainId", "blockNumber")


@query("webhook_fanout", oracle(f"""
SELECT output, rows FROM (
  SELECT count(DISTINCT (t.orderKey, t.copy)) AS transactions,
    count(*) FILTER (WHERE c.kind = 'erc20') AS erc20,
    count(*) FILTER (WHERE c.kind = 'erc721') AS erc721,
    count(*) FILTER (WHERE c.kind = 'erc1155') AS erc1155,
    count(*) FILTER (WHERE c.lineStatus = 'F') AS internal,
    count(c.orderKey) AS logs
  FROM {DELIVERIES} t LEFT JOIN children c ON c.orderKey = t.orderKey) q
UNPIVOT (rows FOR output IN (transactions, erc20, erc721, erc1155, internal, logs))""",
                                ("children", "orders_tx")))
def q_webhook_fanout(spark, sf_dir):
    """T10 (batch form): row counts of the six outputs of one envelope pass,
    computed in a single aggregation over the envelopes."""
    from chainflow.plans.fanout_queries import webhook_envelopes
    tx = P.tx_rows(webhook_envelopes(Fixtures(spark, sf_dir)))
    sizes = tx.agg(
        F.count("*").alias("transactions"),
        F.sum(F.size("erc20Transfers")).alias("erc20"),
        F.sum(F.size("erc721Transfers")).alias("erc721"),
        F.sum(F.size("erc1155Transfers")).alias("erc1155"),
        F.sum(F.size("internalTransactions")).alias("internal"),
        F.sum(F.size("logs")).alias("logs"))
    return sizes.unpivot([], ["transactions", "erc20", "erc721", "erc1155", "internal", "logs"],
                         "output", "rows")


# --- per-entity sinks (K07-K25) ---------------------------------------------------
# Each entity is encoded as (topic, key, value JSON) for its topic, with the fields
# of its wire form.  Ratio metrics travel as long rows (K06): their JSON text would
# depend on how an engine prints a double.

def _sink(key, entity, spark_fn, cols, duck_from, views, key_col="chainId", topic_entity=None):
    """``cols`` are names, or (name, DuckDB expression) where the view has no such column."""
    topic = TOPICS.topic(topic_entity or entity)
    pairs = [c if isinstance(c, tuple) else (c, f'"{c}"') for c in cols]
    packed = ", ".join(f'"{name}" := {expr}' for name, expr in pairs)
    sql = oracle(f"""SELECT '{topic}' AS topic, cast("{key_col}" AS varchar) AS key,
  CAST(to_json(struct_pack({packed})) AS VARCHAR) AS value FROM {duck_from}""", views)

    def run(spark, sf_dir):
        df = spark_fn(Fixtures(spark, sf_dir)).withColumn("topic", F.lit(topic))
        return K.encode_payload(df, [name for name, _ in pairs], key=key_col)
    query(key, sql)(run)


def _kind(kind_filter):
    return (f"(SELECT c.*, t.chainId, t.txHash FROM children c JOIN orders_tx t ON c.orderKey = t.orderKey "
            f"WHERE {kind_filter}) x")


def _children(kind):
    return lambda fx: feeds.child_rows(fx, kind, ("chainId",))


_CH = ("children", "orders_tx")
_TX_FIELDS = ["blockHash", "blockNumber", "from", "gas", "gasPrice", "txHash", "txStatus", "input", "nonce", "to",
              "transactionIndex", "value", "chainId", "receiptGasUsed", "receiptEffectiveGasPrice", "blockTimestamp"]
_TOKEN = ("struct_pack(address := tokenAddress, name := 'Token ' || right(tokenAddress, 4), "
          "symbol := 'T' || right(tokenAddress, 4)")
_VALUE_18 = vwd("value", 18)
_HEAD = ["transactionHash"]
_TAIL = ["blockTimestamp", "logIndex"]

_sink("sink_transactions", "transactions", lambda fx: fx.transactions, _TX_FIELDS, "transactions", ("transactions",))
_sink("sink_single_tx", "transactions", lambda fx: P.flatten_tx_detail(feeds.tx_details(fx)),
      ["txHash", "blockHash", "blockNumber", "blockTimestamp", "chainId", ("from", 'lower("from")'),
       ("to", 'lower("to")'), "transactionIndex", "gasPrice", "txStatus", "value"], "transactions", ("transactions",))
_sink("sink_erc20", "erc20", _children("erc20"),
      [*_HEAD, ("type", "'ERC20'"), "from", "to", "value", *_TAIL,
       ("erc20Token", f"{_TOKEN}, decimals := 18, \"valueWithDecimals\" := {_VALUE_18})")],
      _kind("c.kind = 'erc20'"), _CH)
_sink("sink_erc721", "erc721", _children("erc721"),
      [*_HEAD, ("type", "'ERC721'"), "from", "to", "tokenId", *_TAIL, ("erc721Token", f"{_TOKEN})")],
      _kind("c.kind = 'erc721'"), _CH)
_sink("sink_erc1155", "erc1155", _children("erc1155"),
      [*_HEAD, ("type", "'ERC1155'"), "from", "to", "tokenId", "value", *_TAIL, ("erc1155Token", f"{_TOKEN})")],
      _kind("c.kind = 'erc1155'"), _CH)
_sink("sink_internal", "internal", _children("internal"),
      [("from", '"to"'), ("to", "tokenAddress"), "internalTxType", "value", "gasUsed", ("gasLimit", "'100000'"),
       "transactionHash"], _kind("c.lineStatus = 'F'"), _CH)
_sink("sink_logs", "logs", lambda fx: _children("logs")(fx).withColumn("topic2", F.coalesce("topic2", F.lit(""))),
      [("address", "tokenAddress"),
       ("topic0", f"CASE WHEN kind = 'erc1155' THEN '{feeds.TRANSFER_SINGLE_TOPIC}' ELSE '{feeds.TRANSFER_TOPIC}' END"),
       ("topic1", '"from"'), ("topic2", "CASE WHEN lineStatus = 'F' THEN '' ELSE \"to\" END"), ("data", "value"),
       ("transactionIndex", "0"), "logIndex", ("removed", "false")], _kind("true"), _CH)
_sink("sink_chains", "chains", lambda fx: fx.chains.withColumn("networkToken", F.struct(
    F.col("tokenName").alias("name"), F.col("tokenSymbol").alias("symbol"), F.col("tokenDecimals").alias("decimals"),
    F.col("tokenLogoUri").alias("logoUri"), F.col("tokenDescription").alias("description")))
      .withColumn("enabledFeatures", F.filter(F.split("features", ","), lambda x: x != "")),
      ["chainId", "status", "chainName", "description", "platformChainId", "subnetId", "vmId", "vmName", "explorerUrl",
       "rpcUrl", "wsUrl", "isTestnet", "private", "chainLogoUri",
       ("enabledFeatures", "list_filter(string_split(features, ','), lambda x: x <> '')"),
       ("networkToken", 'struct_pack(name := tokenName, symbol := tokenSymbol, decimals := tokenDecimals, '
                        '"logoUri" := tokenLogoUri, description := tokenDescription)')], "chains", ("chains",))
_sink("sink_blocks", "blocks", lambda fx: W.cumulative_tx(fx.blocks).withColumn(
    "cumulativeTransactions", F.col("cumulativeTransactions").cast("string")),
      ["chainId", "blockNumber", "blockTimestamp", "blockHash", "txCount", "baseFee", "gasUsed", "gasLimit",
       "parentHash", "feesSpent", ("cumulativeTransactions", """cast(cast(sum(txCount) OVER (PARTITION BY chainId
         ORDER BY cast(blockNumber AS bigint)) AS bigint) AS varchar)""")], "blocks", ("blocks",))
_sink("sink_subnets", "subnets", lambda fx: FL.nonempty_id(feeds.subnets_nested(fx)).withColumn(
    "blockchains", F.transform(F.array_sort(F.transform("blockchains", lambda b: b["blockchainId"])), lambda b: b)),
      ["subnetId", ("blockchains", "list_sort(coalesce(ids, []))")],
      "(SELECT s.*, (SELECT list(blockchainId) FROM blockchains b WHERE b.subnetId = s.subnetId) AS ids "
      "FROM subnets s WHERE s.subnetId <> '') x", ("subnets", "blockchains"), key_col="subnetId")
_sink("sink_blockchains", "blockchains", lambda fx: fx.blockchains, ["blockchainId", "vmId", "subnetId"],
      "blockchains", ("blockchains",), key_col="blockchainId")
_sink("sink_validators", "validators", lambda fx: fx.validators.withColumn("uptime", F.coalesce("uptime", F.lit(0))),
      ["nodeId", "startTime", "endTime", "stakeAmount", ("uptime", "coalesce(uptime, 0)")],
      "validators", ("validators",), key_col="nodeId")
_sink("sink_delegators", "delegators", lambda fx: fx.delegators,
      ["delegator", "nodeId", "stakeAmount", "startTime", "endTime", "rewardAddress"],
      "delegators", ("delegators",), key_col="nodeId")
_sink("sink_bridges", "bridges", lambda fx: fx.bridge_txs,
      ["id", "sourceChain", "destChain", "asset", "amount", "sender", "receiver", "status"],
      "bridge_txs", ("bridge_txs",), key_col="sourceChain")


# Metric families: each all its measures over its own window, under wire names.  A field that a window has no
# value for (no block yet, no gap yet) is left out of the message; the window is sent all the same.  Messages are compared
# field by field as they are read back, because two engines print a double in different ways.
def _family_sink(key, entity, make, period_s, duck, fields):
    """``fields``: wire name -> column of the family's table."""
    topic = TOPICS.topic(entity if TOPICS.topic(entity) else "metrics")  # an unset topic falls back (K04)
    names = {"chainId": "chainId", "timestamp": "window_start", "period": None, **fields}
    period = f"{period_s // 3600}h0m0s" if period_s % 3600 == 0 else f"{period_s // 60}m0s"
    columns = ", ".join((f"'{period}'" if c is None else f'"{c}"') + f' AS "{n}"' for n, c in names.items())
    sql = f"SELECT '{topic}' AS topic, chainId AS key, {columns} FROM ({duck}) family"

    def run(spark, sf_dir):
        df = make(spark, sf_dir).withColumn("topic", F.lit(topic)).select("topic", *[
            (C.go_duration(F.lit(period_s)) if c is None else F.col(c)).alias(n) for n, c in names.items()])
        messages = K.encode_payload(df, list(names))
        wire = df.drop("topic").schema
        return messages.select("topic", "key", F.from_json("value", wire).alias("m")).select("topic", "key", "m.*")
    query(key, sql)(run)


def _metric_sinks():
    from chainflow.operators import metrics as M
    from chainflow.plans import metric_queries as Q

    def of(fn, *window):
        def make(spark, sf_dir):
            fx = Fixtures(spark, sf_dir)
            return fn(fx.transactions, fx.blocks, *window)
        return make

    _family_sink("sink_activity", "metrics.activity", of(M.activity, 1800, 300), 1800, Q.activity_sql(1800, 300), {
        "activeAddresses": "active_addresses", "activeSenders": "active_senders", "newAddresses": "new_addresses",
        "uniqueContracts": "unique_contracts", "txCount": "tx_count", "successfulTxCount": "success_count",
        "failedTxCount": "fail_count", "averageTxPerBlock": "avg_tx_per_block", "averageTxFee": "avg_tx_fee",
        "totalGasUsed": "gas_used"})
    _family_sink("sink_performance", "metrics.performance", of(M.performance, 900, 60), 900, Q.perf_sql(900, 60), {
        "avgTps": "avg_tps", "maxTps": "max_tps", "avgGps": "avg_gps", "maxGps": "max_gps", "blockTime": "block_time",
        "currentBlockTime": "current_block_time"})
    _family_sink("sink_gas", "metrics.gas", of(M.gas, 1800, 300), 1800, Q.gas_sql(1800, 300), {
        "averageGasPrice": "avg_gas_price", "medianGasPrice": "median_gas_price", "minimumGasPrice": "min_gas_price",
        "maximumGasPrice": "max_gas_price", "totalGasUsed": "gas_used", "averageGasLimit": "avg_gas_limit",
        "averageGasUsed": "avg_gas_used", "gasUtilizationRate": "gas_utilization_rate", "gasEfficiency": "gas_efficiency",
        "feesPaid": "fees_paid"})
    _family_sink("sink_cumulative", "metrics.cumulative", lambda s, d: Q.cumulative(s, d, 900), 900, Q.cumulative_sql(900), {
        "totalTxs": "total_txs", "totalAddresses": "cumulative_addresses", "totalActiveAccounts": "cumulative_active_accounts",
        "totalContracts": "cumulative_contracts", "totalDeployers": "cumulative_deployers", "totalTokens": "cumulative_tokens",
        "totalGasUsed": "total_gas_used", "totalFeesCollected": "total_fees_collected",
        "totalBlocksProduced": "total_blocks_produced"})
    _family_sink("sink_metrics", "metrics", Q.hourly, 3600, Q.hourly_sql(), {
        "activeAddresses": "active_addresses", "txCount": "tx_count", "avgTps": "avg_tps", "avgGasPrice": "avg_gas_price",
        "feesPaid": "fees_paid"})


_metric_sinks()
