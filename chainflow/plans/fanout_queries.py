"""Registered fan-out / projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainflow.operators import fanout as P
from chainflow.plans.duck import DELIVERIES, part, arity, vwd
from chainflow.plans.registry import query
from chainflow.sources import decode, feeds
from chainflow.sources.feeds import WEBHOOK_SECRET
from chainflow.sources.fixtures import Fixtures, duck_with


def webhook_envelopes(fx: Fixtures):
    """Decoded, non-corrupt webhook envelopes (shared by several queries)."""
    good, _ = decode.split_corrupt(decode.decode_webhook(feeds.webhook_raw(fx), WEBHOOK_SECRET), parsed=decode.ENVELOPE)
    return good


MONITORED_CHAIN = "9000"  # the configured chain a head stream belongs to

_CHILD = "FROM children c JOIN orders_tx t ON c.orderKey = t.orderKey"


@query("explode_erc20", duck_with(f"""
SELECT t.txHash, t.chainId, t.blockNumber, c.transactionHash, c.logIndex, c."from", c."to",
  c.value, c.blockTimestamp, c.tokenAddress, {vwd('c.value', 18)} AS valueWithDecimals
{_CHILD} WHERE c.kind = 'erc20'""", "children", "orders_tx"))
def q_explode_erc20(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return P.explode_erc20(feeds.transactions_nested(fx)).select(
        "txHash", "chainId", "blockNumber", "transactionHash", "logIndex", "from", "to",
        "value", "blockTimestamp", F.col("erc20Token.address").alias("tokenAddress"),
        F.col("erc20Token.valueWithDecimals").alias("valueWithDecimals"))


@query("explode_erc721", duck_with(f"""
SELECT t.txHash, t.chainId, t.blockNumber, c.transactionHash, c.logIndex, c."from", c."to",
  c.tokenId, c.blockTimestamp, c.tokenAddress
{_CHILD} WHERE c.kind = 'erc721'""", "children", "orders_tx"))
def q_explode_erc721(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return P.explode_erc721(feeds.transactions_nested(fx)).select(
        "txHash", "chainId", "blockNumber", "transactionHash", "logIndex", "from", "to",
        "tokenId", "blockTimestamp", F.col("erc721Token.address").alias("tokenAddress"))


@query("explode_erc1155", duck_with(f"""
SELECT t.txHash, t.chainId, t.blockNumber, c.transactionHash, c.logIndex, c."from", c."to",
  c.tokenId, c.value, c.blockTimestamp, c.tokenAddress
{_CHILD} WHERE c.kind = 'erc1155'""", "children", "orders_tx"))
def q_explode_erc1155(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return P.explode_erc1155(feeds.transactions_nested(fx)).select(
        "txHash", "chainId", "blockNumber", "transactionHash", "logIndex", "from", "to",
        "tokenId", "value", "blockTimestamp", F.col("erc1155Token.address").alias("tokenAddress"))


@query("explode_internal", duck_with(f"""
SELECT t.txHash, t.chainId, t.blockNumber, t.blockTimestamp, c."to" AS "from",
  c.tokenAddress AS "to", c.internalTxType, c.value, c.gasUsed, '100000' AS gasLimit,
  c.transactionHash
{_CHILD} WHERE c.lineStatus = 'F'""", "children", "orders_tx"))
def q_explode_internal(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return P.explode_internal(feeds.transactions_nested(fx))


@query("explode_logs", duck_with(f"""
SELECT t.txHash, t.chainId, t.blockNumber, t.blockTimestamp, c.tokenAddress AS address,
  CASE WHEN c.kind = 'erc1155'
    THEN '0xc3d58168c5ae7397731d063d5bbf3d657854427343f4c083240f7aacaa2d0f62'
    ELSE '0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef' END AS topic0,
  c."from" AS topic1, CASE WHEN c.lineStatus = 'F' THEN NULL ELSE c."to" END AS topic2,
  CAST(NULL AS VARCHAR) AS topic3, c.value AS data, 0 AS transactionIndex, c.logIndex,
  false AS removed
FROM children c JOIN {DELIVERIES} t ON c.orderKey = t.orderKey""", "children", "orders_tx"))
def q_explode_logs(spark, sf_dir):
    """Log rows of every decoded webhook delivery (duplicates included)."""
    fx = Fixtures(spark, sf_dir)
    return P.explode_logs(webhook_envelopes(fx), logs_from="transaction")


@query("tx_rows", duck_with(f"""
SELECT t.txHash, t.chainId, t.blockNumber, t.value, t.txStatus,
  cast(count(*) FILTER (WHERE c.kind = 'erc20') AS int) AS n_erc20,
  cast(count(*) FILTER (WHERE c.kind = 'erc721') AS int) AS n_erc721,
  cast(count(*) FILTER (WHERE c.kind = 'erc1155') AS int) AS n_erc1155,
  cast(count(*) FILTER (WHERE c.lineStatus = 'F') AS int) AS n_internal,
  cast(count(c.orderKey) AS int) AS n_logs
FROM {DELIVERIES} t LEFT JOIN children c ON c.orderKey = t.orderKey
GROUP BY t.orderKey, t.copy, t.txHash, t.chainId, t.blockNumber, t.value, t.txStatus""",
                          "children", "orders_tx"))
def q_tx_rows(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    rows = P.tx_rows(webhook_envelopes(fx))
    return rows.select("txHash", "chainId", "blockNumber", "value", "txStatus",
                       F.size("erc20Transfers").alias("n_erc20"),
                       F.size("erc721Transfers").alias("n_erc721"),
                       F.size("erc1155Transfers").alias("n_erc1155"),
                       F.size("internalTransactions").alias("n_internal"),
                       F.size("logs").alias("n_logs"))


@query("include_flags", duck_with("""
SELECT t.txHash, cast(count(c.orderKey) FILTER (WHERE c.lineStatus = 'F') AS int) AS n_internal,
  false AS has_logs
FROM orders_tx t LEFT JOIN children c ON c.orderKey = t.orderKey GROUP BY t.txHash""",
                                  "children", "orders_tx"))
def q_include_flags(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    tx = P.include_flags(feeds.transactions_nested(fx), include_logs=False, include_internal=True)
    return tx.select("txHash", F.size("internalTransactions").alias("n_internal"),
                     F.lit("logs" in tx.columns).alias("has_logs"))


@query("flatten_tx_detail", duck_with("""
SELECT txHash, blockHash, blockNumber, blockTimestamp, chainId, lower("from") AS "from",
  lower("to") AS "to", transactionIndex, receiptGasUsed, gas, gasPrice, txStatus,
  2 AS type, nonce, value, substr(input, 1, 10) AS input
FROM transactions""", "transactions"))
def q_flatten_tx_detail(spark, sf_dir):
    return P.flatten_tx_detail(feeds.tx_details(Fixtures(spark, sf_dir)))


@query("unwrap_events", duck_with("""
SELECT chainId, blockNumber, blockTimestamp, blockHash, txCount, gasUsed, feesSpent
FROM blocks""", "blocks"))
def q_unwrap_events(spark, sf_dir):
    """Block events arrive wrapped as ``{"block": {...}}``; unwrap to block rows."""
    fx = Fixtures(spark, sf_dir)
    wrapped = fx.blocks.select(F.to_json(F.struct(F.struct("*").alias("block"))).alias("value"))
    decoded = wrapped.select(F.from_json("value", "struct<block:" + _block_ddl() + ">").alias("e"))
    return P.unwrap_events(decoded, "e.block").select(
        "chainId", "blockNumber", "blockTimestamp", "blockHash", "txCount", "gasUsed", "feesSpent")


def _block_ddl():
    from chainflow import schemas as S
    return S.BLOCK


@query("explode_subnet_chains", duck_with("""
SELECT s.subnetId, b.blockchainId, b.vmId, b.subnetId AS blockchainSubnetId
FROM subnets s JOIN blockchains b ON s.regionKey = b.regionKey""", "subnets", "blockchains"))
def q_explode_subnet_chains(spark, sf_dir):
    subnets = feeds.subnets_nested(Fixtures(spark, sf_dir))
    return P.explode_subnet_chains(subnets)


@query("stamp_live", duck_with(f"""
SELECT topic, "offset", {part('topic', 2)} AS type, {part('topic', 3)} AS chainId,
  eventTime AS receivedAt
FROM topic_messages WHERE {arity('topic')} >= 3""", "topic_messages"))
def q_stamp_live(spark, sf_dir):
    from chainflow.operators import filters
    msgs = filters.topic_arity_filter(Fixtures(spark, sf_dir).topic_messages)
    return P.stamp_live(msgs, F.col("eventTime")).select("topic", "offset", "type", "chainId",
                                                         "receivedAt")


@query("live_envelope", duck_with(f"""
SELECT "offset", '{{"type":"' || {part('topic', 2)} || '","chainId":"' || {part('topic', 3)}
  || '","data":' || to_json("value") || ',"timestamp":' || cast(eventTime AS varchar) || '}}' AS envelope
FROM topic_messages WHERE {arity('topic')} >= 3""", "topic_messages"))
def q_live_envelope(spark, sf_dir):
    from chainflow.operators import filters
    msgs = filters.topic_arity_filter(Fixtures(spark, sf_dir).topic_messages)
    stamped = P.stamp_live(msgs, F.col("eventTime"))
    return P.live_envelope(stamped, data_col="value").select("offset", "envelope")


@query("stamp_chain", duck_with("""
SELECT blockNumber, blockHash, blockTimestamp, '9000' AS chainId FROM blocks""", "blocks"))
def q_stamp_chain(spark, sf_dir):
    """Blocks looked up for the monitored chain's head stream get its id stamped."""
    blocks = Fixtures(spark, sf_dir).blocks.select("blockNumber", "blockHash", "blockTimestamp")
    return P.stamp_chain(blocks, MONITORED_CHAIN)


@query("network_token", duck_with("""
SELECT chainId, tokenName AS networkTokenName, tokenSymbol AS networkTokenSymbol,
  tokenDecimals AS networkTokenDecimals, unnest(string_split(features, ',')) AS feature
FROM chains WHERE features <> ''
UNION ALL
SELECT chainId, tokenName, tokenSymbol, tokenDecimals, NULL FROM chains WHERE features = ''""",
                                  "chains"))
def q_network_token(spark, sf_dir):
    chains = feeds.chains_nested(Fixtures(spark, sf_dir))
    return P.network_token(chains).select("chainId", "networkTokenName", "networkTokenSymbol",
                                          "networkTokenDecimals", "feature")
