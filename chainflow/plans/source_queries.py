"""Registered readers (S01-S21) and scalar-function queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chainflow import schemas as S
from chainflow.functions import scalar as C
from chainflow.operators import fanout as P
from chainflow.operators import filters as FL
from chainflow.operators.lookups import small
from chainflow.plans.duck import part, vwd
from chainflow.plans.metric_queries import oracle
from chainflow.plans.registry import query
from chainflow.session import checkpoint_dir
from chainflow.sources import decode, feeds, topic_log
from chainflow.sources.feeds import WEBHOOK_SECRET
from chainflow.sources.fixtures import Fixtures

_DIGITS = lambda c: F.regexp_extract(c, r"(\d+)$", 1).cast("bigint")
_COPIES = """FROM orders_tx t JOIN (SELECT 1 AS copy UNION ALL SELECT 2 AS copy) r
  ON r.copy = 1 OR t.orderKey % 10 = 0"""


def _struct_of(df):
    return F.struct(*[F.col(c) for c in df.columns])


# --- landed REST pages (S01-S11) ---------------------------------------------

def _scan_chains(spark, sf_dir):
    chains = feeds.chains_nested(Fixtures(spark, sf_dir))
    docs = feeds.landed_pages(chains, _struct_of(chains), "chains", F.col("chainId").cast("bigint"), 10)
    return decode.good_items(decode.decode_pages(docs, S.CHAIN, "chains"))


_CHAINS_SQL = """SELECT chainId, chainName, isTestnet, private,
  cast(CASE WHEN features = '' THEN 0 ELSE len(string_split(features, ',')) END AS int) AS n_features,
  tokenSymbol, tokenDecimals FROM chains"""


def _chain_cols(df):
    return df.select("chainId", "chainName", "isTestnet", "private",
                     F.size("enabledFeatures").alias("n_features"),
                     F.col("networkToken.symbol").alias("tokenSymbol"),
                     F.col("networkToken.decimals").alias("tokenDecimals"))


@query("scan_chains", oracle(_CHAINS_SQL, ("chains",)))
def q_scan_chains(spark, sf_dir):
    return _chain_cols(_scan_chains(spark, sf_dir))


@query("lookup_chain", oracle(_CHAINS_SQL + """
WHERE chainId IN (SELECT chainId FROM event_log WHERE event_type LIKE 'chain.%')""", ("chains", "event_log")))
def q_lookup_chain(spark, sf_dir):
    """S02 (set form): details of every chain named by a chain event."""
    fx = Fixtures(spark, sf_dir)
    wanted = fx.event_log.filter(F.col("event_type").startswith("chain.")).select("chainId")
    return _chain_cols(_scan_chains(spark, sf_dir).join(wanted, "chainId", "left_semi"))


@query("scan_validators", oracle("SELECT * FROM validators", ("validators",)))
def q_scan_validators(spark, sf_dir):
    v = Fixtures(spark, sf_dir).validators
    docs = feeds.landed_pages(v, _struct_of(v), "validators", _DIGITS("nodeId"), 50)
    return decode.good_items(decode.decode_pages(docs, S.VALIDATOR, "validators"))


@query("lookup_validator", oracle("""
SELECT * FROM validators WHERE nodeId IN (SELECT nodeId FROM delegators)""", ("validators", "delegators")))
def q_lookup_validator(spark, sf_dir):
    """S06 (set form): the validator of every delegation.

    Single-validator responses arrive wrapped as ``{"validator": {...}}``.
    """
    fx = Fixtures(spark, sf_dir)
    v = fx.validators
    docs = v.select(F.to_json(F.struct(_struct_of(v).alias("validator"))).alias("value"))
    found = decode.good_items(decode.decode_single(docs, S.VALIDATOR, "validator"))
    return found.join(fx.delegators.select("nodeId"), "nodeId", "left_semi")


@query("scan_delegators", oracle("SELECT * FROM delegators", ("delegators",)))
def q_scan_delegators(spark, sf_dir):
    d = Fixtures(spark, sf_dir).delegators
    docs = feeds.landed_pages(d, _struct_of(d), "delegations", _DIGITS("delegator"), 50)
    return decode.good_items(decode.decode_pages(docs, S.DELEGATOR, "delegations"))


_SUBNET_SQL = """SELECT s.subnetId, cast(count(b.blockchainId) AS int) AS n_blockchains
FROM subnets s LEFT JOIN blockchains b ON s.regionKey = b.regionKey GROUP BY s.subnetId"""


def _scan_subnets(spark, sf_dir):
    sn = feeds.subnets_nested(Fixtures(spark, sf_dir))
    docs = feeds.landed_pages(sn, _struct_of(sn), "subnets",
                              F.coalesce(F.col("subnetId").try_cast("bigint"), F.lit(-1)), 10)
    return decode.good_items(decode.decode_pages(docs, S.SUBNET, "subnets"))


@query("scan_subnets", oracle(_SUBNET_SQL, ("subnets", "blockchains")))
def q_scan_subnets(spark, sf_dir):
    return _scan_subnets(spark, sf_dir).select("subnetId", F.size("blockchains").alias("n_blockchains"))


@query("lookup_subnet", oracle(f"""SELECT * FROM ({_SUBNET_SQL}) q
WHERE subnetId IN (SELECT subnetId FROM chains)""", ("subnets", "blockchains", "chains")))
def q_lookup_subnet(spark, sf_dir):
    """S09 (set form): the subnet of every chain; detail wrapped as ``{"subnet": {...}}``."""
    fx = Fixtures(spark, sf_dir)
    sn = feeds.subnets_nested(fx)
    docs = sn.select(F.to_json(F.struct(_struct_of(sn).alias("subnet"))).alias("value"))
    got = decode.good_items(decode.decode_single(docs, S.SUBNET, "subnet")).join(
        fx.chains.select("subnetId"), "subnetId", "left_semi")
    return got.select("subnetId", F.size("blockchains").alias("n_blockchains"))


@query("scan_blockchains", oracle("SELECT blockchainId, vmId, subnetId FROM blockchains", ("blockchains",)))
def q_scan_blockchains(spark, sf_dir):
    b = Fixtures(spark, sf_dir).blockchains.select("blockchainId", "vmId", "subnetId")
    docs = feeds.landed_pages(b, _struct_of(b), "blockchains", _DIGITS("blockchainId"), 10)
    return decode.good_items(decode.decode_pages(docs, S.BLOCKCHAIN, "blockchains"))


#: Asked (source, destination) pairs: some without any transaction, one with a chain that nobody knows.
_ROUTES = """SELECT DISTINCT 'C' || cast(n_nationkey % 4 AS string) AS sourceChain,
  'C' || cast((n_nationkey * 3 + 1) % 5 AS string) AS destChain FROM nation"""


@query("scan_bridge_txs", oracle(f"""
SELECT id, sourceChain, destChain, asset, amount, sender, receiver, status FROM bridge_txs
WHERE (sourceChain, destChain) IN ({_ROUTES.replace("AS string", "AS varchar")})""", ("bridge_txs",)))
def q_scan_bridge_txs(spark, sf_dir):
    """S11 (set form): bridge transactions of the asked (source, destination) pairs."""
    fx = Fixtures(spark, sf_dir)
    b = fx.bridge_txs.drop("blockTimestamp")
    docs = feeds.landed_pages(b, _struct_of(b), "transactions", _DIGITS("id"), 100)
    rows = decode.good_items(decode.decode_pages(docs, S.BRIDGE_TX, "transactions"))
    key = F.col("n_nationkey").cast("int")
    asked = fx.table("nation").select(
        F.concat(F.lit("C"), (key % 4).cast("string")).alias("sourceChain"),
        F.concat(F.lit("C"), ((key * 3 + 1) % 5).cast("string")).alias("destChain")).distinct()
    return rows.join(asked, ["sourceChain", "destChain"], "left_semi")


@query("lookup_token", oracle("""
SELECT address, symbol, decimals, price FROM tokens
WHERE lower(address) IN (SELECT lower(tokenAddress) FROM children WHERE kind = 'erc20')""",
                              ("tokens", "children")))
def q_lookup_token(spark, sf_dir):
    """S12 (set form): token details of every token seen in an ERC20 transfer."""
    fx = Fixtures(spark, sf_dir)
    t = fx.tokens
    docs = t.select(F.to_json(F.struct("address", "name", "symbol", "decimals", "logoUri",
                                       F.struct(F.col("price").alias("value"),
                                                F.col("currencyCode")).alias("price"))).alias("value"))
    tokens = decode.good_items(decode.decode_single(docs, S.TOKEN))
    seen = feeds.child_rows(fx, "erc20").select(
        F.lower("erc20Token.address").alias("_a")).distinct()
    return tokens.join(seen, F.lower(tokens["address"]) == seen["_a"], "left_semi").select(
        "address", "symbol", "decimals", F.col("price.value").alias("price"))


@query("lookup_tx_detail", oracle("""
SELECT txHash, lower("from") AS "from", lower("to") AS "to", transactionIndex, txStatus
FROM transactions WHERE txHash IN (SELECT '0x' || sha256(cast(o_orderkey AS varchar)) FROM orders)""", ("transactions",)))
def q_lookup_tx_detail(spark, sf_dir):
    """S13 (set form): details of asked hashes, one for each order, most of them of no transaction; flattened."""
    fx = Fixtures(spark, sf_dir)
    wanted = fx.table("orders").select(
        F.concat(F.lit("0x"), F.sha2(F.col("o_orderkey").cast("string").cast("binary"), 256)).alias("_h"))
    details = feeds.tx_details(fx)
    hit = details.join(wanted, details["nativeTransaction.hash"] == wanted["_h"], "left_semi")
    return P.flatten_tx_detail(hit).select("txHash", "from", "to", "transactionIndex", "txStatus")


@query("lookup_block", oracle("""
SELECT k.chainId, k.id, b.blockNumber, b.blockHash FROM keys k
JOIN blocks b ON k.chainId = b.chainId AND (k.id = b.blockNumber OR k.id = b.blockHash)""", ("blocks",),
                              ["""keys AS (SELECT chainId, CASE WHEN cast(blockNumber AS bigint) % 7 = 0
  THEN blockHash ELSE blockNumber END AS id FROM blocks WHERE cast(blockNumber AS bigint) % 7 IN (0, 1))"""]))
def q_lookup_block(spark, sf_dir):
    """S04 (set form): blocks by number or by hash, for a table of lookup ids.

    ``number = id OR hash = id`` would plan as a nested loop; it runs as two
    equi-joins on (chainId, number) and (chainId, hash), unioned.
    """
    blocks = Fixtures(spark, sf_dir).blocks.select("chainId", "blockNumber", "blockHash")
    n = F.col("blockNumber").cast("bigint")
    keys = blocks.filter((n % 7).isin(0, 1)).select(
        F.col("chainId").alias("kChain"),
        F.when(n % 7 == 0, F.col("blockHash")).otherwise(F.col("blockNumber")).alias("id"))
    by_num = keys.join(blocks, (F.col("kChain") == F.col("chainId")) & (F.col("id") == F.col("blockNumber")))
    by_hash = keys.join(blocks, (F.col("kChain") == F.col("chainId")) & (F.col("id") == F.col("blockHash")))
    pick = lambda j: j.select("chainId", "id", "blockNumber", "blockHash")
    return pick(by_num).unionByName(pick(by_hash))


# --- wire decoders (S18-S21) ---------------------------------------------------

@query("newheads_decode", oracle("""
SELECT chainId, blockTimestamp AS receivedAt, cast(blockNumber AS bigint) % 89 = 0 AS is_corrupt,
  CASE WHEN cast(blockNumber AS bigint) % 89 = 0 THEN NULL ELSE 'eth_subscription' END AS method,
  CASE WHEN cast(blockNumber AS bigint) % 89 = 0 THEN NULL
       WHEN cast(blockNumber AS bigint) % 50 = 0 THEN '' ELSE blockHash END AS hash
FROM blocks
UNION ALL SELECT chainId, min(blockTimestamp) - 1, false, NULL, NULL FROM blocks GROUP BY chainId""",
                                 ("blocks",)))
def q_newheads_decode(spark, sf_dir):
    d = decode.decode_newheads(feeds.newheads_raw(Fixtures(spark, sf_dir)))
    return d.select("chainId", "receivedAt", "is_corrupt", F.col("msg.method").alias("method"),
                    F.col("msg.params.result.hash").alias("hash"))


@query("newheads_filter", oracle("""
SELECT blockHash AS hash, cast(blockNumber AS bigint) AS blockNumber FROM blocks
WHERE cast(blockNumber AS bigint) % 50 <> 0 AND cast(blockNumber AS bigint) % 89 <> 0""", ("blocks",)))
def q_newheads_filter(spark, sf_dir):
    d = decode.decode_newheads(feeds.newheads_raw(Fixtures(spark, sf_dir)))
    return FL.newheads_filter(d).select("hash", "blockNumber")


@query("hex_quantity", oracle("""
SELECT '0x' || lower(hex(cast(blockNumber AS bigint))) AS number, cast(blockNumber AS bigint) AS blockNumber
FROM blocks WHERE cast(blockNumber AS bigint) % 50 <> 0 AND cast(blockNumber AS bigint) % 89 <> 0""",
                              ("blocks",)))
def q_hex_quantity(spark, sf_dir):
    """The heads' hex block numbers decoded back to integers."""
    d = decode.decode_newheads(feeds.newheads_raw(Fixtures(spark, sf_dir)))
    return FL.newheads_filter(d).select("number", "blockNumber")


@query("webhook_decode", oracle(f"""
SELECT t.orderKey AS deliveryKey,
  CASE WHEN t.orderKey % 97 = 0 THEN NULL ELSE cast(t.orderKey AS varchar) END AS messageId,
  CASE WHEN t.orderKey % 97 = 0 THEN NULL ELSE t.txHash END AS txHash,
  NOT (t.orderKey % 11 = 0 OR t.orderKey % 13 = 0) AS signature_valid,
  t.orderKey % 97 = 0 AS is_corrupt
{_COPIES}""", ("orders_tx",)))
def q_webhook_decode(spark, sf_dir):
    d = decode.decode_webhook(feeds.webhook_raw(Fixtures(spark, sf_dir)), WEBHOOK_SECRET)
    return d.select("deliveryKey", "messageId", F.col("event.transaction.txHash").alias("txHash"),
                    "signature_valid", "is_corrupt")


@query("hmac_verify", oracle(f"""
SELECT t.orderKey AS deliveryKey, NOT (t.orderKey % 11 = 0 OR t.orderKey % 13 = 0) AS signature_valid
{_COPIES}""", ("orders_tx",)))
def q_hmac_verify(spark, sf_dir):
    """HMAC-SHA256 of every delivered body against its signature header."""
    raw = feeds.webhook_raw(Fixtures(spark, sf_dir))
    sig = C.signature_header("sigPrimary", "sigAlt", "sigHub")
    return raw.select("deliveryKey", C.signature_valid("body", sig, WEBHOOK_SECRET).alias("signature_valid"))


@query("signature_header", oracle(f"""
SELECT t.orderKey AS deliveryKey, CASE WHEN t.orderKey % 13 = 0 THEN NULL
  WHEN t.orderKey % 3 = 0 THEN 'primary' WHEN t.orderKey % 3 = 1 THEN 'alt' ELSE 'hub' END AS header
{_COPIES}""", ("orders_tx",)))
def q_signature_header(spark, sf_dir):
    """Which of the three headers carried the signature (first non-empty)."""
    raw = feeds.webhook_raw(Fixtures(spark, sf_dir))
    named = [F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.lit(n))
             for c, n in (("sigPrimary", "primary"), ("sigAlt", "alt"), ("sigHub", "hub"))]
    return raw.select("deliveryKey", C.signature_header(*named).alias("header"))


_LOG = """log AS (SELECT topic, "partition", row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1 AS "offset",
  "key", "value", eventTime FROM topic_messages)"""


def _landed_log(spark, sf_dir) -> str:
    """A new topic log with all messages; ranges of offsets are written by different tasks, in order."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/topics-{uuid.uuid4().hex}"
    order = ["topic", "partition", "offset"]
    rows = (Fixtures(spark, sf_dir).topic_messages.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("topic", "partition", F.timestamp_seconds("eventTime").alias("timestamp"),
                    F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")))
    topic_log.register(spark)
    rows.write.format(topic_log.FORMAT).mode("append").save(path)
    return path


@query("topic_source", oracle("""
SELECT topic, "partition", "offset", "key", strlen("value") AS value_bytes, eventTime AS timestamp FROM log""",
                              ("topic_messages",), [_LOG]))
def q_topic_source(spark, sf_dir):
    """All topics of a log, read from the earliest offsets."""
    log = decode.read_topic(spark, {"path": _landed_log(spark, sf_dir)}, fmt=topic_log.FORMAT)
    return log.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                      F.length("value").cast("bigint").alias("value_bytes"),
                      F.unix_seconds("timestamp").alias("timestamp"))


@query("topic_wildcard", oracle("""
SELECT topic, count(*) AS messages FROM topic_messages
WHERE regexp_full_match(topic, '^chain\\.logs\\.[^.]+$') GROUP BY topic""", ("topic_messages",)))
def q_topic_wildcard(spark, sf_dir):
    """Subscribe to ``chain.logs.*`` (one segment per ``*``); other topics' files are not opened."""
    log = decode.read_topic(spark, {"path": _landed_log(spark, sf_dir), "subscribePattern": "chain.logs.*"}, fmt=topic_log.FORMAT)
    return log.groupBy("topic").agg(F.count("*").alias("messages"))


@query("replay", oracle("""
SELECT topic, "partition", "offset", "key", "value" FROM log JOIN (
  SELECT topic, "partition", min("offset") AS since FROM log
  WHERE eventTime >= (SELECT (min(eventTime) + max(eventTime)) // 2 FROM log) GROUP BY ALL) s USING (topic, "partition")
WHERE "offset" >= since""", ("topic_messages",), [_LOG]))
def q_replay(spark, sf_dir):
    """Replay from a time, half way through the history: each partition from its first offset not before it."""
    low, high = Fixtures(spark, sf_dir).topic_messages.agg(F.min("eventTime"), F.max("eventTime")).first()
    since = ((low or 0) + (high or 0)) // 2
    log = decode.read_topic(spark, {"path": _landed_log(spark, sf_dir)}, replay_from_ms=since * 1000, fmt=topic_log.FORMAT)
    return log.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


# --- scalar functions (C03, C04, C06, C07, C09-C12) -------------------------------

_WIDE = "0" * 30


@query("uint256", oracle(f"""
SELECT chainId, CASE WHEN s = 0 THEN '0' ELSE cast(s AS varchar) || '{_WIDE}' END AS total
FROM (SELECT chainId, sum(cast(value AS decimal(38,0))) AS s FROM transactions GROUP BY chainId) q""",
                         ("transactions",)))
def q_uint256(spark, sf_dir):
    """Exact sums of 256-bit amounts (values scaled by 10^30, beyond decimal(38))."""
    tx = Fixtures(spark, sf_dir).transactions
    return tx.groupBy("chainId").agg(C.uint256_sum(F.concat("value", F.lit(_WIDE))).alias("total"))


@query("value_with_decimals", oracle(f"""
SELECT c.transactionHash, c.logIndex, t.decimals, {vwd('c.value', 't.decimals')} AS valueWithDecimals
FROM children c JOIN tokens t ON c.tokenAddress = t.address WHERE c.kind = 'erc20'""",
                                     ("children", "tokens")))
def q_value_with_decimals(spark, sf_dir):
    """Token amounts shifted by each token's decimals, exactly, as text."""
    fx = Fixtures(spark, sf_dir)
    transfers = feeds.child_rows(fx, "erc20").select(
        "transactionHash", "logIndex", "value", F.col("erc20Token.address").alias("tokenAddress"))
    j = transfers.join(small(fx.tokens.select("address", "decimals")),
                       transfers["tokenAddress"] == F.col("address"))
    return j.select("transactionHash", "logIndex", "decimals",
                    C.value_with_decimals("value", F.col("decimals")).alias("valueWithDecimals"))


@query("epoch_to_ts", oracle("""
SELECT txHash, strftime(make_timestamp(blockTimestamp * 1000000), '%Y-%m-%d %H:%M:%S') AS ts_text,
  blockTimestamp AS roundtrip FROM transactions""", ("transactions",)))
def q_epoch_to_ts(spark, sf_dir):
    tx = Fixtures(spark, sf_dir).transactions
    ts = C.epoch_to_ts("blockTimestamp")
    return tx.select("txHash", ts.cast("string").alias("ts_text"), C.ts_to_epoch(ts).alias("roundtrip"))


@query("rfc3339", oracle("""
SELECT txHash, strftime(make_timestamp(blockTimestamp * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ts_rfc3339
FROM transactions""", ("transactions",)))
def q_rfc3339(spark, sf_dir):
    tx = Fixtures(spark, sf_dir).transactions
    return tx.select("txHash", C.rfc3339(C.epoch_to_ts("blockTimestamp")).alias("ts_rfc3339"))


@query("topic_parts", oracle(f"""
SELECT "offset", {part('topic', 1)} AS p1, {part('topic', 2)} AS p2, {part('topic', 3)} AS p3,
  {part('topic', 4)} AS p4 FROM topic_messages""", ("topic_messages",)))
def q_topic_parts(spark, sf_dir):
    m = Fixtures(spark, sf_dir).topic_messages
    return m.select("offset", *[C.topic_part("topic", i).alias(f"p{i}") for i in range(1, 5)])


@query("json_decode", oracle("""
SELECT "offset", CASE WHEN json_valid("value") THEN cast(json_extract("value", '$.k') AS int) END AS k
FROM topic_messages""", ("topic_messages",)))
def q_json_decode(spark, sf_dir):
    m = Fixtures(spark, sf_dir).topic_messages
    return m.select("offset", C.json_decode("value", "struct<k:int>")["k"].alias("k"))


@query("json_encode", oracle("""
SELECT nodeId,
  '{"nodeId":"' || nodeId || '","startTime":' || startTime || ',"endTime":' || endTime
    || ',"stakeAmount":"' || stakeAmount || '"'
    || CASE WHEN uptime IS NULL THEN '' ELSE ',"uptime":' || uptime END || '}' AS json_omit,
  '{"nodeId":"' || nodeId || '","startTime":' || startTime || ',"endTime":' || endTime
    || ',"stakeAmount":"' || stakeAmount || '","uptime":' || coalesce(cast(uptime AS varchar), 'null')
    || '}' AS json_full
FROM validators""", ("validators",)))
def q_json_encode(spark, sf_dir):
    """C11: ``omitempty`` drops NULL fields; the full form keeps them as null."""
    v = Fixtures(spark, sf_dir).validators
    s = _struct_of(v)
    return v.select("nodeId", C.json_encode(s).alias("json_omit"),
                    C.json_encode(s, keep_nulls=True).alias("json_full"))


@query("interval_trunc", oracle("""
SELECT chainId, g AS grain, cast(epoch(date_trunc(g, make_timestamp(blockTimestamp * 1000000))) AS bigint)
  AS bucket, count(*) AS n
FROM transactions, (SELECT unnest(['hour', 'day', 'week', 'month']) AS g) grains GROUP BY ALL""",
                                ("transactions",)))
def q_interval_trunc(spark, sf_dir):
    """Transaction counts per chain at each metric grain."""
    tx = Fixtures(spark, sf_dir).transactions.select("chainId", C.epoch_to_ts("blockTimestamp").alias("ts"))
    buckets = F.explode(F.array(*[
        F.struct(F.lit(g).alias("grain"), C.ts_to_epoch(C.interval_trunc("ts", g)).alias("bucket"))
        for g in C.GRAINS]))
    # One scan and one aggregation for all grains.
    return tx.select("chainId", buckets.alias("b")).groupBy("chainId", "b.grain", "b.bucket") \
        .agg(F.count("*").alias("n"))
