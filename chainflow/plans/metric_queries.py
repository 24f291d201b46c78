"""Registered metric queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainflow.operators import fanout as P
from chainflow.operators import hourly_store as store
from chainflow.operators import metrics as M
from chainflow.operators import series
from chainflow.plans.duck import vwd
from chainflow.plans.registry import query
from chainflow.session import checkpoint_dir
from chainflow.sources import decode, feeds
from chainflow.sources.feeds import WEBHOOK_SECRET
from chainflow.sources.fixtures import DUCK, Fixtures, _closure, view_sql

HOUR, DAY = 3600, 86400


# ---------------------------------------------------------------------------
# DuckDB oracle building blocks
# ---------------------------------------------------------------------------

def oracle(body: str, views=(), ctes=()) -> str:
    parts = [f"{n} AS ({view_sql(n, DUCK)})" for n in _closure(views)] + list(ctes)
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body.strip()


def dwin(ts: str, size: int, slide: int | None = None) -> str:
    """Window starts of ``ts`` as a DuckDB expression (unnest for sliding)."""
    slide = slide or size
    p = f"({ts} - {ts} % {slide})"
    k = size // slide
    if k == 1:
        return p
    return "unnest([" + ", ".join(f"{p} - {slide * i}" for i in range(k)) + "])"


TF = """tf AS (SELECT chainId, blockTimestamp AS ts, "from", "to", txStatus = '1' AS ok,
  coalesce("to", '') <> '' AND coalesce(input, '') NOT IN ('', '0x') AS is_call,
  cast(gasPrice AS decimal(38,0)) AS gasPrice, cast(receiptGasUsed AS decimal(38,0)) AS gasUsed,
  cast(cast(receiptGasUsed AS decimal(38,0)) * cast(receiptEffectiveGasPrice AS decimal(38,0))
       AS decimal(38,0)) AS fee
  FROM transactions)"""
ROLES = """roles AS (SELECT * FROM (
  SELECT chainId, ts, 'a' AS role, "from" AS item FROM tf UNION ALL
  SELECT chainId, ts, 'a', "to" FROM tf UNION ALL
  SELECT chainId, ts, 's', "from" FROM tf UNION ALL
  SELECT chainId, ts, 'c', CASE WHEN is_call THEN "to" END FROM tf) x
  WHERE item IS NOT NULL AND item <> '')"""
TXV = ("transactions", "blocks")


def activity_sql(size: int, slide: int | None = None) -> str:
    w = lambda ts: dwin(ts, size, slide)
    ctes = [TF, ROLES,
            f"""base AS (SELECT chainId, window_start, cast(count(*) AS bigint) AS tx_count,
  cast(count(*) FILTER (WHERE ok) AS bigint) AS success_count, sum(fee) AS fee
  FROM (SELECT *, {w('ts')} AS window_start FROM tf) GROUP BY chainId, window_start)""",
            f"""dist AS (SELECT chainId, window_start,
  count(DISTINCT item) FILTER (WHERE role = 'a') AS active_addresses,
  count(DISTINCT item) FILTER (WHERE role = 's') AS active_senders,
  count(DISTINCT item) FILTER (WHERE role = 'c') AS unique_contracts
  FROM (SELECT *, {w('ts')} AS window_start FROM roles) GROUP BY chainId, window_start)""",
            """fs AS (SELECT chainId, item, min(ts) AS ts FROM roles WHERE role = 'a' GROUP BY chainId, item)""",
            f"""fresh AS (SELECT chainId, window_start, count(*) AS new_addresses
  FROM (SELECT *, {w('ts')} AS window_start FROM fs) GROUP BY chainId, window_start)""",
            f"""bpb AS (SELECT chainId, window_start,
  cast(sum(txCount) AS double) / cast(count(*) AS double) AS avg_tx_per_block,
  cast(sum(cast(gasUsed AS decimal(38,0))) AS varchar) AS gas_used
  FROM (SELECT chainId, txCount, gasUsed, {w('blockTimestamp')} AS window_start FROM blocks)
  GROUP BY chainId, window_start)"""]
    return oracle("""
SELECT chainId, window_start, tx_count, success_count, tx_count - success_count AS fail_count,
  active_addresses, active_senders, unique_contracts,
  cast(coalesce(new_addresses, 0) AS bigint) AS new_addresses, avg_tx_per_block,
  cast(fee AS double) / cast(tx_count AS double) / 1e18 AS avg_tx_fee, gas_used
FROM base JOIN dist USING (chainId, window_start) LEFT JOIN fresh USING (chainId, window_start)
  LEFT JOIN bpb USING (chainId, window_start)""", TXV, ctes)


def gas_sql(size: int, slide: int | None = None) -> str:
    w = lambda ts: dwin(ts, size, slide)
    ctes = [TF,
            f"""prices AS (SELECT chainId, window_start,
  cast(sum(gasPrice) AS double) / cast(count(gasPrice) AS double) AS avg_gas_price,
  quantile_cont(cast(gasPrice AS double), 0.5) AS median_gas_price,
  cast(min(gasPrice) AS varchar) AS min_gas_price, cast(max(gasPrice) AS varchar) AS max_gas_price
  FROM (SELECT *, {w('ts')} AS window_start FROM tf) GROUP BY chainId, window_start)""",
            f"""bt AS (SELECT chainId, window_start, sum(gu) AS gu, sum(gl) AS gl, sum(fs) AS fs,
  count(*) AS nb FROM (SELECT chainId, cast(gasUsed AS decimal(38,0)) AS gu,
  cast(gasLimit AS decimal(38,0)) AS gl, cast(feesSpent AS decimal(38,0)) AS fs,
  {w('blockTimestamp')} AS window_start FROM blocks) GROUP BY chainId, window_start)"""]
    return oracle("""
SELECT chainId, window_start, cast(gu AS varchar) AS gas_used, avg_gas_price, median_gas_price,
  min_gas_price, max_gas_price, cast(fs AS varchar) AS fees_paid,
  cast(gl AS double) / cast(nb AS double) AS avg_gas_limit,
  cast(gu AS double) / cast(nb AS double) AS avg_gas_used,
  cast(100 AS double) * cast(gu AS double) / cast(gl AS double) AS gas_utilization_rate,
  cast(gu AS double) / cast(gl AS double) AS gas_efficiency
FROM prices LEFT JOIN bt USING (chainId, window_start)""", TXV, ctes)


def perf_sql(size: int, slide: int | None = None) -> str:
    w = lambda ts: dwin(ts, size, slide)
    ctes = [TF,
            """ps AS (SELECT chainId, ts AS sec, count(*) AS n, sum(gasUsed) AS g FROM tf GROUP BY chainId, ts)""",
            f"""rates AS (SELECT chainId, window_start, sum(n) AS n, sum(g) AS g, max(n) AS max_tps,
  max(g) AS mg FROM (SELECT *, {w('sec')} AS window_start FROM ps) GROUP BY chainId, window_start)""",
            """bg AS (SELECT chainId, cast(blockNumber AS bigint) AS number, blockTimestamp AS ts,
  blockTimestamp - lag(blockTimestamp) OVER (PARTITION BY chainId ORDER BY cast(blockNumber AS bigint)) AS gap
  FROM blocks)""",
            f"""gaps AS (SELECT chainId, window_start,
  cast(sum(gap) AS double) / cast(count(gap) AS double) AS block_time,
  arg_max_null(gap, number) AS current_block_time
  FROM (SELECT *, {w('ts')} AS window_start FROM bg) GROUP BY chainId, window_start)"""]
    return oracle(f"""
SELECT chainId, window_start, cast(n AS double) / cast({size} AS double) AS avg_tps,
  cast(max_tps AS bigint) AS max_tps, cast(g AS double) / cast({size} AS double) AS avg_gps,
  cast(mg AS varchar) AS max_gps, block_time, cast(current_block_time AS bigint) AS current_block_time
FROM rates LEFT JOIN gaps USING (chainId, window_start)""", TXV, ctes)


def cumulative_sql(bucket: int) -> str:
    ctes = [TF, ROLES,
            f"""b AS (SELECT chainId, blockTimestamp - blockTimestamp % {bucket} AS bucket,
  sum(txCount) AS txs, sum(cast(gasUsed AS decimal(38,0))) AS gas,
  sum(cast(feesSpent AS decimal(38,0))) AS fees, count(*) AS nb FROM blocks GROUP BY ALL)""",
            """created AS (SELECT * FROM tf WHERE ok AND coalesce("to", '') = '')""",
            f"""news AS (SELECT chainId, ts - ts % {bucket} AS bucket,
  count(*) FILTER (WHERE role = 'a') AS na, count(*) FILTER (WHERE role = 's') AS ns,
  count(*) FILTER (WHERE role = 'k') AS nk, count(*) FILTER (WHERE role = 'd') AS nd,
  count(*) FILTER (WHERE role = 'x') AS nx
  FROM (SELECT chainId, role, item, min(ts) AS ts FROM roles WHERE role IN ('a', 's') GROUP BY ALL
        UNION ALL SELECT chainId, 'd', "from", min(ts) FROM created GROUP BY chainId, "from"
        UNION ALL SELECT chainId, 'k', NULL, ts FROM created
        UNION ALL SELECT t.chainId, 'x', c.tokenAddress, min(c.blockTimestamp)
        FROM children c JOIN orders_tx t ON c.orderKey = t.orderKey GROUP BY t.chainId, c.tokenAddress) u GROUP BY ALL)""",
            """j AS (SELECT coalesce(b.chainId, n.chainId) AS chainId, coalesce(b.bucket, n.bucket) AS bucket,
  coalesce(txs, 0) AS txs, gas, fees, coalesce(nb, 0) AS nb, coalesce(na, 0) AS na,
  coalesce(ns, 0) AS ns, coalesce(nk, 0) AS nk, coalesce(nd, 0) AS nd,
  coalesce(nx, 0) AS nx
  FROM b FULL JOIN news n ON b.chainId = n.chainId AND b.bucket = n.bucket)"""]
    return oracle("""
SELECT chainId, bucket AS window_start, cast(sum(txs) OVER w AS bigint) AS total_txs,
  cast(sum(gas) OVER w AS varchar) AS total_gas_used,
  cast(sum(fees) OVER w AS varchar) AS total_fees_collected,
  cast(sum(nb) OVER w AS bigint) AS total_blocks_produced,
  cast(sum(na) OVER w AS bigint) AS cumulative_addresses,
  cast(sum(ns) OVER w AS bigint) AS cumulative_active_accounts,
  cast(sum(nk) OVER w AS bigint) AS cumulative_contracts,
  cast(sum(nd) OVER w AS bigint) AS cumulative_deployers,
  cast(sum(nx) OVER w AS bigint) AS cumulative_tokens
FROM j WINDOW w AS (PARTITION BY chainId ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
                  (*TXV, "children", "orders_tx"), ctes)


def _proj(sql: str, cols: str) -> str:
    return f"SELECT {cols} FROM ({sql}) q"


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _tb(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return fx, fx.transactions, fx.blocks


def _family(fn, size, slide=None):
    def run(spark, sf_dir):
        _, tx, blocks = _tb(spark, sf_dir)
        return fn(tx, blocks, size, slide)
    return run


# Sliding / tumbling families
query("window_activity", activity_sql(1800, 300))(_family(M.activity, 1800, 300))
query("window_gas", gas_sql(1800, 300))(_family(M.gas, 1800, 300))
query("window_performance", perf_sql(900, 60))(_family(M.performance, 900, 60))


def cumulative(spark, sf_dir, bucket_s):
    """The cumulative family, tokens of the three transfer tables included."""
    fx, tx, blocks = _tb(spark, sf_dir)
    transfers = fx.children.select("orderKey", F.col("blockTimestamp").alias("ts"), F.col("tokenAddress").alias("token")).join(
        fx.orders_tx.select("orderKey", "chainId"), "orderKey").select("chainId", "ts", "token")
    return M.cumulative(tx, blocks, bucket_s, transfers)


@query("window_cumulative", cumulative_sql(900))
def q_window_cumulative(spark, sf_dir):
    return cumulative(spark, sf_dir, 900)


# Single metrics at hour grain (A01-A24): each key runs only its own part.
_K = "chainId, window_start"


def _part(key, cols, sql_fn, build):
    query(key, _proj(sql_fn(HOUR), f"{_K}, {cols}"))(build)


def _feat_part(fn, cols, **options):
    def run(spark, sf_dir):
        _, tx, _b = _tb(spark, sf_dir)
        return fn(M.tx_features(tx), HOUR, HOUR, **options).select(*M.KEYS, *cols)
    return run


_part("active_addresses", "active_addresses", activity_sql,
      _feat_part(M.address_counts, ["active_addresses"], roles=("a",)))
_part("active_senders", "active_senders", activity_sql,
      _feat_part(M.address_counts, ["active_senders"], roles=("s",)))
_part("unique_contracts", "unique_contracts", activity_sql,
      _feat_part(M.address_counts, ["unique_contracts"], roles=("s", "c")))  # senders show every window
_part("tx_count", "tx_count", activity_sql, _feat_part(M.tx_counts, ["tx_count"]))
_part("tx_success_fail", "success_count, fail_count", activity_sql,
      lambda s, d: M.tx_counts(M.tx_features(_tb(s, d)[1]), HOUR, HOUR).select(
          *M.KEYS, "success_count", (F.col("tx_count") - F.col("success_count")).alias("fail_count")))


@query("new_addresses", f"""SELECT chainId, window_start, new_addresses FROM ({activity_sql(HOUR)}) q
WHERE new_addresses > 0""")
def q_new_addresses(spark, sf_dir):
    _, tx, _b = _tb(spark, sf_dir)
    return M.new_addresses(M.tx_features(tx), HOUR, HOUR)


@query("avg_tx_per_block", f"""SELECT chainId, window_start, avg_tx_per_block FROM ({activity_sql(HOUR)}) q""")
def q_avg_tx_per_block(spark, sf_dir):
    _, tx, blocks = _tb(spark, sf_dir)
    # Windows are those with transactions; blocks only contribute the ratio.
    windows = M.tx_counts(M.tx_features(tx), HOUR, HOUR).select(*M.KEYS)
    return windows.join(M.tx_per_block(blocks, HOUR, HOUR).drop("gas_used"), M.KEYS, "left")


@query("avg_tx_fee", _proj(activity_sql(HOUR), f"{_K}, avg_tx_fee"))
def q_avg_tx_fee(spark, sf_dir):
    _, tx, _b = _tb(spark, sf_dir)
    c = M.tx_counts(M.tx_features(tx), HOUR, HOUR)
    return c.select(*M.KEYS, (M._ratio(F.col("fee"), F.col("tx_count")) / 1e18).alias("avg_tx_fee"))


for _key, _cols in [("gas_used", "gas_used"), ("avg_gas_price", "avg_gas_price"),
                    ("median_gas_price", "median_gas_price"), ("min_gas_price", "min_gas_price"),
                    ("max_gas_price", "max_gas_price"), ("fees_paid", "fees_paid"),
                    ("avg_gas_limit", "avg_gas_limit"), ("avg_gas_used", "avg_gas_used"),
                    ("gas_utilization_rate", "gas_utilization_rate"),
                    ("gas_efficiency", "gas_efficiency")]:
    query(_key, _proj(gas_sql(HOUR), f"{_K}, {_cols}"))(
        (lambda c: lambda s, d: M.gas(_tb(s, d)[1], _tb(s, d)[2], HOUR).select(*M.KEYS, c))(_cols))

for _key, _cols in [("avg_tps", "avg_tps"), ("max_tps", "max_tps"), ("avg_gps", "avg_gps"),
                    ("max_gps", "max_gps"), ("block_time", "block_time"),
                    ("current_block_time", "current_block_time")]:
    query(_key, _proj(perf_sql(HOUR), f"{_K}, {_cols}"))(
        (lambda c: lambda s, d: M.performance(_tb(s, d)[1], _tb(s, d)[2], HOUR).select(*M.KEYS, c))(_cols))


# Cumulative (A25, A26) at hour grain, A27 trailing 30 days
for _key, _cols in [
        ("cumulative_totals", ["total_txs", "total_gas_used", "total_fees_collected", "total_blocks_produced"]),
        ("cumulative_distinct", ["cumulative_addresses", "cumulative_active_accounts", "cumulative_contracts",
                                 "cumulative_deployers", "cumulative_tokens"])]:
    query(_key, _proj(cumulative_sql(HOUR), f"{_K}, {', '.join(_cols)}"))(
        (lambda cols: lambda s, d: cumulative(s, d, HOUR).select(*M.KEYS, *cols))(_cols))


@query("active_contracts_month", oracle(f"""
SELECT chainId, window_start + {29 * DAY} AS day, count(DISTINCT "to") AS active_contracts
FROM (SELECT chainId, "to", {dwin('ts', 30 * DAY, DAY)} AS window_start FROM tf WHERE is_call)
GROUP BY chainId, window_start""", TXV, [TF]))
def q_active_contracts_month(spark, sf_dir):
    _, tx, _b = _tb(spark, sf_dir)
    return M.active_contracts_trailing(tx, 30, DAY)


# Staking and bridges
_STAKING_SQL = oracle("""
SELECT (SELECT count(DISTINCT nodeId) FROM validators) AS validator_count,
  (SELECT count(*) FROM delegators) AS delegator_count,
  cast(sum(cast(stakeAmount AS decimal(38,0))) AS varchar) AS total_staked
FROM (SELECT stakeAmount FROM validators UNION ALL SELECT stakeAmount FROM delegators) s""",
                      ("validators", "delegators"))


def _staking(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return M.staking(fx.validators, fx.delegators)


query("validator_count", _proj(_STAKING_SQL, "validator_count"))(
    lambda s, d: _staking(s, d).select("validator_count"))
query("delegator_count", _proj(_STAKING_SQL, "delegator_count"))(
    lambda s, d: _staking(s, d).select("delegator_count"))
query("total_staked", _proj(_STAKING_SQL, "total_staked"))(
    lambda s, d: _staking(s, d).select("total_staked"))
query("staking_point", _STAKING_SQL)(_staking)
query("staking_row", _proj(_STAKING_SQL, """'staking' AS type, validator_count AS "validatorCount",
  delegator_count AS "delegatorCount", total_staked AS "totalStaked", 'mainnet' AS network,
  cast(0 AS bigint) AS "timestamp" """))(
    lambda s, d: P.staking_row(_staking(s, d), "mainnet", 0))

BRIDGE_ASSET = "1-URGENT"  # the one asset whose bridged total is reported
_BRIDGE_SQL = oracle(f"""
SELECT count(DISTINCT (sourceChain, destChain)) AS active_bridges, count(*) AS bridge_tx_count,
  cast(sum(cast(amount AS decimal(38,0))) FILTER (asset = '{BRIDGE_ASSET}') AS varchar) AS total_bridged
FROM bridge_txs""", ("bridge_txs",))


def _bridge(spark, sf_dir):
    return M.bridge(Fixtures(spark, sf_dir).bridge_txs, BRIDGE_ASSET)


query("active_bridges", _proj(_BRIDGE_SQL, "active_bridges"))(
    lambda s, d: _bridge(s, d).select("active_bridges"))
query("bridge_tx_count", _proj(_BRIDGE_SQL, "bridge_tx_count"))(
    lambda s, d: _bridge(s, d).select("bridge_tx_count"))
query("total_bridged", _proj(_BRIDGE_SQL, "total_bridged"))(
    lambda s, d: _bridge(s, d).select("total_bridged"))
query("bridge_metric_point", _BRIDGE_SQL)(_bridge)
query("bridge_metric_rows", oracle("""
SELECT 'teleporter' AS type, metric, value, cast(0 AS bigint) AS timestamp FROM (
  SELECT 'activeTeleporterBridges' AS metric, cast(active_bridges AS double) AS value FROM b UNION ALL
  SELECT 'teleporterTransactions', cast(bridge_tx_count AS double) FROM b UNION ALL
  SELECT 'totalBridgedBtc', cast(total_bridged AS double) FROM b) s""",
                                   ctes=[f"b AS ({_proj(_BRIDGE_SQL, '*')})"]))(
    lambda s, d: P.bridge_metric_rows(_bridge(s, d), 0))


# Value transferred
@query("value_transferred", oracle(f"""
SELECT chainId, blockTimestamp - blockTimestamp % {DAY} AS window_start,
  cast(sum(cast(value AS decimal(38,0))) AS varchar) AS value_transferred, count(*) AS tx_count
FROM transactions GROUP BY ALL""", ("transactions",)))
def q_value_transferred(spark, sf_dir):
    return M.value_transferred(Fixtures(spark, sf_dir).transactions, DAY)


@query("value_transferred_usd", oracle(f"""
SELECT window_start, {vwd('cast(sum(cast(raw * cast(round(price * 100) AS bigint) AS decimal(38,0)) '
                          "* cast('1' || repeat('0', 18 - decimals) AS decimal(38,0))) AS varchar)", 20)}
  AS value_transferred_usd, count(t.price) AS tokens, count(*) - count(t.price) AS unpriced_tokens,
  cast(0 AS bigint) AS bad_amounts
FROM (SELECT blockTimestamp - blockTimestamp % {DAY} AS window_start, tokenAddress,
        sum(cast(value AS decimal(38,0))) AS raw FROM children WHERE kind = 'erc20' GROUP BY ALL) p
LEFT JOIN tokens t ON p.tokenAddress = t.address GROUP BY window_start""", ("children", "tokens")))
def q_value_transferred_usd(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    transfers = fx.children.filter(F.col("kind") == "erc20").select("blockTimestamp", "value", "tokenAddress")
    return M.value_transferred_usd(transfers, fx.tokens, DAY)


# Counters and token activity
@query("ingest_counters", oracle("""
SELECT count(*) FILTER (WHERE orderKey % 97 <> 0) AS processed,
  count(*) FILTER (WHERE orderKey % 97 = 0) AS errors,
  count(*) FILTER (WHERE orderKey % 11 = 0 OR orderKey % 13 = 0) AS invalid_sigs
FROM orders_tx t JOIN (SELECT 1 AS copy UNION ALL SELECT 2 AS copy) r
  ON r.copy = 1 OR t.orderKey % 10 = 0""", ("orders_tx",)))
def q_ingest_counters(spark, sf_dir):
    """Webhook counters; signature validity comes from the HMAC check."""
    d = decode.decode_webhook(feeds.webhook_raw(Fixtures(spark, sf_dir)), WEBHOOK_SECRET)
    return d.agg(F.count_if(~F.col("is_corrupt")).alias("processed"),
                 F.count_if("is_corrupt").alias("errors"),
                 F.count_if(~F.col("signature_valid")).alias("invalid_sigs"))


@query("topic_counters", oracle("""
SELECT topic, count(*) AS messages, max(eventTime) AS last_consumed FROM topic_messages GROUP BY topic""",
                                ("topic_messages",)))
def q_topic_counters(spark, sf_dir):
    return Fixtures(spark, sf_dir).topic_messages.groupBy("topic").agg(
        F.count("*").alias("messages"), F.max("eventTime").alias("last_consumed"))


@query("internal_by_type", oracle("""
SELECT internalTxType, count(*) AS n FROM children WHERE lineStatus = 'F' GROUP BY 1""", ("children",)))
def q_internal_by_type(spark, sf_dir):
    internal = feeds.child_rows(Fixtures(spark, sf_dir), "internal")
    return internal.groupBy("internalTxType").agg(F.count("*").alias("n"))


@query("nft_mints", oracle(f"""
SELECT kind, tokenAddress, count(*) FILTER (WHERE "from" = '{M.ZERO_ADDRESS}') AS mints,
  count(*) AS transfers
FROM children WHERE kind IN ('erc721', 'erc1155') GROUP BY ALL""", ("children",)))
def q_nft_mints(spark, sf_dir):
    nfts = Fixtures(spark, sf_dir).children.filter(F.col("kind").isin("erc721", "erc1155"))
    return M.nft_mints(nfts.select("kind", "from", "tokenAddress"))


@query("erc1155_batches", oracle("""
SELECT transactionHash, tokenAddress, count(*) AS n,
  cast(sum(cast(value AS decimal(38,0))) AS varchar) AS total_value,
  string_agg(tokenId, ',' ORDER BY tokenId) AS token_ids
FROM children WHERE kind = 'erc1155' GROUP BY ALL""", ("children",)))
def q_erc1155_batches(spark, sf_dir):
    t = feeds.child_rows(Fixtures(spark, sf_dir), "erc1155").select(
        "transactionHash", "tokenId", "value", F.col("erc1155Token.address").alias("tokenAddress"))
    return M.erc1155_batches(t)


# Hourly metric set (T07), long rows (P13), first 24 points (O03), series
_HOURLY_COLS = "active_addresses, tx_count, avg_tps, avg_gas_price, fees_paid"


def hourly_sql() -> str:
    a, g, p = activity_sql(HOUR), gas_sql(HOUR), perf_sql(HOUR)
    return f"""SELECT a.chainId, a.window_start, a.active_addresses, a.tx_count, p.avg_tps,
  g.avg_gas_price, g.fees_paid
FROM ({a}) a JOIN ({p}) p USING (chainId, window_start) JOIN ({g}) g USING (chainId, window_start)"""


def hourly(spark, sf_dir):
    _, tx, blocks = _tb(spark, sf_dir)
    feat = M.tx_features(tx)
    return M.hourly_set(feat, blocks, HOUR)


def stored_hours(spark, sf_dir):
    """(the hourly rollup, kept as a table in day partitions; the time of the newest transaction)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/hours-{uuid.uuid4().hex}"
    hours = hourly(spark, sf_dir)
    store.update_hours(hours, path)
    end = Fixtures(spark, sf_dir).transactions.agg(F.max("blockTimestamp")).first()[0] or 0
    return store.read_hours(spark, path, hours.withColumn("day", store.day_of(F.col("window_start"))).schema), end


_NEWEST = oracle("SELECT max(blockTimestamp) FROM transactions", ("transactions",))
_LAST_DAY_SQL = f"""SELECT * FROM ({hourly_sql()}) h
WHERE window_start BETWEEN ({_NEWEST}) - {DAY} AND ({_NEWEST})"""


@query("window_hourly", hourly_sql())
def q_window_hourly(spark, sf_dir):
    """The five hourly metrics of every hour, from the rollup (``store.last_day`` reads a collection's 86,400 seconds)."""
    hours, _ = stored_hours(spark, sf_dir)
    return hours.drop("day")


_LONG_METRICS = ["active_addresses", "tx_count", "avg_tps", "avg_gas_price", "fees_paid"]


def _long_sql(source: str) -> str:
    return f"""SELECT chainId, window_start AS timestamp, metric, value
FROM (UNPIVOT (SELECT chainId, window_start, cast(active_addresses AS double) AS active_addresses,
  cast(tx_count AS double) AS tx_count, avg_tps, avg_gas_price, cast(fees_paid AS double) AS fees_paid
  FROM ({source}) h) ON {', '.join(_LONG_METRICS)} INTO NAME metric VALUE value) u"""


def long_points(hours):
    return P.metric_long_rows(hours, ["chainId", "window_start"], _LONG_METRICS).select(
        "chainId", F.col("window_start").alias("timestamp"), "metric", "value")


@query("metric_long_rows", f"""
SELECT *, 'hour' AS interval, cast(0 AS bigint) AS collectTime FROM ({_long_sql(hourly_sql())}) l""")
def q_metric_long_rows(spark, sf_dir):
    long = P.metric_long_rows(hourly(spark, sf_dir), ["chainId", "window_start"], _LONG_METRICS,
                              "hour", 0)
    return long.withColumnRenamed("window_start", "timestamp")


@query("first_24_hours", _long_sql(f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY chainId ORDER BY window_start) AS rn FROM ({_LAST_DAY_SQL}) d) q
  WHERE rn <= 24"""))
def q_first_24_hours(spark, sf_dir):
    """The first page (24 points, ascending) of each chain's five series over the last 86,400 seconds.

    The per-chain window runs over a day's hourly rows.
    """
    w = Window.partitionBy("chainId").orderBy("window_start")
    hours = store.last_day(*stored_hours(spark, sf_dir))
    return long_points(hours.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 24).drop("rn"))


def series_sql() -> str:
    """All series from the raw rows, each grain by itself, distinct counts by count(DISTINCT)."""
    grain = {g: f"cast(epoch(date_trunc('{g}', make_timestamp(ts * 1000000))) AS bigint)" for g in ("hour", "day", "week", "month")}
    each = lambda rows: " UNION ALL ".join(
        f"SELECT *, '{g}' AS interval, {at} AS bucket FROM {rows}" for g, at in grain.items())
    key = "chainId, interval, bucket"
    ctes = [TF, ROLES,
            """sec AS (SELECT chainId, ts, count(*) AS n, sum(gasUsed) AS g, sum(gasPrice) AS sp, count(gasPrice) AS np,
  max(gasPrice) AS mp FROM tf GROUP BY chainId, ts)""",
            f"""x AS (SELECT {key}, sum(n) AS n, sum(g) AS g, max(n) AS mn, max(g) AS mg, sum(sp) AS sp, sum(np) AS np,
  max(mp) AS mp FROM ({each('sec')}) GROUP BY ALL)""",
            f"""sets AS (SELECT {key}, count(DISTINCT item) FILTER (role = 'a') AS na, count(DISTINCT item) FILTER (role = 's') AS ns
  FROM ({each('roles')}) GROUP BY ALL)""",
            """bt AS (SELECT chainId, blockTimestamp AS ts, cast(gasUsed AS decimal(38,0)) AS gu,
  cast(feesSpent AS decimal(38,0)) AS fs FROM blocks)""",
            f"bs AS (SELECT {key}, sum(gu) AS gu, sum(fs) AS fs FROM ({each('bt')}) GROUP BY ALL)",
            """created AS (SELECT * FROM tf WHERE ok AND coalesce("to", '') = '')""",
            """fresh AS (SELECT chainId, min(ts) AS ts, 'a' AS what FROM roles WHERE role = 'a' GROUP BY chainId, item
  UNION ALL SELECT chainId, ts, 'k' FROM created
  UNION ALL SELECT chainId, min(ts), 'd' FROM created GROUP BY chainId, "from")""",
            f"""news AS (SELECT {key}, count(*) FILTER (what = 'a') AS ca, count(*) FILTER (what = 'k') AS ck,
  count(*) FILTER (what = 'd') AS cd FROM ({each('fresh')}) GROUP BY ALL)""",
            f"keys AS (SELECT {key} FROM x UNION SELECT {key} FROM bs UNION SELECT {key} FROM news)",
            """j AS (SELECT *, CASE interval WHEN 'hour' THEN 3600 WHEN 'day' THEN 86400 WHEN 'week' THEN 604800
    ELSE cast(epoch(make_timestamp(bucket * 1000000) + INTERVAL 1 MONTH) AS bigint) - bucket END AS seconds
  FROM keys LEFT JOIN x USING (chainId, interval, bucket) LEFT JOIN sets USING (chainId, interval, bucket)
    LEFT JOIN bs USING (chainId, interval, bucket) LEFT JOIN news USING (chainId, interval, bucket))""",
            """wide AS (SELECT chainId, interval, bucket AS timestamp, cast(na AS double) AS activeAddresses,
  cast(ns AS double) AS activeSenders, cast(n AS double) AS txCount,
  cast(sum(coalesce(ca, 0)) OVER w AS double) AS cumulativeAddresses, cast(sum(coalesce(n, 0)) OVER w AS double) AS cumulativeTxCount,
  cast(sum(coalesce(ck, 0)) OVER w AS double) AS cumulativeContracts, cast(sum(coalesce(cd, 0)) OVER w AS double) AS cumulativeDeployers,
  cast(gu AS double) AS gasUsed, cast(g AS double) / cast(seconds AS double) AS avgGps, cast(mg AS double) AS maxGps,
  cast(n AS double) / cast(seconds AS double) AS avgTps, cast(mn AS double) AS maxTps,
  cast(sp AS double) / cast(np AS double) AS avgGasPrice, cast(mp AS double) AS maxGasPrice, cast(fs AS double) AS feesPaid
  FROM j WINDOW w AS (PARTITION BY chainId, interval ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""]
    one = " UNION ALL ".join(f"SELECT chainId, interval, timestamp, '{m}' AS metric, {m} AS value FROM wide WHERE {m} IS NOT NULL"
                             for m in series.SERIES)
    return oracle(f"""SELECT chainId, metric, interval, timestamp, value,
  cast((row_number() OVER (PARTITION BY chainId, metric, interval ORDER BY timestamp) - 1) // {PAGE} AS bigint) AS page
FROM ({one}) p""", TXV, ctes)


PAGE = 100


@query("metric_series", series_sql())
def q_metric_series(spark, sf_dir):
    """All 15 series at all four grains over the whole range, with the page that each point is on."""
    _, tx, blocks = _tb(spark, sf_dir)
    return series.paged(series.in_range(series.metric_series(tx, blocks)), PAGE)


@query("metric_point", f"""
SELECT chainId, metric, max_by(value, timestamp) AS value, max(timestamp) AS timestamp
FROM ({_long_sql(hourly_sql())}) l GROUP BY chainId, metric""")
def q_metric_point(spark, sf_dir):
    """The latest point of each series; the rollup's rows are read, not the transactions again."""
    hours, _ = stored_hours(spark, sf_dir)
    return long_points(hours.drop("day")).groupBy("chainId", "metric").agg(
        F.max_by("value", "timestamp").alias("value"), F.max("timestamp").alias("timestamp"))
