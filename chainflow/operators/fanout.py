"""Projections (P01-P17): fan nested transactions out, unwrap, stamp, reshape.

All are narrow transformations (no shuffle): ``explode`` / ``select`` /
``unpivot`` run inside the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainflow.functions import scalar as C

PARENT_KEYS = ("txHash", "blockNumber", "blockTimestamp", "chainId")
CHILD_ARRAYS = ("erc20Transfers", "erc721Transfers", "erc1155Transfers",
                "internalTransactions", "logs")


def _explode(tx: DataFrame, arr: Column, prefix: str, parents) -> DataFrame:
    """Parent key columns + the exploded element's fields.

    A parent key whose name the element already has (``blockTimestamp`` on a
    transfer) is left out; the element's own value wins.
    """
    exploded = tx.select(*[F.col(prefix + p).alias(p) for p in parents],
                         F.explode(arr).alias("_child"))
    child_fields = exploded.schema["_child"].dataType.fieldNames()
    keep = [p for p in parents if p not in child_fields]
    return exploded.select(*keep, "_child.*")


def explode_children(tx: DataFrame, field: str, parents=PARENT_KEYS, tx_col: str | None = None) -> DataFrame:
    """One row per element of a transaction's nested array.

    Parent keys are carried along so child rows can be joined back (the
    reference's log rows lack them).  ``tx_col`` names a struct column that
    holds the transaction (e.g. ``event.transaction`` of an envelope).
    """
    prefix = f"{tx_col}." if tx_col else ""
    return _explode(tx, F.col(prefix + field), prefix, parents)


def explode_erc20(tx, **kw):
    return explode_children(tx, "erc20Transfers", **kw)


def explode_erc721(tx, **kw):
    return explode_children(tx, "erc721Transfers", **kw)


def explode_erc1155(tx, **kw):
    return explode_children(tx, "erc1155Transfers", **kw)


def explode_internal(tx, **kw):
    return explode_children(tx, "internalTransactions", **kw)


LOGS_FROM = ("transaction", "envelope", "both")


def explode_logs(envelopes: DataFrame, logs_from: str = "transaction",
                 tx_col: str = "event.transaction", envelope_logs: str = "event.logs",
                 parents=PARENT_KEYS) -> DataFrame:
    """Log rows of webhook envelopes.

    ``transaction`` reads the transaction's own logs (the reference's choice),
    ``envelope`` the envelope-level array, ``both`` their concatenation.
    """
    if logs_from not in LOGS_FROM:
        raise ValueError(f"logs_from must be one of {LOGS_FROM}")
    tx_logs = F.coalesce(F.col(f"{tx_col}.logs"), F.array())
    env_logs = F.coalesce(F.col(envelope_logs), F.array())
    arr = {"transaction": tx_logs, "envelope": env_logs,
           "both": F.concat(tx_logs, env_logs)}[logs_from]
    return _explode(envelopes, arr, f"{tx_col}.", parents)


def tx_rows(envelopes: DataFrame, tx_col: str = "event.transaction") -> DataFrame:
    """The transaction itself as a row, nested arrays kept."""
    return envelopes.select(f"{tx_col}.*")


def flatten_tx_detail(details: DataFrame, native: str = "nativeTransaction") -> DataFrame:
    """Rich native transaction -> flat transaction row."""
    n = lambda f: F.col(f"{native}.{f}")
    return details.select(
        n("hash").alias("txHash"), n("blockHash").alias("blockHash"),
        n("blockNumber").alias("blockNumber"), n("blockTimestamp").alias("blockTimestamp"),
        n("chainId").alias("chainId"),
        F.lower(n("from.address")).alias("from"), F.lower(n("to.address")).alias("to"),
        n("txIndex").try_cast("int").alias("transactionIndex"),
        n("gasUsed").alias("receiptGasUsed"), n("gasLimit").alias("gas"),
        n("gasPrice").alias("gasPrice"), n("txStatus").alias("txStatus"),
        n("txType").alias("type"), n("nonce").alias("nonce"), n("value").alias("value"),
        n("method.methodHash").alias("input"),
    )


def explode_subnet_chains(subnets: DataFrame) -> DataFrame:
    """One row per blockchain of a subnet."""
    return subnets.select("subnetId", F.explode("blockchains").alias("b")).select(
        "subnetId", "b.blockchainId", "b.vmId", F.col("b.subnetId").alias("blockchainSubnetId"))


def unwrap_events(events: DataFrame, wrapper: str) -> DataFrame:
    """Strip an event wrapper: ``{"chain": {...}}`` -> the chain's columns."""
    return events.select(f"{wrapper}.*")


def stamp_live(messages: DataFrame, received_at, topic_col: str = "topic") -> DataFrame:
    """Overwrite ``type``/``chainId`` from the topic, add ``receivedAt`` (P10).

    ``received_at`` is an argument (column or literal) so runs are deterministic.
    """
    ra = received_at if isinstance(received_at, Column) else F.lit(received_at)
    return messages.withColumns({
        "type": C.topic_part(topic_col, 2),
        "chainId": C.topic_part(topic_col, 3),
        "receivedAt": ra,
    })


def live_envelope(df: DataFrame, data_col: str = "data", ts_col: str = "receivedAt") -> DataFrame:
    """``{type, chainId, data, timestamp}`` JSON text sent to live clients."""
    return df.withColumn("envelope", F.to_json(F.struct(
        F.col("type"), F.col("chainId"), F.col(data_col).alias("data"),
        F.col(ts_col).alias("timestamp"))))


def stamp_chain(blocks: DataFrame, chain_id: str) -> DataFrame:
    """Constant chain id on looked-up blocks."""
    return blocks.withColumn("chainId", F.lit(chain_id))


def metric_long_rows(wide: DataFrame, ids: list[str], metrics: list[str],
                     interval: str = "hour", collect_time=None) -> DataFrame:
    """Wide metric table -> ``{chainId, metric, timestamp, value, interval, collectTime}``."""
    long = wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(ids, metrics, "metric", "value")
    ct = collect_time if isinstance(collect_time, Column) else F.lit(collect_time).cast("bigint")
    return long.withColumn("interval", F.lit(interval)).withColumn("collectTime", ct)


def staking_row(staking: DataFrame, network: str, ts=None) -> DataFrame:
    """``{type: "staking", validatorCount, delegatorCount, totalStaked, network, timestamp}``."""
    tcol = ts if isinstance(ts, Column) else F.lit(ts).cast("bigint")
    return staking.select(
        F.lit("staking").alias("type"), F.col("validator_count").alias("validatorCount"),
        F.col("delegator_count").alias("delegatorCount"), F.col("total_staked").alias("totalStaked"),
        F.lit(network).alias("network"), tcol.alias("timestamp"))


# The type tag and metric names of the bridge metric rows.
BRIDGE_ROW_TYPE = "teleporter"
BRIDGE_METRICS = ("activeTeleporterBridges", "teleporterTransactions", "totalBridgedBtc")


def bridge_metric_rows(bridge: DataFrame, ts=None) -> DataFrame:
    """Three ``{type, metric, value, timestamp}`` bridge metric rows."""
    tcol = ts if isinstance(ts, Column) else F.lit(ts).cast("bigint")
    a, b, c = BRIDGE_METRICS
    return bridge.select(F.expr(
        f"stack(3, '{a}', cast(active_bridges AS double), "
        f"'{b}', cast(bridge_tx_count AS double), "
        f"'{c}', cast(total_bridged AS double)) AS (metric, value)"),
        *[c for c in bridge.columns if c not in ("active_bridges", "bridge_tx_count", "total_bridged")]
    ).select(F.lit(BRIDGE_ROW_TYPE).alias("type"), "*", tcol.alias("timestamp"))


def include_flags(tx: DataFrame, include_logs: bool = False,
                  include_internal: bool = False) -> DataFrame:
    """Drop ``logs`` / ``internalTransactions`` unless asked for.

    Dropping the column lets Catalyst prune the nested field from the scan.
    """
    drop = [c for c, keep in (("logs", include_logs), ("internalTransactions", include_internal))
            if not keep]
    return tx.drop(*drop)


def network_token(chains: DataFrame) -> DataFrame:
    """Flatten ``networkToken{}`` and one row per enabled feature."""
    flat = chains.select("*", *[F.col(f"networkToken.{f}").alias("networkToken" + f[0].upper() + f[1:])
                                for f in ("name", "symbol", "decimals", "logoUri", "description")])
    return flat.drop("networkToken").withColumn("feature", F.explode_outer("enabledFeatures"))
