"""Nested, JSON and signed feeds derived from the flat fixture views.

These are the inputs the reference receives over the wire (webhook bodies,
``newHeads`` frames, landed REST pages, topic messages), rebuilt as Spark
DataFrames from the given tables so that their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainflow.functions import scalar as C
from chainflow.sources.fixtures import Fixtures, children_of_lines, nested_lines, orders_tx_with, orders_with_copies, parties_of_copies

# Public event signatures (topic0) of the token standards.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
TRANSFER_SINGLE_TOPIC = "0xc3d58168c5ae7397731d063d5bbf3d657854427343f4c083240f7aacaa2d0f62"

# Test secret of the webhook feed and the wrong one used for bad signatures.
WEBHOOK_SECRET = "whsec-chainflow-test"
WRONG_SECRET = "not-the-secret"
TOKEN_DECIMALS = 18
HEADS_SUBSCRIPTION = "0xsubheads"


def _empty_if_null(arr: Column, ddl: str) -> Column:
    return F.coalesce(arr, F.array().cast(f"array<{ddl}>"))


def child_structs(of=F.col) -> dict[str, Column]:
    """The wire form of each kind of child row, from the columns of ``children`` (``of``: name -> column)."""
    col = lambda name: of(name).alias(name)
    token = lambda: of("tokenAddress")
    name = F.concat(F.lit("Token "), F.substring(token(), -4, 4))
    symbol = F.concat(F.lit("T"), F.substring(token(), -4, 4))
    erc20 = F.struct(
        col("transactionHash"), F.lit("ERC20").alias("type"), col("from"), col("to"),
        col("value"), col("blockTimestamp"), col("logIndex"),
        F.struct(token().alias("address"), name.alias("name"), symbol.alias("symbol"),
                 F.lit(TOKEN_DECIMALS).alias("decimals"),
                 C.value_with_decimals(of("value"), F.lit(TOKEN_DECIMALS)).alias("valueWithDecimals")
                 ).alias("erc20Token"))
    erc721 = F.struct(
        col("transactionHash"), F.lit("ERC721").alias("type"), col("from"), col("to"),
        col("tokenId"), col("blockTimestamp"), col("logIndex"),
        F.struct(token().alias("address"), name.alias("name"), symbol.alias("symbol")).alias("erc721Token"))
    erc1155 = F.struct(
        col("transactionHash"), F.lit("ERC1155").alias("type"), col("from"), col("to"),
        col("tokenId"), col("value"), col("blockTimestamp"), col("logIndex"),
        F.struct(token().alias("address"), name.alias("name"), symbol.alias("symbol")).alias("erc1155Token"))
    internal = F.struct(
        of("to").alias("from"), token().alias("to"), col("internalTxType"), col("value"),
        col("gasUsed"), F.lit("100000").alias("gasLimit"), col("transactionHash"))
    log = F.struct(
        token().alias("address"),
        F.when(of("kind") == "erc1155", F.lit(TRANSFER_SINGLE_TOPIC))
         .otherwise(F.lit(TRANSFER_TOPIC)).alias("topic0"),
        of("from").alias("topic1"),
        F.when(of("lineStatus") == "F", F.lit(None).cast("string")).otherwise(of("to")).alias("topic2"),
        F.lit(None).cast("string").alias("topic3"),
        of("value").alias("data"), F.lit(0).alias("transactionIndex"), col("logIndex"),
        F.lit(False).alias("removed"))
    return {"erc20": erc20, "erc721": erc721, "erc1155": erc1155, "internal": internal, "logs": log}


# Which rows of ``children`` are children of each kind (None: all).
CHILD_KINDS = {"erc20": ("kind", "erc20"), "erc721": ("kind", "erc721"), "erc1155": ("kind", "erc1155"),
               "internal": ("lineStatus", "F"), "logs": None}


def child_rows(fx: Fixtures, kind: str, parents: tuple[str, ...] = ()) -> DataFrame:
    """Flat child rows in their wire form, with columns of their transaction.

    Equal to exploding the nested array, without building it first.
    """
    own = CHILD_KINDS[kind]
    ch = fx.children if own is None else fx.children.filter(F.col(own[0]) == own[1])
    rows = ch.select(child_structs()[kind].alias("_child"), "orderKey")
    if not parents:
        return rows.select("_child.*")
    tx = fx.orders_tx.select("orderKey", *[F.col(c).alias(f"_p_{c}") for c in parents])
    child = rows.schema["_child"].dataType.fieldNames()
    return rows.join(tx, "orderKey").select(
        *[F.col(f"_p_{c}").alias(c) for c in parents if c not in child], "_child.*")


def transactions_nested(fx: Fixtures) -> DataFrame:
    """One transaction per order with its five nested arrays.

    A key's raw lines (a bounded group) are collected, left-joined to every
    order, and only then made into children; orders without lines get empty arrays.
    """
    from chainflow import schemas as S

    tables = fx.by_order()
    lines = fx.spark.sql(nested_lines(), lineitem=tables["lineitem"]).withColumnRenamed("orderKey", "_line_order")
    # Both sides are sorted by their windows in the order that the join needs.
    raw = fx.spark.sql(orders_with_copies(), orders=tables["orders"]).join(lines, F.col("o_orderkey") == F.col("_line_order"), "left")
    # The strings of the transaction are made above the join: only raw columns are shuffled.
    tx = fx.spark.sql(orders_tx_with("lines, copies"), orders=raw)
    tx = C.once(tx, _parties=F.expr(parties_of_copies("copies")))
    joined = C.once(tx, _children=F.expr(children_of_lines("lines", "_parties", "txHash"))).drop("lines", "copies", "_parties")

    def of_kind(kind):
        own = CHILD_KINDS[kind]
        own = F.col("_children") if own is None else F.filter("_children", lambda c: c[own[0]] == own[1])
        return F.transform(own, lambda c: child_structs(lambda name: c[name])[kind])

    arrays = {"erc20Transfers": "erc20", "erc721Transfers": "erc721", "erc1155Transfers": "erc1155",
              "internalTransactions": "internal", "logs": "logs"}
    joined = joined.select("*", *(of_kind(kind).alias(name) for name, kind in arrays.items())).drop("_children")
    return joined.select(
        F.sha2(F.concat(F.lit("b:"), F.col("chainId"), F.lit(":"), F.col("blockNumber")), 256)
         .alias("_bh"),
        "*",
    ).select(
        F.concat(F.lit("0x"), F.col("_bh")).alias("blockHash"), "blockNumber", "from",
        F.col("receiptGasUsed").alias("gas"), "gasPrice",
        F.col("gasPrice").alias("maxFeePerGas"), F.lit("0").alias("maxPriorityFeePerGas"),
        "txHash", "txStatus", "input", F.lit("0").alias("nonce"), "to",
        F.lit(0).alias("transactionIndex"), "value", F.lit(2).alias("type"), "chainId",
        F.col("receiptGasUsed").alias("receiptCumulativeGasUsed"), "receiptGasUsed",
        F.col("gasPrice").alias("receiptEffectiveGasPrice"), F.lit(None).cast("string").alias("receiptRoot"),
        "blockTimestamp",
        _empty_if_null(F.col("erc20Transfers"), S.ERC20).alias("erc20Transfers"),
        _empty_if_null(F.col("erc721Transfers"), S.ERC721).alias("erc721Transfers"),
        _empty_if_null(F.col("erc1155Transfers"), S.ERC1155).alias("erc1155Transfers"),
        _empty_if_null(F.col("internalTransactions"), S.INTERNAL).alias("internalTransactions"),
        _empty_if_null(F.col("logs"), S.LOG).alias("logs"),
        F.col("orderKey").alias("_orderKey"),
    )


def tx_details(fx: Fixtures) -> DataFrame:
    """Rich native transaction form (input of P01): nested parties, string index."""
    t = fx.transactions
    party = lambda c: F.struct(F.col(c).alias("address"),
                               F.lit(None).cast("string").alias("name"),
                               F.lit(None).cast("string").alias("symbol"),
                               F.lit(None).cast("int").alias("decimals"),
                               F.lit(None).cast("string").alias("logoUri"))
    native = F.struct(
        "blockNumber", "blockTimestamp", "blockHash", "chainId",
        F.col("transactionIndex").cast("string").alias("txIndex"),
        F.col("txHash").alias("hash"), F.col("txStatus"),
        F.lit(2).alias("txType"), F.col("gas").alias("gasLimit"),
        F.col("receiptGasUsed").alias("gasUsed"), F.col("gasPrice"), "nonce",
        party("from").alias("from"), party("to").alias("to"),
        F.struct(F.lit("CALL").alias("callType"), F.substring("input", 1, 10).alias("methodHash"),
                 F.lit(None).cast("string").alias("methodName")).alias("method"),
        F.col("value"))
    return t.select(native.alias("nativeTransaction"),
                    F.col("receiptEffectiveGasPrice").alias("_effectivePrice"))


def webhook_raw(fx: Fixtures) -> DataFrame:
    """Signed webhook deliveries, one row per HTTP request.

    ``messageId`` = order key.  Body truncated when key % 97 = 0, signed with
    the wrong secret when % 11 = 0, unsigned when % 13 = 0; the header slot
    rotates with key % 3; every 10th message is delivered twice.
    """
    tx = transactions_nested(fx)
    k = F.col("_orderKey")
    payload = tx.drop("_orderKey")
    envelope = F.struct(
        F.lit("wh-chainflow").alias("webhookId"), F.lit("address_activity").alias("eventType"),
        k.cast("string").alias("messageId"),
        F.struct(F.struct(*[F.col(c) for c in payload.columns]).alias("transaction"),
                 F.col("logs").alias("logs")).alias("event"))
    full = F.to_json(envelope)
    body = F.when(F.col("messageId_key") % 97 == 0,
                  F.expr("substring(_full, 1, length(_full) div 2)")).otherwise(F.col("_full"))
    signed = C.once(tx.select(k.alias("messageId_key"), F.col("blockTimestamp"), full.alias("_full")), body=body)
    sig = (F.when(F.col("messageId_key") % 13 == 0, F.lit(None).cast("string"))
           .when(F.col("messageId_key") % 11 == 0, C.signature_of("body", WRONG_SECRET))
           .otherwise(C.signature_of("body", WEBHOOK_SECRET)))
    slot = F.col("messageId_key") % 3
    # Every 10th message is delivered twice, 30 s apart: one pass, no union.
    delays = F.when(F.col("messageId_key") % 10 == 0, F.array(F.lit(1), F.lit(31))) \
        .otherwise(F.array(F.lit(1)))
    once = signed.select(
        F.col("messageId_key").alias("deliveryKey"), "body",
        F.when(slot == 0, sig).alias("sigPrimary"),
        F.when(slot == 1, sig).alias("sigAlt"),
        F.when(slot == 2, sig).alias("sigHub"),
        "blockTimestamp", delays.alias("_delays"))
    return once.select("*", F.explode("_delays").alias("_d")).select(
        "deliveryKey", "body", "sigPrimary", "sigAlt", "sigHub",
        (F.col("blockTimestamp") + F.col("_d")).alias("receivedAt"))


def newheads_raw(fx: Fixtures) -> DataFrame:
    """``newHeads`` socket frames: one per block plus one confirmation per chain.

    The hash is empty when blockNumber % 50 = 0 (the frame is skipped) and the
    frame is cut short when blockNumber % 89 = 0 (it is undecodable).
    """
    b = fx.blocks
    num = F.col("blockNumber").cast("bigint")
    frame = F.to_json(F.struct(
        F.lit("2.0").alias("jsonrpc"), F.lit("eth_subscription").alias("method"),
        F.struct(F.concat(F.lit(HEADS_SUBSCRIPTION), F.col("chainId")).alias("subscription"),
                 F.struct(F.when(num % 50 == 0, F.lit("")).otherwise(F.col("blockHash")).alias("hash"),
                          F.col("parentHash"), C.to_hex_quantity(num).alias("number")).alias("result")
                 ).alias("params")))
    heads = b.select("chainId", F.col("blockTimestamp").alias("receivedAt"),
                     F.when(num % 89 == 0, F.substring(frame, 1, 20)).otherwise(frame).alias("frame"))
    confirmations = b.groupBy("chainId").agg(F.min("blockTimestamp").alias("receivedAt")).select(
        "chainId", (F.col("receivedAt") - 1).alias("receivedAt"),
        F.to_json(F.struct(F.lit("2.0").alias("jsonrpc"), F.lit(1).alias("id"),
                           F.concat(F.lit(HEADS_SUBSCRIPTION), F.col("chainId")).alias("result"))).alias("frame"))
    return heads.unionByName(confirmations)


def landed_pages(df: DataFrame, item: Column, array_field: str, key: Column,
                 page_size: int) -> DataFrame:
    """Landed REST pages: ``{<array_field>: [...], nextPageToken}`` JSON documents.

    Page number = ``key div page_size`` for a numeric key, so every group is
    bounded by the page size and no global ordering is needed.  A full page
    carries a next-page token.
    """
    paged = df.groupBy(F.floor(key / page_size).cast("bigint").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(key.alias("k"), item.alias("item")))).alias("items"))
    doc = F.to_json(F.struct(
        F.transform("items", lambda x: x["item"]).alias(array_field),
        F.when(F.size("items") >= page_size,
               F.concat(F.lit("p"), (F.col("page") + 1).cast("string"))).alias("nextPageToken")))
    return paged.select("page", doc.alias("value"))


def subnets_nested(fx: Fixtures) -> DataFrame:
    """Subnets with their nested ``blockchains[]`` (one group per subnet)."""
    chains = fx.blockchains.groupBy("regionKey").agg(
        F.array_sort(F.collect_list(F.struct("blockchainId", "vmId", "subnetId"))).alias("blockchains"))
    return fx.subnets.join(chains, "regionKey", "left").select(
        "subnetId", F.coalesce("blockchains", F.array().cast(
            "array<struct<blockchainId:string,vmId:string,subnetId:string>>")).alias("blockchains"))


def chains_nested(fx: Fixtures) -> DataFrame:
    """Chain rows in API shape: ``enabledFeatures[]`` and ``networkToken{}``."""
    c = fx.chains
    return c.select(
        "chainId", "status", "chainName", "description", "platformChainId", "subnetId", "vmId",
        "vmName", "explorerUrl", "rpcUrl", "wsUrl", "isTestnet", "private", "chainLogoUri",
        F.filter(F.split("features", ","), lambda f: f != "").alias("enabledFeatures"),
        F.struct(F.col("tokenName").alias("name"), F.col("tokenSymbol").alias("symbol"),
                 F.col("tokenDecimals").alias("decimals"), F.col("tokenLogoUri").alias("logoUri"),
                 F.col("tokenDescription").alias("description")).alias("networkToken"))
