"""Metric families (A01-A40) over tumbling, sliding and running windows.

The reference only names these quantities (its services emit sample
constants); the formulas here are ours and live in this one module.

Design for scale
----------------
* Everything is grouped by ``(chainId, window_start)``, never by ``chainId``
  alone: one hot chain can hold a third of all rows, a window of it cannot.
* Sliding windows are built from **panes** (slide-sized tumbling buckets).
  Additive measures (count, sum, min, max) are aggregated per pane first and
  only the pane rows are fanned out to the ``size/slide`` windows; distinct
  sets are deduplicated per pane before fan-out.  Raw rows are never
  multiplied by the window fan-out.
* Ratios are ``double(exact integer) / double(exact integer)``; amounts are
  summed exactly as ``decimal(38,0)`` and reported as digit strings.
* All window starts are Unix seconds (``bigint``), as the metric sink emits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainflow.functions import scalar as C

DEC = "decimal(38,0)"
ZERO_ADDRESS = "0x" + "0" * 40


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pane_of(ts, slide_s: int) -> Column:
    """Start of the slide-sized bucket holding ``ts`` (Unix seconds)."""
    t = _c(ts)
    return t - F.pmod(t, F.lit(slide_s))


def fan_out(df: DataFrame, size_s: int, slide_s: int, pane_col: str = "pane",
            out: str = "window_start") -> DataFrame:
    """Give each pane row the start of every window that contains it.

    Windows are ``[start, start + size)`` with starts aligned to ``slide``
    (Spark's ``window(ts, size, slide)`` semantics).  Tumbling windows
    (size == slide) keep one row per pane.
    """
    if size_s % slide_s:
        raise ValueError("window size must be a multiple of the slide")
    k = size_s // slide_s
    if k == 1:
        return df.withColumn(out, F.col(pane_col))
    starts = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                         lambda i: F.col(pane_col) - i.cast("bigint") * slide_s)
    return df.withColumn(out, F.explode(starts))


def windowed(df: DataFrame, ts: str, size_s: int, slide_s: int | None = None,
             out: str = "window_start") -> DataFrame:
    """Row-level window assignment (use for non-additive measures only)."""
    slide_s = slide_s or size_s
    return fan_out(df.withColumn("_pane", pane_of(ts, slide_s)), size_s, slide_s,
                   "_pane", out).drop("_pane")


# ---------------------------------------------------------------------------
# Per-row features
# ---------------------------------------------------------------------------

def is_contract_call(to="to", input_="input") -> Column:
    return (F.coalesce(_c(to), F.lit("")) != "") & ~F.coalesce(_c(input_), F.lit("")).isin("", "0x")


def tx_features(tx: DataFrame) -> DataFrame:
    """The transaction columns every metric needs, typed once."""
    return tx.select(
        "chainId", F.col("blockTimestamp").alias("ts"), "from", "to",
        (F.col("txStatus") == "1").alias("ok"),
        is_contract_call().alias("is_call"),
        C.uint("gasPrice").alias("gasPrice"),
        C.uint("receiptGasUsed").alias("gasUsed"),
        (C.uint("receiptGasUsed") * C.uint("receiptEffectiveGasPrice")).cast(DEC).alias("fee"),
    )


def block_typed(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "chainId", F.col("blockNumber").cast("bigint").alias("number"),
        F.col("blockTimestamp").alias("ts"), F.col("txCount").cast("bigint").alias("txCount"),
        C.uint("gasUsed").alias("gasUsed"), C.uint("gasLimit").alias("gasLimit"),
        C.uint("feesSpent").alias("feesSpent"))


def block_features(blocks: DataFrame) -> DataFrame:
    """Typed block columns plus ``gap`` = seconds since the chain's previous block."""
    from chainflow.operators.timeline import segmented_lag
    return segmented_lag(block_typed(blocks), "chainId", "number", "ts", "_prevTs") \
        .withColumn("gap", F.col("ts") - F.col("_prevTs")).drop("_prevTs")


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


# ---------------------------------------------------------------------------
# Distinct sets over windows
# ---------------------------------------------------------------------------

def distinct_per_window(items: DataFrame, size_s: int, slide_s: int,
                        keys=("chainId",), item_cols=("role", "item")) -> DataFrame:
    """Count distinct items per ``(keys, window_start, role)``.

    ``items`` has ``ts`` and the item columns.  Items are deduplicated per
    pane, fanned out, deduplicated per window, then counted: two shuffles on
    bounded keys, no per-distinct Expand.
    """
    panes = items.select(*keys, pane_of("ts", slide_s).alias("pane"), *item_cols).distinct()
    per_window = fan_out(panes, size_s, slide_s).drop("pane").distinct()
    return per_window.groupBy(*keys, "window_start", item_cols[0]).agg(F.count("*").alias("n"))


def _roles(feat: DataFrame, roles: tuple[str, ...] = ("a", "s", "c")) -> DataFrame:
    """(chainId, ts, role, item): a = any party, s = sender, c = called contract; only the wanted roles."""
    parties = {"a": [F.col("from"), F.col("to")], "s": [F.col("from")],
               "c": [F.when(F.col("is_call"), F.col("to"))]}
    return feat.select("chainId", "ts", F.explode(F.array(*[
        F.struct(F.lit(r).alias("role"), item.alias("item")) for r in roles for item in parties[r]])).alias("r")) \
        .select("chainId", "ts", "r.role", "r.item") \
        .filter(F.col("item").isNotNull() & (F.col("item") != ""))


def first_seen(feat: DataFrame, role: str = "a") -> DataFrame:
    """First appearance per ``(chainId, address)`` (W06): ``min(ts)``."""
    return _roles(feat, (role,)).groupBy("chainId", "item").agg(F.min("ts").alias("first_ts"))


# ---------------------------------------------------------------------------
# Families
# ---------------------------------------------------------------------------

KEYS = ["chainId", "window_start"]


def tx_counts(feat: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    """A03, A06 and the fee total: additive, aggregated per pane first."""
    panes = feat.groupBy("chainId", pane_of("ts", slide_s).alias("pane")).agg(
        F.count("*").alias("n"), F.count_if("ok").alias("ok"), F.sum("fee").alias("fee"))
    return fan_out(panes, size_s, slide_s).groupBy(*KEYS).agg(
        F.sum("n").cast("bigint").alias("tx_count"), F.sum("ok").cast("bigint").alias("success_count"),
        F.sum("fee").alias("fee"))


ADDRESS_COUNTS = {"a": "active_addresses", "s": "active_senders", "c": "unique_contracts"}


def address_counts(feat: DataFrame, size_s: int, slide_s: int, roles: tuple[str, ...] = ("a", "s", "c")) -> DataFrame:
    """Distinct parties, senders and called contracts (only the wanted ones)."""
    counts = distinct_per_window(_roles(feat, roles), size_s, slide_s)
    return counts.groupBy(*KEYS).agg(*[
        F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)).cast("bigint").alias(ADDRESS_COUNTS[r])
        for r in roles])


def new_addresses(feat: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    """Addresses whose first-ever appearance (W06) falls in the window."""
    fresh = first_seen(feat).groupBy("chainId", pane_of("first_ts", slide_s).alias("pane")) \
        .agg(F.count("*").alias("n"))
    return fan_out(fresh, size_s, slide_s).groupBy(*KEYS).agg(
        F.sum("n").cast("bigint").alias("new_addresses"))


def tx_per_block(blocks: DataFrame, size_s: int, slide_s: int) -> DataFrame:
    """Mean transactions per block, and gas, of the window's blocks."""
    bpanes = block_typed(blocks).groupBy("chainId", pane_of("ts", slide_s).alias("pane")).agg(
        F.sum("txCount").alias("txs"), F.count("*").alias("blocks"), F.sum("gasUsed").alias("gu"))
    return fan_out(bpanes, size_s, slide_s).groupBy(*KEYS).agg(
        _ratio(F.sum("txs"), F.sum("blocks")).alias("avg_tx_per_block"),
        F.sum("gu").cast(DEC).cast("string").alias("gas_used"))


def activity(tx: DataFrame, blocks: DataFrame, size_s: int, slide_s: int | None = None) -> DataFrame:
    """A01-A09 per ``(chainId, window_start)``.

    The parts are aggregated separately and joined on the window key; each
    part's final aggregate is already hash-partitioned on that key.
    """
    slide_s = slide_s or size_s
    feat = tx_features(tx)
    out = tx_counts(feat, size_s, slide_s) \
        .join(address_counts(feat, size_s, slide_s), KEYS) \
        .join(new_addresses(feat, size_s, slide_s), KEYS, "left") \
        .join(tx_per_block(blocks, size_s, slide_s), KEYS, "left")
    return out.select(
        *KEYS, "tx_count", "success_count",
        (F.col("tx_count") - F.col("success_count")).alias("fail_count"),
        "active_addresses", "active_senders", "unique_contracts",
        F.coalesce(F.col("new_addresses"), F.lit(0).cast("bigint")).alias("new_addresses"),
        "avg_tx_per_block",
        (_ratio(F.col("fee"), F.col("tx_count")) / 1e18).alias("avg_tx_fee"), "gas_used")


def gas(tx: DataFrame, blocks: DataFrame, size_s: int, slide_s: int | None = None,
        exact_median: bool = True) -> DataFrame:
    """A09-A18 per ``(chainId, window_start)``.

    Price statistics come from transactions, gas/fee totals from blocks.
    The exact median is computed from per-pane price histograms (one row per
    chain, pane and distinct price, weighted by its count), so memory grows
    with distinct prices, not rows; ``exact_median=False`` uses
    ``approx_percentile`` over the rows instead.
    """
    slide_s = slide_s or size_s
    keys = ["chainId", "window_start"]
    feat = tx_features(tx)
    panes = feat.groupBy("chainId", pane_of("ts", slide_s).alias("pane")).agg(
        F.sum("gasPrice").alias("sp"), F.count("gasPrice").alias("np"),
        F.min("gasPrice").alias("mn"), F.max("gasPrice").alias("mx"))
    prices = fan_out(panes, size_s, slide_s).groupBy(*keys).agg(
        _ratio(F.sum("sp"), F.sum("np")).alias("avg_gas_price"),
        F.min("mn").cast("string").alias("min_gas_price"),
        F.max("mx").cast("string").alias("max_gas_price"))
    # Exact median from per-pane price histograms: (chain, pane, price) -> n
    # rows are fanned out instead of raw rows, and percentile() weighs each
    # price by its frequency (same result as over the expanded rows).
    hist = feat.groupBy("chainId", pane_of("ts", slide_s).alias("pane"),
                        F.col("gasPrice").cast("double").alias("p")).agg(F.count("*").alias("n"))
    if exact_median:
        median = fan_out(hist, size_s, slide_s).groupBy(*keys).agg(
            F.percentile("p", F.lit(0.5), F.col("n")).alias("median_gas_price"))
    else:  # percentile_approx takes no weights: row level
        rows = windowed(feat.select("chainId", "ts", F.col("gasPrice").cast("double").alias("p")),
                        "ts", size_s, slide_s)
        median = rows.groupBy(*keys).agg(
            F.percentile_approx("p", 0.5, 10000).cast("double").alias("median_gas_price"))

    bf = block_typed(blocks)
    bpanes = bf.groupBy("chainId", pane_of("ts", slide_s).alias("pane")).agg(
        F.sum("gasUsed").alias("gu"), F.sum("gasLimit").alias("gl"),
        F.sum("feesSpent").alias("fs"), F.count("*").alias("nb"))
    totals = fan_out(bpanes, size_s, slide_s).groupBy(*keys).agg(
        F.sum("gu").alias("gu"), F.sum("gl").alias("gl"), F.sum("fs").alias("fs"),
        F.sum("nb").alias("nb"))
    # left joins against sides that are distinct on the keys: unused ones are pruned
    out = prices.join(median, keys, "left").join(totals, keys, "left")
    return out.select(
        *keys,
        F.col("gu").cast(DEC).cast("string").alias("gas_used"),
        "avg_gas_price", "median_gas_price", "min_gas_price", "max_gas_price",
        F.col("fs").cast(DEC).cast("string").alias("fees_paid"),
        _ratio(F.col("gl"), F.col("nb")).alias("avg_gas_limit"),
        _ratio(F.col("gu"), F.col("nb")).alias("avg_gas_used"),
        (F.lit(100.0) * F.col("gu").cast("double") / F.col("gl").cast("double")).alias("gas_utilization_rate"),
        _ratio(F.col("gu"), F.col("gl")).alias("gas_efficiency"))


def performance(tx: DataFrame, blocks: DataFrame, size_s: int, slide_s: int | None = None) -> DataFrame:
    """A19-A24 per ``(chainId, window_start)``.

    Peak rates are two-level: per-second totals first (a second is its own
    pane), then the max over the window's seconds.
    """
    slide_s = slide_s or size_s
    keys = ["chainId", "window_start"]
    feat = tx_features(tx)
    per_sec = feat.groupBy("chainId", F.col("ts").alias("sec")).agg(
        F.count("*").alias("n"), F.sum("gasUsed").alias("g"))
    panes = per_sec.groupBy("chainId", pane_of("sec", slide_s).alias("pane")).agg(
        F.sum("n").alias("n"), F.sum("g").alias("g"), F.max("n").alias("mn"), F.max("g").alias("mg"))
    rates = fan_out(panes, size_s, slide_s).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("g").alias("g"), F.max("mn").alias("max_tps"),
        F.max("mg").alias("mg"))

    bf = block_features(blocks)
    bpanes = bf.groupBy("chainId", pane_of("ts", slide_s).alias("pane")).agg(
        F.sum("gap").alias("sg"), F.count("gap").alias("ng"),
        F.max_by(F.struct("number", "gap"), "number").alias("last"))
    gaps = fan_out(bpanes, size_s, slide_s).groupBy(*keys).agg(
        F.sum("sg").alias("sg"), F.sum("ng").alias("ng"),
        F.max_by(F.col("last.gap"), F.col("last.number")).alias("current_block_time"))
    out = rates.join(gaps, keys, "left")
    return out.select(
        *keys,
        _ratio(F.col("n"), F.lit(size_s)).alias("avg_tps"),
        F.col("max_tps").cast("bigint").alias("max_tps"),
        _ratio(F.col("g"), F.lit(size_s)).alias("avg_gps"),
        F.col("mg").cast(DEC).cast("string").alias("max_gps"),
        _ratio(F.col("sg"), F.col("ng")).alias("block_time"),
        F.col("current_block_time").cast("bigint").alias("current_block_time"))


def cumulative(tx: DataFrame, blocks: DataFrame, bucket_s: int, transfers: DataFrame | None = None) -> DataFrame:
    """Running totals per chain at every bucket with activity.

    ``transfers`` (chainId, ts, token) of all token standards give the tokens seen so far.

    Totals are aggregated per ``(chainId, bucket)`` first; the running sum is
    then a window over bucket rows (one row per chain and bucket), so the
    per-chain window holds buckets, not transactions.
    """
    feat = tx_features(tx)
    w = Window.partitionBy("chainId").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    bf = block_typed(blocks)
    b = bf.groupBy("chainId", pane_of("ts", bucket_s).alias("bucket")).agg(
        F.sum("txCount").alias("txs"), F.sum("gasUsed").alias("gas"),
        F.sum("feesSpent").alias("fees"), F.count("*").alias("nb"))

    roles = _roles(feat)
    firsts = roles.filter(F.col("role").isin("a", "s")).groupBy("chainId", "role", "item") \
        .agg(F.min("ts").alias("ts"))
    created = feat.filter(F.col("ok") & (F.coalesce(F.col("to"), F.lit("")) == ""))
    deployers = created.groupBy("chainId", F.col("from").alias("item")).agg(F.min("ts").alias("ts")) \
        .select("chainId", F.lit("d").alias("role"), "item", "ts")
    contracts = created.select("chainId", F.lit("k").alias("role"), F.lit(None).cast("string").alias("item"), "ts")
    facts = firsts.unionByName(deployers).unionByName(contracts)
    if transfers is not None:
        facts = facts.unionByName(transfers.filter("token <> ''").groupBy("chainId", F.col("token").alias("item"))
                                  .agg(F.min("ts").alias("ts")).withColumn("role", F.lit("x")))
    news = facts.groupBy(
        "chainId", pane_of("ts", bucket_s).alias("bucket")).agg(
        F.count_if(F.col("role") == "a").alias("na"), F.count_if(F.col("role") == "s").alias("ns"),
        F.count_if(F.col("role") == "k").alias("nk"), F.count_if(F.col("role") == "d").alias("nd"),
        F.count_if(F.col("role") == "x").alias("nx"))

    out = b.join(news, ["chainId", "bucket"], "full").na.fill(0, ["txs", "nb", "na", "ns", "nk", "nd", "nx"])
    return out.select(
        "chainId", F.col("bucket").alias("window_start"),
        F.sum("txs").over(w).cast("bigint").alias("total_txs"),
        F.sum("gas").over(w).cast(DEC).cast("string").alias("total_gas_used"),
        F.sum("fees").over(w).cast(DEC).cast("string").alias("total_fees_collected"),
        F.sum("nb").over(w).cast("bigint").alias("total_blocks_produced"),
        F.sum("na").over(w).cast("bigint").alias("cumulative_addresses"),
        F.sum("ns").over(w).cast("bigint").alias("cumulative_active_accounts"),
        F.sum("nk").over(w).cast("bigint").alias("cumulative_contracts"),
        F.sum("nd").over(w).cast("bigint").alias("cumulative_deployers"),
        *([F.sum("nx").over(w).cast("bigint").alias("cumulative_tokens")] if transfers is not None else []))


def active_contracts_trailing(tx: DataFrame, days: int = 30, day_s: int = 86400) -> DataFrame:
    """Distinct called contracts in the trailing ``days`` per chain and day."""
    feat = tx_features(tx).filter("is_call").select(
        "chainId", "ts", F.lit("c").alias("role"), F.col("to").alias("item"))
    counts = distinct_per_window(feat, days * day_s, day_s)
    return counts.select("chainId", (F.col("window_start") + (days - 1) * day_s).alias("day"),
                         F.col("n").cast("bigint").alias("active_contracts"))


# --- staking / bridge (A28-A33) ---------------------------------------------

def staking(validators: DataFrame, delegators: DataFrame) -> DataFrame:
    """One summary row (partial aggregates, no group key)."""
    stakes = validators.select(F.lit("v").alias("kind"), "nodeId", "stakeAmount").unionByName(
        delegators.select(F.lit("d").alias("kind"), "nodeId", "stakeAmount"))
    return stakes.agg(
        F.count_distinct(F.when(F.col("kind") == "v", F.col("nodeId"))).alias("validator_count"),
        F.count_if(F.col("kind") == "d").alias("delegator_count"),
        C.uint256_sum("stakeAmount").alias("total_staked"))


def bridge(bridge_txs: DataFrame, asset: str | None = None) -> DataFrame:
    """Active routes and tx count of all assets; amount bridged (of one asset or all)."""
    amount = F.col("amount") if asset is None else F.when(F.col("asset") == asset, F.col("amount"))
    return bridge_txs.agg(
        F.count_distinct("sourceChain", "destChain").alias("active_bridges"),
        F.count("*").alias("bridge_tx_count"),
        C.uint256_sum(amount).alias("total_bridged"))


# --- value transferred (A34-A35) ---------------------------------------------

def value_transferred(tx: DataFrame, bucket_s: int = 86400) -> DataFrame:
    """Exact 256-bit sum of native value per chain and bucket."""
    return tx.groupBy("chainId", pane_of("blockTimestamp", bucket_s).alias("window_start")).agg(
        C.uint256_sum("value").alias("value_transferred"), F.count("*").alias("tx_count"))


PRICE_DIGITS = 18  # decimal places of a price
MAX_DECIMALS = 77  # of a token: 10^77 is the largest power of ten in 256 bits
_USD_DIGITS = 182  # 104 of amount times price, and up to MAX_DECIMALS zeros


def value_transferred_usd(transfers: DataFrame, prices: DataFrame, bucket_s: int = 86400) -> DataFrame:
    """USD value of ERC20 transfers per bucket (J09), exact.

    Values are summed in limbs per (bucket, token), so 256-bit amounts keep all
    their digits.  Each token total times its price (an exact decimal of 18
    places, below 10^9) is brought to one denominator by appending zeros, and those texts
    are summed in limbs again.  No digit is rounded away.

    ``tokens`` were priced; ``unpriced_tokens`` have no usable price, or decimals
    outside 0 to 77; ``bad_amounts`` counts transfers whose value is not a
    digit string of at most 78 digits.
    """
    value = F.when(F.col("value").rlike(C.DIGITS) & (F.length("value") <= 78), F.col("value"))
    per_token = transfers.groupBy(pane_of("blockTimestamp", bucket_s).alias("window_start"),
                                  F.col("tokenAddress")).agg(
        C.uint256_sum(value).alias("raw"), F.count_if(value.isNull()).alias("bad"))
    # The price table is a dimension; the planner broadcasts it only under
    # spark.sql.autoBroadcastJoinThreshold (its size is checked), else shuffles.
    priced = per_token.join(prices.select("address", "decimals", "price"),
                            per_token["tokenAddress"] == prices["address"], "left")
    exact = F.col("price").try_cast(f"decimal(27,{PRICE_DIGITS})")
    usable = (exact >= 0) & F.col("decimals").between(0, MAX_DECIMALS)
    units = F.replace(exact.cast("string"), F.lit("."), F.lit("")).cast("decimal(27,0)")
    term = F.when(usable, F.concat(C.digits_times("raw", units),
                                   F.repeat(F.lit("0"), MAX_DECIMALS - F.col("decimals"))))
    term = F.regexp_replace(term, "^0+(?=.)", "")
    return priced.groupBy("window_start").agg(
        C.value_with_decimals(C.digits_sum(term, _USD_DIGITS), F.lit(MAX_DECIMALS + PRICE_DIGITS))
        .alias("value_transferred_usd"),
        F.count_if(F.coalesce(usable, F.lit(False))).alias("tokens"),
        F.count_if(~F.coalesce(usable, F.lit(False))).alias("unpriced_tokens"),
        F.sum("bad").cast("bigint").alias("bad_amounts"))


# --- token activity (A39, A40) and the hourly set (T07) ----------------------

def nft_mints(transfers: DataFrame) -> DataFrame:
    """Mints (from the zero address) and transfers per NFT token."""
    return transfers.groupBy("kind", "tokenAddress").agg(
        F.count_if(F.col("from") == ZERO_ADDRESS).alias("mints"), F.count("*").alias("transfers"))


def erc1155_batches(transfers: DataFrame) -> DataFrame:
    """Per (transaction, token) batch: size, exact value sum, token ids.

    A batch is one transaction's transfers of one token, so the collected
    id list is bounded by the transaction.
    """
    return transfers.groupBy("transactionHash", "tokenAddress").agg(
        F.count("*").alias("n"), C.uint256_sum("value").alias("total_value"),
        F.array_join(F.array_sort(F.collect_list("tokenId")), ",").alias("token_ids"))


def hourly_set(feat: DataFrame, blocks: DataFrame, size_s: int = 3600) -> DataFrame:
    """The five hourly chain metrics (tumbling, so panes are windows)."""
    base = feat.groupBy("chainId", pane_of("ts", size_s).alias("window_start")).agg(
        F.count("*").alias("tx_count"), F.sum("gasPrice").alias("sp"),
        F.count("gasPrice").alias("np"))
    addrs = address_counts(feat, size_s, size_s, ("a",))
    fees = block_typed(blocks).groupBy("chainId", pane_of("ts", size_s).alias("window_start")) \
        .agg(F.sum("feesSpent").alias("fs"))
    return base.join(addrs, KEYS).join(fees, KEYS, "left").select(
        *KEYS, "active_addresses", F.col("tx_count").cast("bigint").alias("tx_count"),
        _ratio(F.col("tx_count"), F.lit(size_s)).alias("avg_tps"),
        _ratio(F.col("sp"), F.col("np")).alias("avg_gas_price"),
        F.col("fs").cast(DEC).cast("string").alias("fees_paid"))
