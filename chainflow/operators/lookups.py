"""Lookups as joins (J01-J11) and set operations.

Dimension sides (chain sets, subscriptions, watch lists, topic maps, price
tables) are small; the planner broadcasts them only while their measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a
shuffle join beyond it.  A hint is given to narrow rows that were counted
(``small``), so nothing unbounded is ever broadcast on a hint.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainflow.functions import scalar as C

WILD = "*"
SMALL_ROWS = 500_000  # narrow rows that may be broadcast once they are counted


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """``df``, broadcast in joins where it is counted to have at most ``most`` rows; else the planner decides."""
    if df.isStreaming or df.limit(most + 1).count() > most:
        return df
    return F.broadcast(df)


def heads_join_blocks(heads: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each new head -> its full block by hash; unmatched heads drop."""
    return heads.join(blocks, heads["hash"] == blocks["blockHash"], "inner")


def chains_join_detail(chains: DataFrame, details: DataFrame) -> DataFrame:
    """Chain list ⋈ detail on chainId; chains without detail drop."""
    return chains.join(details, "chainId", "inner")


def subnets_join_detail(subnets: DataFrame, details: DataFrame) -> DataFrame:
    """Every subnet, with its detail when found."""
    return subnets.join(details, "subnetId", "left")


def chain_set(spark, seed: list[str], seen: DataFrame | None = None,
              col: str = "chainId") -> DataFrame:
    """Monitored chains: configured seed ∪ chains seen in chain events, distinct."""
    base = spark.createDataFrame([(c,) for c in seed], f"{col} string")
    return base.unionByName(seen.select(col)).distinct() if seen is not None else base


def blocks_semi_chains(blocks: DataFrame, chains: DataFrame) -> DataFrame:
    """Blocks of monitored chains (J04 / F08): a left-semi join."""
    return blocks.join(chains, "chainId", "left_semi")


PART_ROWS = 100_000  # messages of one match key that a part holds
LIST_ROWS = 1_000  # subscribers of one match key that a list holds, about
TASK_PAIRS = 10_000_000  # pairs that a task returns, about; a core has its share of fewer


def resolve_subscriptions(subs: DataFrame) -> DataFrame:
    """Latest subscription per client wins."""
    latest = subs.groupBy("clientId").agg(
        F.max_by(F.struct("subTopic", "subChain"), "subTime").alias("s"))
    return latest.select("clientId", "s.subTopic", "s.subChain")


def subscription_periods(subs: DataFrame) -> DataFrame:
    """Each subscription with the time span ``[validFrom, validTo)`` in which it was its client's latest (T13 over time)."""
    later = Window.partitionBy("clientId").orderBy("subTime")
    return subs.select("clientId", "subTopic", "subChain", F.col("subTime").alias("validFrom"),
                       F.lead("subTime").over(later).alias("validTo"))


def fanout_subscriptions(messages: DataFrame, subs: DataFrame, type_col: str = "type", chain_col: str = "chainId",
                         time_col: str | None = None, part_rows: int = PART_ROWS, small_rows: int = SMALL_ROWS) -> DataFrame:
    """Message × subscriber where topic and chain each match exactly or by
    wildcard (``""`` or ``"*"``) (J05).

    With ``time_col``, ``subs`` are periods and a message meets those that held at its time (T12).

    The OR condition would plan as a nested-loop join.  Instead each message
    is expanded to its four match keys — (type, chain), (type, *), (*, chain),
    (*, *) — and subscribers' wildcards are normalised to ``*``: one equi-join,
    output exactly the matching pairs.

    Keys are counted on both sides first, and subscribers that no message can meet are left out.  The others
    are joined as lists, unpacked after the join.  Where few are left (``small_rows``), the lists are broadcast, and the messages,
    each shuffled once, are dealt over as many tasks as their pairs need.  Else a key with more than
    ``part_rows`` messages, as (*, *) has in the end, is dealt over as many parts as it needs, and
    only the subscribers of such keys are copied to their parts.  The messages of a stream are not counted.
    """
    norm = lambda c: F.when(F.coalesce(F.col(c), F.lit("")).isin("", WILD), F.lit(WILD))
    span = ["validFrom", "validTo"] if time_col else []
    on = ["_kt", "_kc"]
    s = subs.select("clientId", norm("subTopic").otherwise(F.col("subTopic")).alias("_kt"),
                    norm("subChain").otherwise(F.col("subChain")).alias("_kc"), *span)
    held = lambda at: (at >= F.col("validFrom")) & (F.col("validTo").isNull() | (at < F.col("validTo")))
    keys = lambda t, c: F.explode(F.array(*(F.struct(x.alias("_kt"), y.alias("_kc")) for x in (t, F.lit(WILD))
                                            for y in (c, F.lit(WILD)))))
    keyed = lambda df: df.select("*", keys(F.col(type_col), F.col(chain_col)).alias("_k")).select("*", "_k.*").drop("_k")
    if messages.isStreaming:  # a micro-batch is bounded, and a stream cannot be counted first
        out = keyed(messages).join(s, on).drop(*on)
        return out.filter(held(F.col(time_col))).drop(*span) if time_col else out
    if time_col:  # an empty period holds at no time
        s = s.filter(held(F.col("validFrom")))
    met = (messages.groupBy(F.col(type_col).alias("_t"), F.col(chain_col).alias("_c")).count()
           .select("count", keys(F.col("_t"), F.col("_c")).alias("_k")).groupBy("_k._kt", "_k._kc").agg(F.sum("count").alias("_n")))
    met = s.groupBy(*on).agg(F.count(F.lit(1)).alias("_subs")).join(met, on)
    n_keys, n_subs, pairs = met.agg(F.count(F.lit(1)), F.coalesce(F.sum("_subs"), F.lit(0)),
                                    F.coalesce(F.sum(F.col("_subs").cast("double") * F.col("_n")), F.lit(0.0))).first()
    few = F.broadcast if n_keys <= SMALL_ROWS else (lambda df: df)
    lists = F.ceil(F.col("_subs") / LIST_ROWS)
    hashed = lambda df: F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    s = (s.withColumn("_list", hashed(s)).join(few(met), on).withColumn("_list", F.pmod("_list", lists))
         .groupBy(*on, "_n", "_list").agg(F.collect_list(F.struct("clientId", *span)).alias("_subs")))
    m = messages
    if n_subs <= small_rows:
        cores = messages.sparkSession.sparkContext.defaultParallelism
        tasks = max(math.ceil(pairs / TASK_PAIRS), min(cores, math.ceil(pairs * 20 / TASK_PAIRS)))
        if tasks > 1:
            m = m.repartition(tasks, hashed(m))
        out = keyed(m).join(F.broadcast(s), on)
    else:
        parts = F.ceil(F.col("_n") / part_rows).cast("int")
        s = s.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        m = keyed(m.withColumn("_part", hashed(m))).join(few(met.select(*on, "_n")), on)
        out = m.withColumn("_part", F.pmod("_part", parts).cast("int")).drop("_n").join(s, [*on, "_part"])
    columns = [f"`{c}`" for c in messages.columns]
    out = out.select(*columns, F.explode("_subs").alias("_s")).select(*columns, "_s.*")
    return out.filter(held(F.col(time_col))).drop(*span) if time_col else out


def tx_semi_watchlist(tx: DataFrame, watch: DataFrame, address_col: str = "address") -> DataFrame:
    """Transactions touching a watched address.

    Participants (C13) are exploded, semi-joined to the lower-cased watch
    list, and the matching (txHash, address) pairs returned.
    """
    parts = tx.select("txHash", F.explode(C.tx_participants()).alias("address"))
    w = watch.select(F.lower(F.col(address_col)).alias("address")).distinct()
    return parts.join(small(w), "address", "left_semi")


def events_join_topics(events: DataFrame, topic_map: DataFrame) -> DataFrame:
    """Event type -> topic (J07); unmapped types drop (inner)."""
    return events.join(topic_map, "event_type", "inner")


def unmapped_events(events: DataFrame, topic_map: DataFrame) -> DataFrame:
    """The rejects of J07: event types with no topic."""
    return events.join(topic_map, "event_type", "left_anti")


def delegators_join_validators(delegators: DataFrame, validators: DataFrame) -> DataFrame:
    """Delegator ⋈ validator on nodeId, delegators kept."""
    v = validators.select("nodeId", F.col("stakeAmount").alias("validatorStake"),
                          F.col("uptime").alias("validatorUptime"))
    return delegators.join(v, "nodeId", "left")


def transfers_join_prices(transfers: DataFrame, prices: DataFrame,
                          token_col: str = "tokenAddress") -> DataFrame:
    """Transfer ⋈ token price -> USD value per transfer.

    Transfers of a token without a price are kept: ``price`` and ``valueUsd`` are NULL.
    A 256-bit value is read as a double, so no digits are cut off.
    """
    p = small(prices.select(F.lower("address").alias("_addr"), "decimals", "price"))
    j = transfers.join(p, F.lower(F.col(token_col)) == F.col("_addr"), "left").drop("_addr")
    value = F.when(F.col("value").rlike(C.DIGITS), F.col("value")).cast("double")
    usd = value / F.pow(F.lit(10.0), F.col("decimals")) * F.col("price")
    return j.withColumn("valueUsd", usd)


def children_join_parent(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Child rows -> parent transaction on transactionHash = txHash."""
    p = parents.select(F.col("txHash"), *[F.col(c).alias("parent" + c[0].upper() + c[1:])
                                          for c in parents.columns if c != "txHash"])
    return children.join(p, children["transactionHash"] == p["txHash"], "inner").drop("txHash")


def snapshot_changes(current: DataFrame, previous: DataFrame, key: str, entity: str) -> DataFrame:
    """Classify rows of a new snapshot against the previous one.

    New key -> ``<entity>.created``; same key with different content
    (null-safe comparison of all columns) -> ``<entity>.updated``; equal rows
    emit nothing.
    """
    cols = [c for c in current.columns if c != key]
    prev = previous.select(key, F.struct(*cols).alias("_prev"), F.lit(True).alias("_had"))
    j = current.select(key, F.struct(*cols).alias("_cur")).join(prev, key, "left")
    kind = (F.when(F.col("_had").isNull(), F.lit(f"{entity}.created"))
            .when(~F.col("_cur").eqNullSafe(F.col("_prev")), F.lit(f"{entity}.updated")))
    return j.select(key, kind.alias("event_type")).filter(F.col("event_type").isNotNull())


# --- set operations ---------------------------------------------------------

def union_all(*frames: DataFrame, distinct: bool = False, allow_missing: bool = False) -> DataFrame:
    """``unionByName`` of all frames (U01, U02, U04, U05); duplicates kept unless asked."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out.distinct() if distinct else out
