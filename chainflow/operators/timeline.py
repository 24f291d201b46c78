"""Ordered operators (W04-W07, O01-O04): running totals, gaps, continuity, pages.

A plain ``Window.partitionBy("chainId")`` puts one whole chain in one task,
and one chain may hold a third of all rows.  The per-chain ordered operators
here are therefore *segmented*: rows are cut into ranges of the order key
(``segment`` consecutive block numbers), the work runs per range in
parallel, and only one small row per range (its total / its last value) goes
through a per-chain window to carry across range borders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainflow.session import checkpoint_dir

SEGMENT = 4096  # order-key values per range
GAP_SLICE = 100_000  # missing numbers made at once


def _seg(order: str, segment: int) -> Column:
    return F.floor(F.col(order) / segment).cast("bigint")


def segmented_lag(df: DataFrame, key: str, order: str, value: str, out: str,
                  segment: int = SEGMENT) -> DataFrame:
    """``lag(value)`` over ``key`` ordered by ``order``, without a per-key task.

    Within a range the previous row comes from a window partitioned by
    (key, range).  The first row of a range takes the last value of the
    nearest earlier non-empty range, found on the per-range summary.
    """
    d = df.withColumn("_seg", _seg(order, segment))
    w_in = Window.partitionBy(key, "_seg").orderBy(order)
    d = d.withColumn("_prev", F.lag(value).over(w_in))
    last = d.groupBy(key, "_seg").agg(F.max_by(F.col(value), F.col(order)).alias("_last"))
    w_seg = Window.partitionBy(key).orderBy("_seg")
    carry = last.select(key, "_seg", F.lag("_last").over(w_seg).alias("_carry"))
    first = F.row_number().over(w_in) == 1
    return d.join(carry, [key, "_seg"], "left") \
        .withColumn(out, F.when(first, F.col("_carry")).otherwise(F.col("_prev"))) \
        .drop("_seg", "_prev", "_carry")


def segmented_running_sum(df: DataFrame, key: str, order: str, value: str, out: str,
                          segment: int = SEGMENT) -> DataFrame:
    """Running ``sum(value)`` per key in ``order`` (rows up to and including this one)."""
    d = df.withColumn("_seg", _seg(order, segment))
    w_in = Window.partitionBy(key, "_seg").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_run", F.sum(value).over(w_in))
    totals = d.groupBy(key, "_seg").agg(F.sum(value).alias("_tot"))
    w_seg = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_seg", F.coalesce(F.sum("_tot").over(w_seg), F.lit(0)).alias("_off"))
    return d.join(offsets, [key, "_seg"], "left") \
        .withColumn(out, F.col("_run") + F.col("_off")).drop("_seg", "_run", "_off")


def segmented_row_number(df: DataFrame, key: str, segment: Column, order: list, out: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY key ORDER BY order)`` for hot keys.

    ``segment`` must be monotone in ``order`` (e.g. the hour of a timestamp
    that leads the order).  Rows are numbered within (key, segment); each
    segment's offset is a running sum over the per-segment counts — a table
    with one row per (key, segment), not per row.
    """
    d = df.withColumn("_seg", segment)
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(key, "_seg").orderBy(*order)))
    counts = d.groupBy(key, "_seg").agg(F.count("*").alias("_n"))
    w_seg = Window.partitionBy(key).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_seg", F.coalesce(F.sum("_n").over(w_seg), F.lit(0)).alias("_off"))
    return d.join(offsets, [key, "_seg"], "left").withColumn(out, F.col("_rn") + F.col("_off")) \
        .drop("_seg", "_rn", "_off")


def cumulative_tx(blocks: DataFrame) -> DataFrame:
    """``cumulativeTransactions`` per block: running txCount per chain."""
    b = blocks.withColumn("_n", F.col("blockNumber").cast("bigint")) \
        .withColumn("_tx", F.col("txCount").cast("bigint"))
    return segmented_running_sum(b, "chainId", "_n", "_tx", "cumulativeTransactions") \
        .drop("_n", "_tx")


def block_gaps(blocks: DataFrame) -> DataFrame:
    """Seconds since the previous block of the same chain (W05); NULL for the first."""
    b = blocks.withColumn("_n", F.col("blockNumber").cast("bigint"))
    with_prev = segmented_lag(b, "chainId", "_n", "blockTimestamp", "_prevTs")
    return with_prev.withColumn("gapSeconds", F.col("blockTimestamp") - F.col("_prevTs")) \
        .drop("_n", "_prevTs")


def chain_continuity(blocks: DataFrame, ranges: bool = False) -> DataFrame:
    """Missing block numbers and parent-hash breaks per chain.

    Returns one row per missing number (``kind = 'missing'``) and one per
    block whose ``parentHash`` differs from the previous block's hash while
    numbers are consecutive (``kind = 'parent_mismatch'``).  With
    ``ranges=True`` each gap is one row ``(chainId, fromBlock, toBlock)``,
    so output size no longer grows with the length of a gap.
    """
    b = blocks.withColumn("_n", F.col("blockNumber").cast("bigint"))
    both = segmented_lag(b.withColumn("_block", F.struct(F.col("_n").alias("n"), F.col("blockHash").alias("hash"))),
                         "chainId", "_n", "_block", "_before")
    gap = both.filter(F.col("_n") - F.col("_before.n") > 1).select(
        "chainId", (F.col("_before.n") + 1).alias("fromBlock"), (F.col("_n") - 1).alias("toBlock"))
    if ranges:
        return gap
    slices = gap.select("chainId", "toBlock", F.explode(
        F.sequence("fromBlock", "toBlock", F.lit(GAP_SLICE))).alias("_from"))
    gaps = slices.select("chainId", F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_from") + GAP_SLICE - 1, F.col("toBlock")))).alias("blockNumber"),
        F.lit("missing").alias("kind"))
    breaks = both.filter((F.col("_n") - F.col("_before.n") == 1)
                         & (F.col("parentHash") != F.col("_before.hash"))).select(
        "chainId", F.col("_n").alias("blockNumber"), F.lit("parent_mismatch").alias("kind"))
    return gaps.unionByName(breaks)


def chain_forks(blocks: DataFrame) -> DataFrame:
    """Canonical chain, orphans and broken parents among competing blocks.

    One row per (chainId, blockNumber, blockHash) with ``link`` and ``status``:

    * ``link`` is ``start`` if the chain has no block one number lower, ``linked`` if
      one of those has the ``parentHash``, else ``broken``.  A broken block is taken to
      follow the one with the smallest hash among them.
    * ``status`` is ``canonical`` for the blocks on the way back from the tip of each
      stretch of consecutive numbers (its last number's smallest hash), else ``orphan``.

    A number with one block is canonical whatever the branches do, as every way back
    passes it.  Only rows of contested numbers are searched: from the block that the
    uncontested number above names, pointers to the 1st, 2nd, 4th, ... ancestor mark
    the branch, doubling its length per round.  Rounds grow with the logarithm of the
    longest fork, not of the chain, and no chain or fork is gathered in one task.

    Defined cases: repeated reports of a hash count once (of several parents the
    smallest counts); a null parent is broken; rows without chain, hash or a whole
    number are left out; other columns are ignored; an empty table gives no rows.
    """
    checkpoint_dir(blocks.sparkSession)
    block = ["chainId", "n", "blockHash"]
    reports = (blocks.select("chainId", F.expr("try_cast(blockNumber AS bigint)").alias("n"), "blockHash", "parentHash")
               .dropna(subset=block).groupBy(*block).agg(F.min("parentHash").alias("parentHash")))
    heights = reports.groupBy("chainId", "n").agg(F.count("*").alias("width"), F.min("blockHash").alias("least"))
    below = heights.select("chainId", (F.col("n") + 1).alias("n"), F.col("least").alias("leastBelow"),
                           F.col("width").alias("widthBelow"))
    above = heights.select("chainId", (F.col("n") - 1).alias("n"), F.lit(True).alias("continued"))
    parents = reports.select("chainId", (F.col("n") + 1).alias("n"), F.col("blockHash").alias("parentHash"),
                             F.lit(True).alias("known"))
    linked = (reports.join(heights, ["chainId", "n"]).join(below, ["chainId", "n"], "left")
              .join(above, ["chainId", "n"], "left").join(parents, ["chainId", "n", "parentHash"], "left")
              .withColumn("link", F.when(F.col("leastBelow").isNull(), "start").when(F.col("known"), "linked")
                          .otherwise("broken"))
              .withColumn("up", F.when(F.col("known"), F.col("parentHash")).otherwise(F.col("leastBelow")))
              .select(*block, "link", "up", "width", "widthBelow", "least",
                      F.coalesce("continued", F.lit(False)).alias("continued"))).checkpoint()

    marks = [linked.where("width = 1 AND widthBelow > 1").select("chainId", (F.col("n") - 1).alias("n"),
                                                                 F.col("up").alias("blockHash"))
             .union(linked.where("width > 1 AND NOT continued AND blockHash = least").select(*block))]
    jump = linked.where("width > 1 AND widthBelow > 1").select(*block, "up")
    step = 1
    while not jump.isEmpty():
        marked = reduce(DataFrame.union, marks)
        marks.append(marked.join(jump, block).select("chainId", (F.col("n") - step).alias("n"),
                                                     F.col("up").alias("blockHash")).checkpoint())
        further = jump.select("chainId", (F.col("n") + step).alias("n"), F.col("blockHash").alias("up"),
                              F.col("up").alias("_up"))
        jump = jump.join(further, ["chainId", "n", "up"]).select(*block, F.col("_up").alias("up")).checkpoint()
        step *= 2
    marked = reduce(DataFrame.union, marks).withColumn("marked", F.lit(True))
    return linked.join(marked, block, "left").select(
        "chainId", F.col("n").alias("blockNumber"), "blockHash", "link",
        F.when((F.col("width") == 1) | F.col("marked"), "canonical").otherwise("orphan").alias("status"))


def keyset_page(df: DataFrame, key: str, page_size: int, after=None,
                descending: bool = False) -> DataFrame:
    """One page after a token: ``filter(key > token).orderBy(key).limit(n)``.

    The limit is the feature (a page).  ``orderBy + limit`` plans as a
    per-partition top-k, so at most ``page_size + 1`` rows ever meet; the
    extra row only tells whether a next page exists.  ``next_token`` is the
    page's last key when it does.
    """
    k = F.col(key)
    src = df if after is None else df.filter(k < after if descending else k > after)
    order = k.desc() if descending else k.asc()
    top = src.orderBy(order).limit(page_size + 1)
    whole = Window.partitionBy(F.lit(1))  # over ≤ page_size + 1 rows
    numbered = top.withColumn("_rn", F.row_number().over(Window.orderBy(order))) \
        .withColumn("_more", F.max("_rn").over(whole) > page_size)
    page = numbered.filter(F.col("_rn") <= page_size)
    edge = (F.min(k) if descending else F.max(k)).over(whole)
    return page.withColumn("next_token", F.when(F.col("_more"), edge)).drop("_rn", "_more")


def keyset_pages(df: DataFrame, group: str, key: str, page_size: int, after=None,
                 descending: bool = False, segment: int = 1 << 20) -> DataFrame:
    """One page per group after a token (O01/O02/S03 in set form).

    Two-phase top-k, so a hot group is never sorted in one task: keep the
    first ``page_size + 1`` rows of every (group, key range), then rank only
    those survivors per group.  ``next_token`` = the page's last key when a
    further row exists.
    """
    k = F.col(key)
    src = df if after is None else df.filter(k < after if descending else k > after)
    order = k.desc() if descending else k.asc()
    seg = F.floor(k / segment)
    first = src.withColumn("_r", F.row_number().over(Window.partitionBy(group, seg).orderBy(order))) \
        .filter(F.col("_r") <= page_size + 1).drop("_r")
    ranked = first.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(order))) \
        .filter(F.col("_rn") <= page_size + 1)
    whole = Window.partitionBy(group)
    page = ranked.withColumn("_more", F.max("_rn").over(whole) > page_size) \
        .filter(F.col("_rn") <= page_size)
    edge = (F.min(k) if descending else F.max(k)).over(whole)
    return page.withColumn("next_token", F.when(F.col("_more"), edge)).drop("_rn", "_more")


def drain_pages(df: DataFrame, key: str, page_size: int, partition: str | None = None) -> DataFrame:
    """All pages at once (O04): page number = ``(rank - 1) div page_size``.

    Ranks come from a segmented running count, so a partition's rows never
    meet in one task.  With ``partition`` (e.g. chainId) pages are per key.
    """
    part = partition or "_all"
    d = df if partition else df.withColumn("_all", F.lit(0))
    d = d.withColumn("_one", F.lit(1).cast("bigint")).withColumn("_k", F.col(key).cast("bigint"))
    ranked = segmented_running_sum(d, part, "_k", "_one", "_rank")
    out = ranked.withColumn("page", F.floor((F.col("_rank") - 1) / page_size).cast("bigint")) \
        .drop("_one", "_k", "_rank")
    return out if partition else out.drop("_all")
