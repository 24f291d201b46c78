"""Whole metric families on streams (T03, T04, T05, T07), equal to their batch forms.

Transactions and blocks become *facts*: counted transactions of a second, addresses by role,
gas prices, blocks.  Facts of the same second are combined before the shuffle, so a busy chain
sends one row for many transactions.  Addresses are dealt over ``shards`` by hash; a chain's
other facts, which are few by then, go to its shard 0.

One ``transformWithStateInPandas`` operator keeps, for each chain and shard,

* a map of *panes* (slide-sized buckets) with exact address sets, price histograms, per-second totals
  and the pane's blocks in order of their numbers,
* a map of the first time that each address was seen, kept for good (the answer to "new" needs it), and
* the last block that has left the panes, from which the next one's gap is measured.

An event-time timer at each window's end gives the window's partial row and evicts the
pane that no later window needs.  A pane's address that turns out to be seen earlier moves to the earlier pane as
long as both are open, so late rows within the watermark count as if they had come in order.
A second, built-in aggregation adds up the shards.  A window is given once, when the
watermark has passed its end.  Both inputs carry a watermark; the slower one decides.

Gaps between blocks assume that a chain's block times don't fall as its numbers rise.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from chainflow.operators import metrics as M

WATERMARK = "10 minutes"
SHARDS = 16

_FACT = "chainId string, kind string, item string, ts long, n long, ok long, fee decimal(38,0), gas decimal(38,0), cap decimal(38,0)"

#: Partial measures of a window: how shards are added up, and the type.
_SUMMED = {"tx_count": "long", "success_count": "long", "active_addresses": "long", "active_senders": "long",
           "unique_contracts": "long", "new_addresses": "long", "price_n": "long", "blocks": "long", "block_txs": "long",
           "gap_sum": "long", "gap_n": "long"}
_SUMMED_DIGITS = ("fee", "gas", "price_sum", "block_fees", "block_gas", "block_cap")
_SINGLE = {"max_tps": "long", "max_gps": "string", "min_price": "string", "max_price": "string", "median_price": "double",
           "last_gap": "long"}  # known to shard 0 alone
_PARTIAL = (["windowEnd timestamp", "window_start long"] + [f"{c} {t}" for c, t in _SUMMED.items()]
            + [f"{c} string" for c in _SUMMED_DIGITS] + [f"{c} {t}" for c, t in _SINGLE.items()])


def _combined(facts: DataFrame) -> DataFrame:
    """Facts of the same second and item as one, within each Arrow batch."""
    keys = ["chainId", "kind", "item", "ts"]
    added = ["n", "ok", "fee", "gas", "cap"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by(keys).aggregate([(c, "sum") for c in added])
                table = table.rename_columns([c.removesuffix("_sum") for c in table.column_names])
                yield from table.select(batch.schema.names).cast(batch.schema).to_batches()

    return facts.mapInArrow(run, _FACT)


def _fact(kind: str, item: Column | None, n=0, ok=0, fee=None, gas=None) -> Column:
    none = F.lit(None).cast(M.DEC)
    return F.struct(F.lit(kind).alias("kind"), (F.lit(None) if item is None else item).cast("string").alias("item"),
                    F.lit(n).cast("long").alias("n"), (F.lit(ok) if isinstance(ok, int) else ok).cast("long").alias("ok"),
                    (none if fee is None else fee).cast(M.DEC).alias("fee"),
                    (none if gas is None else gas).cast(M.DEC).alias("gas"), none.alias("cap"))


def facts(tx: DataFrame, blocks: DataFrame, kinds: str, watermark: str = WATERMARK, shards: int = SHARDS) -> DataFrame:
    """The facts of both streams, with event time, watermark and shard.

    ``kinds`` are letters: t transactions, a parties, s senders, c called contracts, p prices, b blocks.
    """
    feat = M.tx_features(tx)
    of = {"t": [_fact("t", None, 1, F.col("ok"), F.col("fee"), F.col("gasUsed"))],
          "a": [_fact("a", F.col("from")), _fact("a", F.col("to"))], "s": [_fact("s", F.col("from"))],
          "c": [_fact("c", F.when(F.col("is_call"), F.col("to")))], "p": [_fact("p", F.col("gasPrice"), 1)]}
    entries = [f for k in kinds if k in of for f in of[k]]
    mine = (feat.select("chainId", "ts", F.explode(F.array(*entries)).alias("f"))
            .select("chainId", "f.kind", "f.item", "ts", "f.n", "f.ok", "f.fee", "f.gas", "f.cap")
            .filter((F.col("kind") == "t") | (F.col("item") != "")))

    def timed(df: DataFrame) -> DataFrame:
        return _combined(df).withColumn("eventTime", F.timestamp_seconds("ts")).withWatermark("eventTime", watermark)

    out = timed(mine)
    if "b" in kinds:
        out = out.union(timed(M.block_typed(blocks).select(
            "chainId", F.lit("b").alias("kind"), F.col("number").cast("string").alias("item"), "ts",
            F.col("txCount").alias("n"), F.lit(0).cast("long").alias("ok"), F.col("feesSpent").cast(M.DEC).alias("fee"),
            F.col("gasUsed").cast(M.DEC).alias("gas"), F.col("gasLimit").cast(M.DEC).alias("cap"))))
    own = F.when(F.col("kind").isin("a", "s", "c"), F.pmod(F.xxhash64("item"), F.lit(shards))).otherwise(0)
    return out.withColumn("shard", own.cast("int"))


def weighted_median(prices: dict[int, int]) -> float | None:
    """The exact median of a histogram, as ``percentile`` gives it: halfway between two middle values."""
    total = sum(prices.values())
    if not total:
        return None
    low, high = (total - 1) // 2, total // 2
    seen, found = 0, []
    for price in sorted(prices):
        before, seen = seen, seen + prices[price]
        found += [price for at in (low, high) if before <= at < seen]
    a, b = float(found[0]), float(found[1])
    return a if a == b else 0.5 * a + 0.5 * b


class WindowState(StatefulProcessor):
    """Panes of one chain and shard; a timer at each window's end gives its partial measures."""

    def __init__(self, size_s: int, slide_s: int):
        self.size, self.slide = size_s, slide_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "body string")
        self.first = handle.getMapState("first", "address string", "ts long")
        self.left = handle.getValueState("left", "number long, ts long")
        self.loaded: dict[tuple, dict[int, dict | None]] = {}  # panes that this batch has read for its timers

    def _load(self, pane: int) -> dict | None:
        got = self.panes.getValue((pane,))
        if got is None:
            return None
        body = json.loads(got[0])
        return body | {r: set(body[r]) for r in ("a", "s", "c", "new")}

    def _window(self, key: tuple, start: int, end: int) -> dict[int, dict]:
        """The stored panes of a window; each is read once for all windows of a batch."""
        known = {p: b for p, b in self.loaded.get(key, {}).items() if p >= start}
        for p in range(start, end, self.slide):
            if p not in known:
                known[p] = self._load(p)
        self.loaded[key] = known
        return {p: known[p] for p in range(start, end, self.slide) if known[p] is not None}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        touched: dict[int, dict] = {}
        firsts: dict[str, int] = {}

        def body(ts: int) -> dict:
            pane = ts - ts % self.slide
            if pane not in touched:
                got = self._load(pane)
                if got is None:
                    got = {"n": 0, "ok": 0, "fee": 0, "gas": 0, "a": set(), "s": set(), "c": set(), "new": set(),
                           "price": {}, "second": {}, "block": {}}
                    for end in range(pane + self.slide, pane + self.size + 1, self.slide):
                        self.handle.registerTimer(end * 1000)
                touched[pane] = got
            return touched[pane]

        def digits(x) -> int:
            return 0 if x is None or x != x else int(x)

        for frame in rows:
            columns = (frame[c].tolist() for c in ("kind", "item", "ts", "n", "ok", "fee", "gas", "cap"))
            for kind, item, ts, n, ok, fee, gas, cap in zip(*columns):
                at = body(ts)
                if kind == "t":
                    at["n"] += n
                    at["ok"] += ok
                    at["fee"] += digits(fee)
                    at["gas"] += digits(gas)
                    second = at["second"].setdefault(str(ts), [0, 0])
                    second[0] += n
                    second[1] += digits(gas)
                elif kind == "p":
                    at["price"][item] = at["price"].get(item, 0) + n
                elif kind == "b":
                    at["block"][item] = [ts, n, digits(fee), digits(gas), digits(cap)]
                else:
                    at[kind].add(item)
                    if kind == "a" and ts < firsts.get(item, ts + 1):
                        firsts[item] = ts
        for item, ts in firsts.items():
            known = self.first.getValue((item,))
            if known is None or ts < known[0]:
                if known is not None:  # both panes are open: the earlier row was not late
                    body(known[0])["new"].discard(item)
                body(ts)["new"].add(item)
                self.first.updateValue((item,), (ts,))
        self.loaded.pop(tuple(key), None)
        for pane, got in touched.items():
            self.panes.updateValue((pane,), (json.dumps(got | {r: sorted(got[r]) for r in ("a", "s", "c", "new")}),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() // 1000
        start = end - self.size
        bodies = self._window(tuple(key), start, end)
        left = self.left.get() if self.left.exists() else None
        if bodies:
            yield pd.DataFrame([self._measures(list(bodies.values()), left) | {
                "chainId": key[0], "windowEnd": pd.Timestamp(end, unit="s", tz="UTC"), "window_start": start}])[
                    ["chainId", *(c.split()[0] for c in _PARTIAL)]]
        if start in bodies:
            blocks = [(int(number), b[0]) for number, b in bodies[start]["block"].items()]
            if blocks and (left is None or max(blocks)[0] > left[0]):
                self.left.update(max(blocks))
            self.panes.removeKey((start,))
            self.loaded[tuple(key)].pop(start)

    @staticmethod
    def _measures(bodies: list[dict], left: tuple | None) -> dict:
        union = {r: len(set().union(*(b[r] for b in bodies))) for r in ("a", "s", "c", "new")}
        prices: dict[int, int] = {}
        for b in bodies:
            for price, n in b["price"].items():
                prices[int(price)] = prices.get(int(price), 0) + n
        seconds = [s for b in bodies for s in b["second"].values()]
        blocks = sorted((int(number), x) for b in bodies for number, x in b["block"].items())
        times = ([left[1]] if left else []) + [x[0] for _, x in blocks]
        gaps = [b - a for a, b in zip(times, times[1:])]
        return {
            "tx_count": sum(b["n"] for b in bodies), "success_count": sum(b["ok"] for b in bodies),
            "fee": str(sum(b["fee"] for b in bodies)), "gas": str(sum(b["gas"] for b in bodies)),
            "active_addresses": union["a"], "active_senders": union["s"], "unique_contracts": union["c"],
            "new_addresses": union["new"],
            "price_n": sum(prices.values()), "price_sum": str(sum(p * n for p, n in prices.items())),
            "min_price": str(min(prices)) if prices else None, "max_price": str(max(prices)) if prices else None,
            "median_price": weighted_median(prices),
            "max_tps": max((s[0] for s in seconds), default=None),
            "max_gps": str(max(s[1] for s in seconds)) if seconds else None,
            "blocks": len(blocks), "block_txs": sum(x[1] for _, x in blocks),
            "block_fees": str(sum(x[2] for _, x in blocks)), "block_gas": str(sum(x[3] for _, x in blocks)),
            "block_cap": str(sum(x[4] for _, x in blocks)),
            "gap_sum": sum(gaps), "gap_n": len(gaps), "last_gap": gaps[-1] if gaps else None}


def windows(tx: DataFrame, blocks: DataFrame, size_s: int, slide_s: int, kinds: str, watermark: str = WATERMARK,
            shards: int = SHARDS) -> DataFrame:
    """All measures of every closed window with transactions, shards added up."""
    if size_s % slide_s:
        raise ValueError("window size must be a multiple of the slide")
    partial = facts(tx, blocks, kinds, watermark, shards).groupBy("chainId", "shard").transformWithStateInPandas(
        WindowState(size_s, slide_s), "chainId string, " + ", ".join(_PARTIAL), "Append", "EventTime",
        eventTimeColumnName="windowEnd")
    return partial.groupBy("windowEnd", "chainId").agg(
        F.max("window_start").alias("window_start"), *(F.sum(c).alias(c) for c in _SUMMED),
        *(F.sum(F.col(c).cast(M.DEC)).alias(c) for c in _SUMMED_DIGITS), *(F.max(c).alias(c) for c in _SINGLE)
    ).filter("tx_count > 0")


def _of_blocks(c: str) -> Column:
    return F.when(F.col("blocks") > 0, F.col(c).cast(M.DEC).cast("string"))


def activity_stream(tx: DataFrame, blocks: DataFrame, size_s: int = 1800, slide_s: int = 300, **options) -> DataFrame:
    """A01-A09 of every closed window."""
    w = windows(tx, blocks, size_s, slide_s, "tascb", **options)
    return w.select(
        "chainId", "window_start", "tx_count", "success_count", (F.col("tx_count") - F.col("success_count")).alias("fail_count"),
        "active_addresses", "active_senders", "unique_contracts", "new_addresses",
        M._ratio(F.col("block_txs"), F.col("blocks")).alias("avg_tx_per_block"),
        (M._ratio(F.col("fee"), F.col("tx_count")) / 1e18).alias("avg_tx_fee"), _of_blocks("block_gas").alias("gas_used"))


def gas_stream(tx: DataFrame, blocks: DataFrame, size_s: int = 1800, slide_s: int = 300, **options) -> DataFrame:
    """A09-A18 of every closed window."""
    w = windows(tx, blocks, size_s, slide_s, "tpb", **options)
    gas, cap = F.col("block_gas"), F.col("block_cap")
    return w.select(
        "chainId", "window_start", _of_blocks("block_gas").alias("gas_used"),
        M._ratio(F.col("price_sum"), F.col("price_n")).alias("avg_gas_price"), F.col("median_price").alias("median_gas_price"),
        F.col("min_price").alias("min_gas_price"), F.col("max_price").alias("max_gas_price"),
        _of_blocks("block_fees").alias("fees_paid"), M._ratio(cap, F.col("blocks")).alias("avg_gas_limit"),
        M._ratio(gas, F.col("blocks")).alias("avg_gas_used"),
        F.try_divide(F.lit(100.0) * gas.cast("double"), cap.cast("double")).alias("gas_utilization_rate"),
        M._ratio(gas, cap).alias("gas_efficiency"))


def performance_stream(tx: DataFrame, blocks: DataFrame, size_s: int = 900, slide_s: int = 60, **options) -> DataFrame:
    """A19-A24 of every closed window."""
    w = windows(tx, blocks, size_s, slide_s, "tb", **options)
    return w.select(
        "chainId", "window_start", M._ratio(F.col("tx_count"), F.lit(size_s)).alias("avg_tps"), "max_tps",
        M._ratio(F.col("gas"), F.lit(size_s)).alias("avg_gps"), "max_gps",
        M._ratio(F.col("gap_sum"), F.col("gap_n")).alias("block_time"), F.col("last_gap").alias("current_block_time"))


def hourly_stream(tx: DataFrame, blocks: DataFrame, size_s: int = 3600, **options) -> DataFrame:
    """The five hourly chain metrics of every closed hour."""
    w = windows(tx, blocks, size_s, size_s, "tapb", **options)
    return w.select(
        "chainId", "window_start", "active_addresses", "tx_count",
        M._ratio(F.col("tx_count"), F.lit(size_s)).alias("avg_tps"),
        M._ratio(F.col("price_sum"), F.col("price_n")).alias("avg_gas_price"), _of_blocks("block_fees").alias("fees_paid"))


# executors need no copy of this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
