"""Whole metric families on streams against their batch forms, with late rows and evicted state."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chainflow.operators import metrics as M
from chainflow.sources.fixtures import Fixtures
from chainflow.streaming import families, jobs

SF = "/root/testdata/sf0.001"


def rounded(rows):
    return {tuple(float(f"{x:.12g}") if isinstance(x, float) else x for x in r) for r in rows}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Transactions and blocks in three files each, by time; some rows of a part come with the next one, one comes too late."""
    root = tmp_path_factory.mktemp("landed")
    fx = Fixtures(spark, SF)
    paths = {}
    first = fx.transactions.agg(F.min("blockTimestamp")).first()[0]
    for name, df in (("tx", fx.transactions), ("blocks", fx.blocks)):  # five days
        df.filter(F.col("blockTimestamp") < first + 5 * 86400).coalesce(1).write.parquet(str(root / f"all-{name}"))
    tx, blocks = (spark.read.parquet(str(root / f"all-{n}")) for n in ("tx", "blocks"))
    low, high = tx.agg(F.min("blockTimestamp"), F.max("blockTimestamp")).first()
    step = (high - low) // 3 + 1
    for name, df, key in (("tx", tx, "txHash"), ("blocks", blocks, "blockHash")):
        paths[name] = str(root / name)
        # rows of the last hour of a part may come a part later: within the watermark of two hours
        part = F.floor((F.col("blockTimestamp") - low) / step).cast("int")
        late = ((F.col("blockTimestamp") - low) % step > step - 3600) & (F.crc32(F.col(key).cast("binary")) % 2 == 0) & (part < 2)
        dealt = df.withColumn("_p", part + late.cast("int"))
        for i in range(3):
            dealt.filter(F.col("_p") == i).drop("_p").coalesce(1).write.mode("append").parquet(paths[name])
    # the first transaction again, weeks later under another hash: too late to count
    tx.orderBy("blockTimestamp").limit(1).withColumn("txHash", F.lit("0xlate")).coalesce(1).write.mode("append").parquet(paths["tx"])
    return tx, blocks, paths, high


CASES = {"activity": (families.activity_stream, lambda t, b: M.activity(t, b, 1800, 600), 1800, 600),
         "gas": (families.gas_stream, lambda t, b: M.gas(t, b, 1800, 600), 1800, 600),
         "performance": (families.performance_stream, lambda t, b: M.performance(t, b, 900, 300), 900, 300),
         "hourly": (families.hourly_stream, lambda t, b: M.hourly_set(M.tx_features(t), b, 3600), 3600, None)}


@pytest.mark.parametrize("name", sorted(CASES))
def test_family_stream_equals_batch_on_closed_windows(spark, landed, scratch, name):
    tx, blocks, paths, high = landed
    stream, batch, size, slide = CASES[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        options = {"slide_s": slide} if slide else {}
        out = stream(jobs.file_stream(spark, paths["tx"], tx.schema, max_files=1),
                     jobs.file_stream(spark, paths["blocks"], blocks.schema, max_files=1), size, watermark="2 hours", shards=3, **options)
        jobs.run_available_now(out, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = spark.read.parquet(os.path.join(scratch, "out"))
    columns = got.columns
    last = min(high, blocks.agg(F.max("blockTimestamp")).first()[0]) - 2 * 3600
    want = rounded([tuple(r[c] for c in columns) for r in batch(tx, blocks).collect() if r["window_start"] + size <= last])
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and rounded(rows) == want and want


class Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    """State of one key in dictionaries."""

    def __init__(self):
        self.maps, self.timers, self.value = {}, set(), None

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, Map())

    def getValueState(self, name, schema):
        handle = self

        class State:
            def exists(self):
                return handle.value is not None

            def get(self):
                return handle.value

            def update(self, value):
                handle.value = value
        return State()

    def registerTimer(self, ms):
        self.timers.add(ms)


class Expired:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms


def test_addresses_move_to_earlier_panes_and_panes_are_evicted():
    state, handle = families.WindowState(20, 10), Handle()
    state.init(handle)

    def send(*rows):
        frame = pd.DataFrame([dict(zip(("kind", "item", "ts", "n", "ok", "fee", "gas", "cap"), (*r, 0, 0, None, None, None)))
                              for r in rows])
        assert list(state.handleInputRows(("c", 0), iter([frame]), None)) == []

    def close(end):
        handle.timers.discard(end * 1000)
        return [tuple(r) for f in state.handleExpiredTimer(("c", 0), None, Expired(end * 1000))
                for r in f[["window_start", "active_addresses", "new_addresses", "blocks", "gap_sum"]].values.tolist()]

    send(("a", "x", 25), ("a", "y", 25), ("b", "7", 25))
    send(("a", "x", 12), ("b", "6", 12))  # late, within the watermark
    assert handle.timers == {20000, 30000, 40000}
    assert close(20) == [(0, 1, 1, 1, 0)]
    assert close(30) == [(10, 2, 2, 2, 13)] and list(handle.maps["panes"]) == [(20,)]
    assert close(40) == [(20, 2, 1, 1, 13)] and not handle.maps["panes"]
    send(("a", "x", 45), ("b", "9", 45))  # seen before; the gap is measured from a block that left long ago
    assert close(50) == [(30, 1, 0, 1, 20)] and close(60) == [(40, 1, 0, 1, 20)]
    assert not handle.maps["panes"] and handle.maps["first"] == {("x",): (12,), ("y",): (25,)}


def test_weighted_median():
    for prices in ([5], [1, 2], [3, 1, 2], [7, 7, 7, 9], [1, 1, 4, 10], [2, 4, 4, 5, 9, 9]):
        counts = {p: prices.count(p) for p in prices}
        ordered = sorted(prices)
        want = (ordered[(len(prices) - 1) // 2] + ordered[len(prices) // 2]) / 2
        assert families.weighted_median(counts) == want
    assert families.weighted_median({}) is None
