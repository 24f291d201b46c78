"""Stored blocks: ranges reach the scan, other days and row groups are not read."""

import contextlib
import glob
import io

import pyarrow.parquet as pq

from chainflow.sources import block_store

SCHEMA = "chainId string, blockNumber string, blockTimestamp bigint"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_ranges_are_pushed_and_pruned(spark, scratch):
    rows = [(str(i % 3), str(i), 1_700_000_000 + i * 300) for i in range(3000)]
    rows += [("0", "5", 1_700_000_000 + 2999 * 300), ("0", "x", 1_700_000_000), ("1", "77", None), ("1", None, 5)]
    path = f"file://{scratch}/store"
    block_store.write_blocks(spark.createDataFrame(rows, SCHEMA), path, files=6)

    def numbers(df):
        return sorted((r.chainId, r.number, r.blockTimestamp) for r in df.collect())

    whole = [(c, int(n), t) for c, n, t in rows if n and n.isdigit()]
    for low, high in ((1000, 1200), (None, 10), (2990, None), (5, 5), (77, 77), (4000, 5000)):
        got = block_store.read_numbers(spark, path, low, high)
        want = [r for r in whole if (low or 0) <= r[1] <= (high or 10 ** 9)]
        assert sorted(map(str, numbers(got))) == sorted(map(str, want)), (low, high)
    assert block_store.read_numbers(spark, path).count() == len(rows)
    assert block_store.read_numbers(spark, path, 0, -1).count() == len(rows)
    start, end = 1_700_100_000, 1_700_150_000
    got = block_store.read_times(spark, path, start, end)
    assert numbers(got) == sorted(r for r in whole if r[2] is not None and start <= r[2] < end)

    text = plan(block_store.read_numbers(spark, path, 1000, 1200))
    assert "GreaterThanOrEqual(number,1000), LessThanOrEqual(number,1200)" in text and "PartitionFilters: [isnotnull(day" in text
    text = plan(got)
    assert f"GreaterThanOrEqual(blockTimestamp,{start})" in text and "PartitionFilters: [isnotnull(day" in text
    files = block_store.read_numbers(spark, path, 1000, 1200).inputFiles()
    assert files and len(glob.glob(f"{scratch}/store/blocks/day=*")) > 8
    bounds = []
    for f in glob.glob(f"{scratch}/store/blocks/day=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("number")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            if s.has_min_max:
                bounds.append((s.min, s.max))
    hit = [b for b in bounds if b[1] >= 1000 and b[0] <= 1200]
    assert len(hit) <= 4 < len(bounds)  # the day of the late block among them


def test_empty_store(spark, scratch):
    path = f"file://{scratch}/store"
    block_store.write_blocks(spark.createDataFrame([("0", "1", 1)], SCHEMA).where("blockNumber = '2'"), path)
    assert block_store.read_numbers(spark, path, 1, 5).isEmpty()
    assert block_store.read_times(spark, path, 1, 5).isEmpty()
