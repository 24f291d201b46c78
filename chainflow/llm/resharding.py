"""Minimum-cost-flow resharding.

Documents lie in old shards; the new shards have capacities.  The flow network is

    old shard's blocks -> the same new shard (cost 0) or any other (cost: the bytes moved) -> capacity

A block is the rows of one old shard in one size class, so its rows cost about the
same to move; what must leave a shard leaves with the smallest rows first.  The solver
sees sums per block only (a few hundred per shard at most: four per doubling of the
size), never rows.
Each new shard takes floor(N / shards) rows, and N mod shards of them one more; which
ones is the flow's choice.

A block's flow is a list of rank ranges.  Rows get their rank in the block without one
large group: a block is cut into segments by the rows' hash, segments are counted with map-side
combining, and a row's rank is its segment's start plus its number in the segment.
The slot in the new shard follows from the rank, so one shuffle places every row.

``reshard`` gives the assignment, ``rewrite`` writes the shards that lose or gain
rows as new files and leaves the others alone.

Defined cases: a null text counts as empty (size 1); a null doc_id is a row like any other;
repeated rows are placed each; fewer rows than shards leave some shards empty; old shards
beyond the new ones are emptied; extra columns are ignored, and carried by ``rewrite``;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C

SHARDS = 16
ROWS_PER_SEGMENT = 50_000


class Flow:
    """Minimum-cost flow by successive shortest paths with potentials."""

    def __init__(self, nodes: int):
        self.edges: list[list] = []  # [to, left, cost]; an edge's reverse is its number xor 1
        self.at: list[list[int]] = [[] for _ in range(nodes)]

    def edge(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.at[a].append(len(self.edges))
        self.edges.append([b, capacity, cost])
        self.at[b].append(len(self.edges))
        self.edges.append([a, 0, -cost])
        return len(self.edges) - 2

    def solve(self, source: int, sink: int) -> None:
        """Push as much as can be; costs must not be negative."""
        n = len(self.at)
        potential = [0] * n
        while True:
            far, via = [None] * n, [None] * n
            far[source] = 0
            heap = [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > far[a]:
                    continue
                for e in self.at[a]:
                    b, left, cost = self.edges[e]
                    if left:
                        new = d + cost + potential[a] - potential[b]
                        if far[b] is None or new < far[b]:
                            far[b], via[b] = new, e
                            heapq.heappush(heap, (new, b))
            if far[sink] is None:
                return
            for a in range(n):
                if far[a] is not None:
                    potential[a] += far[a]
            push, b = None, sink
            while b != source:
                e = via[b]
                push = self.edges[e][1] if push is None else min(push, self.edges[e][1])
                b = self.edges[e ^ 1][0]
            b = sink
            while b != source:
                e = via[b]
                self.edges[e][1] -= push
                self.edges[e ^ 1][1] += push
                b = self.edges[e ^ 1][0]

    def flow(self, edge: int) -> int:
        return self.edges[edge ^ 1][1]


def plan_transfers(blocks: list[tuple[int, int, int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(old, block, first rank, end rank, new) ranges from (old, block, rows, bytes).

    A hub stands for "any other shard", so a block has two edges and not one per shard.  A
    shard takes its floor, and one row more through an edge that the rows above all floors share.
    """
    total = sum(b[2] for b in blocks)
    if not total:
        return []
    floor, more = divmod(total, shards)
    source, sink, hub, spare = 0, 1, 2, 3
    first_block = 4 + shards
    net = Flow(first_block + len(blocks))
    stay, leave, gain = [], [], []
    for i, (old, _, rows, size) in enumerate(blocks):
        net.edge(source, first_block + i, rows, 0)
        stay.append(net.edge(first_block + i, 4 + old, rows, 0) if old < shards else None)
        leave.append(net.edge(first_block + i, hub, rows, -(-size // rows)))
    for j in range(shards):
        gain.append(net.edge(hub, 4 + j, total, 0))
        net.edge(4 + j, sink, floor, 0)
        net.edge(4 + j, spare, 1, 0)
    net.edge(spare, sink, more, 0)
    net.solve(source, sink)

    wants = [[j, net.flow(g)] for j, g in enumerate(gain)]
    out = []
    for i, (old, block, rows, _) in enumerate(blocks):
        moved = net.flow(leave[i])
        if moved < rows:
            out.append((old, block, moved, rows, old))
        at = 0
        while at < moved:
            to = next(w for w in wants if w[1])
            take = min(moved - at, to[1])
            out.append((old, block, at, at + take, to[0]))
            to[1] -= take
            at += take
    return out


def size_class(size: Column) -> Column:
    """Four classes per doubling of the size."""
    return F.floor(F.log2(size.cast("double")) * 4 + 1e-9).cast("int")


def reshard(docs: DataFrame, old_shard: Column, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
            rows_per_segment: int = ROWS_PER_SEGMENT) -> tuple[DataFrame, list[tuple[int, int, int, int, int]]]:
    """(rows with size, text_crc32, old_shard, shard and slot, transfers).

    Sizes are UTF-8 bytes of the text plus one; the count law holds: shards' rows differ by at most one.
    """
    names = ["size", "text_crc32", "old_shard", "shard", "slot"]
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    src = C.without(docs.withColumn("_old", old_shard.cast("int")), [n for n in names if n != text])
    rows = src.withColumns({"size": F.octet_length(body).cast("long") + 1, "text_crc32": F.crc32(body)})
    rows = rows.withColumn("_class", size_class(F.col("size")))
    stats = rows.groupBy(F.col("_old").alias("old"), F.col("_class").alias("size_class"))
    blocks = [(r.old, r.size_class, r.rows, r.bytes) for r in stats.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")).orderBy("old", "size_class").collect()]
    transfers = plan_transfers(blocks, shards)
    segments = max(1, -(-max((b[2] for b in blocks), default=0) // rows_per_segment))

    key = ["_old", "_class", "_segment"]
    rows = rows.withColumn("_segment", F.pmod(F.xxhash64(doc_id, "text_crc32", "size"), F.lit(segments)))
    starts = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_start", F.sum("_n").over(Window.partitionBy("_old", "_class").orderBy("_segment")
                                                     .rowsBetween(Window.unboundedPreceding, -1)))
              .select(*key, F.coalesce("_start", F.lit(0)).alias("_start")))
    place = Window.partitionBy(*key).orderBy(F.col(doc_id).asc_nulls_last(), "text_crc32", "size")
    ranked = (rows.withColumn("_number", F.row_number().over(place) - 1).join(starts, key)
              .withColumn("_rank", F.col("_start") + F.col("_number")))

    base, listed = [0] * shards, []
    for old, block, first, end, new in transfers:
        listed.append((old, block, first, end, new, base[new]))
        base[new] += end - first
    ranges = docs.sparkSession.createDataFrame(
        listed, "r_old int, r_class int, r_first long, r_end long, shard int, r_base long")
    found = ranked.join(F.broadcast(ranges), (F.col("_old") == F.col("r_old")) & (F.col("_class") == F.col("r_class"))
                        & (F.col("_rank") >= F.col("r_first")) & (F.col("_rank") < F.col("r_end")))
    found = found.withColumn("slot", F.col("r_base") + F.col("_rank") - F.col("r_first"))
    return found.withColumnRenamed("_old", "old_shard").drop(
        "_class", "_segment", "_number", "_start", "_rank", "r_old", "r_class", "r_first", "r_end", "r_base"), transfers


def affected(transfers: list[tuple[int, int, int, int, int]]) -> list[int]:
    """The shards that lose or gain rows."""
    return sorted({s for old, _, _, _, new in transfers if old != new for s in (old, new)})


def rewrite(placed: DataFrame, transfers: list[tuple[int, int, int, int, int]], out: str) -> list[int]:
    """Write the affected shards below ``out`` as shard=K folders; returns their numbers.

    Tasks write their rows of each shard as files of their own, so no shard passes through one task.
    """
    shards = affected(transfers)
    placed.where(F.col("shard").isin(shards)).write.partitionBy("shard").parquet(out)
    return shards
