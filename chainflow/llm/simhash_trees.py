"""SimHash near-duplicates through vantage-point trees over Hamming distance.

1. A text's fingerprint is the bitwise majority of its shingles' XXH64 hashes.  Equal fingerprints
   are one point, so copies are counted before anything is dealt out.
2. Two points that differ in at most ``radius`` bits differ in at most ``radius // 2`` bits of one half
   of the fingerprint.  Each half gets a vantage-point tree of its own, with that smaller radius:
   far fewer balls then cross a branch's border than with the whole radius on all bits.
3. The upper part of a tree is fitted on a bounded sample (``sample`` points): a node has
   a vantage point and a distance, and points not farther than that go inside.  Its leaves are
   shards.  Every point goes home to one shard.  It also visits the later shards that its ball reaches: by the
   triangle inequality the inside can hold a partner only if ``d - r <= limit`` and the outside only if
   ``d + r > limit``.  A pair meets in the shard of the point whose home is later.
4. A shard goes on with the same tree in its task, members and visitors together, until a few members are
   left, which are compared with their visitors on all bits.  Links of a shard are
   reduced to a forest before they leave the task, so a dense group gives as many links as members.
5. Shards with over ``max_members`` members or visitors are dealt out over several tasks: both by hash, every part of the
   members with every part of the visitors.
   The forests of all shards are joined to components, which get their smallest doc_id.

The sample only decides where borders lie; every point is routed and compared whatever it holds.
The driver sees the sample and nothing else.

Defined cases: a null or empty text has fingerprint zero and links like any other; a text with fewer words
than ``k`` is one shingle; repeated rows and equal texts share a point; a null doc_id is a member but
never names a component (a component of null ids only has a null component_id); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import kernels as K
from .jaccard_join import NO_ID, components

#: Points that a tree's upper part is fitted on, and the least of them in a shard.
SAMPLE = 1 << 17
SAMPLE_IN_SHARD = 16
#: Points that a shard should hold, and that one task takes at most.
SHARD = 4096
MAX_MEMBERS = 1 << 17
#: Members that are compared directly.
FEW = 96

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_U = np.uint64
HALVES = (_U(0xFFFFFFFF), _U(0xFFFFFFFF00000000))


def fingerprint(body: bytes, k: int = 3, seed: int = 42) -> int:
    """The 64-bit fingerprint of a UTF-8 text."""
    words = body.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(k, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    one = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for lo in range(0, len(starts), 1 << 15):
        part = slice(lo, lo + (1 << 15))
        h = np.array([one(line[a:b], seed) for a, b in zip(starts[part], ends[part])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, seed: int = 42) -> DataFrame:
    """Per row: doc_id and its fingerprint ``fp``, the 64 bits as a long."""

    def run(batches):
        for batch in batches:
            for lo, rows, raw, offsets in K.slices(batch.column(1)):
                body, cut = raw.tobytes(), offsets.tolist()
                fps = np.array([fingerprint(body[a:b], k, seed) for a, b in zip(cut, cut[1:])], _U)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, rows), pa.array(fps.view(np.int64))],
                                                 ["doc_id", "fp"])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, C.take("doc_id long, fp long"))


def _away(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _split(points: np.ndarray, mask: np.uint64, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and limit with the fewest points beside the border, both sides holding a fair share; None: none."""
    best = None
    at = np.unique(np.linspace(0, len(points) - 1, 5).astype(int))
    for vantage in points[at]:
        counts = np.bincount(_away(points, vantage, mask), minlength=65)
        inside = np.cumsum(counts)
        for limit in range(64):
            least = min(inside[limit], len(points) - inside[limit])
            if 4 * least >= len(points):
                crossing = counts[max(0, limit - radius + 1):limit + radius + 1].sum()
                # how much work is left, as a share: both sides, and what visits both
                cost = (crossing + max(inside[limit], len(points) - inside[limit])) / len(points)
                if best is None or cost < best[0]:
                    best = (cost, vantage, limit)
    return best[1:] if best and best[0] < 1.45 else None


class ShardTree:
    """The upper part of a vantage-point tree: nodes in order of their parents, leaves are shards."""

    def __init__(self, sample: np.ndarray, total: int, mask: np.uint64, radius: int, shard: int = SHARD,
                 least: int = SAMPLE_IN_SHARD):
        self.mask, self.radius = mask, radius
        self.vantage: list[int] = []
        self.limit: list[int] = []
        self.sides: list[list[int]] = []  # per node: inside and outside, a node or -1 - shard
        self.shards = 0
        self._grow(sample, max(least, shard * len(sample) // max(1, total)))

    def _grow(self, points: np.ndarray, stop: int) -> None:
        todo = [(points, None, 0)]
        while todo:
            points, parent, side = todo.pop()
            cut = _split(points, self.mask, self.radius) if len(points) > stop else None
            if cut is None:
                here = -1 - self.shards
                self.shards += 1
            else:
                here = len(self.limit)
                self.vantage.append(int(cut[0]))
                self.limit.append(cut[1])
                self.sides.append([0, 0])
                near = _away(points, cut[0], self.mask) <= cut[1]
                todo += [(points[~near], here, 1), (points[near], here, 0)]
            if parent is not None:
                self.sides[parent][side] = here

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(point index, shard, is home) of every shard that a point belongs to or visits; visits only after the home."""
        rows, homes = np.arange(len(points)), np.ones(len(points), bool)
        if not self.limit:
            return rows, np.zeros(len(points), np.int64), homes
        out: list[tuple] = []
        todo = [(0, rows, homes)]
        while todo:
            node, rows, home = todo.pop()
            if node < 0:
                out.append((rows, np.full(len(rows), -1 - node), home))
                continue
            far = _away(points[rows], _U(self.vantage[node]), self.mask).astype(np.int64)
            limit = self.limit[node]
            near, inside, outside = far <= limit, far - self.radius <= limit, far + self.radius > limit
            for side, takes, own in ((0, inside, near), (1, outside, ~near)):
                if takes.any():
                    todo.append((self.sides[node][side], rows[takes], (home & own)[takes]))
        rows, shards, home = (np.concatenate(x) for x in zip(*out))
        mine = np.empty(len(points), np.int64)
        mine[rows[home]] = shards[home]
        keep = home | (shards > mine[rows])
        return rows[keep], shards[keep], home[keep]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, lowest member) that connect the same of n numbers as the links (a, b) do."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    away = np.flatnonzero(root != np.arange(n))
    return away, root[away]


def links_of(members: np.ndarray, visitors: np.ndarray, mask: np.uint64, radius: int, half: int,
             few: int = FEW, own: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Links between members (distinct), if ``own``, and from visitors to members, at most ``radius`` bits apart.

    The result connects what all links connect.  ``half`` is the radius on the bits of ``mask``.
    """
    points = np.concatenate([members, visitors])
    m, n = len(members), len(points)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    held = 0

    def compare(rows: np.ndarray, guests: np.ndarray, mine: int) -> None:
        nonlocal a, b, held
        step = max(1, (1 << 20) // max(1, len(rows)))
        for lo in range(0, len(guests), step):
            g = guests[lo:lo + step]
            i, j = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[g][None, :]) <= radius)
            x, y = rows[i], g[j]
            real = x != y if own else y >= m
            a.append(x[real])
            b.append(y[real])
            held += int(real.sum())
            if held > max(1 << 20, 2 * n):
                x, y = forest(np.concatenate(a), np.concatenate(b), n)
                a, b, held = [x], [y], 0

    # members come first among their own guests
    todo = [(np.arange(m), np.arange(n) if own else np.arange(m, n), mask, half)]
    while todo:
        rows, guests, bits, r = todo.pop()
        if not len(rows) or not len(guests):
            continue
        cut = _split(points[rows], bits, r) if len(rows) > few else None
        if cut is None and len(rows) > few and bits != _U(0xFFFFFFFFFFFFFFFF):
            bits, r = _U(0xFFFFFFFFFFFFFFFF), radius  # equal on this half: go on with all bits
            cut = _split(points[rows], bits, r)
        if cut is None:
            for lo in range(0, len(rows), 4096):
                compare(rows[lo:lo + 4096], guests, m)
            continue
        vantage, limit = cut
        near = _away(points[rows], vantage, bits) <= limit
        far = _away(points[guests], vantage, bits).astype(np.int64)
        todo += [(rows[near], guests[far - r <= limit], bits, r), (rows[~near], guests[far + r > limit], bits, r)]
    x, y = forest(np.concatenate(a), np.concatenate(b), n)
    return points[x], points[y]


def near_links(points: DataFrame, radius: int = 3, sample: int = SAMPLE, shard: int = SHARD,
               max_members: int = MAX_MEMBERS, few: int = FEW) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all pairs at most ``radius`` bits apart."""
    spark = points.sparkSession
    total = points.count()
    drawn = points.orderBy(F.xxhash64("fp"), "fp").limit(sample).toArrow().column("fp").to_numpy().view(_U)
    half = radius // 2
    trees = [ShardTree(drawn, total, mask, half, shard) for mask in HALVES]
    packed = C.Shared(spark, trees)

    def route(batch: pa.RecordBatch) -> dict:
        fps = batch.column(0).to_numpy().view(_U)
        out = [(i, s * 2 + t, h) for t, tree in enumerate(packed.value) for i, s, h in (tree.route(fps),)]
        rows, shards, homes = (np.concatenate(x) for x in zip(*out))
        return {"shard": shards, "home": homes, "fp": fps[rows].view(np.int64)}

    routed = C.map_arrow(points.select("fp"), route, C.take("shard long, home boolean, fp long"))
    parts = (routed.groupBy("shard").agg(F.count_if("home").alias("members"), F.count_if(~F.col("home")).alias("guests"))
             .where((F.col("members") > max_members) | (F.col("guests") > max_members))
             .select("shard", *(F.greatest(F.lit(1), F.ceil(F.col(c) / max_members)).cast("int").alias(c)
                                for c in ("members", "guests"))))
    if parts.isEmpty():
        dealt = routed.withColumns({"part": F.lit(0), "table": F.lit(0)})
    else:
        # a member sits in one part, at all its tables, and is a guest of the later parts; a guest has one table in each part
        dealt = (routed.join(F.broadcast(parts), "shard", "left").withColumns({
            "members": F.coalesce("members", F.lit(1)), "guests": F.coalesce("guests", F.lit(1))})
            .withColumns({"own": F.when(F.col("home"), F.pmod(F.xxhash64("fp"), "members")).otherwise(F.lit(-1)),
                          "seat": F.pmod(F.xxhash64("fp", F.lit(1)), "guests")})
            .withColumn("at", F.explode(F.expr("""
                concat(CASE WHEN home THEN transform(sequence(0, guests - 1), t -> struct(cast(own AS int) AS part, t AS table, true AS home))
                            ELSE cast(array() AS array<struct<part:int,table:int,home:boolean>>) END,
                       transform(filter(sequence(0, members - 1), p -> p > own),
                                 p -> struct(p AS part, cast(seat AS int) AS table, false AS home)))""")))
            .select("shard", "at.part", "at.table", "at.home", "fp"))

    def shard_links(frame: pd.DataFrame) -> pd.DataFrame:
        fps, home = frame["fp"].to_numpy().view(_U), frame["home"].to_numpy()
        mask = HALVES[int(frame["shard"].iloc[0]) % 2]
        a, b = links_of(np.sort(fps[home]), np.sort(fps[~home]), mask, radius, half, few, int(frame["table"].iloc[0]) == 0)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (dealt.select("shard", "part", "table", "home", "fp").groupBy("shard", "part", "table")
            .applyInPandas(shard_links, "a long, b long"))


def near_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 3, radius: int = 3,
                    **options) -> DataFrame:
    """One row per input row: doc_id, fp (long) and component_id, the smallest doc_id reachable by links."""
    rows = C.written(fingerprints(docs, doc_id, text, k), "fingerprints")
    points = C.written(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "points")
    links = C.written(near_links(points, radius, **options), "links")
    roots = components(links)
    named = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return C.attach(rows, C.written(named.join(lowest, "root").select("fp", "n", "component_id"), "named"), "fp", "n")
