"""Exact n-gram Jaccard self-join with token-combination prefixes.

A document's set holds its distinct k-word shingles (64-bit hashes).  Two
documents link when ``den * |A & B| >= num * |A | B|``; a linked set can then miss
at most ``tau = floor((den - num) * |A| / den)`` of the other's tokens.

1. One Arrow pass builds each text's set; equal sets are one *class*.  Only the
   tokens of a *low zone* (the lowest fifth of the hash space) are kept on disk,
   and how many texts hold each of them is counted with map-side combining.
2. A class with more than ``tau`` tokens that nobody else has can link with nobody and
   goes no further.  The low zone alone settles this for most of a corpus; the other
   classes' remaining tokens are counted among those classes only, which settles
   most of the rest.
3. All tokens have one global order, by (count, hash).  A class indexes a prefix of it.
   A rare token is indexed alone.  Tokens of the frequent class (``frequent`` texts
   or more) fall into sub-classes by hash and are indexed as pairs within a sub-class;
   its first token then proves nothing, so the prefix is extended until
   ``alone + rare + sum(max(0, taken - 1)) > tau``.  Two linked sets share a whole pair
   or a rare token, whichever of their prefixes ends first (pigeonhole).
   Signatures also hold the size band, and a set near a band's lower end is
   indexed in both, so sets of unlike size seldom meet.
4. Candidates are verified on the whole sets.  A bucket of m classes is not
   expanded into m*m pairs: its members are first linked with one pivot, chosen anew by
   each of ``pivots`` groups of signatures, and what is linked is contracted to
   components; pairs inside one need no check.  What still shares a bucket across
   components is then checked pair by pair, so no link between components is lost.

Counts, components and pairs stay distributed.  The only broadcast is the list of
document ids whose sets are needed, up to ``max_broadcast_ids`` (counted first);
beyond that it is a shuffle join.

Defined cases: a null text or one without words has an empty set and links with
nothing; equal non-empty sets always link; repeated rows are members of one
class; a null doc_id can be a member but never names a component (a component of
null ids only has a null component_id); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import kernels as K

#: Part of the hash space whose tokens are counted; above the prefix's share (15 % at 0.85).
ZONE = 0.2
_ZONE_LIMIT = int(ZONE * 2 ** 64)
#: Stands for a null doc_id: no id is above it.
NO_ID = (1 << 63) - 1
MAX_BROADCAST_IDS = 4_000_000

DOC_SETS = "doc_id long, node binary, n long, zone_n long, part_key long, zone array<long>"
SETS = ("node binary, rep long, n long, alone long, hashes array<long>, counts array<long>, rest_n long, "
        "tokens array<long>")
CLASSES = "id long, node binary, rep long, n long, alone long, tokens array<long>, signatures array<long>"


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=11).digest()


def _distinct(tokens: np.ndarray) -> int:
    """How many tokens differ in their top 44 bits, by which they are counted."""
    top = tokens >> np.uint64(20)
    return len(top) - int((top[1:] == top[:-1]).sum())


def doc_sets(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """Per row its set's digest (node), sizes, and the low-zone tokens (once per task for equal sets).

    A low-zone entry is the token's top 44 bits beside the digest's last 20; ``part_key``
    has its first 64.  Together they name the class in two longs.
    """

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            ids = batch.column(0)
            out = {"node": [], "n": [], "zone_n": [], "part_key": [], "zone": []}
            for lo, rows, raw, offsets in K.slices(batch.column(1)):
                for s in K.shingle_sets(K.Words(raw, offsets, K.SPACE_WORDS), k):
                    node = _digest(s) if len(s) else b""
                    cut = int(np.searchsorted(s, np.uint64(_ZONE_LIMIT)))
                    out["node"].append(node)
                    out["n"].append(len(s))
                    out["zone_n"].append(_distinct(s[:cut]))
                    out["part_key"].append(int.from_bytes(node[:8], "big", signed=True) if node else 0)
                    if node and node not in seen:
                        seen.add(node)
                        tail = np.uint64(int.from_bytes(node[8:], "big") & 0xFFFFF)
                        out["zone"].append(((s[:cut] >> np.uint64(20) << np.uint64(20)) | tail).view(np.int64))
                    else:
                        out["zone"].append(None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(out["node"], pa.binary()), pa.array(out["n"], pa.int64()),
                 pa.array(out["zone_n"], pa.int64()), pa.array(out["part_key"], pa.int64()),
                 pa.array(out["zone"], pa.list_(pa.int64()))],
                ["doc_id", "node", "n", "zone_n", "part_key", "zone"])

    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                      F.col(text).cast("string").alias("text"))
    return src.mapInArrow(lambda it: run(b for b in it if b.num_rows), C.take(DOC_SETS))


def prefix_signatures(n: int, shared: dict[int, int], alone: int, num: int, den: int, frequent: int) -> set[int]:
    """Signatures of a set of n tokens: counts of those that others hold as well, and how many are its own."""
    known = sorted((count, t) for t, count in shared.items())
    found: set[int] = set()
    for band in range((-(-num * n // den)).bit_length(), n.bit_length() + 1):
        left = (den - num) * n // den + 1 - alone
        groups = max(1, round(0.15 * (1 << band)))  # about as many as a prefix needs
        taken: dict[int, list[int]] = {}
        for count, t in known:
            if left <= 0:
                break
            if count < frequent:
                found.add(hash((band, 1, t)))
                left -= 1
            else:
                mates = taken.setdefault(t % groups, [])
                found.update(hash((band, 2, m, t)) for m in mates)
                left -= 1 if mates else 0
                mates.append(t)
    return found


def _whole_sets(k: int):
    def build(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c.split()[0]: [] for c in SETS.split(", ")}
        carried = {c: batch.column(c).to_pylist() for c in ("node", "rep", "n", "alone", "hashes", "counts")}
        for lo, rows, raw, offsets in K.slices(batch.column("text")):
            for i, s in enumerate(K.shingle_sets(K.Words(raw, offsets, K.SPACE_WORDS), k), lo):
                if len(s) and _digest(s) == carried["node"][i]:  # else another text under the same doc_id
                    for c, values in carried.items():
                        out[c].append(values[i])
                    out["rest_n"].append(_distinct(s[int(np.searchsorted(s, np.uint64(_ZONE_LIMIT))):]))
                    out["tokens"].append(s.view(np.int64))
        return out
    return build


def _index(num: int, den: int, frequent: int):
    def build(batch: pa.RecordBatch) -> dict:
        cols = dict(zip(batch.schema.names, batch.columns))
        rows = zip(*(cols[c].to_pylist() for c in ("n", "alone", "hashes", "counts", "more_hashes", "more_counts")))
        signatures = [sorted(prefix_signatures(n, dict(zip([*h, *mh], [*c, *mc])), alone, num, den, frequent))
                      for n, alone, h, c, mh, mc in rows]
        return {c.split()[0]: cols.get(c.split()[0]) for c in CLASSES.split(", ")} | {"signatures": signatures}
    return build


def _texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, limit: int) -> DataFrame:
    """Rows of ``wanted`` with the texts under their ids; a short list of ids is broadcast."""
    src = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("rep"),
                      F.col(text).cast("string").alias("text"))
    if wanted.count() <= limit:
        src = src.join(F.broadcast(wanted.select("rep").distinct()), "rep", "left_semi")
    return wanted.join(src, "rep")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); a component's nodes have one root.

    Each round maps every node to its smallest neighbour (or itself) and contracts the links,
    which at least halves the nodes of a component; the rounds' maps are then joined up.
    """
    links = links.select("a", "b").where("a <> b")
    maps = []
    while True:
        both = links.union(links.select("b", "a"))
        low = C.written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        maps.append(low)
        links = C.written(
            links.join(low.select("a", F.col("m").alias("x")), "a")
            .join(low.select(F.col("a").alias("b"), F.col("m").alias("y")), "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name)
        if links.isEmpty():
            break
    roots = maps[0].select(F.col("a").alias("node"), F.col("m").alias("root"))
    for low in maps[1:]:
        roots = (roots.join(low.withColumnRenamed("a", "root"), "root", "left")
                 .select("node", F.coalesce("m", "root").alias("root")))
    return C.written(roots, name)


def _verified(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of class ids whose whole sets link."""
    def side(x):
        return classes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"s_{x}"))
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .withColumn("both", F.size(F.array_intersect("s_a", "s_b")))
            .where(f"{den} * both >= {num} * (n_a + n_b - both)").select("a", "b"))


def _fit(num: int, den: int) -> str:
    """Two sets can link as far as their sizes (n) and the tokens that others hold as well (u) tell."""
    return f"a <> b AND {den} * least(u_a, u_b) >= {num} * (n_a + n_b - least(u_a, u_b))"


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _shared(entries: DataFrame, key: list[str]) -> DataFrame:
    """Per key its tokens that another key holds as well, with their counts."""
    counts = entries.groupBy("token").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    return (entries.join(counts, "token").groupBy(*key)
            .agg(F.collect_set(F.struct("token", "count")).alias("shared")))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4, num: int = 85,
                 den: int = 100, frequent: int = 32, pivots: int = 16,
                 max_broadcast_ids: int = MAX_BROADCAST_IDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id (smallest id with the same set), component_id, node."""
    rows = C.written(doc_sets(docs, doc_id, text, k), "sets")
    classes = rows.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("zone_n").alias("zone_n"),
        F.first("part_key").alias("part_key"))
    tau = f"floor({den - num} * n / {den})"
    nothing = F.array().cast("array<struct<token:bigint,count:bigint>>")

    # low zone: classes with too few tokens of their own
    entries = rows.where("zone IS NOT NULL").select("part_key", F.explode("zone").alias("entry"))
    entries = entries.select(F.shiftrightunsigned("entry", 20).alias("token"),
                             F.col("entry").bitwiseAND(0xFFFFF).alias("tail"), "part_key")
    tail = F.conv(F.substring(F.hex("node"), 18, 5), 16, 10).cast("long")
    survivors = C.written(
        classes.withColumn("tail", tail).join(_shared(entries, ["part_key", "tail"]), ["part_key", "tail"], "left")
        .withColumn("shared", F.coalesce("shared", nothing)).withColumn("alone", F.col("zone_n") - F.size("shared"))
        .where(f"alone <= {tau}")
        .select("rep", "node", "n", "alone", F.col("shared.token").alias("hashes"),
                F.col("shared.count").alias("counts")), "survivors")

    # their whole sets, and the other tokens counted among them
    sets = C.map_arrow(_texts_of(docs, survivors, doc_id, text, max_broadcast_ids), _whole_sets(k), C.take(SETS))
    if _ids_repeat(rows):
        sets = sets.dropDuplicates(["node"])
    sets = C.written(sets.withColumn("id", F.monotonically_increasing_id()), "whole")
    rest = (sets.select("id", F.explode("tokens").alias("token"))
            .select("id", F.shiftrightunsigned("token", 20).alias("token")).where(F.col("token") >= _ZONE_LIMIT >> 20))
    alive = (sets.join(_shared(rest, ["id"]), "id", "left").withColumn("shared", F.coalesce("shared", nothing))
             .withColumn("alone", F.col("alone") + F.col("rest_n") - F.size("shared")).where(f"alone <= {tau}")
             .withColumn("more_hashes", F.col("shared.token")).withColumn("more_counts", F.col("shared.count"))
             .drop("shared", "rest_n"))
    index = C.written(C.map_arrow(alive, _index(num, den, frequent), C.take(CLASSES)), "index")
    buckets = index.select("id", "n", (F.col("n") - F.col("alone")).alias("u"), F.explode("signatures").alias("signature"))

    # pivots first: the member with most in common with others, or by a hash of its own for each group
    group = F.pmod("signature", F.lit(pivots))
    rank = F.when(group == 0, 1 - F.col("u") / F.col("n")).otherwise(F.pmod(F.xxhash64("id", group), F.lit(1 << 30)) / (1 << 30))
    pivot = buckets.groupBy("signature").agg(
        F.min_by(F.struct(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("u").alias("u_a")),
                 F.struct(rank, "id")).alias("pivot"),
        F.count(F.lit(1)).alias("m")).where("m > 1").select("signature", "pivot.*")
    pairs = C.written(_ordered(
        buckets.select("signature", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("u").alias("u_b"))
        .join(pivot, "signature")
        .where(_fit(num, den))), "pairs")
    links = C.written(_verified(pairs, index, num, den), "links")
    roots = components(links)

    # then, pair by pair, what shares a bucket across components; a pair is made in its first shared bucket only
    here = (buckets.join(roots.withColumnRenamed("node", "id"), "id", "left")
            .select("signature", "id", "n", "u", F.coalesce("root", "id").alias("root")))
    open_buckets = here.groupBy("signature").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low <> high").select("signature")
    members = here.join(open_buckets, "signature")
    members = members.join(members.groupBy("id").agg(F.collect_set("signature").alias("own")), "id")

    def side(x):
        return members.select("signature", F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}")
                                                                  for c in ("n", "u", "root", "own")])
    across = (side("a").join(side("b"), "signature").where("a < b AND root_a <> root_b").where(_fit(num, den))
              .where(F.array_min(F.array_intersect("own_a", "own_b")) == F.col("signature")).select("a", "b"))
    left = C.written(across.join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = C.written(_verified(left, index, num, den), "links")
    if not more.isEmpty():
        roots = components(links.union(more))

    named = index.select("id", "node", "rep").join(roots.withColumnRenamed("node", "id"), "id")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(smallest, "root").select("node", "component")

    def real(c):
        return F.when(c != NO_ID, c)

    return (rows.select("doc_id", "n", "node").join(classes.select("node", "rep").join(named, "node", "left"),
                                                    "node", "left")
            .select(real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                    real(F.coalesce("component", "rep", "doc_id")).alias("component_id"),
                    real(F.coalesce("rep", "doc_id")).alias("class_id"), "node"))


def _ids_repeat(rows: DataFrame) -> bool:
    return not rows.groupBy("doc_id").count().where("count > 1").isEmpty()


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
             max_broadcast_ids: int = MAX_BROADCAST_IDS, **options) -> DataFrame:
    """One document of each component, the one with the smallest id, with the columns of ``docs``.

    Where ids repeat, one row of each (id, set) stays; documents without words all stay.
    """
    columns = docs.columns
    labels = C.written(near_classes(docs, doc_id, text, max_broadcast_ids=max_broadcast_ids, **options), "labels")
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    gone = labels.where("NOT (doc_id <=> component_id)")
    repeated = labels.groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        gone = gone.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id")).distinct()
        if gone.count() <= max_broadcast_ids:
            gone = F.broadcast(gone)
        return docs.withColumn("_id", key).join(gone, "_id", "left_anti").select(*columns)
    # ids repeat: tell rows apart by their set as well
    nodes = doc_nodes(docs, text, options.get("k", 4))
    whole = nodes.withColumn("_id", key)
    gone = gone.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.col("node").alias("_node")).distinct()
    kept = whole.join(gone, ["_id", "_node"], "left_anti")
    empty = kept.where("length(_node) = 0")
    return kept.where("length(_node) > 0").dropDuplicates(["_id", "_node"]).unionByName(empty).select(*columns)


def doc_nodes(docs: DataFrame, text: str, k: int) -> DataFrame:
    """``docs`` with ``_node``, the digest of each row's set."""
    at = docs.columns.index(text)
    names = docs.columns

    def run(batch: pa.RecordBatch) -> dict:
        nodes = [_digest(s) if len(s) else b"" for _, _, raw, offsets in K.slices(batch.column(at))
                 for s in K.shingle_sets(K.Words(raw, offsets, K.SPACE_WORDS), k)]
        return dict(zip(names, batch.columns)) | {"_node": nodes}

    schema = type(docs.schema)(docs.schema.fields + C.take("_node binary").fields)
    return C.map_arrow(docs, run, schema)
