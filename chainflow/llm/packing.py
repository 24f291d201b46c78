"""Best-fit packing of token pieces by hierarchical residual rounds.

Texts are tokenised where they are; only what is longer than a sequence is cut.  Every
partition packs its pieces best-fit, longest first, and emits the bins that are nearly
full.  The pieces of underfull bins go up a tree: groups of ``fan_in`` nodes meet in one
task, which packs them again, emits what is nearly full now and passes on the rest.  The
last node emits everything.

Pieces of one length are alike to best fit.  So a node takes and passes on numbers of
pieces by length, at most ``fan_in * size`` rows, however many pieces these are: nothing
is capped, and no piece moves.  What a node emits are ranges: of a child's pieces of one
length, those from a number on fill bins from a number on.  On the way down ranges of a
node become ranges of its children, and at last of the partitions, where a piece's number
among those of its length says its sequence and offset.

Best fit puts small pieces (at most half a sequence) beside large ones.  A node that has
few large ones would fill bins with small pieces alone that gaps elsewhere need, as on
input ordered by length.  So it emits such bins only as long as the share of its small
pieces stays unused that, counted over all nodes of the round, could fill the gaps beside
large ones.

Tokens come from a byte-level BPE rank file (its path is a parameter); the ids of
``pack`` equal those of the ``tokenizers`` library at its defaults for the same
vocabulary: an added token's string in a text is its id.  Each document ends in id
``end_id``.

Defined cases: a null or empty text is its end id alone (one piece of length 1);
repeated rows are packed each; a null doc_id stays null; extra input columns are
not carried; an empty table gives no rows.
"""

from __future__ import annotations

import array
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import kernels as K

SEQUENCE = 1024
MAX_BROADCAST_ROWS = 200_000
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, "
          "node long, number long")

#: The rank file's split pattern, and the same without its look-ahead.  They differ
#: only where white space follows white space.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT_SINGLE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""


def added_tokens(vocabulary: str | None) -> dict[str, int]:
    """The added tokens of the vocabulary; a rank file of one's own has none."""
    if vocabulary is not None:
        return {}
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError("added tokens that take in or depend on what is beside them")
    return {t["content"]: t["id"] for t in tokens}


def encoders(vocabulary: str | None):
    """(any text, texts without neighbouring white space, texts with added tokens) encoders and the
    added tokens as bytes, once per worker."""
    cache = K.worker_cache()
    key = ("bpe", vocabulary)
    if key not in cache:
        import base64

        import tiktoken

        if vocabulary is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.tiktoken")
        else:
            path = vocabulary
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        added = added_tokens(vocabulary)
        full, single = (tiktoken.Encoding(f"pack{i}", pat_str=p, mergeable_ranks=ranks, special_tokens=added)
                        for i, p in enumerate((_SPLIT, _SPLIT_SINGLE)))
        cache[key] = (full.encode_ordinary, single.encode_ordinary,
                      lambda text: full.encode(text, allowed_special="all"), [t.encode() for t in added])
    return cache[key]


_WHITE = np.zeros(256, np.uint8)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = 1
#: Lead bytes of the white space beyond ASCII; a text with one takes the full pattern.
_LEADS = np.zeros(256, np.uint8)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = 1


def plain_spacing(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: no two white-space characters stand together, as far as bytes tell."""
    white = _WHITE[raw]
    odd = _LEADS[raw]
    odd[1:] |= white[1:] & white[:-1]
    total = np.concatenate(([0], np.cumsum(odd, dtype=np.int64)))
    return total[offsets[1:]] == total[offsets[:-1]]


def token_ids(texts: pa.Array, vocabulary: str | None, with_added: bool = False) -> Iterator[list[int]]:
    """Ids of each text; ``with_added`` takes the strings of added tokens as those, otherwise they are ordinary text."""
    full, single, special, added = encoders(vocabulary)
    for lo, rows, raw, offsets in K.slices(texts):
        plain = plain_spacing(raw, offsets)
        data = raw.tobytes()
        some = with_added and any(t in data for t in added)
        for i in range(rows):
            text = data[offsets[i]:offsets[i + 1]]
            encode = special if some and any(t in text for t in added) else single if plain[i] else full
            yield encode(text.decode("utf-8", "replace"))


def cut(ids: list[int], end_id: int, size: int) -> list[tuple[int, list[int]]]:
    """(start, ids) pieces of a document: one, or pieces of ``size`` after a shorter first one."""
    ids = [*ids, end_id]
    first = len(ids) % size or size
    return [(0, ids[:first]), *((s, ids[s:s + size]) for s in range(first, len(ids), size))]


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int], list[int]]:
    """Best fit, longest first: bin and offset of every item, and the bins' fills.

    Bins are found by what is left in them: a bit for every remainder that some bin has.
    """
    by_left: list[list[int]] = [[] for _ in range(size + 1)]
    have = 0
    bins, offsets, fills = [0] * len(lengths), [0] * len(lengths), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fit = have >> n
        if fit:
            left = n + (fit & -fit).bit_length() - 1
            b = by_left[left].pop()
            if not by_left[left]:
                have &= ~(1 << left)
        else:
            left, b = size, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        left -= n
        if left:
            by_left[left].append(b)
            have |= 1 << left
    return bins, offsets, fills


class Plan:
    """Best fit, longest first, of counted lengths: where the pieces of every length go.

    A row: of pieces of ``length`` those from number ``start`` on fill bins from ``first``
    on, ``per`` in each, from ``offset`` on.  ``left`` lists (first bin, bins, what is left
    in each) of all bins.
    """

    def __init__(self, counts: dict[int, int], size: int):
        rows: list[tuple[int, int, int, int, int, int]] = []
        by_left: dict[int, list[tuple[int, int]]] = {}  # ranges (first bin, bins) by what is left in them
        self.bins = 0
        for n in sorted(counts, reverse=True):
            start, todo = 0, counts[n]

            def fill(first: int, bins: int, left: int) -> None:
                """Pieces into as many bins of the range as are needed; the rest of the range stays as it is."""
                nonlocal start, todo
                per = left // n
                whole = min(bins, todo // per)
                some = todo - whole * per if whole < bins else 0
                for at, many, each in ((first, whole, per), (first + whole, 1, some)):
                    if many and each:
                        rows.append((n, start, many * each, at, each, size - left))
                        start, todo = start + many * each, todo - many * each
                        by_left.setdefault(left - each * n, []).append((at, many))
                used = whole + (some > 0)
                if used < bins:
                    by_left.setdefault(left, []).append((first + used, bins - used))

            for left in sorted(x for x in by_left if x >= n):
                if not todo:
                    break
                for first, bins in by_left.pop(left):
                    if todo:
                        fill(first, bins, left)
                    else:
                        by_left.setdefault(left, []).append((first, bins))
            if todo:
                new = -(-todo // (size // n))
                self.bins += new
                fill(self.bins - new, new, size)
        self.length, self.start, self.count, self.first, self.per, self.offset = (
            np.array([r[i] for r in sorted(rows)], np.int64) for i in range(6))
        self.left = sorted((first, bins, left) for left, own in by_left.items() for first, bins in own)


def emitted(plan: Plan, counts: dict[int, int], size: int, slack: int, reserve: float) -> list[tuple[int, int]]:
    """(first bin, end) of the bins that a node emits: nearly full, and those of small pieces beyond the reserve."""
    # bins are made in order of their first piece's length, so those led by a large one come first
    large = sum(n for length, n in counts.items() if 2 * length > size)
    small = sum(length * n for length, n in counts.items() if 2 * length <= size)
    room = int(small * (1 - reserve))
    out = []
    for first, bins, left in plan.left:
        if left > slack:
            continue
        alone = min(bins, max(0, first + bins - large))  # bins of small pieces alone
        take = min(alone, room // (size - left))
        room -= take * (size - left)
        if bins - alone + take:
            out.append((first, first + bins - alone + take))
    return out


RANGES = ("node long, child long, length long, start long, count long, emitted boolean, "
          "first long, per long, offset long, skip long, base long")


def merger(level: int, last: bool, size: int, slack: int, reserve: float):
    """One node of the tree: ranges of its children's pieces, emitted or passed on."""

    def merge(part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "ascending"), ("child", "ascending")])
        node = part["node"][0].as_py()
        child, length, n = (part[c].to_numpy() for c in ("child", "length", "n"))
        counts: dict[int, int] = {}
        for k, many in zip(length.tolist(), n.tolist()):
            counts[k] = counts.get(k, 0) + many
        plan = Plan(counts, size)
        spans = [(0, plan.bins)] if last else emitted(plan, counts, size, slack, reserve)
        ends = np.array([e for _, e in spans], np.int64)
        starts = np.array([s for s, _ in spans], np.int64)
        number = level << 58 | node << 38
        # cut the plan's rows at the borders of emitted bins and of children: one number line over all lengths
        total = np.cumsum(n) - n
        at = dict(zip(length[::-1].tolist(), total[::-1].tolist()))
        begin = plan.start + np.array([at[k] for k in plan.length.tolist()], np.int64)
        order = np.argsort(begin)
        begin, per, first, offset = begin[order], plan.per[order], plan.first[order], plan.offset[order]
        bins = plan.count[order] // per
        cuts = [begin, total]
        for border in (starts, ends):
            # rows and borders meet where a border lies inside a row's bins
            low, high = np.searchsorted(border, first, "right"), np.searchsorted(border, first + bins, "left")
            row = np.repeat(np.arange(len(first)), high - low)
            which = np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[row]
            cuts.append(begin[row] + (border[which] - first[row]) * per[row])
        cut_at = np.unique(np.concatenate(cuts))
        many = np.diff(np.append(cut_at, n.sum()))
        row = np.searchsorted(begin, cut_at, "right") - 1
        own = np.searchsorted(total, cut_at, "right") - 1
        skip = cut_at - begin[row]
        inside = first[row] + skip // per[row]
        done = np.zeros(len(cut_at), bool)
        if len(starts):
            span = np.searchsorted(starts, inside, "right") - 1
            done = (span >= 0) & (inside < ends[span])
        passed = np.where(done, 0, many)
        before = np.cumsum(passed) - passed
        # a passed-on range begins at this number among the node's passed-on pieces of its length
        head = np.searchsorted(length[own], length[own], "left")
        base = before - before[head]
        rows = len(cut_at)
        return pa.table([np.full(rows, node), child[own], length[own], cut_at - total[own], many, done,
                         number + first[row], per[row], offset[row], skip, base], NAMES)

    return merge


NAMES = [f.split()[0] for f in RANGES.split(", ")]


def tree(counts: DataFrame, size: int, fan_in: int, slack: int) -> DataFrame:
    """Ranges (node, length, start, count, first, per, offset, skip) of all pieces from counts (node, length, n)."""
    top = counts.agg(F.max("node")).first()[0]
    levels: list[DataFrame] = []
    nodes, items = (top or 0) + 1, counts.withColumnRenamed("node", "child").withColumn("node", F.col("child"))
    while True:
        last = nodes == 1 and len(levels) > 0
        gaps, small = items.agg(
            F.sum(F.when(F.col("length") * 2 > size, (size - F.col("length")) * F.col("n"))),
            F.sum(F.when(F.col("length") * 2 <= size, F.col("length") * F.col("n")))).first()
        reserve = min(1.0, (gaps or 0) / small) if small else 0.0
        ranges = C.written(items.groupBy("node").applyInArrow(
            merger(len(levels), last, size, slack, reserve), C.take(RANGES)), "ranges")
        levels.append(ranges)
        if last:
            break
        nodes = -(-nodes // fan_in)
        items = (ranges.where("NOT emitted").groupBy(F.col("node").alias("child"), "length")
                 .agg(F.sum("count").alias("n")).withColumn("node", F.floor(F.col("child") / fan_in).cast("long")))
    columns = ["length", "start", "count", "first", "per", "offset", "skip"]
    down = None
    for ranges in reversed(levels):
        own = ranges.where("emitted").select(F.col("child").alias("node"), *columns)
        if down is not None:
            up, low = down.alias("up"), ranges.where("NOT emitted").alias("low")
            begin = F.greatest("up.start", "low.base")
            end = F.least(F.col("up.start") + F.col("up.count"), F.col("low.base") + F.col("low.count"))
            meet = up.join(low, (F.col("up.node") == F.col("low.node")) & (F.col("up.length") == F.col("low.length"))
                           & (begin < end))
            own = own.unionByName(meet.select(
                F.col("low.child").alias("node"), "up.length", (F.col("low.start") + begin - F.col("low.base")).alias("start"),
                (end - begin).alias("count"), "up.first", "up.per", "up.offset",
                (F.col("up.skip") + begin - F.col("up.start")).alias("skip")))
        down = C.written(own, "placed")
    return down


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE, end_id: int = 2,
         vocabulary: str | None = None, with_ids: bool = False, fan_in: int = 8, slack: int = 8,
         local_pieces: int = 200_000) -> DataFrame:
    """One row per piece: where its document's ids begin, and its sequence and offset there.

    ``with_ids`` carries the ids themselves, from which ``assemble`` builds the sequences.
    Bins with at most ``slack`` tokens left are nearly full; ``fan_in`` nodes meet in one.
    ``local_pieces`` are written at a time.
    """
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = C.take(PIECES)
    names = [f.name for f in schema]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = TaskContext.get().partitionId()
        rows: list[tuple] = []
        seen = [0] * (size + 1)

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
            rows.clear()
            return batch

        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()),
                 pa.int64(), pa.int64()]
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), token_ids(batch.column(1), vocabulary, True)):
                for k, (start, part) in enumerate(cut(ids, end_id, size)):
                    n = len(part)
                    rows.append((key, k, start, n, zlib.crc32(array.array("I", part).tobytes()),
                                 part if with_ids else None, node, seen[n]))
                    seen[n] += 1
                if len(rows) >= local_pieces:
                    yield flush()
        if rows:
            yield flush()

    pieces = C.written(src.mapInArrow(local, schema), "pieces")
    counts = C.written(pieces.groupBy("node", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    # a partition has few ranges of one length
    ranges = tree(counts, size, fan_in, slack)
    placed = (ranges.groupBy("node", "length")
              .agg(F.sort_array(F.collect_list(F.struct("start", "first", "per", "offset", "skip"))).alias("ranges")))
    if ranges.count() <= MAX_BROADCAST_ROWS:
        placed = F.broadcast(placed)
    own = F.element_at(F.filter("ranges", lambda r: r["start"] <= F.col("number")), -1)
    at = F.col("number") - F.col("own.start") + F.col("own.skip")
    return (pieces.join(placed, ["node", "length"]).withColumn("own", own)
            .select(*names[:6], F.expr("own.first + (number - own.start + own.skip) div own.per").alias("sequence_id"),
                    (F.col("own.offset") + at % F.col("own.per") * F.col("length")).alias("offset")))


def assemble(pieces: DataFrame) -> DataFrame:
    """The packed sequences: one row with the ids of its pieces in order (at most one sequence's length)."""
    return (pieces.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"),
                    F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"),
                                                            p["offset"].alias("offset"))).alias("pieces")))
