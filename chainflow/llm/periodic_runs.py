"""Periodic runs of words, found as maximal pairs of an LCP-interval tree.

A run is a stretch of words with smallest period q that no neighbouring word extends.
Its two copies, one q words after the other, are a *maximal pair*: equal stretches whose left
neighbours differ and whose right neighbours differ.  Conversely a maximal pair at distance q and of
``m`` words with ``m >= (exponent - 1) * q`` spans exactly a run of ``m + q`` words, so
nothing has to be extended afterwards.

1. Words of a slice of texts get exact numbers, and the suffixes of each text are sorted by
   prefix doubling in numpy, for all texts of the slice at once.  Only suffixes that still share
   their first words with another one go into the next round.
2. Lengths of common prefixes come from the rounds' ranks.  Where they reach the
   shortest pair that can make a run, the intervals are walked bottom-up.
3. A node of the tree holds its positions in order, as one list of a left-word class as long as all
   have the same left word.  Two lists of the same class can't give a maximal pair and are only
   joined.  Otherwise each position of the smaller list looks at its neighbours in the larger
   one: the two copies of a run are neighbours among all occurrences of the part they
   share, because an occurrence between them would give a smaller period.
4. Of pairs that span the same stretch the least distance is its period.

A text is one row and is handled by one task; memory is bounded by the slice, or by the longest text.

Defined cases: a null or empty text has no words, no run and an empty collapsed text; repeated
rows are answered one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import kernels as K

#: Shortest run in words, and least length / period.
LEAST_WORDS = 6
LEAST_EXPONENT = 4

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Suffixes:
    """Sorted suffixes of many texts; ``codes`` are word numbers, ``ends`` the first position after each position's text."""

    def __init__(self, codes: np.ndarray, text_of: np.ndarray, ends: np.ndarray, least: int):
        self.codes, self.ends, self.n = codes, ends, len(codes)
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # (words, positions, ranks) while shared
        n = self.n
        key = text_of * (int(codes.max()) + 1 if n else 1) + codes
        order = np.argsort(key, kind="stable")
        slots = np.arange(n)
        rank = np.empty(n, np.int64)
        rank[order] = self._heads(key[order], slots)
        self.order = order
        k = 1
        self.shared_slots = np.zeros(0, np.int64)
        while True:
            slots = self._shared(rank, slots)
            if k <= least:
                self.shared_slots = slots  # slots whose first k words are shared
            if not len(slots):
                break
            now = self.order[slots]
            if k >= 4:
                at = np.sort(now)
                self.levels.append((k, at, rank[at]))
            follow = now + k
            inside = follow < ends[now]
            second = np.where(inside, rank[np.where(inside, follow, 0)] + 1, 0)
            key = rank[now] * (n + 2) + second
            by = np.argsort(key, kind="stable")
            self.order[slots] = now[by]
            heads = self._heads(key[by], slots)
            rank[now[by]] = heads
            k *= 2

    @staticmethod
    def _heads(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Per entry of sorted keys the slot of the first equal one."""
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        return np.maximum.accumulate(np.where(first, slots, 0)) if len(keys) else slots

    def _shared(self, rank: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """The slots whose rank another slot has as well."""
        r = rank[self.order[slots]]
        same = np.zeros(len(r) + 1, bool)
        same[1:-1] = r[1:] == r[:-1]
        return slots[same[1:] | same[:-1]]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that the suffixes at x and y (of one text each pair) have in common at their start."""
        length = np.zeros(len(x), np.int64)
        for k, at, ranks in reversed(self.levels):
            rx, ry = (self._rank_at(p + length, at, ranks) for p in (x, y))
            length += k * ((rx >= 0) & (rx == ry))
        for _ in range(3):  # what is left is shorter than the shortest level
            a, b = x + length, y + length
            inside = (a < self.ends[x]) & (b < self.ends[y])
            same = self.codes[np.where(inside, a, 0)] == self.codes[np.where(inside, b, 0)]
            length += inside & same
        return length

    @staticmethod
    def _rank_at(p: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(at, p), len(at) - 1)
        return np.where(at[i] == p, ranks[i], -1)


def _join(a: tuple[list, int], b: tuple[list, int], length: int, left: list, exponent: int, found: dict) -> tuple[list, int]:
    """Pairs between two nodes whose words in common are ``length``; the joined node (positions, class or -2: several)."""
    (large, c), (small, d) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
    if c != d or c == -2:
        reach = length // (exponent - 1)
        for p in small:
            i = bisect_left(large, p)
            if i and p - large[i - 1] <= reach and left[p] != left[large[i - 1]]:
                _note(found, large[i - 1], p, length)
            if i < len(large) and large[i] - p <= reach and left[p] != left[large[i]]:
                _note(found, p, large[i], length)
    if 8 * len(small) < len(large):
        for p in small:
            insort(large, p)
    else:
        large += small
        large.sort()
    return large, c if c == d else -2


def _note(found: dict, start: int, copy: int, length: int) -> None:
    span = (start, copy + length)
    period = copy - start
    if found.get(span, period + 1) > period:
        found[span] = period


def maximal_pairs(suffixes: Suffixes, least: int, least_words: int, exponent: int) -> dict[tuple[int, int], int]:
    """{(start, end): period} of all runs, positions counted over the slice."""
    found: dict[tuple[int, int], int] = {}
    slots = suffixes.shared_slots
    if not len(slots):
        return found
    order = suffixes.order[slots]
    common = np.zeros(len(slots), np.int64)
    # texts don't share words here, so suffixes of two texts have nothing in common
    beside = np.flatnonzero((slots[1:] == slots[:-1] + 1) & (suffixes.ends[order[1:]] == suffixes.ends[order[:-1]])) + 1
    common[beside] = suffixes.common(order[beside - 1], order[beside])
    starts = np.concatenate(([True], suffixes.ends[:-1] != suffixes.ends[1:]))
    left_codes = np.empty(suffixes.n, np.int64)
    left_codes[1:] = suffixes.codes[:-1]
    left_codes[starts] = -1  # no word at the left: a class of its own
    left = left_codes.tolist()

    stack: list[tuple[int, tuple[list, int]]] = []
    node = None
    for p, length in zip(order.tolist(), common.tolist()):
        if length < least:
            while stack:
                above, sibling = stack.pop()
                node = _join(sibling, node, above, left, exponent, found)
        else:
            while stack and stack[-1][0] > length:
                above, sibling = stack.pop()
                node = _join(sibling, node, above, left, exponent, found)
            if stack and stack[-1][0] == length:
                node = _join(stack.pop()[1], node, length, left, exponent, found)
            stack.append((length, node))
        node = ([p], left[p])
    while stack:
        above, sibling = stack.pop()
        node = _join(sibling, node, above, left, exponent, found)
    return {(a, b): q for (a, b), q in found.items() if b - a >= max(least_words, exponent * q)}


def runs_of(texts: list[list[bytes]], least_words: int = LEAST_WORDS,
            exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Per list of words its runs (start, length, period), by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t], np.int64)
    after = np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    # a pair of m words at distance q makes m + q words, and m >= (exponent - 1) * q
    least = min(max(least_words - q, (exponent - 1) * q) for q in range(1, least_words + 1))
    found = maximal_pairs(Suffixes(codes, text_of, after[text_of], least), least, least_words, exponent)
    first = after - sizes
    for (a, b), q in found.items():
        t = int(text_of[a])
        out[t].append((a - int(first[t]), b - a, q))
    for t in out:
        t.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that follow the first period of a run containing them, joined by spaces."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, period in runs:
        gone[start + period:start + length] = True
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS,
              exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Per row: doc_id, n_words, runs sorted by start and period, and the text with each run cut to its first period.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A run has at least ``least_words`` words and
    ``exponent`` (2 or more) times its period.
    """
    if exponent < 2 or least_words < 2:
        raise ValueError("a run holds its period twice at least")
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = C.take(SCHEMA)
    arrow = to_arrow_schema(schema)
    span = arrow.field("runs").type.value_type

    def answer(ids: pa.Array, bodies: list[bytes]) -> pa.RecordBatch:
        words = [b.split() for b in bodies]  # bytes.split() knows just these separators
        runs = runs_of(words, least_words, exponent)
        flat = np.array([r for t in runs for r in t], np.int64).reshape(-1, 3)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in runs]))).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(span))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(w) for w in words], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), spans).cast(arrow.field("runs").type),
             pa.array([collapse(w, r) for w, r in zip(words, runs)], pa.binary()).cast(arrow.field("collapsed").type)],
            schema=arrow)

    def run(batches):
        for batch in batches:
            for lo, rows, raw, offsets in K.slices(batch.column(1)):
                body, cut = raw.tobytes(), offsets.tolist()
                yield answer(batch.column(0).slice(lo, rows), [body[a:b] for a, b in zip(cut, cut[1:])])

    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return src.mapInArrow(run, schema)


def longest(runs):
    """Of a column of sorted runs the one with the greatest length / period, compared exactly; null without runs."""
    empty = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, empty, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
