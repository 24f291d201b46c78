"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of 0 to ``order`` bytes.  A byte's code
length under a language is looked up at the longest context; a byte that was
never seen there costs an escape (method C: distinct successors over
count plus distinct) and is tried one byte shorter, down to a uniform byte.  The
statistics are frozen after fitting, so the code length of every (context, byte)
is a constant: all contexts of all languages are compiled to one table per
length, and a text's exact code length is a sum of table rows.  The language with
the shortest code wins; ``score`` is its share when code lengths are taken as
probabilities.

Fitting uses at most ``train_rows`` whole texts of each language (those with the
lowest hash of their id), outside the held-out fold; a documented bound.  Contexts are
counted by Spark; the compiled table is what those texts hold and is broadcast.  Where
it could pass ``MAX_TABLE_BYTES``, languages are compiled in blocks, which score a batch one
after the other.  Every row is predicted from its whole text.

Defined cases: a null text, an empty one or one without a letter is ``und`` with
score 0; ties go to the language first in order; with nothing to learn from all
rows are ``und``; a null doc_id is not held out and not learned from; repeated rows are
predicted alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C
from . import kernels as K

ORDER = 3
FOLDS, HELD = 4, 2
TRAIN_ROWS = 300
#: Of a compiled table, by the grams counted.
MAX_TABLE_BYTES = 64 << 20
MAX_BROADCAST_ROWS = 200_000
_LETTER_OR_NUMBER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """A character of Unicode's letter categories; signs such as ``½``, ``²`` and ``Ⅷ`` are numbers."""
    return any(unicodedata.category(m[0])[0] == "L" for m in _LETTER_OR_NUMBER.finditer(text))


def grams(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(last byte's place, bytes as one number) of every run of ``length`` bytes inside a text."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = raw[:n].astype(np.int64)
    for j in range(1, length):
        key = key << 8 | raw[j:j + n]
    start = np.repeat(offsets[:-1], np.diff(offsets))  # of each byte's text
    last = np.arange(length - 1, len(raw))
    inside = last - start[length - 1:] >= length - 1
    return last[inside], key[inside]


class Trees:
    """Compiled code lengths: per context length sorted grams and contexts with a column per language."""

    def __init__(self, languages: list[str], counts: dict[int, dict[str, tuple[np.ndarray, np.ndarray]]], order: int):
        """counts: by gram length (1 to order + 1) and language, sorted grams and how often each occurs."""
        self.languages, self.order = languages, order
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        many = len(languages)
        none = np.zeros(0, np.int64)
        for k in range(order + 1):
            seen = [counts.get(k + 1, {}).get(x, (none, none)) for x in languages]
            union = np.unique(np.concatenate([g for g, _ in seen])) if seen else none
            above = np.unique(union >> 8)
            cost, escape = np.full((len(union), many), np.nan), np.zeros((len(above), many))
            for j, (g, c) in enumerate(seen):
                if not len(g):
                    continue
                context, first, inverse = np.unique(g >> 8, return_index=True, return_inverse=True)
                total = np.bincount(inverse, weights=c)
                distinct = np.diff(np.append(first, len(g)))
                cost[np.searchsorted(union, g), j] = -np.log2(c / (total + distinct)[inverse])
                escape[np.searchsorted(above, context), j] = -np.log2(distinct / (total + distinct))
            self.contexts.append(above)
            self.escapes.append(escape)
            if k == 0:
                shorter = np.full((len(union), many), 8.0)
            else:
                shorter = self.code(union & ((1 << 8 * k) - 1), k - 1)
            fallback = escape[np.searchsorted(above, union >> 8)] + shorter
            self.grams.append(union)
            self.costs.append(np.where(np.isnan(cost), fallback, cost))

    def code(self, key: np.ndarray, k: int) -> np.ndarray:
        """Code length of each gram's last byte after its k bytes of context, per language."""
        out = np.full((len(key), len(self.languages)), 8.0)
        add = None
        left = np.arange(len(key))
        while k >= 0 and len(left):
            known = self.grams[k]
            pos = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            hit = known[pos] == key if len(known) else np.zeros(len(key), bool)
            got = self.costs[k][pos[hit]] if len(known) else np.zeros((0, len(self.languages)))
            out[left[hit]] = got if add is None else got + add[hit]
            miss = ~hit
            left, key = left[miss], key[miss]
            add = np.zeros((len(left), len(self.languages))) if add is None else add[miss]
            above = self.contexts[k]
            if len(above):
                pos = np.minimum(np.searchsorted(above, key >> 8), len(above) - 1)
                add = add + np.where((above[pos] == key >> 8)[:, None], self.escapes[k][pos], 0)
            key = key & ((1 << 8 * k) - 1)
            k -= 1
        if len(left):
            out[left] = 8.0 + add
        return out

    def lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language."""
        n = len(offsets) - 1
        total = np.zeros((n, len(self.languages)))
        doc = np.repeat(np.arange(n), np.diff(offsets))
        depth = np.arange(len(raw)) - offsets[:-1][doc]
        for k in range(self.order + 1):
            last, key = grams(raw, offsets, k + 1)
            if k < self.order:  # only the byte that has no longer context
                first = depth[last] == k
                last, key = last[first], key[first]
            if not len(last):
                continue
            # equal grams cost alike: code each once
            unique, inverse = np.unique(key, return_inverse=True)
            bits = self.code(unique, k)
            for j in range(len(self.languages)):
                total[:, j] += np.bincount(doc[last], weights=bits[inverse, j], minlength=n)
        return total

    def best(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: the first language of the least bits, those, and the sum of all probabilities over its own."""
        found = []
        limit = max(1 << 16, K.CHUNK_BYTES * 8 // max(8, len(self.languages)))
        for lo, rows, raw, offsets in K.slices(texts, limit):
            bits = self.lengths(raw, offsets)
            least = bits.min(axis=1)
            found.append((np.array(self.languages, object)[bits.argmin(axis=1)], least,
                          np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)))
        return tuple(map(np.concatenate, zip(*found)))

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        return predict([self] if self.languages else [], texts)


def predict(blocks: Iterable[Trees], texts: pa.Array) -> tuple[list[str], list[float]]:
    """Language and score of every text over all blocks, whose languages are in order."""
    best = None
    for trees in blocks:
        new = trees.best(texts)
        if best is None:
            best = new
            continue
        least = np.minimum(best[1], new[1])
        mass = sum(m * np.exp2(np.maximum(least - bits, -1000)) for _, bits, m in (best, new))
        best = np.where(new[1] < best[1], new[0], best[0]), least, mass
    letters = []
    for lo, rows, raw, offsets in K.slices(texts):
        data = raw.tobytes()
        letters += [has_letter(data[offsets[i]:offsets[i + 1]].decode("utf-8", "replace")) for i in range(rows)]
    if best is None:
        return ["und"] * len(letters), [0.0] * len(letters)
    return ([x if good else "und" for x, good in zip(best[0], letters)],
            [float(1 / m) if good else 0.0 for m, good in zip(best[2], letters)])


class Blocks:
    """Trees of blocks of languages, compiled one after the other."""

    def __init__(self, grams: DataFrame, blocks: list[list[str]], order: int):
        self.grams, self.blocks, self.order = grams, blocks, order

    def __iter__(self) -> Iterator[Trees]:
        for languages in self.blocks:
            got = (self.grams.where(F.col("lang").isin(languages)).toArrow()
                   .sort_by([("lang", "ascending"), ("length", "ascending"), ("gram", "ascending")]))
            names, lengths = np.array(got["lang"].to_pylist(), object), got["length"].to_numpy()
            gram, number = got["gram"].to_numpy(), got["count"].to_numpy()
            counts: dict[int, dict[str, tuple]] = {}
            for k in range(1, self.order + 2):
                for name in languages:
                    own = (lengths == k) & (names == name)
                    counts.setdefault(k, {})[name] = (gram[own], number[own])
            yield Trees(languages, counts, self.order)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", order: int = ORDER,
          train_rows: int = TRAIN_ROWS) -> Trees | Blocks:
    """Trees of all languages in ``lang``, from a bounded sample of each outside the held-out fold."""
    rows = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                        F.col(lang).cast("string").alias("lang"))
            .where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
            .where(C.crc_fold("doc_id", FOLDS) != HELD))
    sizes = C.written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    languages = sorted(r.lang for r in sizes.select("lang").collect())
    if not languages:
        return Trees([], {}, order)
    if len(languages) <= MAX_BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    # Ids hash evenly: a threshold per language lets about twice the wanted rows through to the exact choice.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limit = ((1 << 30) * F.least(F.lit(1.0), F.lit(2 * train_rows + 200.0) / F.col("rows"))).cast("long")
    chosen = (rows.join(sizes, "lang").where(place < limit)
              .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(place, "doc_id", "text")))
              .where(F.col("n") <= train_rows).select("lang", "text"))

    def count(batch: pa.RecordBatch) -> dict:
        out = {"lang": [], "length": [], "gram": [], "count": []}
        names = np.array(batch.column(0).to_pylist(), object)
        for lo, n, raw, offsets in K.slices(batch.column(1)):
            doc = np.repeat(np.arange(lo, lo + n), np.diff(offsets))
            for k in range(1, order + 2):
                last, key = grams(raw, offsets, k)
                for name in set(names[lo:lo + n]):
                    g, c = np.unique(key[names[doc[last]] == name], return_counts=True)
                    out["lang"] += [name] * len(g)
                    out["length"] += [k] * len(g)
                    out["gram"] += g.tolist()
                    out["count"] += c.tolist()
        return out

    grams_of = C.written(C.map_arrow(chosen, count, C.take("lang string, length int, gram long, count long"))
                         .groupBy("lang", "length", "gram").agg(F.sum("count").alias("count")), "grams")
    held = {r.lang: r["count"] for r in grams_of.groupBy("lang").count().collect()}
    blocks, total = [[]], 0
    for name in languages:
        total += held.get(name, 0)
        if blocks[-1] and total * (len(blocks[-1]) + 1) * 16 > MAX_TABLE_BYTES:
            blocks.append([])
            total = held.get(name, 0)
        blocks[-1].append(name)
    trees = Blocks(grams_of, blocks, order)
    return next(iter(trees)) if len(blocks) == 1 else trees


def identify(docs: DataFrame, trees: Trees | Blocks, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    docs = C.without(docs, ["lang_pred", "score"])
    at, names = docs.columns.index(text), docs.columns
    blocks = trees if isinstance(trees, Blocks) else [trees] if trees.languages else []
    shared = [C.Shared(docs.sparkSession, t) for t in blocks]

    def run(batch: pa.RecordBatch) -> dict:
        found, scores = predict((s.value for s in shared), batch.column(at))
        return dict(zip(names, batch.columns)) | {"lang_pred": found, "score": scores}

    return C.map_arrow(docs, run, type(docs.schema)(
        docs.schema.fields + C.take("lang_pred string, score double").fields))
