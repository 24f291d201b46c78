"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A window
is ``n`` consecutive words of a benchmark item; an item with fewer words (but
not none) is one window of all its words.  The windows' 64-bit hashes are
broadcast; every document word position is probed (a bit map first, then the
sorted hashes), and each hash hit is verified word for word.

The broadcast holds benchmark windows only and never grows with the documents.
Its bytes are summed first: beyond ``max_broadcast_bytes`` the windows are cut
into blocks by hash, each block scans all documents, and the sparse hits are
joined back by (doc_id, text digest).

Defined cases: a null or empty text has no words and is clean; null benchmark
texts and items without words are never found; equal windows belong to all
their items; a null item_id has no name and is left out; repeated document rows
are scanned each; input columns that have an output's name are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import kernels as K

MAX_BROADCAST_BYTES = 64 << 20
_BITS = 20

WINDOWS = "hash long, n_words int, words string, item_id string"
FOUND = ("n_words long, n_hit long, items array<string>, hit_spans array<struct<start:int,end:int>>, "
         "clean_text string")


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", n: int = 10) -> DataFrame:
    """One row per benchmark window: hash, its words joined by a space, item."""

    def windows(batch: pa.RecordBatch) -> dict:
        out = {"hash": [], "n_words": [], "words": [], "item_id": []}
        ids = batch.column(0).to_pylist()
        for lo, rows, raw, offsets in K.slices(batch.column(1)):
            w = K.Words(raw, offsets, K.ALNUM_WORDS)
            data = K.ALNUM_WORDS[1][raw].tobytes()
            for i in range(rows):
                a, b = int(w.first[i]), int(w.first[i + 1])
                size = min(n, b - a)
                if not size or ids[lo + i] is None:
                    continue
                for h, j in zip(K.window_hash(w.hash[a:b], size).view(np.int64).tolist(), range(a, b - size + 1)):
                    out["hash"].append(h)
                    out["n_words"].append(size)
                    out["words"].append(b" ".join(
                        data[s:e] for s, e in zip(w.starts[j:j + size], w.ends[j:j + size])).decode("utf-8"))
                    out["item_id"].append(ids[lo + i])
        return out

    src = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    return C.map_arrow(src, windows, C.take(WINDOWS)).distinct()


class Windows:
    """A block of benchmark windows, ready to be probed."""

    def __init__(self, rows: list):
        self.items: dict[str, list[str]] = {}
        hashes: dict[int, set[int]] = {}
        for r in rows:
            self.items.setdefault(r.words, []).append(r.item_id)
            hashes.setdefault(r.n_words, set()).add(r.hash)
        self.sorted = {size: np.sort(np.array(list(h), np.int64).view(np.uint64)) for size, h in hashes.items()}

    def probe(self, w: K.Words) -> list[tuple[int, np.ndarray]]:
        """(window size, first word of each hash hit inside one text) for every size."""
        maps = self.__dict__.setdefault("_maps", {})
        found = []
        for size, known in self.sorted.items():
            h = K.window_hash(w.hash, size)
            if not len(h):
                continue
            if size not in maps:
                bits = np.zeros(1 << _BITS, bool)
                bits[(known >> np.uint64(64 - _BITS)).astype(np.int64)] = True
                maps[size] = bits
            at = np.flatnonzero(maps[size][(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = at[w.doc[at] == w.doc[at + size - 1]]
            pos = np.searchsorted(known, h[at])
            at = at[known[np.minimum(pos, len(known) - 1)] == h[at]]
            if len(at):
                found.append((size, at))
        return found


def _scan(block, texts: pa.Array, want_text: bool) -> dict:
    windows = block.value
    n_words, n_hit, items, spans, clean = [], [], [], [], []
    for lo, rows, raw, offsets in K.slices(texts):
        w = K.Words(raw, offsets, K.ALNUM_WORDS)
        covered = np.zeros(len(w.starts) + 1, np.int64)
        named: dict[int, set[str]] = {}
        data = None
        for size, at in windows.probe(w):
            data = data if data is not None else K.ALNUM_WORDS[1][raw].tobytes()
            for i in at.tolist():
                words = b" ".join(
                    data[s:e] for s, e in zip(w.starts[i:i + size], w.ends[i:i + size])).decode("utf-8", "replace")
                ids = windows.items.get(words)
                if ids:
                    covered[i] += 1
                    covered[i + size] -= 1
                    named.setdefault(int(w.doc[i]), set()).update(ids)
        hit = np.cumsum(covered[:-1]) > 0
        hits = np.bincount(w.doc[hit], minlength=rows)
        n_words += w.per_doc.tolist()
        n_hit += hits.tolist()
        for i in range(rows):
            items.append(sorted(named.get(i, ())))
            if not hits[i]:
                spans.append([])
                clean.append(None)
                continue
            a, b = int(w.first[i]), int(w.first[i + 1])
            edge = np.diff(np.concatenate(([0], hit[a:b].view(np.int8), [0])))
            runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
            spans.append([{"start": s, "end": e} for s, e in runs])
            if want_text:
                keep, at = [], int(offsets[i])
                for s, e in runs:
                    keep.append(raw[at:int(w.starts[a + s])].tobytes())
                    at = int(w.ends[a + e - 1])
                keep.append(raw[at:int(offsets[i + 1])].tobytes())
                clean.append(b"".join(keep).decode("utf-8", "replace"))
            else:
                clean.append(None)
    return {"n_words": n_words, "n_hit": n_hit, "items": items, "hit_spans": spans, "clean_text": clean}


def _block_count(windows: DataFrame, max_bytes: int) -> int:
    """How many broadcast blocks keep the windows' bytes below the bound."""
    total = windows.agg(F.sum(F.length("words") + F.coalesce(F.length("item_id"), F.lit(0)) + 64)).first()[0] or 0
    return -(-int(total) // max_bytes) or 1


def _block(windows: DataFrame, number: int, count: int) -> C.Shared:
    part = windows if count == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(count)) == number)
    return C.Shared(windows.sparkSession, Windows(part.collect()))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 10,
                       item_id: str = "item_id", item_text: str = "text", want_text: bool = False,
                       max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """All columns of ``docs`` with n_words, n_hit, items, hit_spans (word ranges) and clean_text.

    ``clean_text`` is the text without its hit spans, or null where nothing was hit.
    """
    schema = C.take(FOUND)
    names = [f.name for f in schema]
    docs = C.without(docs, [x for x in names if x != text])
    windows = C.written(benchmark_windows(benchmark, item_id, item_text, n), "windows")
    count = _block_count(windows, max_broadcast_bytes)
    where = docs.columns.index(text)

    def scanner(block):
        def scan(batch: pa.RecordBatch) -> dict:
            return dict(zip(docs_columns, batch.columns)) | _scan(block, batch.column(where), want_text)
        return scan

    docs_columns = docs.columns
    full = type(docs.schema)(docs.schema.fields + schema.fields)
    if count == 1:
        return C.map_arrow(docs, scanner(_block(windows, 0, 1)), full)
    # Beyond the bound: one scan per block, ended before the next block is built, so that one block at a time
    # is held; hits are sparse and meet again by the text's digest.
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    hits = None
    for number in range(count):
        block = _block(windows, number, count)
        part = (C.map_arrow(docs.select(text), _text_scanner(block, text), C.take(f"`{text}` string, " + FOUND))
                .where("n_hit > 0").select(digest.alias("_text_key"), "items", "hit_spans").distinct())
        part = C.written(part, "hits")
        block.packed.unpersist()
        hits = part if hits is None else hits.unionByName(part)
    empty = Windows([])
    base = C.map_arrow(docs, scanner(C.Shared(docs.sparkSession, empty)), full)
    merged = (hits.groupBy("_text_key")
              .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_spans")))).alias("_spans")))
    joined = base.withColumn("_text_key", digest).join(merged, "_text_key", "left")

    def merge(batch: pa.RecordBatch) -> dict:
        cols = dict(zip(batch.schema.names, batch.columns))
        return {c: cols[c] for c in docs_columns} | _merge(cols, text, want_text)

    return C.map_arrow(joined, merge, full)


def _text_scanner(block, text: str):
    return lambda batch: {text: batch.column(0)} | _scan(block, batch.column(0), False)


def _merge(cols: dict, text: str, want_text: bool) -> dict:
    """Union of the spans that the blocks found for each text."""
    out = {"n_words": cols["n_words"], "n_hit": [], "items": [], "hit_spans": [], "clean_text": []}
    for body, items, spans in zip(cols[text].to_pylist(), cols["_items"].to_pylist(), cols["_spans"].to_pylist()):
        runs: list[list[int]] = []
        for s in sorted((x["start"], x["end"]) for x in spans or ()):
            if runs and s[0] <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], s[1])
            else:
                runs.append(list(s))
        out["n_hit"].append(sum(e - s for s, e in runs))
        out["items"].append(items or [])
        out["hit_spans"].append([{"start": s, "end": e} for s, e in runs])
        if not (runs and want_text):
            out["clean_text"].append(None)
            continue
        data = body.encode()
        raw = np.frombuffer(data, np.uint8)
        w = K.Words(raw, np.array([0, len(raw)]), K.ALNUM_WORDS, hashed=False)
        keep, at = [], 0
        for s, e in runs:
            keep.append(data[at:w.starts[s]])
            at = int(w.ends[e - 1])
        out["clean_text"].append(b"".join([*keep, data[at:]]).decode("utf-8", "replace"))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", action: str = "drop",
                  **options) -> DataFrame:
    """Remove what is contaminated, with the columns of ``docs``.

    ``action="drop"`` removes documents with a hit; ``"cut"`` removes the hit
    spans, repeated until the joined rest has no hit, and keeps the document.
    """
    columns = docs.columns
    if action == "drop":
        return find_contamination(docs, benchmark, text, **options).where("n_hit = 0").select(*columns)
    if action != "cut":
        raise ValueError(f"unknown action {action!r}")
    while True:
        found = C.written(find_contamination(docs, benchmark, text, want_text=True, **options), "cut")
        docs = found.withColumn(text, F.coalesce("clean_text", text)).select(*columns)
        if found.where("n_hit > 0").isEmpty():
            return docs


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document: counts, the found items and their digest."""
    return found.select(
        F.col(doc_id).alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def digest_of(items: list[str]) -> str:
    """The digest of ``report`` in plain Python, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
