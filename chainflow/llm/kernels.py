"""Vectorised text kernels that the Arrow operators of this subpackage share.

They work on the byte buffer of a whole Arrow string column, in slices of about
``CHUNK_BYTES`` (a longer single text is its own slice), so a task's memory is
bounded by the longest text, not by its partition.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C17  # odd and 3 mod 4, so that base - 1 has a single factor of two


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    name = "_chainflow_llm_worker_cache"
    mod = sys.modules.get(name)
    if mod is None:
        mod = sys.modules[name] = types.ModuleType(name)
        mod.data = {}
    return mod.data


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


#: Bytes of a word that are hashed at once.
_BLOCK = 1 << 12


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per-byte random values, and the base's powers for a block."""
    cache = worker_cache()
    if "powers" not in cache:
        powers = np.ones(_BLOCK, _U)
        with np.errstate(over="ignore"):
            powers[1:] = _U(_BASE)
            cache["powers"] = (mix64(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93)), np.cumprod(powers))
    return cache["powers"]


def _word_hashes(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per word the sum of its bytes' values times the base's power of their place in the word.

    ``values`` has those of all bytes, or of the words' bytes alone.
    """
    if not len(starts):
        return np.zeros(0, _U)
    powers = _tables()[1]
    if int(sizes.max()) <= _BLOCK:
        cuts = np.cumsum(sizes)
        heads = cuts - sizes
        if len(values) != cuts[-1]:
            values = values[np.arange(int(cuts[-1])) + np.repeat(starts - heads, sizes)]
        place = np.arange(int(cuts[-1]), dtype=np.int32) - np.repeat(heads.astype(np.int32), sizes)
        return np.add.reduceat(values * powers[place], heads)
    out = np.empty(len(starts), _U)
    short = sizes <= _BLOCK
    out[short] = _word_hashes(values, starts[short], sizes[short])
    for i in np.flatnonzero(~short).tolist():
        total, factor, step = 0, 1, pow(_BASE, _BLOCK, 1 << 64)
        for lo in range(int(starts[i]), int(starts[i] + sizes[i]), _BLOCK):
            part = values[lo:min(lo + _BLOCK, int(starts[i] + sizes[i]))]
            total += factor * int((part * powers[:len(part)]).sum(dtype=_U))
            factor = factor * step % (1 << 64)
        out[i] = total % (1 << 64)
    return out


def byte_class(pattern_bytes: bytes, lower_ascii: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(is word byte, byte after lower-casing A-Z) tables for the given separators."""
    word = np.ones(256, bool)
    word[list(pattern_bytes)] = False
    fold = np.arange(256, dtype=np.uint8)
    if lower_ascii:
        fold[65:91] += 32
    return word, fold


#: `[^\x20\x09-\x0D]+` after lower-casing A-Z.
SPACE_WORDS = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, letters, all beyond ASCII.
ALNUM_WORDS = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def slices(column: pa.Array, limit: int = CHUNK_BYTES):
    """(first row, rows, bytes, offsets) of consecutive row ranges of about ``limit`` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi - lo, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of a slice: start and end byte, text index, 64-bit hash of the folded bytes."""

    __slots__ = ("starts", "ends", "doc", "hash", "per_doc", "first")

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, classes, hashed: bool = True):
        word, fold = classes
        n_docs = len(offsets) - 1
        size = len(raw)
        isw = np.zeros(size + 2, bool)
        isw[1:-1] = word[raw]
        cut = np.zeros(size + 1, bool)
        cut[offsets] = True
        self.starts = np.flatnonzero(isw[1:-1] & (~isw[:-2] | cut[:-1]))
        self.ends = np.flatnonzero(isw[1:-1] & (~isw[2:] | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.per_doc = np.diff(self.first)
        self.doc = np.repeat(np.arange(n_docs), self.per_doc)
        if hashed:
            sizes = self.ends - self.starts
            value = _tables()[0][fold]
            alone = int(sizes.max(initial=0)) <= _BLOCK
            h = _word_hashes(value[raw[isw[1:-1]] if alone else raw], self.starts, sizes)
            self.hash = mix64(h + sizes.astype(_U) * _U(0xA24BAED4963EE407))
        else:
            self.hash = None


def window_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hash of every k consecutive entries (text borders not looked at)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _U(0x9FB21C651E98DF25)
        out += words[j:j + n]
    return mix64(out ^ _U(k))


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct k-word shingle hashes; a shorter text is one shingle of all its words."""
    win = window_hash(words.hash, k)
    out = []
    for a, m in zip(words.first[:-1].tolist(), words.per_doc.tolist()):
        if m >= k:
            s = np.sort(win[a:a + m - k + 1])
            if m > k:
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            out.append(s)
        elif m:
            out.append(window_hash(words.hash[a:a + m], m))
        else:
            out.append(np.zeros(0, _U))
    return out
