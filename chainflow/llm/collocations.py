"""Phrase collocations, counted with broadcast double-array tries.

Phrases are counted level by level, within each language.

1. Words are counted for each language (shards first, then summed).  Words found ``least`` times or more
   get dense numbers; the texts are written once more as streams of these numbers, in which a
   0 stands for a border of a piece or text and for any rarer word: no frequent phrase crosses one.
2. Candidates of k + 1 words are *Apriori-safe*: a frequent phrase of k words with the word after it, where the last k words are
   frequent as well.  A task notes each candidate it meets, with its number up to
   ``least``; these are summed, and what stays below ``least`` can't be frequent.
3. The candidates are dealt into blocks of at most ``block`` phrases, one task builds the double-array trie of a block, and
   the tries are broadcast one after the other.  Numpy then moves all positions of a
   stream through the trie together, one level at a time, dropping those that fall out, and counts
   accepting states with bincount.  The shards' counts are summed by Spark.  The same pass notes
   the candidates of the next level.
4. Scores, phrases inside longer ones and ranks are joins and aggregates of the counted phrases.

Everything whose size grows with the corpus is a table; a task or the driver holds a block of the dictionary or one trie.

Defined cases: a null text is empty; a null language is ``und``; repeated rows count each time; an empty table gives no rows;
other columns are ignored; ties are settled by the phrase's bytes.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import kernels as K

#: A word's bytes end at these, and the first group ends a piece as well.
_BORDERS = bytes([*b".,;:!?", *range(0x0A, 0x0E)])
WORDS = K.byte_class(_BORDERS + b"\x20\x09")
_IS_BORDER = np.isin(np.arange(256), list(_BORDERS))

LEAST = 100
LONGEST = 5
TOP = 2000
#: Words of the dictionary that are broadcast at once, and phrases of one trie.
DICTIONARY = 2_000_000
BLOCK = 500_000
#: Entries that a task gathers before it hands them on, and rows that it hands on at once: Spark reads a batch into memory beside its heap.
_HELD = 1 << 20
_HANDED = 1 << 16
#: Bytes of a trie in a row.
_PIECE = 1 << 20


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text).cast("string").alias("text"))


def _by_language(batch: pa.RecordBatch):
    """(language, bytes, offsets) of slices of a batch (lang, text), language by language."""
    codes = batch.column(0).dictionary_encode()
    at = codes.indices.to_numpy()
    order = np.argsort(at, kind="stable")
    texts = batch.column(1).take(pa.array(order))
    cuts = np.searchsorted(at[order], np.arange(len(codes.dictionary) + 1))
    for lang, lo, hi in zip(codes.dictionary.to_pylist(), cuts.tolist(), cuts[1:].tolist()):
        for _, _, raw, offsets in K.slices(texts.slice(lo, hi - lo)):
            yield lang, raw, offsets


def _handed(rows: pa.RecordBatch):
    """``rows`` in small batches."""
    for lo in range(0, rows.num_rows, _HANDED):
        yield rows.slice(lo, _HANDED)


def split_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of a slice, and whether each is the first of its piece."""
    words = K.Words(raw, offsets, WORDS, hashed=False)
    isword, fold = WORDS
    borders = np.concatenate(([0], np.cumsum(_IS_BORDER[raw])))
    first = np.ones(len(words.starts), bool)
    first[1:] = (borders[words.starts[1:]] != borders[words.ends[:-1]]) | (words.doc[1:] != words.doc[:-1])
    ends = np.concatenate(([0], np.cumsum(words.ends - words.starts))).astype(np.int32)
    data = fold[raw[isword[raw]]]
    return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data)]), first


def count_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) over all texts."""

    def run(batches):
        held: dict[str, dict[str, int]] = {}
        size = 0

        def out():
            for x, counts in held.items():
                yield from _handed(pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(x, pa.string()), len(counts)), pa.array(counts.keys(), pa.string(), size=len(counts)),
                     pa.array(counts.values(), pa.int64(), size=len(counts))], ["lang", "word", "n"]))

        for batch in batches:
            words: dict[str, list[pa.Array]] = {}
            for x, raw, offsets in _by_language(batch) if batch.num_rows else ():
                words.setdefault(x, []).append(split_words(raw, offsets)[0])
            for x, names in words.items():
                counts = held.setdefault(x, {})
                size -= len(counts)
                found = pc.value_counts(pa.chunked_array(names))
                for w, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                    counts[w] = counts.get(w, 0) + n
                size += len(counts)
                if size > _HELD // 2:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    parts = _texts(docs, text, lang).mapInArrow(run, C.take("lang string, word string, n long"))
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """``df``, written, with dense numbers ``num`` from ``start``."""
    table = C.written(df.withColumn("_at", F.monotonically_increasing_id()), name)
    sizes = table.groupBy(F.shiftright("_at", 33).alias("_part")).count().collect()  # a row for each task
    starts, total = {}, start
    for r in sorted(sizes, key=lambda r: r["_part"]):
        starts[r["_part"]] = total
        total += r["count"]
    offsets = df.sparkSession.createDataFrame([(int(p), s) for p, s in starts.items()], "_part long, _start long")
    return (table.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")
            .withColumn("num", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_start"))


def _pick(words: list[pa.Array], known: dict, langs: list[str]) -> list[np.ndarray]:
    """Numbers of lists of words, each of a language, 0 where a block of the dictionary hasn't them.

    A look-up hashes a language's whole dictionary, so all lists of a language share one.
    """
    out = [np.zeros(len(w), np.int32) for w in words]
    for x in known.keys() & set(langs):
        names, numbers = known[x]
        mine = [i for i, lang in enumerate(langs) if lang == x]
        at = pc.index_in(pa.chunked_array([words[i] for i in mine]), value_set=names).combine_chunks()
        found = np.where(np.asarray(at.is_valid()), numbers[pc.fill_null(at, 0).to_numpy()], 0).astype(np.int32)
        for i, part in zip(mine, np.split(found, np.cumsum([len(words[i]) for i in mine])[:-1])):
            out[i] = part
    return out


def _stream(numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The numbers with a 0 before each piece, without repeated zeros, 0 at both ends."""
    out = np.zeros(len(numbers) + int(first.sum()) + 1, np.int32)
    out[np.arange(len(numbers)) + np.cumsum(first)] = numbers
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
    return out[keep]


def _rows(streams: list[np.ndarray], **more) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(s) for s in streams]))).astype(np.int32)
    flat = np.concatenate([*streams, np.zeros(0, np.int32)])
    return pa.RecordBatch.from_arrays([*more.values(), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                      [*more, "ids"])


def number_texts(docs: DataFrame, words: DataFrame, n_words: int, text: str = "text", lang: str = "lang",
                 dictionary: int = DICTIONARY) -> DataFrame:
    """The texts as rows ``ids``: numbers of frequent words (``words``: lang, word, num from 1), 0 for all else."""
    spark = docs.sparkSession

    def block(at: int):
        rows = words.where(f"num > {at} AND num <= {at + dictionary}").select("lang", "word", "num").toArrow()
        known = {}
        for x in pc.unique(rows["lang"]).to_pylist():
            mine = rows.filter(pc.equal(rows["lang"], x))
            known[x] = (mine["word"].combine_chunks(), mine["num"].to_numpy().astype(np.int32))
        return spark.sparkContext.broadcast(known)  # plain arrays, so that a worker holds them once, not packed as well

    src = _texts(docs, text, lang)
    if n_words <= dictionary:
        known = block(0)

        def whole(batches):
            for batch in batches:
                langs, names, first = [], [], []
                for x, raw, offsets in _by_language(batch) if batch.num_rows else ():
                    for to, part in zip((langs, names, first), (x, *split_words(raw, offsets))):
                        to.append(part)
                for ids, heads in zip(_pick(names, known.value, langs), first):
                    yield _rows([_stream(ids, heads)])

        return C.written(src.mapInArrow(whole, C.take("ids array<int>")), "streams", C.LONG_VALUES)

    # a dictionary of several blocks: each adds the numbers of its words
    def spread(batches):
        for batch in batches:
            for x, raw, offsets in _by_language(batch) if batch.num_rows else ():
                names, first = split_words(raw, offsets)
                one = pa.array(np.array([0, len(names)], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x]), pa.ListArray.from_arrays(one, names), pa.ListArray.from_arrays(one, pa.array(first)),
                     pa.ListArray.from_arrays(one, pa.array(np.zeros(len(names), np.int32)))],
                    ["lang", "words", "first", "ids"])

    fields = "lang string, words array<string>, first array<boolean>, ids array<int>"
    table = C.written(src.mapInArrow(spread, C.take(fields)), "spread", C.LONG_VALUES)
    for at in range(0, n_words, dictionary):
        known = block(at)

        def add(batches, known=known):
            for batch in batches:
                rows = [batch.slice(i, 1) for i in range(batch.num_rows)]
                found = _pick([row.column("words").flatten() for row in rows], known.value, batch.column("lang").to_pylist())
                for row, more in zip(rows, found):
                    ids = row.column("ids").flatten().to_numpy() + more
                    yield _rows([ids], lang=row.column("lang"), words=row.column("words"), first=row.column("first"))

        table = C.written(table.mapInArrow(add, C.take(fields)), "spread", C.LONG_VALUES)

    def close(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield _rows([_stream(row.column("ids").flatten().to_numpy(),
                                     row.column("first").flatten().to_numpy(zero_copy_only=False))])

    return C.written(table.mapInArrow(close, C.take("ids array<int>")), "streams", C.LONG_VALUES)


class Trie:
    """Double-array trie of phrases of equal length: the child of state s by symbol c is ``base[s] + c`` if ``check`` there is s.

    ``symbol`` has the symbols of the words in ``alphabet``, from 1; words with many parents have low ones, so that the
    children of a wide node lie close together.  State 0 is the root.  ``number`` has the phrase of an accepting state, else -1.
    """

    WINDOW = 1 << 14

    def __init__(self, phrases: np.ndarray, numbers: np.ndarray):
        self.words = phrases.shape[1]
        self.alphabet, at, uses = np.unique(phrases, return_inverse=True, return_counts=True)
        a, m = len(self.alphabet), len(phrases)
        self.symbol = np.empty(a, np.int32)
        self.symbol[np.argsort(-uses, kind="stable")] = np.arange(1, a + 1)
        phrases = self.symbol[at.reshape(phrases.shape)]
        del at
        order = np.lexsort(phrases.T[::-1])
        phrases, numbers = phrases[order], numbers[order]
        self.base = np.zeros(a + 1, np.int32)
        self.check = np.full(a + 1, -1, np.int32)  # the root's children come first
        new = np.zeros(m, bool)
        new[:1] = True
        state = np.zeros(m, np.int64)
        for level in range(self.words):
            column = phrases[:, level]
            new[1:] |= column[1:] != column[:-1]
            heads = np.flatnonzero(new)  # one for each node of this level
            parents, symbols = state[heads], column[heads]
            if level:
                self._place(parents, symbols)
            here = self.base[parents] + symbols
            self.check[here] = parents
            state = here[np.cumsum(new) - 1]
        end = int(np.flatnonzero(self.check >= 0).max(initial=0)) + a + 2  # any symbol of any state stays inside
        self._reserve(end)
        self.base, self.check = self.base[:end], self.check[:end]
        self.number = np.full(end, -1, np.int32)
        self.number[state] = numbers

    @classmethod
    def of(cls, parts: dict) -> Trie:
        """The trie with the given arrays."""
        trie = cls.__new__(cls)
        vars(trie).update(parts)
        return trie

    def _reserve(self, size: int) -> None:
        more = size - len(self.base)
        if more > 0:
            more += len(self.base) // 2
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _place(self, parents: np.ndarray, symbols: np.ndarray) -> None:
        """Bases for parents (grouped, symbols ascending): the widest first, each at its first fit; single children fill gaps."""
        heads = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
        sizes = np.diff(np.append(heads, len(parents)))
        a = len(self.alphabet)
        many = np.flatnonzero(sizes > 1)
        start, width = 0, 0
        taken = self.check >= 0
        taken[:a + 1] = True
        for i in many[np.argsort(-sizes[many], kind="stable")].tolist():
            mine = symbols[heads[i]:heads[i] + sizes[i]]
            if len(mine).bit_length() != width:  # narrower nodes look again from the left
                start, width = 0, len(mine).bit_length()
            while True:
                if start + self.WINDOW + a + 1 > len(taken):
                    taken = np.concatenate([taken, np.zeros(len(taken) + self.WINDOW, bool)])
                blocked = taken[start + mine[0]:start + mine[0] + self.WINDOW].copy()
                for c in mine[1:].tolist():
                    blocked |= taken[start + c:start + c + self.WINDOW]
                at = int(blocked.argmin())
                if not blocked[at]:
                    break
                start += self.WINDOW
            self.base[parents[heads[i]]] = start + at
            taken[start + at + mine] = True
        single = heads[sizes == 1]
        free = np.flatnonzero(~taken)[:len(single)]
        free = np.concatenate([free, len(taken) + np.arange(len(single) - len(free))])
        self.base[parents[single]] = free - symbols[single]
        last = int((self.base[parents] + symbols).max(initial=0))
        self._reserve(last + 1)

    def accepted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, numbers) of all phrases in a stream that ends with 0."""
        at = np.minimum(np.searchsorted(self.alphabet, ids), max(0, len(self.alphabet) - 1))
        symbols = np.where(self.alphabet[at] == ids, self.symbol[at], 0) if len(self.alphabet) else np.zeros(len(ids), np.int64)
        symbols = np.append(symbols, np.zeros(self.words, np.int64))
        where = np.flatnonzero(symbols)
        state = np.zeros(len(where), np.int64)
        for level in range(self.words):
            c = symbols[where + level]
            to = self.base[state] + c
            on = (c > 0) & (self.check[to] == state)
            where, state = where[on], to[on]
        return where, self.number[state].astype(np.int64)


def _noted(held: list[np.ndarray], cap: int) -> pa.RecordBatch:
    """The codes with their numbers up to ``cap``; ``held`` is emptied."""
    codes = np.concatenate(held)
    held.clear()
    codes.sort()
    heads = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))[:len(codes)])
    code, n = codes[heads], np.diff(np.append(heads, len(codes)))
    return pa.RecordBatch.from_arrays([pa.array(np.ones(len(code), bool)), pa.array(code),
                                       pa.array(np.minimum(n, cap).astype(np.int64))], ["next", "code", "n"])


def _counts(phrases: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(len(phrases), bool)), pa.array(phrases.astype(np.int64)),
                                       pa.array(n.astype(np.int64))], ["next", "code", "n"])


def _follow(ids: np.ndarray, where: np.ndarray, numbers: np.ndarray, words: int, alone: bool) -> np.ndarray:
    """Codes (phrase, next word) of phrases that a frequent word follows, the last words being frequent too."""
    after = np.append(ids, np.zeros(words + 1, ids.dtype))[where + words].astype(np.int64)
    good = after > 0
    if alone:  # the trie has all phrases of this length
        known = np.zeros(len(ids) + 1, bool)
        known[where] = True
        good &= known[where + 1]
    return numbers[good] << 32 | after[good]


def scan(streams: DataFrame, trie, words: int, size: int, least: int, alone: bool, more: bool) -> DataFrame:
    """(next, code, n): counts of the trie's phrases, by number, and with ``more`` candidates with a word more.

    ``trie`` is a broadcast trie's arrays with its least number, or None for single words (not counted here).
    """

    def run(batches):
        held: list[np.ndarray] = []
        many = 0
        counts = np.zeros(size, np.int64)
        parts, low = (None, 0) if trie is None else trie.value
        tree = parts and Trie.of(parts)
        for batch in batches:
            for ids in batch.column(0):
                ids = ids.values.to_numpy()
                if tree is None:
                    where = np.flatnonzero(ids)
                    numbers = ids[where].astype(np.int64)
                else:
                    where, numbers = tree.accepted(ids)
                    np.add.at(counts, numbers - low, 1)
                if more:
                    held.append(_follow(ids, where, numbers, words, alone))
                    many += len(held[-1])
                    if many > _HELD:
                        yield from _handed(_noted(held, least))
                        many = 0
        if held:
            yield from _handed(_noted(held, least))
        found = np.flatnonzero(counts)
        yield from _handed(_counts(found + low, counts[found]))

    return streams.mapInArrow(run, C.take("next boolean, code long, n long")).groupBy("next", "code").agg(F.sum("n").alias("n"))


def _tries(phrases: DataFrame, words: int, block: int) -> DataFrame:
    """A pickled trie for each block of phrase numbers, in pieces: Arrow and Parquet hold a value several times beside Spark's heap."""

    def build(key, table):
        flat = table.column("ids").combine_chunks().flatten().to_numpy().reshape(-1, words)
        packed = memoryview(pickle.dumps(vars(Trie(flat, table.column("num").to_numpy()))))
        pieces = [pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([i], pa.int32()), pa.array([packed[i * _PIECE:(i + 1) * _PIECE]], pa.binary())],
            ["block", "piece", "trie"])
                  for i in range(-(-len(packed) // _PIECE))]
        return pa.Table.from_batches(pieces)

    return C.written(phrases.select(F.floor(F.col("num") / block).alias("block"), "num", "ids").groupBy("block")
                     .applyInArrow(build, "block long, piece int, trie binary"), "tries", C.LONG_VALUES)


def _trie(tries: DataFrame, block: int) -> dict:
    """The arrays of a block's trie."""
    pieces = sorted(tries.where(F.col("block") == block).select("piece", "trie").collect())
    packed = b"".join(piece for _, piece in pieces)
    del pieces  # the driver is short of memory as well
    return pickle.loads(packed)


def count_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                  dictionary: int = DICTIONARY, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): lang, ids, phrase, words, n of all phrases of 1 to ``longest`` words found ``least`` times or more,

    and the number of all words for each lang.
    """
    spark = docs.sparkSession
    every = C.written(count_words(docs, text, lang), "words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("total"))
    words = C.written(numbered(every.where(F.col("n") >= least), "frequent", 1), "frequent")
    n_words = words.count()
    streams = number_texts(docs, words, n_words, text, lang, dictionary)
    frequent = words.select("lang", F.array(F.col("num").cast("int")).alias("ids"), F.col("word").alias("phrase"),
                            F.lit(1).alias("words"), "n")
    levels = [frequent]
    before = words.select("num", "lang", F.array(F.col("num").cast("int")).alias("ids"), F.col("word").alias("phrase"))
    heard = C.written(scan(streams, None, 1, 0, least, True, longest > 1), "noted")
    for k in range(2, longest + 1):
        found = heard.where("next").where(F.col("n") >= least)
        word = words.select(F.col("num").alias("_word"), "word")
        candidates = numbered(
            found.select(F.shiftright("code", 32).alias("num"), F.col("code").bitwiseAND((1 << 32) - 1).alias("_word"))
            .join(before, "num").join(word, "_word")
            .select("lang", F.concat("ids", F.array(F.col("_word").cast("int"))).alias("ids"),
                    F.concat_ws(" ", "phrase", "word").alias("phrase")), "candidates")
        candidates = C.written(candidates, "candidates")
        size = candidates.count()
        if not size:
            break
        tries = _tries(candidates, k, block)
        scans = None
        for b in range(-(-size // block)):
            low = b * block
            trie = spark.sparkContext.broadcast((_trie(tries, b), low))
            part = C.written(scan(streams, trie, k, min(block, size - low), least, size <= block, k < longest), "noted")
            scans = part if scans is None else scans.union(part)
        heard = scans
        counts = heard.where("NOT next").select(F.col("code").alias("num"), "n")
        levels.append(C.written(candidates.join(counts.where(F.col("n") >= least), "num").select(
            "lang", "ids", "phrase", F.lit(k).alias("words"), "n"), "phrases"))
        before = candidates
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.union(level)
    return phrases, totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP, **options) -> DataFrame:
    """The first ``top`` phrases of each language by the score of their weakest cut: lang, rank, phrase, a, l, r, n, score.

    A cut of a phrase found ``a`` times into parts found ``l`` and ``r`` times scores ``floor(1000 * a * n / (l * r))``,
    exactly; a phrase inside a longer one that is found as often is left out.
    """
    phrases, totals = count_phrases(docs, text, lang, least, longest, **options)
    found = phrases.select("ids", F.col("n").alias("f"))
    several = phrases.where("words > 1")
    cuts = (several.select("lang", "ids", "phrase", F.col("n").alias("a"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
            .withColumns({"left": F.expr("slice(ids, 1, k)"), "right": F.expr("slice(ids, k + 1, size(ids) - k)")})
            .join(found.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
            .join(found.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right")
            .join(F.broadcast(totals) if totals.count() <= 100_000 else totals, "lang")
            .withColumn("score", F.expr("cast(1000 AS decimal(38,0)) * a * total div (cast(l AS decimal(38,0)) * r)")))
    weakest = cuts.groupBy("lang", "ids", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r", F.col("total").alias("n"))).alias("cut"))
    inside = (several.where("words > 2").select(F.col("n").alias("f"), "ids", "words",
                                                F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
              .select("f", F.explode(F.expr("transform(sequence(1, words - size + 1), i -> slice(ids, i, size))")).alias("ids"))
              .groupBy("ids").agg(F.max("f").alias("f")))
    alone = (weakest.join(inside, "ids", "left").where("f IS NULL OR f < a")
             .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score"))
    from pyspark.sql import Window

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
