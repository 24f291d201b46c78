"""Distribution-divergence quality rules in DataFrame functions only.

Every text gets base counts (words, symbols, repeated lines and word windows) and two
histograms: character classes, and common words (the listed words of each language,
and all other words).  A language's reference is the sum of the histograms of its
texts over the whole table.  A text is rejected when, for a histogram that has enough in it
(the minimum-length guards), its Jensen-Shannon distance from even the nearest
reference is above the threshold.  Texts that fail the base rule are rejected and are
no part of a reference.

One pass over the texts makes a slim table of counts in the shared folder;
references are one aggregate of it, a table with a row per language.  Up to
``LITERALS`` of them become literals; more are broadcast in blocks of about
``BLOCK_LANGUAGES``, one after the other, each as one array that a text's distances are
folded over.  The texts are never shuffled.

Defined cases: a null text, like an empty one, has no words and fails the base rule;
a null language takes part in no reference but is judged against all; with no
reference the base rule decides alone; repeated rows are judged alike; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Frequent function words of the languages, in lower case.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "das", "von", "zu", "mit", "nicht", "ist", "ein", "auf", "für"),
    "en": ("the", "of", "and", "to", "a", "in", "that", "is", "was", "for", "it", "with", "as", "on", "this"),
    "es": ("el", "la", "de", "que", "y", "los", "se", "las", "un", "por", "con", "no", "una", "es", "del"),
    "fr": ("le", "les", "et", "des", "à", "est", "dans", "pour", "du", "sur", "pas", "au", "qui", "ne"),
}
WORDS = tuple(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))
#: A letter for each word, so that a text's common words are one short string to count in.
_CODES = [chr(0x4E00 + i) for i in range(len(WORDS))]

#: The base rule.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Guards and thresholds of the distances.
MIN_CHARS, CHAR_DISTANCE = 100, 0.27
MIN_COMMON, WORD_DISTANCE = 50, 0.36
#: References written into the plan, and references of a broadcast block (about 600 bytes each).
LITERALS, BLOCK_LANGUAGES = 64, 20_000

SPACE = r"[\x20\x09-\x0D]+"


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and both histograms."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "char_counts", "word_counts"]
    df = C.without(docs, [n for n in names if n != text])
    kept = [F.col(f"`{c}`") for c in df.columns]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    inner = F.btrim(body, F.lit(" \t\n\x0b\f\r"))
    df = df.select(*kept, body.alias("_t"), F.when(F.length(inner) > 0, F.split(inner, SPACE)).otherwise(
        F.array().cast("array<string>")).alias("_w"))
    places = F.sequence(F.lit(1), F.size("_w") - 4)
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    common = F.filter(F.transform("_w", F.lower), lambda w: w.isin(*WORDS))
    code = F.create_map(*(F.lit(x) for pair in zip(WORDS, _CODES) for x in pair))
    df = df.select("*", lines.alias("_lines"),
                   F.array_join(F.transform(common, lambda w: code[w]), "").alias("_codes"))
    # a text whose windows' hashes all differ repeats nothing; the others sort the windows themselves
    repeats = (F.size("_w") >= 5) & (F.size(F.array_distinct(F.transform(
        places, lambda i: F.xxhash64(F.slice("_w", i, 5))))) < F.size("_w") - 4)
    df = df.withColumn("_sorted", F.when(repeats, F.sort_array(F.transform(
        places, lambda i: F.struct(F.array_join(F.slice("_w", i, 5), " ").alias("w"), i.alias("i"))))))
    twice = F.array_sort(F.transform(F.filter("_sorted", lambda x, j: F.coalesce(
        (F.get("_sorted", j - 1)["w"] == x["w"]) | (F.get("_sorted", j + 1)["w"] == x["w"]),
        F.get("_sorted", j - 1)["w"] == x["w"], F.get("_sorted", j + 1)["w"] == x["w"], F.lit(False))),
        lambda x: x["i"]))
    df = df.withColumn("_twice", twice)
    # a window's words that the next repeated window doesn't cover as well
    repeat_words = F.coalesce(F.aggregate(F.transform("_twice", lambda p, j: F.least(
        F.lit(5), F.coalesce(F.get("_twice", j + 1) - p, F.lit(5)))), F.lit(0), lambda a, n: a + n), F.lit(0))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("_t", pattern, ""))

    n_chars, n_symbols = F.length("_t"), left(r"[^#*$%&|<>]+")
    word_chars = F.length(F.array_join("_w", ""))
    others = F.col("_t")
    for vowel in "aeiou":
        others = F.replace(others, F.lit(vowel), F.lit(""))
    vowels, upper = n_chars - F.length(others), left("[^A-Z]+")
    digits, marks, beyond = left("[^0-9]+"), left(r"[^.,;:!?'\"()/-]+"), left(r"[\x00-\x7F]+")
    df = df.select(
        *kept, F.size("_w").cast("long").alias("n_words"), word_chars.cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words.cast("long").alias("n_repeat_words"), F.length("_codes").alias("_common"), "_codes",
        n_chars.alias("_n"), vowels.alias("_vowels"), upper.alias("_upper"),
        digits.alias("_digits"), marks.alias("_marks"), beyond.alias("_beyond"))
    # vowels, capitals, digits, marks, symbols, beyond ASCII, white space; the rest is mostly consonants
    chars = [F.col("_vowels"), F.col("_upper"), F.col("_digits"), F.col("_marks"), F.col("n_symbols"), F.col("_beyond"),
             F.col("_n") - F.col("word_chars")]
    rest = F.col("_n")
    for c in chars:
        rest = rest - c
    words = [F.length("_codes") - F.length(F.replace("_codes", F.lit(c), F.lit(""))) for c in _CODES]
    return df.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
         ).alias("base_failed"),
        F.array(*(c.cast("long") for c in (*chars, rest))).alias("char_counts"),
        F.array(*(c.cast("long") for c in (*words, F.col("n_words") - F.col("_common")))).alias("word_counts"))


def references(counts: DataFrame, lang: str = "lang") -> DataFrame:
    """lang, chars, words: both distributions of every language, smoothed by one count per bin."""
    n_chars, n_words = 8, len(WORDS) + 1
    sums = (counts.where(F.col(lang).isNotNull() & ~F.col("base_failed")).groupBy(F.col(lang).alias("lang"))
            .agg(F.array(*(F.sum(F.col("char_counts")[i]) + 1 for i in range(n_chars))).alias("chars"),
                 F.array(*(F.sum(F.col("word_counts")[i]) + 1 for i in range(n_words))).alias("words")))

    def shares(column: str) -> Column:
        total = F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.transform(column, lambda x: x / total).alias(column)

    return C.written(sums.select("lang", shares("chars"), shares("words")), "references")


def shares_of(counts: Column) -> Column:
    """A count array as shares of its sum, which is added up once and not once a bin."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(F.array(total), lambda t: F.transform(counts, lambda x: x / t))[0]


def js_distance(counts: Column, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a count array from a distribution without zeros."""
    return shares_distance(shares_of(counts), reference)


def shares_distance(shares: Column, reference: list[float] | Column) -> Column:
    """``js_distance`` of a count array's shares, for several references."""

    def term(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        # a share of zero leaves q * log2(2)
        return F.when(p > 0, p * F.log2(p / m) + q * F.log2(q / m)).otherwise(q)

    parts = F.zip_with(shares, reference if isinstance(reference, Column) else F.array(*map(F.lit, reference)), term)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def folded(column: str, which: str):
    return lambda r: shares_distance(F.col(column), r[which])


def judge(counts: DataFrame, refs: DataFrame) -> DataFrame:
    """``counts`` with char_distance, word_distance (to the nearest reference; null below the guards) and kept."""
    size = F.aggregate("char_counts", F.lit(0).cast("long"), lambda a, x: a + x)
    sides = (("char_distance", "_chars", "chars", size >= MIN_CHARS),
             ("word_distance", "_words", "words", F.col("n_words") >= MIN_COMMON))
    far, many = counts.withColumns({column: F.when(enough, shares_of(F.col(of))) for (_, column, _, enough), of in zip(
        sides, ("char_counts", "word_counts"))}), refs.count()
    if many <= LITERALS:
        rows = refs.collect()
        for name, column, which, enough in sides:
            found = [shares_distance(F.col(column), r[which]) for r in rows]
            far = far.withColumn(name, F.when(enough, F.least(*found) if len(found) > 1 else found[0])
                                 if found else F.lit(None).cast("double"))
    else:
        far = far.select("*", *(F.lit(None).cast("double").alias(name) for name, *_ in sides))
        blocks = -(-many // BLOCK_LANGUAGES)
        for b in range(blocks):
            block = (refs.where(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == b)
                     .agg(F.collect_list(F.struct("chars", "words")).alias("_refs")))
            far = far.crossJoin(F.broadcast(block)).withColumns({name: F.when(enough, F.least(name, F.array_min(F.transform(
                "_refs", folded(column, which))))) for name, column, which, enough in sides}
            ).drop("_refs")
    bad = F.coalesce(F.col("char_distance") > CHAR_DISTANCE, F.lit(False)) | F.coalesce(
        F.col("word_distance") > WORD_DISTANCE, F.lit(False))
    return far.withColumn("kept", ~F.col("base_failed") & ~bad).drop("_chars", "_words")


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, both distances and kept."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counts = C.written(base_counts(slim).drop("text"), "counts")
    return judge(counts, references(counts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "char_distance", "word_distance")
