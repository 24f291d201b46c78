"""The registered queries of this subpackage: QUERIES (key -> job) and ORACLES (key -> DuckDB SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat
from . import collocations
from . import common as C
from . import decontaminate as dec
from . import jaccard_join as jac
from . import language
from . import packing
from . import periodic_runs as periodic
from . import quality
from . import quality_rules as rules
from . import resharding
from . import secrets
from . import simhash_trees as simhash
from . import warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return put


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT dw.r, dw.i, dw.size, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
covered AS (SELECT r, count(DISTINCT p) AS n_hit
            FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""


@query("op9_benchmark_decontamination", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated words and items of every document against the whole benchmark."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = dec.find_contamination(docs, C.read(spark, sf_dir, "benchmark").select("item_id", "text"))
    return dec.report(found)


@query("op3_best_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 1024 tokens."""
    pieces = packing.pack(C.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - least(4, len(w)) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a),
k AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY g) AS class_id
      FROM (SELECT doc_id, string_agg(g, chr(10) ORDER BY g) AS g FROM s GROUP BY doc_id))
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(k.class_id, d.doc_id) AS class_id
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query("op2_ngram_jaccard_join", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: Jaccard >= 0.85 over 4-word shingles."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return jac.near_classes(docs).select("doc_id", "n_shingles", "component_id", "class_id")


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from a factorisation machine fitted outside the held-out fold."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, C.read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(C.crc_fold("doc_id", quality.FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document by byte context trees fitted outside the held-out fold."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trees = language.train(docs)
    return language.identify(docs.select("doc_id", "text"), trees).select(
        "doc_id", F.coalesce(C.crc_fold("doc_id", language.FOLDS) == language.HELD, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
rules(kind, rank, p) AS (VALUES
  ('assign', 0, '(?:(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 'AKIA[A-Z0-9]+'),
  ('hex', 2, '[0-9a-f]+')),
x AS (
  SELECT r, kind, rank, p, unnest(parts) AS hit, generate_subscripts(parts, 1) AS i
  FROM (SELECT r, kind, rank, p, regexp_extract_all(t, '(?s)' || p || '|.') AS parts FROM d, rules
        WHERE regexp_matches(t, CASE kind WHEN 'hex' THEN '[0-9a-f]{32}' ELSE p END))),
h AS (SELECT r, kind, rank, p, hit,
             CAST(sum(length(hit)) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS e FROM x),
f AS (
  SELECT r, kind, rank, e - length(hit) AS s, e FROM h
  WHERE regexp_full_match(hit, p)
    AND CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '^[^:=]*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8
             WHEN 'access' THEN length(hit) >= 16 ELSE length(hit) >= 32 END),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


@query("op6_secret_scans", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, each distinct text scanned once through a fresh ledger."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return secrets.report(secrets.findings(docs, C.scratch(spark, "ledger")))


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                  (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS last_role, lead(role) OVER w AS next_role
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (
  SELECT conv_id, i, role, text,
         length(text) + length(regexp_replace(text, '[^<\[]', '', 'g'))
         + CASE WHEN last_role IS NULL OR last_role <> role
                THEN 9 + length(role) + length(regexp_replace(role, '[^<\[]', '', 'g'))
                     + 2 * length(regexp_replace(role, '[^\n]', '', 'g')) ELSE 8 END
         + CASE WHEN next_role IS NULL OR next_role <> role THEN 8 ELSE 0 END AS chars
  FROM o)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""


@query("op7_chat_formatting", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, with one whose texts are control strings."""
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = C.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.report(chat.read_back(chat.format_chats(rows)))


def _op1_sql() -> str:
    words = ", ".join("'" + w + "'" for w in rules.WORDS)
    vowels, upper, digits, marks, symbols, beyond, spaces = (
        f"len(t) - len(regexp_replace(t, '{p}', '', 'g'))" for p in (
            "[aeiou]", "[A-Z]", "[0-9]", """[.,;:!?''"()/-]""", "[#*$%&|<>]", r"[^\x00-\x7F]",
            r"[\x20\x09-\x0D]"))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS win
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT r, unnest(generate_series(i, i + 4)) AS p
              FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM g) WHERE n > 1) GROUP BY r),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines
        FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
b AS (SELECT r, doc_id, lang, t, w, CAST(len(w) AS BIGINT) AS n_words,
             CAST(len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST({symbols} AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             len(w) < {rules.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {rules.MAX_REPEAT_PERCENT} * len(w) AS base_failed
      FROM d LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
cc AS (SELECT r, [{vowels}, {upper}, {digits}, {marks}, {symbols}, {beyond}, {spaces}] AS c, len(t) AS n FROM b),
cb AS (SELECT r, 'c' AS kind, unnest(list_append(c, n - list_sum(c))) AS n,
              'c' || generate_subscripts(list_append(c, 0), 1) AS bin FROM cc),
wl AS (SELECT r, lower(x) AS x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM b) WHERE lower(x) IN ({words}) GROUP BY ALL),
wb AS (SELECT r, 'w' AS kind, n, 'w' || x AS bin FROM wl
       UNION ALL SELECT b.r, 'w', b.n_words - coalesce(s.n, 0), 'rest' FROM b LEFT JOIN (SELECT r, sum(n) AS n FROM wl GROUP BY r) s USING (r)),
bins AS (SELECT * FROM cb UNION ALL SELECT r, kind, n, bin FROM wb),
slots AS (SELECT 'c' AS kind, 'c' || unnest(generate_series(1, 8)) AS bin
          UNION ALL SELECT 'w', 'w' || unnest([{words}]) UNION ALL SELECT 'w', 'rest'),
langs AS (SELECT DISTINCT lang FROM b WHERE lang IS NOT NULL AND NOT base_failed),
sums AS (SELECT l.lang, s.kind, s.bin, coalesce(x.n, 0) + 1 AS n FROM langs l CROSS JOIN slots s
         LEFT JOIN (SELECT lang, bin, sum(n) AS n FROM bins JOIN b USING (r) WHERE NOT base_failed GROUP BY ALL) x
                ON x.lang = l.lang AND x.bin = s.bin),
refs AS (SELECT lang, kind, bin, n / sum(n) OVER (PARTITION BY lang, kind) AS q FROM sums),
tot AS (SELECT r, kind, sum(n) AS total FROM bins GROUP BY ALL),
far AS (SELECT tot.r, tot.kind, refs.lang, sqrt(greatest(sum(
               CASE WHEN coalesce(bins.n, 0) > 0 THEN (bins.n / total) * log2((bins.n / total) / ((bins.n / total + q) / 2)) ELSE 0 END
               + q * log2(q / ((coalesce(bins.n, 0) / total + q) / 2))) / 2, 0)) AS far
        FROM tot JOIN refs USING (kind) LEFT JOIN bins ON bins.r = tot.r AND bins.bin = refs.bin
        WHERE total >= CASE tot.kind WHEN 'c' THEN {rules.MIN_CHARS} ELSE {rules.MIN_COMMON} END GROUP BY ALL),
bad AS (SELECT DISTINCT r FROM (SELECT r, kind, min(far) AS far FROM far GROUP BY ALL)
        WHERE far > CASE kind WHEN 'c' THEN {rules.CHAR_DISTANCE} ELSE {rules.WORD_DISTANCE} END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept
FROM b
"""


@query("op1_quality_rules", _op1_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and distribution verdict of every document."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return rules.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP4_SQL = r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS h FROM pages),
o AS (SELECT page_id, h, row_number() OVER (PARTITION BY h ORDER BY page_id NULLS LAST) AS i,
             min(page_id) OVER (PARTITION BY h) AS first_id, sha1(h) AS x FROM p),
b AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((('0x' || substr(x, 1 + 10 * (k // 8), 10))::BIGINT >> (35 - 5 * (k % 8))) & 31 AS BIGINT) + 1, 1)), '')
        AS payload_digest FROM o)
SELECT page_id, strlen(h) AS payload_bytes, payload_digest,
       CASE WHEN i = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN i > 1 THEN first_id END AS refers_to
FROM b
"""


@query("op4_warc", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as sharded WARC archives, then read back."""
    out = C.scratch(spark, "warc")
    warc.write_warc(C.read(spark, sf_dir, "pages"), out)
    return warc.read_warc(spark, out, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from source-hashed shards into 16 shards of equal counts, read back from the new files.

    Law ``rows``: shards' counts differ by at most one, with the fewest bytes moved.
    """
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(resharding.SHARDS))
    placed, transfers = resharding.reshard(docs, old)
    out = C.scratch(spark, "shards")
    body = F.coalesce("text", F.lit("")).cast("binary")
    columns = [F.col("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"),
               F.crc32(body).alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot",
               F.lit(None).cast("int").alias("grown_shard"), "old_shard"]
    moved = resharding.rewrite(placed, transfers, out)
    if not moved:
        return placed.select(*columns)
    found = spark.read.schema(placed.schema).parquet(out).select(*columns)
    if len(moved) < resharding.SHARDS:
        found = found.unionByName(placed.where(~F.col("shard").isin(moved)).select(*columns))
    return found


def planted_runs(docs: DataFrame) -> DataFrame:
    """``documents`` whose texts repeat a stretch of their words, wherever the id's checksum ends in 0."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (docs.withColumn("_h", h)
              .withColumn("_w", F.when(F.col("_h") % 10 == 0, F.expr(
                  r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> '')")))
              .withColumn("_n", F.size("_w")).withColumn("_g", F.expr("_h div 10"))
              .withColumn("_a", F.expr("CASE WHEN _n > 0 THEN cast(_g % _n AS int) END"))
              .withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) AS int)")))
    return chosen.select("doc_id", F.expr(
        "CASE WHEN _n > 0 THEN concat_ws(' ', slice(_w, 1, _a), "
        "transform(sequence(_a, _n - 1), i -> _w[_a + (i - _a) % _p])) ELSE text END").alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, its most repetitive one, and digests of all runs and of the collapsed text."""
    docs = planted_runs(C.read(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.col("best")
    return (periodic.find_runs(docs).withColumn("best", periodic.longest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(
            F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")),
            F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


@query("op13_simhash_near_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents whose fingerprints differ in at most three bits."""
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
parts AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT p.lang, p.g, p.f AS a, p.c, x.f AS l, y.f AS r, total.n,
         CAST(CAST(1000 AS HUGEINT) * p.f * total.n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS c FROM parts) p
  JOIN f x ON x.lang = p.lang AND x.g = array_to_string(p.w[1:p.c], ' ')
  JOIN f y ON y.lang = p.lang AND y.g = array_to_string(p.w[p.c + 1:p.k], ' ')
  JOIN total ON total.lang = p.lang),
weak AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, c) AS nth FROM cuts),
inside AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS g, max(f) AS f
  FROM (SELECT lang, w, f, size, unnest(generate_series(1, k - size + 1)) AS i
        FROM (SELECT *, unnest(generate_series(2, k - 1)) AS size FROM parts WHERE k > 2)) GROUP BY ALL),
ranked AS (
  SELECT weak.*, row_number() OVER (PARTITION BY weak.lang ORDER BY score DESC, a DESC, weak.g) AS rank
  FROM weak LEFT JOIN inside ON inside.lang = weak.lang AND inside.g = weak.g
  WHERE nth = 1 AND (inside.f IS NULL OR inside.f < a))
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


@query("op12_collocation_mining", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two to five words of every language, from all documents."""
    return collocations.collocations(C.read(spark, sf_dir, "documents").select("text", "lang"))
