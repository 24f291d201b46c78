"""Secret scans with an incremental blob ledger.

Every text version is content-addressed (SHA-256).  The ledger is a folder of
Parquet files with one row per (blob, rule, rule version) that has been scanned,
with its spans; blobs without a finding are recorded too.  A scan

1. addresses all versions and counts their digests; texts stay where they are,
2. drops the (blob, rule version) pairs that the ledger already has,
3. scans each remaining blob once, with only the rules that it lacks: a blob of one path in place, one of
   several paths after they were brought together (map-side first, so a text that fills
   a third of the table crosses the network once per task),
4. writes the new rows as one committed batch, and
5. joins findings back to every path that holds the blob.

A ledger row stands by itself: it says that this content was scanned with this rule
version, and what was found.  Whatever part of a batch a lost driver leaves
committed is true, and the next scan adds the rest.  A rule that changes gets a new
version; only its pairs are scanned again.

Fixed rules (a span is the whole match; code points; letters of names in either case):
assign, access, hex.  Further rules can be passed; their spans are added, these stay.

Defined cases: a null text is the empty blob and has no span; empty tables give no
rows; repeated rows share one blob and get its findings each; a null path stays null;
extra columns are ignored, and passed through by ``redact``.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C


class Rule(NamedTuple):
    kind: str
    version: int
    pattern: str
    group: int = 0  # the part whose length counts
    least: int = 0


#: The base rules in their order.  assign 1 passed over PASSWORD and PASSWD; 2 names a changed rule in tests.
RULES = (
    Rule("assign", 3, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
)

#: A text without a match of these has none of the rule's; they are quick to fail.
_FIRST_LOOK = {
    "assign": re.compile(r"(?i:password|passwd|secret|token|key)[\"']?\x20*[:=]", re.ASCII),
    "access": re.compile("AKIA"), "hex": re.compile(r"[0-9a-f]{32}"),
}
MAX_BROADCAST_BYTES = 32 << 20
MAX_BROADCAST_BLOBS = 500_000

LEDGER = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def spans_of(rule: Rule, text: str) -> list[tuple[int, int]]:
    look = _FIRST_LOOK.get(rule.kind) if rule in RULES else None
    if look is not None and not look.search(text):
        return []
    return [m.span() for m in re.finditer(rule.pattern, text, re.ASCII) if len(m[rule.group]) >= rule.least]


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All committed rows of the ledger; empty where there is none yet."""
    try:
        return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(ledger)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or str(e)):
            raise
        return spark.createDataFrame([], C.take(LEDGER))


def _blob(content: str):
    return F.unhex(F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("")).cast("binary"), 256))


def update_ledger(versions: DataFrame, ledger: str, content: str = "content", rules: tuple[Rule, ...] = RULES,
                  max_broadcast_blobs: int = MAX_BROADCAST_BLOBS) -> DataFrame:
    """Scan what the ledger lacks and add it; returns the pairs scanned now (blob, kind, version, spans)."""
    spark = versions.sparkSession
    want = [f"{r.kind}@{r.version}" for r in rules]
    have = (read_ledger(spark, ledger).groupBy(F.unhex("blob").alias("blob"))
            .agg(F.collect_set(F.concat_ws("@", "kind", "version")).alias("have")))
    addressed = versions.select(_blob(content).alias("blob"),
                                F.coalesce(F.col(content).cast("string"), F.lit("")).alias("content"))
    lacks = F.array_except(F.array(*map(F.lit, want)), F.coalesce("have", F.array().cast("array<string>")))
    # digests are dealt out, texts are not: most blobs have one path and lack every rule, and are scanned where they lie
    others = C.written(addressed.groupBy("blob").count().join(have, "blob", "left").withColumn("lacks", lacks)
                       .where((F.col("count") > 1) | (F.size("lacks") < len(want))).select("blob", "lacks"), "others")
    few = others.count() <= max_broadcast_blobs
    listed = F.broadcast(others) if few else others
    alone = addressed.join(listed.select("blob"), "blob", "left_anti").withColumn("lacks", F.array(*map(F.lit, want)))
    repeated = (addressed.join(listed.where(F.size("lacks") > 0), "blob").groupBy("blob")
                .agg(F.first("content").alias("content"), F.first("lacks").alias("lacks")))
    by_name = dict(zip(want, rules))

    def scan(batch: pa.RecordBatch) -> dict:
        out = {"blob": [], "kind": [], "version": [], "spans": []}
        for blob, text, lacking in zip(*(c.to_pylist() for c in batch.columns)):
            for name in lacking:
                rule = by_name[name]
                out["blob"].append(blob.hex())
                out["kind"].append(rule.kind)
                out["version"].append(rule.version)
                out["spans"].append([{"start": a, "end": b} for a, b in spans_of(rule, text)])
        return out

    batch = C.scratch_below(ledger, "batch")
    C.map_slices(alone.union(repeated), "content", scan, C.take(LEDGER)).write.parquet(batch)
    return spark.read.schema(LEDGER).parquet(batch)


def _found_blobs(versions: DataFrame, ledger: str, content: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(_blob, found) of the blobs with findings, after a ledger update; broadcast where its size allows."""
    spark = versions.sparkSession
    update_ledger(versions, ledger, content, rules)
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (f"{r.kind}@{r.version}", i)))
    rank = order[F.concat_ws("@", "kind", "version")]
    per_blob = C.written(
        (read_ledger(spark, ledger).withColumn("rank", rank).where("rank IS NOT NULL AND size(spans) > 0")
                .dropDuplicates(["blob", "rank"])
                .select("blob", F.transform("spans", lambda s: F.struct(
                    s["start"].alias("start"), F.col("rank").alias("rank"), F.col("kind").alias("kind"),
                    s["end"].alias("end"))).alias("found"))
                .groupBy(F.unhex("blob").alias("_blob")).agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))),
        "found")
    size = per_blob.agg(F.sum(100 + 40 * F.size("found"))).first()[0] or 0
    return F.broadcast(per_blob) if size <= MAX_BROADCAST_BYTES else per_blob


def findings(versions: DataFrame, ledger: str, content: str = "content",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` with ``found``: (start, order, kind, end) structs of all its rules, sorted; after a ledger update."""
    versions = C.without(versions, ["found", "_blob"])
    per_blob = _found_blobs(versions, ledger, content, rules)
    return versions.withColumn("_blob", _blob(content)).join(per_blob, "_blob", "left").drop("_blob")


def report(found: DataFrame, doc_id: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per path: counts of the base kinds, the digest of the base spans, all spans."""
    none = F.coalesce("found", F.array().cast(found.schema["found"].dataType))
    base = {r.kind for r in RULES}

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter(none, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col(doc_id).alias("doc_id"), *(count(r.kind).alias(f"n_{r.kind}") for r in RULES),
        F.sha2(listed(F.filter(none, lambda s: s["kind"].isin(*base))).cast("binary"), 256).alias("base_sha256"),
        listed(none).alias("spans"))


def redact(docs: DataFrame, ledger: str, text: str = "text", mark: str = "<SECRET>",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans are replaced as one.

    Texts whose redaction brings two halves of a new match together are scanned again
    until none is left; only texts that were changed go into the next round.  A null text stays null.
    """
    columns = docs.columns

    def blank(batch: pa.RecordBatch) -> dict:
        cols = dict(zip(batch.schema.names, batch.columns))
        out = []
        for body, spans in zip(cols[text].to_pylist(), cols["__found"].to_pylist()):
            end, parts = 0, []
            for s in spans:
                if s["start"] >= end:
                    parts += [body[end:s["start"]], mark]
                end = max(end, s["end"])
            out.append("".join([*parts, body[end:]]))
        return cols | {text: out}

    clean = None
    while True:
        per_blob = _found_blobs(docs, ledger, text, rules).toDF("__blob", "__found")
        addressed = docs.withColumn("__blob", _blob(text))
        kept = addressed.join(per_blob, "__blob", "left_anti").select(*columns)
        clean = kept if clean is None else clean.unionByName(kept)
        if per_blob.isEmpty():
            return clean
        changed = addressed.join(per_blob, "__blob").select(*columns, "__found")
        docs = C.written(C.map_slices(changed, text, blank, docs.schema), "redacted")
        if docs.isEmpty():
            return clean
