"""Decoders for wire inputs (S18-S21) and landed REST pages.

Each decoder takes a DataFrame with a text column (from ``spark.read.text``,
a file stream, or the Kafka source's ``value``) and returns typed rows.
Undecodable rows are kept apart, never silently dropped (F04).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainflow import schemas as S
from chainflow.functions import scalar as C
from chainflow.sources import topic_log


def split_corrupt(decoded: DataFrame, flag: str = "is_corrupt", parsed: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) by the decoder's corruption flag.

    ``parsed`` names columns of the same parse as the flag: the good rows' text is then parsed once,
    not for the filter and for the columns.
    """
    good = decoded
    if parsed:
        alone = decoded.select(*(c for c in decoded.columns if c not in (*parsed, flag)), F.col(flag).alias("_flag"),
                               *(F.col(c).alias(f"_{c}") for c in parsed))
        good = C.once(alone, **{flag: F.col("_flag")}, **{c: F.col(f"_{c}") for c in parsed}).select(*decoded.columns)
    return good.filter(~F.col(flag)).drop(flag), decoded.filter(F.col(flag))


#: The columns that ``decode_webhook`` parses from the body.
ENVELOPE = ("webhookId", "eventType", "messageId", "event")


def decode_webhook(raw: DataFrame, secret: str | None, body: str = "body",
                   headers=("sigPrimary", "sigAlt", "sigHub")) -> DataFrame:
    """Webhook deliveries -> envelopes + ``signature_valid`` + ``is_corrupt``.

    Signatures are checked when a secret is configured; as in the reference, a
    bad or missing one only flags the row (``signature_gate`` filters).
    Malformed JSON sets ``is_corrupt``; the envelope stays NULL.
    """
    sig = C.signature_header(*headers)
    valid = C.signature_valid(body, sig, secret) if secret else F.lit(True)
    parsed = raw.select(
        "*",
        _parse_with_corrupt(F.col(body), S.WEBHOOK_ENVELOPE).alias("envelope"),
        sig.alias("signature"),
        valid.alias("signature_valid"))
    return _split_parsed(parsed, "envelope")


CORRUPT = "_corrupt_record"


def _parse_with_corrupt(text, struct_type: str):
    """One JSON parse that also reports undecodable input.

    PERMISSIVE ``from_json`` fills ``_corrupt_record`` with the raw text when
    the document is malformed or a field has the wrong type, so no second
    parse is needed to detect it.
    """
    schema = struct_type[:-1] + f",{CORRUPT}:string>"
    return F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _split_parsed(df: DataFrame, col: str) -> DataFrame:
    """Flatten the parsed struct and turn its corrupt-record field into a flag.

    A corrupt row keeps NULL fields (as a failed decode in the reference).
    """
    fields = [f for f in df.schema[col].dataType.fieldNames() if f != CORRUPT]
    bad = F.col(f"{col}.{CORRUPT}").isNotNull()
    return df.select(*[c for c in df.columns if c != col],
                     *[F.when(~bad, F.col(f"{col}.{f}")).alias(f) for f in fields],
                     bad.alias("is_corrupt"))


def decode_newheads(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """``newHeads`` socket frames -> typed frames + ``is_corrupt``."""
    parsed = frames.select("*", _parse_with_corrupt(F.col(frame), S.NEWHEADS_FRAME).alias("_m"))
    bad = F.col(f"_m.{CORRUPT}").isNotNull()
    return parsed.select(*frames.columns, F.when(~bad, F.col("_m").dropFields(CORRUPT)).alias("msg"),
                         bad.alias("is_corrupt"))


def newheads_filter(decoded: DataFrame) -> DataFrame:
    """Keep head notifications with a hash; drop confirmations (F02) -> head rows."""
    heads = decoded.filter(~F.col("is_corrupt")
                           & (F.col("msg.method") == "eth_subscription")
                           & F.col("msg.params").isNotNull()
                           & (F.coalesce(F.col("msg.params.result.hash"), F.lit("")) != ""))
    return heads.select(
        *[c for c in decoded.columns if c not in ("msg", "is_corrupt")],
        F.col("msg.params.subscription").alias("subscription"),
        F.col("msg.params.result.hash").alias("hash"),
        F.col("msg.params.result.parentHash").alias("parentHash"),
        F.col("msg.params.result.number").alias("number"),
        C.hex_quantity(F.col("msg.params.result.number")).alias("blockNumber"))


def newheads_confirmations(decoded: DataFrame) -> DataFrame:
    """Subscription confirmations (``id`` + ``result``) -> subscription ids."""
    return decoded.filter(~F.col("is_corrupt") & F.col("msg.id").isNotNull()
                          & (F.coalesce(F.col("msg.result"), F.lit("")) != "")) \
        .select("*", F.col("msg.result").alias("subscription")).drop("msg", "is_corrupt")


def decode_pages(docs: DataFrame, entity: str, array_field: str, value: str = "value") -> DataFrame:
    """Landed REST pages -> one row per item + ``is_corrupt`` + ``corrupt_value``.

    The page envelope is unwrapped and its result array exploded.  A malformed
    document, or one with a field of the wrong type, is one row of NULL fields
    with its text in ``corrupt_value``; ``good_items`` leaves those out.
    """
    parsed = docs.select(F.col(value).alias("_text"),
                         _parse_with_corrupt(F.col(value), S.page(entity, array_field)).alias("_p"))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    items = F.when(bad, F.array(F.lit(None).cast(entity))).otherwise(F.col(f"_p.{array_field}"))
    return parsed.select(F.explode(items).alias("item"), bad.alias("is_corrupt"),
                         F.when(bad, F.col("_text")).alias("corrupt_value")) \
        .select("item.*", "is_corrupt", "corrupt_value")


def decode_single(docs: DataFrame, entity: str, wrapper: str | None = None,
                  value: str = "value") -> DataFrame:
    """Single-object responses, optionally wrapped (``{"validator": {...}}``),
    + ``is_corrupt`` + ``corrupt_value`` as ``decode_pages``."""
    schema = f"struct<{wrapper}:{entity}>" if wrapper else entity
    parsed = docs.select(F.col(value).alias("_text"), _parse_with_corrupt(F.col(value), schema).alias("_p"))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    item = F.col(f"_p.{wrapper}") if wrapper else F.col("_p").dropFields(CORRUPT)
    return parsed.select(F.when(~bad, item).alias("item"), bad.alias("is_corrupt"),
                         F.when(bad, F.col("_text")).alias("corrupt_value")) \
        .select("item.*", "is_corrupt", "corrupt_value")


def good_items(decoded: DataFrame) -> DataFrame:
    """The decoded items without the corrupt documents' rows."""
    return decoded.filter(~F.col("is_corrupt")).drop("is_corrupt", "corrupt_value")


def missing_pages(docs: DataFrame, token: str = "pageToken", value: str = "value") -> DataFrame:
    """Tokens that a landed page names as the next one but that no document was landed for.

    ``docs`` has the token each document was asked for (NULL for the first page).
    """
    following = F.get_json_object(F.col(value), "$.nextPageToken")
    named = docs.select(following.alias(token)).filter(F.coalesce(F.col(token), F.lit("")) != "").distinct()
    return named.join(docs.select(token).filter(F.col(token).isNotNull()).distinct(), token, "left_anti")


def read_pages(spark: SparkSession, path: str, entity: str, array_field: str) -> DataFrame:
    """Reader over landed page documents (one JSON document per line)."""
    return decode_pages(spark.read.text(path), entity, array_field)


def read_topic(spark: SparkSession, options: dict, stream: bool = False,
               replay_from_ms: int | None = None, replay: bool = False, fmt: str = "kafka"):
    """Topic source (S20): a topic log on shared storage (``fmt="topiclog"``, option ``path``) or Kafka, where its connector is present.

    A stream starts at the latest offsets, as the reference's consumer; per-group offsets
    become the streaming checkpoint.  ``subscribePattern`` carries wildcard
    topics (S21).  Replay (T14) starts from the earliest offsets, or from a
    timestamp (``startingTimestamp``, milliseconds) when given.
    """
    if fmt == topic_log.FORMAT:
        topic_log.register(spark)
    reader = spark.readStream if stream else spark.read
    opts = {"startingOffsets": "latest"} if stream else {}
    if replay:
        opts["startingOffsets"] = "earliest"
    if replay_from_ms is not None:
        opts.pop("startingOffsets", None)
        opts["startingTimestamp"] = str(replay_from_ms)
    opts.update(options)
    return reader.format(fmt).options(**opts).load()


def topic_matches(topic_col, pattern: str):
    """Topic-name match with one ``*`` = one dot-free segment."""
    return F.col(topic_col).rlike(C.wildcard_regex(pattern)) if isinstance(topic_col, str) \
        else topic_col.rlike(C.wildcard_regex(pattern))
