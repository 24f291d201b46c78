"""Routing to topics (K01-K25): event type -> topic, payload encoding, sinks.

The topic map is a small configuration table (one row per event type); the
join to it is planned by Spark (broadcast while under the size threshold).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainflow.sources import topic_log
from chainflow.sources.fixtures import EVENT_TYPES


@dataclass
class TopicConfig:
    """Topic names per entity; an empty family topic falls back to ``metrics``."""
    prefix: str = "chain"
    names: dict = field(default_factory=dict)

    def topic(self, entity: str) -> str:
        return self.names.get(entity, f"{self.prefix}.{entity}")


# Which entity topic each declared event type is routed to.
# token.* events go to the default metrics topic; internal_tx.created gets
# the internal-transactions topic.
EVENT_ENTITY = {
    "block.created": "blocks", "block.updated": "blocks",
    "chain.created": "chains", "chain.updated": "chains",
    "transaction.created": "transactions", "transaction.updated": "transactions",
    "erc20.transfer": "erc20", "erc721.transfer": "erc721", "erc1155.transfer": "erc1155",
    "log.created": "logs",
    "internal_tx.created": "internal",
    "validator.created": "validators", "validator.updated": "validators",
    "delegator.created": "delegators", "delegator.updated": "delegators",
    "subnet.created": "subnets", "subnet.updated": "subnets",
    "blockchain.created": "blockchains", "blockchain.updated": "blockchains",
    "teleporter.created": "bridges", "teleporter.updated": "bridges",
    "token.created": "metrics", "token.updated": "metrics",
    "metrics.updated": "metrics",
    "metrics.activity.updated": "metrics.activity",
    "metrics.performance.updated": "metrics.performance",
    "metrics.gas.updated": "metrics.gas",
    "metrics.cumulative.updated": "metrics.cumulative",
}
METRIC_FAMILIES = ("metrics.activity", "metrics.performance", "metrics.gas", "metrics.cumulative")

# Metric name -> family topic (others go to the default topic).
METRIC_FAMILY_OF = {
    "activeAddresses": "metrics.activity", "txCount": "metrics.activity",
    "avgTps": "metrics.performance",
    "avgGasPrice": "metrics.gas", "feesPaid": "metrics.gas",
}


def topic_rows(cfg: TopicConfig) -> list[tuple[str, str, str]]:
    """(event_type, configured topic, fallback topic) for all 28 event types."""
    rows = []
    for et in EVENT_TYPES:
        ent = EVENT_ENTITY[et]
        fallback = cfg.topic("metrics") if ent in METRIC_FAMILIES else ""
        rows.append((et, cfg.topic(ent), fallback))
    return rows


def topic_map(spark: SparkSession, cfg: TopicConfig) -> DataFrame:
    """event_type -> topic with the metric-family fallback applied."""
    df = spark.createDataFrame(topic_rows(cfg), "event_type string, configured string, fallback string")
    return df.select("event_type", metric_topic_fallback(F.col("configured"), F.col("fallback")).alias("topic"))


def metric_topic_fallback(family_topic, default_topic):
    """``coalesce(nullif(family, ''), default)``."""
    return F.coalesce(F.nullif(family_topic, F.lit("")), default_topic)


def route_events(events: DataFrame, topics: DataFrame) -> DataFrame:
    """Event -> its topic; unmapped types and empty topics drop."""
    return drop_empty_topic(events.join(topics, "event_type", "inner"))


def drop_empty_topic(df: DataFrame, topic: str = "topic") -> DataFrame:
    """A message without a topic is discarded."""
    return df.filter(F.coalesce(F.col(topic), F.lit("")) != "")


def empty_topic_rejects(df: DataFrame, topic: str = "topic") -> DataFrame:
    """The messages K03 discards, for counting or auditing (the complement filter)."""
    return df.filter(F.coalesce(F.col(topic), F.lit("")) == "")


def encode_payload(df: DataFrame, cols: list[str] | None = None, key: str | None = "chainId",
                   topic: str = "topic") -> DataFrame:
    """Kafka-shaped rows ``(topic, key, value)``; value = JSON of the entity
    without any type tag (K02)."""
    cols = cols or [c for c in df.columns if c != topic]
    value = F.to_json(F.struct(*[F.col(c) for c in cols]))
    k = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.col(topic), k.alias("key"), value.alias("value"))


def events_by_topic(routed: DataFrame) -> DataFrame:
    """Count of routed events per topic."""
    return routed.groupBy("topic").agg(F.count("*").alias("events"))


def route_metric_long(long_rows: DataFrame, cfg: TopicConfig, metric: str = "metric") -> DataFrame:
    """Metric name -> family topic, else the default metrics topic."""
    m = F.col(metric)
    fam = F.lit(cfg.topic("metrics"))
    for name, family in METRIC_FAMILY_OF.items():
        fam = F.when(m == name, metric_topic_fallback(F.lit(cfg.topic(family)),
                                                      F.lit(cfg.topic("metrics")))).otherwise(fam)
    return long_rows.withColumn("topic", fam)


def write_sink(df: DataFrame, path: str, fmt: str = "parquet", **options):
    """Batch sink: a topic log (``fmt="topiclog"``), Kafka with its options, else files partitioned by topic.

    With the options ``writer`` and ``batch`` a topic log takes a batch once, however often it is sent.
    """
    if fmt in ("kafka", topic_log.FORMAT):
        if fmt == topic_log.FORMAT:
            topic_log.register(df.sparkSession)
            options["path"] = path
        return _messages(df).write.format(fmt).mode("append").options(**options).save()
    return df.write.mode("append").partitionBy("topic").format(fmt).save(path)


def write_sink_stream(df: DataFrame, path: str, checkpoint: str, writer: str, **options):
    """Streaming sink into a topic log (K01-K25): each message once, also where a batch is repeated after a failure.

    ``writer`` names the stream in the log; keep it with the checkpoint.
    """
    topic_log.register(df.sparkSession)
    return (_messages(df).writeStream.format(topic_log.FORMAT).outputMode("append").option("checkpointLocation", checkpoint)
            .options(path=path, writer=writer, **options))


def _messages(df: DataFrame) -> DataFrame:
    more = [c for c in ("partition", "timestamp") if c in df.columns]
    return df.select("topic", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), *more)
