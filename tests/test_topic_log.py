"""The topic log: offsets, starts, patterns, restarts, and batches that are written more than once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chainflow.operators import routing
from chainflow.sources import decode, topic_log
from chainflow.streaming import jobs

ROWS = "topic string, partition int, timestamp timestamp, key string, value string"


def messages(spark, topic, first, n, partition=0):
    return spark.range(first, first + n, 1, 1).select(
        F.lit(topic).alias("topic"), F.lit(partition).alias("partition"), F.timestamp_seconds(F.col("id")).alias("timestamp"),
        F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), F.col("id")).alias("value"))


def read(spark, path, **options):
    df = decode.read_topic(spark, {"path": path, **options}, fmt="topiclog")
    return sorted((r.topic, r.partition, r.offset, r.value) for r in
                  df.select("topic", "partition", "offset", F.col("value").cast("string")).collect())


def test_offsets_ranges_and_starts(spark, scratch, monkeypatch):
    monkeypatch.setattr(topic_log, "STEP", 16)
    path = os.path.join(scratch, "log")
    for first in (0, 50, 60):
        routing.write_sink(messages(spark, "a.b.x", first, 50 if first != 50 else 10), path, "topiclog")
    routing.write_sink(messages(spark, "a.c", 5, 3, partition=2), path, "topiclog")
    rows = read(spark, path)
    assert [(t, p, o) for t, p, o, _ in rows] == [("a.b.x", 0, i) for i in range(110)] + [("a.c", 2, i) for i in range(3)]
    assert [v for _, _, _, v in rows][:110] == [f"v{i}" for i in range(110)]
    assert read(spark, path, subscribe="a.c, none") == rows[110:]
    assert read(spark, path, subscribePattern="a.*.*", maxRows="7") == rows[:110]
    assert read(spark, path, subscribePattern="a.*") == rows[110:]
    assert read(spark, path, startingOffsets="latest") == []
    assert read(spark, path, startingOffsets=json.dumps({"a.b.x": {"0": 57}}), subscribe="a.b.x") == rows[57:110]
    for since in (0, 1, 31, 32, 49, 50, 75, 109, 110, 500):  # every block border; times are the ids
        assert read(spark, path, subscribe="a.b.x", startingTimestamp=str(since * 1000)) == rows[min(since, 110):110]
    assert read(spark, os.path.join(scratch, "nothing")) == []


def test_missing_partitions_and_bad_topics(spark, scratch):
    path = os.path.join(scratch, "log")
    df = spark.createDataFrame([("t", "k1", "1"), ("t", "k1", "2"), ("t", None, "3"), ("t", "k2", None)],
                               "topic string, key string, value string").coalesce(1)
    routing.write_sink(df, path, "topiclog", partitions="8")
    rows = read(spark, path)
    assert sorted(v for *_, v in rows if v) == ["1", "2", "3"] and len(rows) == 4
    assert len({p for _, p, _, v in rows if v in ("1", "2")}) == 1
    for topic in ("", "_commits", "x/y"):
        with pytest.raises(Exception, match="not a topic"):
            routing.write_sink(df.withColumn("topic", F.lit(topic)), path, "topiclog")
    assert read(spark, path) == rows  # a failed write leaves nothing behind


def test_a_batch_is_taken_once(spark, scratch):
    path = os.path.join(scratch, "log")
    for batch in ("0", "0", "1", "0", "1"):
        routing.write_sink(messages(spark, "t", 10 * int(batch), 10), path, "topiclog", writer="w", batch=batch)
    routing.write_sink(messages(spark, "t", 20, 10), path, "topiclog", writer="other", batch="0")
    rows = read(spark, path)
    assert [o for _, _, o, _ in rows] == list(range(30)) and [v for *_, v in rows] == [f"v{i}" for i in range(30)]
    named = {s["file"] for parts in topic_log.Log(path).segments.values() for ss in parts.values() for s in ss}
    files = {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    assert files == named  # repeated batches leave no files


def test_commits_of_two_writers_and_whole_lists(spark, scratch, monkeypatch):
    monkeypatch.setattr(topic_log, "FULL", 4)
    path = os.path.join(scratch, "log")
    os.makedirs(path)
    log = topic_log.Log(path)
    one = {"topic": "t", "partition": 0, "file": "x", "rows": 5, "times": [1]}
    assert topic_log.commit(path, [one], "a", 0)
    with pytest.raises(FileExistsError):
        log.publish([one], "b", 0)  # it read the log before a's commit
    for i in range(9):
        assert topic_log.commit(path, [one | {"file": f"y{i}"}], "b", i)
        assert not topic_log.commit(path, [one], "a", 0)
    segments = topic_log.Log(path).segments["t"]["0"]
    assert [s["offset"] for s in segments] == list(range(0, 50, 5)) and [s["file"] for s in segments][0] == "x"


def test_stream_restarts_at_its_offsets_and_picks_up_new_topics(spark, scratch):
    path, sink, checkpoint = (os.path.join(scratch, x) for x in ("log", "sink", "ckpt"))
    routing.write_sink(messages(spark, "a.one", 0, 5), path, "topiclog")

    def run():
        stream = decode.read_topic(spark, {"path": path, "subscribePattern": "a.*"}, stream=True, replay=True, fmt="topiclog")
        jobs.run_available_now(stream, sink, checkpoint)
        return sorted((r.topic, r.offset) for r in spark.read.parquet(sink).collect())

    assert run() == [("a.one", i) for i in range(5)]
    routing.write_sink(messages(spark, "a.one", 5, 2), path, "topiclog")
    routing.write_sink(messages(spark, "a.two", 0, 3), path, "topiclog")
    routing.write_sink(messages(spark, "b.two", 0, 3), path, "topiclog")
    assert run() == [("a.one", i) for i in range(7)] + [("a.two", i) for i in range(3)]
    assert run() == [("a.one", i) for i in range(7)] + [("a.two", i) for i in range(3)]


def test_stream_to_log_leaves_each_message_once(spark, scratch):
    """The query's note of its last batch is lost: the batch is written again, and not added again."""
    source, target, checkpoint = (os.path.join(scratch, x) for x in ("in", "out", "ckpt"))
    routing.write_sink(messages(spark, "t", 0, 20), source, "topiclog")

    def run():
        stream = decode.read_topic(spark, {"path": source}, stream=True, replay=True, fmt="topiclog")
        q = routing.write_sink_stream(stream, target, checkpoint, "copy").trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    first = read(spark, target)
    assert [v for *_, v in first] == [f"v{i}" for i in range(20)]
    noted = os.path.join(checkpoint, "commits")
    for f in os.listdir(noted):
        os.unlink(os.path.join(noted, f))
    run()
    assert read(spark, target) == first
    routing.write_sink(messages(spark, "t", 20, 4), source, "topiclog")
    run()
    assert [v for *_, v in read(spark, target)] == [f"v{i}" for i in range(24)]
