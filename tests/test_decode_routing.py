"""Decoder quarantine rules and the topic map."""

import hashlib
import hmac

from chainflow.operators import routing as K
from chainflow.sources import decode
from chainflow.sources.fixtures import EVENT_TYPES, UNKNOWN_EVENT_TYPE


def _sig(body, secret="s"):
    return "sha256=" + hmac.new(secret.encode(), body.encode(), hashlib.sha256).hexdigest()


def test_webhook_quarantine_and_signatures(spark):
    good = '{"messageId":"m1","event":{"transaction":{"txHash":"0xa","transactionIndex":3}}}'
    mistyped = '{"messageId":"m2","event":{"transaction":{"txHash":"0xb","transactionIndex":"abc"}}}'
    broken = '{"messageId":"m3","event":{"transa'
    rows = [(1, good, _sig(good), None, None), (2, mistyped, None, _sig(mistyped), None),
            (3, broken, None, None, None), (4, good, None, None, _sig(good, "other"))]
    raw = spark.createDataFrame(rows, "deliveryKey int, body string, sigPrimary string, sigAlt string, sigHub string")
    out = {r.deliveryKey: r for r in decode.decode_webhook(raw, "s").collect()}
    assert (out[1].is_corrupt, out[1].signature_valid, out[1].messageId) == (False, True, "m1")
    assert out[1].event.transaction.transactionIndex == 3
    assert (out[2].is_corrupt, out[2].signature_valid) == (True, True)   # type mismatch quarantines
    assert out[2].messageId is None
    assert (out[3].is_corrupt, out[3].signature_valid) == (True, False)  # missing signature
    assert (out[4].is_corrupt, out[4].signature_valid) == (False, False)  # wrong secret
    good_rows, bad_rows = decode.split_corrupt(decode.decode_webhook(raw, "s"))
    assert good_rows.count() == 2 and bad_rows.count() == 2


def test_newheads_filter_drops_confirmations_and_empty_hash(spark):
    frames = [('{"jsonrpc":"2.0","id":1,"result":"0xsub"}',),
              ('{"jsonrpc":"2.0","method":"eth_subscription","params":{"subscription":"0xsub",'
               '"result":{"hash":"0xh","parentHash":"0xp","number":"0x1b4"}}}',),
              ('{"jsonrpc":"2.0","method":"eth_subscription","params":{"subscription":"0xsub",'
               '"result":{"hash":"","parentHash":"0xp","number":"0x1b5"}}}',),
              ('{"jsonrpc":',)]
    df = spark.createDataFrame(frames, "frame string")
    decoded = decode.decode_newheads(df)
    heads = decode.newheads_filter(decoded).collect()
    assert [(r.hash, r.blockNumber) for r in heads] == [("0xh", 436)]
    assert [r.subscription for r in decode.newheads_confirmations(decoded).collect()] == ["0xsub"]
    assert decoded.filter("is_corrupt").count() == 1


def test_topic_map_and_fallback(spark):
    cfg = K.TopicConfig(names={"subnets": "", "metrics.gas": ""})
    tm = {r.event_type: r.topic for r in K.topic_map(spark, cfg).collect()}
    assert len(tm) == len(EVENT_TYPES) == 28 and UNKNOWN_EVENT_TYPE not in tm
    assert tm["metrics.gas.updated"] == "chain.metrics"            # empty family topic falls back
    assert tm["metrics.activity.updated"] == "chain.metrics.activity"
    assert tm["subnet.created"] == ""                               # dropped later by K03
    assert tm["internal_tx.created"] == "chain.internal"
    events = spark.createDataFrame([("subnet.created",), ("block.created",), (UNKNOWN_EVENT_TYPE,)],
                                   "event_type string")
    routed = K.route_events(events, K.topic_map(spark, cfg)).collect()
    assert [(r.event_type, r.topic) for r in routed] == [("block.created", "chain.blocks")]
