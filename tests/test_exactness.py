"""Nothing is dropped or rounded: wide amounts, small prices, damaged documents, long gaps."""

import json
from decimal import Decimal, localcontext

from pyspark.sql import functions as F

from chainflow import schemas as S
from chainflow.functions import scalar as C
from chainflow.operators import dedup as D
from chainflow.operators import metrics as M
from chainflow.operators import timeline as W
from chainflow.sources import decode
from chainflow.streaming import jobs


def usd(spark, transfers, prices):
    t = spark.createDataFrame([(0, a, v) for a, v in transfers], "blockTimestamp long, tokenAddress string, value string")
    p = spark.createDataFrame(prices, "address string, decimals int, price double")
    return M.value_transferred_usd(t, p).first()


def test_usd_keeps_every_digit(spark):
    assert usd(spark, [("a", "1" + "0" * 40)], [("a", 18, 1.0)]).value_transferred_usd == "1" + "0" * 22
    assert usd(spark, [("a", "5")], [("a", 0, 0.001)]).value_transferred_usd == "0.005"
    assert usd(spark, [("a", "1" + "0" * 24)], [("a", 24, 2.0)]).value_transferred_usd == "2"
    wide = str(2 ** 256 - 1)
    got = usd(spark, [("a", wide)] * 3 + [("b", "7"), ("c", "9"), ("a", "x"), ("a", None)],
              [("a", 77, 123456789.125), ("b", 1, 1e-17), ("d", 5, 1.0)])
    with localcontext() as ctx:
        ctx.prec = 300
        want = (Decimal(3 * int(wide)).scaleb(-77) * Decimal("123456789.125")
                + Decimal(7).scaleb(-1) * Decimal("1e-17"))
        assert Decimal(got.value_transferred_usd) == want
    assert (got.tokens, got.unpriced_tokens, got.bad_amounts) == (2, 1, 2)


def test_bridges_of_every_asset_count(spark):
    df = spark.createDataFrame([("A", "B", "x", "5"), ("B", "C", "y", "7")],
                               "sourceChain string, destChain string, asset string, amount string")
    assert tuple(M.bridge(df, "x").first()) == (2, 2, "5")


def test_damaged_pages_are_flagged(spark):
    good = json.dumps({"blockchains": [{"blockchainId": "b", "vmId": "v", "subnetId": "s"}], "nextPageToken": "t2"})
    bad = json.dumps({"validators": [{"nodeId": "n", "startTime": "soon"}]})
    docs = spark.createDataFrame([(good,), ("{broken",)], "value string")
    got = decode.decode_pages(docs, S.BLOCKCHAIN, "blockchains").collect()
    assert sorted((r.is_corrupt, r.blockchainId, r.corrupt_value) for r in got if not r.is_corrupt) == [(False, "b", None)]
    assert [r.corrupt_value for r in got if r.is_corrupt] == ["{broken"]
    mistyped = decode.decode_pages(spark.createDataFrame([(bad,)], "value string"), S.VALIDATOR, "validators").collect()
    assert [(r.is_corrupt, r.nodeId) for r in mistyped] == [(True, None)]
    single = decode.decode_single(spark.createDataFrame([("[",), (json.dumps({"validator": {"nodeId": "n"}}),)],
                                                        "value string"), S.VALIDATOR, "validator")
    assert sorted((r.is_corrupt, r.nodeId) for r in single.collect()) == [(False, "n"), (True, None)]
    assert decode.good_items(single).count() == 1


def test_missing_page_is_found(spark):
    page = lambda t: json.dumps({"blocks": [], "nextPageToken": t})
    docs = spark.createDataFrame([(None, page("p2")), ("p2", page("p3")), ("p4", page(""))],
                                 "pageToken string, value string")
    assert [r.pageToken for r in decode.missing_pages(docs).collect()] == ["p3"]


def test_long_gaps(spark):
    rows = [("0", "1", "h1", "h0"), ("0", str(3_000_000_002), "h2", "x"), ("0", str(3_000_000_003), "h3", "wrong")]
    df = spark.createDataFrame(rows, "chainId string, blockNumber string, blockHash string, parentHash string")
    assert [(r.fromBlock, r.toBlock) for r in W.chain_continuity(df, ranges=True).collect()] == [(2, 3_000_000_001)]
    short = df.withColumn("blockNumber", F.when(F.col("blockNumber") != "1", F.col("blockNumber") - 2_999_740_000)
                          .otherwise(1).cast("bigint").cast("string"))
    got = W.chain_continuity(short)
    assert got.filter("kind = 'missing'").agg(F.count("*"), F.min("blockNumber"), F.max("blockNumber"),
                                              F.count_distinct("blockNumber")).first() == (260_000, 2, 260_001, 260_000)
    assert [r.blockNumber for r in got.filter("kind = 'parent_mismatch'").collect()] == [260_003]


def test_hex_to_63_bits(spark):
    for text, want in [("0x7fffffffffffffff", 2 ** 63 - 1), ("0x8000000000000000", None), ("0x0", 0), ("0x", None),
                       ("0x00000000000000000001f", 31), ("0XFF", 255), ("ff", None), (None, None)]:
        assert spark.createDataFrame([(text,)], "x string").select(C.hex_quantity("x")).first()[0] == want


def test_chain_table_on_a_uri_keeps_every_chain(spark, scratch):
    table = f"file://{scratch}/chains"
    assert jobs.latest_chain_table(spark, table) is None
    step = jobs.dynamic_chains_batch(table, ["0"])
    for i, chain in enumerate(["7", "8", "9"]):
        step(spark.createDataFrame([("chain.created", chain), ("block.created", "5")], "event_type string, chainId string"), i)
    step(spark.createDataFrame([("chain.created", "9")], "event_type string, chainId string"), 2)  # a retried batch
    assert sorted(r.chainId for r in jobs.latest_chain_table(spark, table).collect()) == ["0", "7", "8", "9"]


def test_suppression_of_a_long_key_in_bounded_memory(spark):
    """One key with many sightings over many batches, and many short keys, against a plain fold."""
    hot = spark.range(60_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 60_000).alias("t"))
    many = spark.range(3_000).select((F.col("id") % 700).cast("string").alias("k"), (F.col("id") * 31 % 997).alias("t"))
    rows = hot.union(many).union(spark.createDataFrame([(None, 5), (None, 6), (None, 99)], "k string, t long"))
    got = sorted(map(str, map(tuple, D.suppress_recent(rows, ["k"], "t", 30).collect())))
    want, last = [], {}
    for k, t in sorted(((r.k, r.t) for r in rows.collect()), key=lambda x: x[1]):
        if k not in last or t - last[k] >= 30:
            want.append((k, t))
            last[k] = t
    assert got == sorted(map(str, want))
