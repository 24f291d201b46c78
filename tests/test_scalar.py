"""Scalar functions against Python references on literal edge cases."""

import hashlib
import hmac

from pyspark.sql import functions as F

from chainflow.functions import scalar as C


def test_hmac_matches_python(spark):
    secret = "s3cr3t-" * 12  # longer than a block: key is hashed first
    bodies = ['{"a":1}', "", "ünïcödé body", "x" * 1000]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = [r[0] for r in df.select(C.hmac_sha256_hex("body", secret)).collect()]
    want = [hmac.new(secret.encode(), b.encode(), hashlib.sha256).hexdigest() for b in bodies]
    assert got == want
    short = [r[0] for r in df.select(C.hmac_sha256_hex("body", "k")).collect()]
    assert short == [hmac.new(b"k", b.encode(), hashlib.sha256).hexdigest() for b in bodies]


def test_signature_valid_and_header(spark):
    body = '{"x":2}'
    good = "sha256=" + hmac.new(b"sec", body.encode(), hashlib.sha256).hexdigest()
    df = spark.createDataFrame([(body, "", good, None), (body, None, "", None), (body, "bad", good, None)],
                               "body string, h1 string, h2 string, h3 string")
    out = df.select(C.signature_valid("body", C.signature_header("h1", "h2", "h3"), "sec").alias("v"))
    assert [r.v for r in out.collect()] == [True, False, False]


def test_uint256_sum_exact(spark):
    vals = [str(2 ** 256 - 1), str(2 ** 255), "5", "0", "not-a-number"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = df.agg(C.uint256_sum("v").alias("s")).first().s
    assert got == str(2 ** 256 - 1 + 2 ** 255 + 5)
    assert df.filter("v = '0'").agg(C.uint256_sum("v").alias("s")).first().s == "0"


def test_value_with_decimals(spark):
    cases = [("1500000000000000000", 18, "1.5"), ("5", 18, "0.000000000000000005"),
             ("1000", 3, "1"), ("123", 0, "123"), ("0", 6, "0"), ("120", 1, "12")]
    df = spark.createDataFrame(cases, "v string, d int, want string")
    got = df.select(C.value_with_decimals("v", F.col("d")).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_go_duration_and_hex(spark):
    df = spark.createDataFrame([(1800,), (3600,), (90,), (45,), (0,), (3725,)], "s long")
    assert [r[0] for r in df.select(C.go_duration("s")).collect()] == \
        ["30m0s", "1h0m0s", "1m30s", "45s", "0s", "1h2m5s"]
    h = spark.createDataFrame([("0x1b4",), ("0x0",), ("zz",)], "x string")
    assert [r[0] for r in h.select(C.hex_quantity("x")).collect()] == [436, 0, None]


def test_wildcard_and_topic_parts(spark):
    rx = C.wildcard_regex("chain.logs.*")
    df = spark.createDataFrame([("chain.logs.1",), ("chain.logs",), ("chain.logs.1.x",), ("chain.blocks.1",)],
                               "t string")
    assert [r[0] for r in df.select(F.col("t").rlike(rx)).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(C.topic_part("t", 3)).collect()] == ["1", None, "1", "1"]


def test_tx_participants(spark):
    df = spark.createDataFrame(
        [("0xA", "0xb", [("0xC", "0xb")], [("0xd",)])],
        "`from` string, `to` string, erc20Transfers array<struct<`from`:string,`to`:string>>, "
        "logs array<struct<address:string>>")
    df = df.withColumn("erc721Transfers", F.array().cast("array<struct<`from`:string,`to`:string>>")) \
        .withColumn("erc1155Transfers", F.lit(None).cast("array<struct<`from`:string,`to`:string>>")) \
        .withColumn("internalTransactions", F.array().cast("array<struct<`from`:string,`to`:string>>"))
    got = df.select(F.array_sort(C.tx_participants())).first()[0]
    assert got == ["0xa", "0xb", "0xc", "0xd"]
