"""Registered queries of the subpackage against their DuckDB text, or a plain version."""

import math
import zlib

import duckdb
import numpy as np
import plain
import pytest

import corpus_pipeline
from chainflow.llm import common, quality
from chainflow.llm.queries import ORACLES, QUERIES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_one_query_of_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    res = con.execute(ORACLES[key])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, res.fetchall())


def check_packing(rows, texts):
    """Pieces cover each document's ids; sequences are gapless; the count is near its bound."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: tok.encode(t or "", add_special_tokens=False).ids + [2] for k, t in texts}
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for key, own in pieces.items():
        at = 0
        for i, r in enumerate(sorted(own, key=lambda r: r.piece)):
            part = ids[key][at:at + r.length]
            assert (r.piece, r.start) == (i, at) and (i == 0 or r.length == 1024)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(ids[key])
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    return len(places), math.ceil(sum(map(len, ids.values())) / 1024)


def test_packing_query(spark, con):
    rows = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    used, bound = check_packing(rows, con.execute("SELECT doc_id, text FROM documents").fetchall())
    assert used <= 1.02 * bound + 1


def test_sharding_query(spark, con):
    rows = QUERIES["op5_sharding"](spark, SF).collect()
    texts = dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, ())) for i in range(16)]
    assert max(counts) - min(counts) <= 1


def held_out(con, parts, rest):
    return {k for (k,) in con.execute("SELECT doc_id FROM documents").fetchall()
            if zlib.crc32(str(k).encode()) % parts == rest}


def test_quality_query(spark, con):
    big = "/root/testdata/sf0.01"
    rows = QUERIES["op8_quality_classifier"](spark, big).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{big}/labels.parquet'").fetchall())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    known = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in known) >= 0.95 * len(known)


def test_language_query(spark, con):
    rows = QUERIES["op10_language_id"](spark, SF).collect()
    langs = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    assert {r.doc_id for r in rows if r.held_out} == held_out(con, 4, 2)
    known = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in known) >= 0.97 * len(known)
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline(spark, con):
    """The pipeline against its stages done plainly on what each stage gets."""
    docs = common.read(spark, SF, "documents")
    columns = docs.columns
    labels = common.read(spark, SF, "labels")
    good = quality.score(docs, quality.train(docs, labels)).where("score >= 0.3").select(*columns)
    rows = [r.asDict() for r in good.collect()]
    kept = {r["doc_id"] for r, (_, _, c) in
            zip(rows, plain.components([(r["doc_id"], r["text"]) for r in rows])) if r["doc_id"] == c}
    rows = [r for r in rows if r["doc_id"] in kept]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    rows = [r for r in rows if not plain.contamination(r["text"], items)[1]]
    texts = []
    for r in rows:
        text, end, parts = r["text"], 0, []
        for _, s, e in plain.secrets(text):
            if s >= end:
                parts += [text[end:s], "<SECRET>"]
            end = max(end, e)
        texts.append((r["doc_id"], "".join([*parts, text[end:]])))
    used, bound = check_packing(corpus_pipeline.run(spark, SF).collect(), texts)
    assert used <= 1.02 * bound + 1
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_stage_columns(spark):
    docs = common.read(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SF), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.where("n_chars <> length(text)").isEmpty()
