"""Periodic runs, collocations and SimHash trees against brute force, and their edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import plain
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from chainflow.llm import collocations, periodic_runs, simhash_trees
from chainflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- periodic runs

def plain_runs(words, least=6, exponent=4):
    numbers, found = {}, {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    for q in range(1, len(a) // exponent + 1):
        steps = np.diff(np.concatenate(([0], a[q:] == a[:-q], [0])))
        for start, end in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist()):
            if end - start + q >= max(least, exponent * q):
                found.setdefault((start, end - start + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = np.zeros(len(words), bool)
    for s, n, q in runs:
        gone[s + q:s + n] = True
    return " ".join(w for w, out in zip(words, gone.tolist()) if not out)


def test_runs_match_brute_force_on_repetitive_texts():
    rng = random.Random(11)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            letters = "abcde"[:rng.choice([1, 2, 3, 5])]
            t = []
            for _ in range(rng.randint(0, 12)):
                t += [rng.choice(letters) for _ in range(rng.randint(1, 7))] * rng.choice([1, 1, 2, 4, 5])
                if t and rng.random() < 0.3:
                    t.pop()
            texts.append([x.encode() for x in t])
        assert periodic_runs.runs_of(texts) == [plain_runs(t) for t in texts]
        assert periodic_runs.runs_of(texts, 4, 2) == [plain_runs(t, 4, 2) for t in texts]


def test_runs_of_long_texts_and_many_equal_phrases():
    assert periodic_runs.runs_of([[b"a"] * 30000, b"x y z".split() * 9000]) == [[(0, 30000, 1)], [(0, 27000, 3)]]
    words = []  # one phrase in many places, always between other words
    for i in range(4000):
        words += [b"l%d" % i, *b"the very same five words".split(), b"r%d" % i]
    assert periodic_runs.runs_of([words]) == [[]]


def test_run_edges_in_spark(spark, edge, none):
    docs = edge.withColumns({"runs": F.lit(1), "n_words": F.lit("x"), "collapsed": F.lit(0)})
    rows = periodic_runs.find_runs(docs).collect()
    texts = Counter((r.doc_id, r.text) for r in edge.collect())
    want = Counter()
    for (key, text), n in texts.items():
        words = plain.SPACE_WORD.findall(text or "")
        runs = plain_runs(words)
        want[(key, len(words), tuple(runs), plain_collapse(words, runs))] += n
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in rows) == want
    assert periodic_runs.find_runs(none).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(none, exponent=1)


def test_query_of_runs_matches_brute_force(spark):
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    planted = 0
    for key, text in ((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()):
        w = plain.SPACE_WORD.findall(text or "")
        n, h = len(w), zlib.crc32(str(key).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        r = rows.pop(key)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == plain.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r.collapsed_sha256 == plain.sha(plain_collapse(w, runs))
    assert not rows and planted


# ---------------------------------------------------------------- collocations

def plain_collocations(rows, least, top, longest=5):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain.fold(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        f = {p: n for p, n in c.items() if n >= least}
        scored = []
        for p, a in f.items():
            if len(p) > 1 and not any(len(x) > len(p) and n >= a and
                                      any(x[i:i + len(p)] == p for i in range(len(x) - len(p) + 1)) for x, n in f.items()):
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(seed, n):
    rng = random.Random(seed)
    words = ["The", "the", "é", "　x", "b-c", "q", "zz", "w1", "w2", "w3", "\U0001f600"]
    fixed = ["new york city", "of the q", "zz zz zz zz zz zz", "w1 w2 w3 q é"]
    joints = [" ", " ", " ", "\t", ", ", ".", "\n", "; "]
    return [("".join(rng.choice(words if rng.random() < 0.7 else fixed) + rng.choice(joints) for _ in range(rng.randint(0, 40))),
             rng.choice(["en", "de", None, "und"])) for _ in range(n)] + [(None, "en"), ("", None), (" \n.", "fr")]


@pytest.mark.parametrize("options", [{}, {"dictionary": 7, "block": 5}])
def test_collocations_match_brute_force(spark, options):
    rows = phrase_rows(3, 300)
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("phrase", F.lit(1)).repartition(5)
    got = collocations.collocations(docs, least=9, top=25, **options).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 9, 25)
    assert got[0].asDict().keys() == set("lang rank phrase a l r n score".split())


def test_collocation_edges(spark, edge, none):
    assert collocations.collocations(none).collect() == []
    assert collocations.collocations(none.union(edge.limit(1)), least=1000).collect() == []
    rows = [(r.text, r.lang) for r in edge.collect()]
    assert sorted(map(tuple, collocations.collocations(edge, least=2, top=9).collect())) == plain_collocations(rows, 2, 9)


def test_a_task_hands_on_little_at_once(spark, monkeypatch):
    """Streams hold a slice of 1 MiB of text, and counts and candidates leave a worker in small batches."""
    texts = spark.range(700).select(F.expr("repeat('a b ', 1500)").alias("text"), F.lit("en").alias("lang")).coalesce(1)
    words = spark.createDataFrame([("en", "a", 1), ("en", "b", 2)], "lang string, word string, num long")
    for dictionary in (5, 1):
        ids = collocations.number_texts(texts, words, 2, dictionary=dictionary).select(F.size("ids")).collect()
        assert sum(r[0] for r in ids) == 700 * 3001 + len(ids) and max(r[0] for r in ids) <= (1 << 20) // 2 + 700

    class Task:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

        def __getattr__(self, name):
            return lambda *a, **b: self

    class Known:
        trie = collocations.Trie(np.arange(1, 150_001, dtype=np.int32)[:, None], np.arange(7, 150_007))
        value = vars(trie), 7

    ids = np.tile(np.append(np.arange(1, 150_001, dtype=np.int32), 0), 3)
    batch = pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int32()))], ["ids"])
    for trie, first in ((None, 1), (Known, 7)):
        task = Task()
        collocations.scan(task, trie, 1, 150_000, 100, False, True)
        out = list(task.run(iter([batch])))
        assert max(b.num_rows for b in out) <= 1 << 16
        rows = [r for b in out for r in zip(*b.to_pydict().values())]
        assert sorted(r for r in rows if r[0]) == [(True, (first + i) << 32 | (i + 2), 3) for i in range(149_999)]
        assert sorted(r for r in rows if not r[0]) == [(False, 7 + i, 3) for i in range(150_000 if trie else 0)]


def test_scores_pass_64_bits(spark):
    """1000 * a * n is beyond a long here; a cut's floor is still exact."""
    a, left, right, total = 3 * 10**9, 4 * 10**9 + 7, 5 * 10**9 + 9, 9 * 10**12
    row = spark.createDataFrame([(a, left, right, total)], "a long, l long, r long, total long").selectExpr(
        "cast(1000 AS decimal(38,0)) * a * total div (cast(l AS decimal(38,0)) * r) AS score").first()
    assert row.score == 1000 * a * total // (left * right)


def test_tries_accept_their_phrases_only():
    rng = np.random.default_rng(5)
    for k in (1, 2, 4):
        ids = np.append(rng.zipf(1.5, 4000) % 60, 0).astype(np.int32)
        pool = np.unique(rng.zipf(1.4, (700, k)) % 59 + 1, axis=0).astype(np.int32)
        where, numbers = collocations.Trie(pool, np.arange(len(pool)) + 5).accepted(ids)
        known = {tuple(p): i + 5 for i, p in enumerate(pool.tolist())}
        want = [(i, known[tuple(ids[i:i + k])]) for i in range(len(ids) - k + 1) if tuple(ids[i:i + k].tolist()) in known]
        assert list(zip(where.tolist(), numbers.tolist())) == want


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text):
    w = plain.SPACE_WORD.findall(plain.fold(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, pairs=None):
    """{fingerprint: lowest fingerprint of its component}, by ``pairs`` or by all pairs at most 3 bits apart."""
    f = sorted(fps)
    if pairs is None:
        a = np.array(f, np.uint64)
        pairs = [(f[i], f[i + 1 + j]) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= 3)]
    root = {x: x for x in f}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in f}


def clustered(seed, n, clusters, size):
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(clusters):
        centre = rng.getrandbits(64)
        for _ in range(size):
            x = centre
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return out


@pytest.mark.parametrize("options", [{}, {"shard": 64, "few": 16}, {"shard": 64, "max_members": 50, "few": 8},
                                     {"sample": 60, "shard": 8, "max_members": 200}])
def test_tree_links_connect_all_near_fingerprints(spark, options):
    fps = clustered(4, 1200, 4, 250)
    points = spark.createDataFrame(pd.DataFrame({"fp": np.array(sorted(fps), np.uint64).view(np.int64)})).repartition(4)
    got = [(r.a % 2**64, r.b % 2**64) for r in simhash_trees.near_links(points, **options).collect()]
    assert linked(fps, got) == linked(fps)
    assert all((x ^ y).bit_count() > 0 for x, y in got)


def test_fingerprints_half_the_bits_and_short_texts():
    for t in ("", " \n", "One", "one TWO", "a b c", "a b c d", "x " * 70000, "é \U0001f600 ü ß Ä"):
        assert simhash_trees.fingerprint(t.encode()) == plain_fingerprint(t)


def test_components_on_edges_and_copies(spark, edge, none):
    docs = edge.withColumns({"fp": F.lit("x"), "component_id": F.lit(1), "n": F.lit(2)})
    rows = simhash_trees.near_components(docs).collect()
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in edge.collect()]
    root, low = linked({f for _, f in fps}), {}
    for key, f in fps:
        if key is not None:
            low[root[f]] = min(low.get(root[f], key), key)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in rows) == Counter((k, f, low.get(root[f])) for k, f in fps)
    assert simhash_trees.near_components(none).collect() == []
    many = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same words', concat('w', id)) AS text")
    got = {r.doc_id: r.component_id for r in simhash_trees.near_components(many).collect()}
    assert len(got) == 3000 and {got[i] for i in range(0, 3000, 3)} == {0}


def test_query_of_simhash_matches_brute_force(spark):
    rows = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op13_simhash_near_dedup"](spark, SF).collect()}
    fps = {r.doc_id: plain_fingerprint(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    root, low = linked(set(fps.values())), {}
    for key, f in fps.items():
        low[root[f]] = min(low.get(root[f], key), key)
    assert rows == {key: (f"{f:016x}", low[root[f]]) for key, f in fps.items()}


# ---------------------------------------------------------------- mended edges of earlier operators

def test_number_signs_are_no_letters(spark):
    from chainflow.llm import language

    assert not any(map(language.has_letter, ("", "½ ² Ⅷ", "12 ٣ _-", "\U0001f600")))
    assert all(map(language.has_letter, ("x", "½é", "١ ب", "ʰ", "中")))
    docs = spark.createDataFrame([(i, "the cat and the dog", "en") for i in range(9)] + [(20, "½ ² Ⅷ", "en")],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs.select("doc_id", "text"), language.train(docs)).collect()}
    assert got[20] == "und" and got[0] == "en"


def test_long_words_hash_alike_in_blocks():
    from chainflow.llm import kernels

    import pyarrow as pa

    rng = np.random.default_rng(1)
    long = bytes(rng.integers(97, 123, 3 * kernels._BLOCK + 17, dtype=np.uint8)).decode()
    texts = [long, f"a {long} b", f"{long[:-1]} {long}x", long[:kernels._BLOCK], f" {long[:kernels._BLOCK]}"]
    words = []
    for _, rows, raw, offsets in kernels.slices(pa.array(texts), 1 << 30):
        w = kernels.Words(raw, offsets, kernels.SPACE_WORDS)
        words += [w.hash[w.first[i]:w.first[i + 1]].tolist() for i in range(rows)]
    assert words[0][0] == words[1][1] and words[3] == words[4] and len({h for w in words for h in w}) == 6


def test_ledger_scans_copies_once_and_mixed_blobs(spark, scratch):
    from chainflow.llm import secrets

    rows = [(i, t) for i, t in enumerate(["password=abcdefgh1", "password=abcdefgh1", "clean", None, "", "AKIA" + "A" * 12] * 3)]
    docs = spark.createDataFrame(rows, "path long, content string").repartition(4)
    for few in (0, 1000):  # with and without broadcast digests
        ledger = f"{scratch}/ledger{few}"
        first = secrets.update_ledger(docs, ledger, max_broadcast_blobs=few)
        assert first.count() == 4 * len(secrets.RULES)
        assert secrets.update_ledger(docs, ledger, max_broadcast_blobs=few).count() == 0
        newer = (*secrets.RULES[:2], secrets.RULES[2]._replace(version=9))
        again = secrets.update_ledger(docs, ledger, rules=newer, max_broadcast_blobs=few)
        assert [r.kind for r in again.collect()] == ["hex"] * 4


def test_redaction_goes_on_with_changed_texts_only(spark, scratch):
    from chainflow.llm import secrets

    rows = [(1, "password=abcdefgh1 x", 5), (2, "clean", 6), (3, None, None), (1, "password=abcdefgh1 x", 5),
            (4, "pass" + "AKIA" + "A" * 12 + "word=qwertyuiop", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found long").repartition(3)
    out = secrets.redact(docs, f"{scratch}/ledger", mark="")
    assert out.columns == ["doc_id", "text", "found"]
    got = sorted((r.doc_id, r.text or "", r.found) for r in out.collect())
    assert got == [(1, " x", 5), (1, " x", 5), (2, "clean", 6), (3, "", None), (4, "", 7)]  # the halves of a new match
