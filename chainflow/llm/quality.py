"""Quality classifier: a second-order factorisation machine over hashed words and structure statistics.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

so all pairwise interactions cost time linear in a text's features.  Features are
the text's words (hashed to 2^16 places, square-root counts, unit length) and
statistics of its structure and length.  Language, source, id and labels are
never inputs of a score.

Fitting uses a bounded sample: the ``train_rows`` labelled ids with the lowest hash,
outside the held-out fold, as long as their texts have at most ``train_words``
distinct words in all (8 bytes each).  Only their features reach the driver, one row
for each id; scoring covers every row in Arrow batches against the broadcast model,
whose size is fixed by ``BITS`` and ``rank``.

Defined cases: a null or empty text has no words and all statistics zero, and is
scored like any other; repeated rows score alike; an id with several texts is learned from the one with the
smallest SHA-256; labels that are null or whose id
has no document are not learned from; with no label at all the score is 0.5; a
null doc_id is not held out; extra columns are ignored, and passed through by
``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common as C
from . import kernels as K

BITS = 16
FOLDS = 5
TRAIN_ROWS = 6000
TRAIN_WORDS = 30_000_000
THRESHOLD = 0.3

#: Bytes that a statistic counts, as a share of the text's bytes.
_SHARES = (
    bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("a"), ord("z") + 1)), bytes(range(ord("0"), ord("9") + 1)),
    b"#*$%&", b"|", b"<>{}[]\\^~_=", b"!", b".,;:?", b"\"'()-/@+", b" ", b"\n", bytes(range(128, 256)),
)
N_STATS = len(_SHARES) + 7


def features(texts: pa.Array):
    """(indices, values, texts' borders, statistics) of each slice of a text column."""
    shares = np.zeros(256, np.int64)
    for i, chars in enumerate(_SHARES):
        shares[list(chars)] = i + 1
    for _, rows, raw, offsets in K.slices(texts):
        w = K.Words(raw, offsets, K.SPACE_WORDS)
        size = np.diff(offsets)
        doc_of = np.repeat(np.arange(rows), size)
        classes = np.bincount(doc_of * 16 + shares[raw], minlength=rows * 16).reshape(rows, 16)
        key = w.doc.astype(np.int64) << BITS | (w.hash >> np.uint64(64 - BITS)).astype(np.int64)
        key, count = np.unique(key, return_counts=True)
        doc, index = key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)
        value = np.sqrt(count).astype(np.float32)
        norm = np.sqrt(np.bincount(doc, weights=count, minlength=rows))
        value = (value / norm[doc]).astype(np.float32)
        border = np.searchsorted(doc, np.arange(rows + 1))
        n = np.maximum(size, 1)
        words = np.maximum(w.per_doc, 1)
        lines = classes[:, 11] + (size > 0)
        distinct = np.diff(border)
        after = w.ends - 1
        tail_symbol = np.bincount(w.doc[np.isin(shares[raw[after]], (4, 7))], minlength=rows)
        width = w.ends - w.starts
        single = np.bincount(w.doc[width == 1], minlength=rows)
        stats = np.concatenate([
            classes[:, 1:len(_SHARES) + 1] / n[:, None],
            np.stack([np.log1p(size), np.log1p(w.per_doc), np.log1p(lines), distinct / words,
                      np.bincount(w.doc, weights=width, minlength=rows) / words / 10,
                      tail_symbol / words, single / words], 1)], 1)
        yield index, value, border, stats


class Machine:
    """A trained model; ``scores`` takes a text column."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.w0, self.w, self.v, self.mean, self.scale = w0, w, v, mean, scale

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for index, value, border, stats in features(texts):
            rows = len(border) - 1
            doc = np.repeat(np.arange(rows), np.diff(border))
            z = scaled(stats, self.mean, self.scale)
            wide = 1 << BITS
            linear = np.bincount(doc, weights=self.w[index] * value, minlength=rows) + z @ self.w[wide:]
            pair = np.zeros(rows)
            for f in range(self.v.shape[1]):
                vf = self.v[:, f]
                x = vf[index] * value
                total = np.bincount(doc, weights=x, minlength=rows) + z @ vf[wide:]
                square = np.bincount(doc, weights=x * x, minlength=rows) + (z * z) @ (vf[wide:] ** 2)
                pair += total * total - square
            out.append(1 / (1 + np.exp(-np.clip(self.w0 + linear + pair / 2, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def scaled(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((stats - mean) / scale, -4, 4) / 4


def fit(rows: list[tuple], rank: int = 8, steps: int = 700, batch: int = 64, rate: float = 0.2,
        decay: float = 1e-5, seed: int = 7) -> Machine:
    """AdaGrad on the log loss over (indices, values, statistics, label) rows.

    Both labels weigh the same in total, so that a score says which label a text is
    liker whatever the labels' shares are.
    """
    wide = 1 << BITS
    rng = np.random.default_rng(seed)
    size = wide + N_STATS
    w, v = np.zeros(size), rng.normal(0, 0.02, (size, rank))
    if not rows:
        return Machine(0.0, w, np.zeros((size, rank)), np.zeros(N_STATS), np.ones(N_STATS))
    stats = np.array([r[2] for r in rows])
    mean, scale = stats.mean(0), stats.std(0) + 1e-3
    z = scaled(stats, mean, scale)
    y = np.array([r[3] for r in rows], float)
    p = np.clip(y.mean(), 0.01, 0.99)
    weight = np.where(y > 0, 0.5 / p, 0.5 / (1 - p))
    w0 = 0.0
    gw, gv, g0 = np.full(size, 1e-2), np.full((size, rank), 1e-2), 1e-2
    places = np.arange(wide, size)
    parts = [(np.concatenate([np.asarray(r[0], np.int64), places]), np.concatenate([np.asarray(r[1], float), z[i]]))
             for i, r in enumerate(rows)]
    for _ in range(max(1, -(-steps * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            chosen = order[at:at + batch]
            idx = np.concatenate([parts[i][0] for i in chosen])
            x = np.concatenate([parts[i][1] for i in chosen])
            lens = [len(parts[i][0]) for i in chosen]
            first = np.concatenate(([0], np.cumsum(lens)[:-1]))
            own = np.repeat(np.arange(len(chosen)), lens)
            vx = v[idx] * x[:, None]
            total = np.add.reduceat(vx, first, 0)
            pair = 0.5 * (total ** 2 - np.add.reduceat(vx ** 2, first, 0)).sum(1)
            score = w0 + np.add.reduceat(w[idx] * x, first) + pair
            err = weight[chosen] * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[chosen]) / len(chosen)
            gx = err[own] * x
            places_u, inv = np.unique(idx, return_inverse=True)
            dw = np.bincount(inv, weights=gx) + decay * w[places_u]
            dv = np.stack([np.bincount(inv, weights=gx * (total[own, f] - vx[:, f])) for f in range(rank)], 1)
            dv += decay * v[places_u]
            gw[places_u] += dw ** 2
            gv[places_u] += dv ** 2
            g0 += err.sum() ** 2
            w[places_u] -= rate * dw / np.sqrt(gw[places_u])
            v[places_u] -= rate * dv / np.sqrt(gv[places_u])
            w0 -= rate * err.sum() / np.sqrt(g0)
    return Machine(w0, w, v, mean, scale)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          train_rows: int = TRAIN_ROWS, train_words: int = TRAIN_WORDS, **options) -> Machine:
    """Fit on at most ``train_rows`` labelled ids outside the held-out fold, with at most
    ``train_words`` distinct words (a text's words counted for itself) in all."""
    chosen = (labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
              .where("doc_id IS NOT NULL AND label IS NOT NULL").where(C.crc_fold("doc_id", FOLDS) != 0)
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    digest = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    labelled = src.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", digest.alias("digest"), "text")

    def extract(batch: pa.RecordBatch) -> dict:
        index, value, stat = [], [], []
        for i, x, border, stats in features(batch.column(3)):
            index += np.split(i, border[1:-1])
            value += np.split(x, border[1:-1])
            stat += list(stats)
        return {"doc_id": batch.column(0), "label": batch.column(1), "digest": batch.column(2),
                "index": index, "value": value, "stats": stat}

    # an id that several rows hold is learned from once; tasks keep one row of it each before the shuffle
    names = ["label", "index", "value", "stats"]
    least = (C.map_arrow(labelled, extract, C.take(
        "doc_id long, label double, digest string, index array<int>, value array<float>, stats array<double>"))
        .groupBy("doc_id").agg(F.min_by(F.struct(*names), "digest").alias("row")).select("doc_id", "row.*"))
    seen = C.written(least.withColumn("n", F.size("index").cast("long")), "labelled")
    # at most train_rows rows
    total = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    kept = seen.select("doc_id", total.alias("total")).where(F.col("total") <= train_words).select("doc_id")
    rows = seen.join(F.broadcast(kept), "doc_id").select("doc_id", *names).toArrow().sort_by([("doc_id", "ascending")])
    return fit([(i.values.to_numpy(), v.values.to_numpy(), s.values.to_numpy(), y) for i, v, s, y in
                zip(rows["index"], rows["value"], rows["stats"], rows["label"].to_pylist())], **options)


def score(docs: DataFrame, model: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score as a last column."""
    docs = C.without(docs, [name])
    at, names = docs.columns.index(text), docs.columns
    shared = C.Shared(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> dict:
        return dict(zip(names, batch.columns)) | {name: shared.value.scores(batch.column(at))}

    return C.map_arrow(docs, run, type(docs.schema)(docs.schema.fields + C.take(f"{name} double").fields))


def keep_good(docs: DataFrame, model: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the model accepts, with the columns of ``docs``."""
    return score(docs, model, text, "_score").where(F.col("_score") >= threshold).select(*docs.columns)
