"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

1. *Statistics over every training row*: rows per language, and for each hashed n-gram the rows that hold it.
2. *Sample*: at most ``max_sample`` rows, as many of each language, picked by a hash of the row; the fit reads
   nothing else.  Their features are made where they lie; one task then holds the sample's sparse rows.
3. *Fit*: follow-the-regularised-leader per example, with elastic-net penalties (L1 keeps a weight at exactly
   zero until its gradients add up), for a fixed number of epochs in seeded order.
4. *Calibration*: one temperature for the logits, the least log loss on a part of the sample that was not fitted.
   The languages' shares of all training rows replace those of the sample.
5. *Prediction*: one pass over the texts, the model (features x languages) in each task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)  # any odd numbers
UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    orders: int = 3            # n-grams of 1 to this many characters
    buckets: int = 1 << 15     # of hashed n-grams
    max_sample: int = 8000     # rows that the fit reads
    per_language: int = 1000   # of one language
    max_languages: int = 500   # the most frequent are learned
    calibration: float = 0.2   # of the sample
    epochs: int = 4
    alpha: float = 1.0         # learning rate
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.001
    seed: int = 11


def grams(text: str, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the n-grams of a text: of its lower-case letters, a space before and after every word; those
    with a space inside or of a space alone do not count."""
    plain = " " + _OTHER.sub(" ", text.lower()).strip() + " "
    c = np.frombuffer(plain.encode("utf-32-le"), dtype=np.uint32)
    space = c == 32
    keys = []
    for n in range(1, p.orders + 1):
        size = len(c) - n + 1
        if size <= 0:
            break
        h = np.full(size, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ c[k: k + size]) * _MULTIPLY[k % len(_MULTIPLY)]
            h ^= h >> np.uint32(15)
        out = space[:size] if n == 1 else np.zeros(size, dtype=bool)
        for k in range(1, n - 1):
            out = out | space[k: k + size]
        if n == 2:
            out = space[:size] & space[1:]
        keys.append(h[~out] & np.uint32(p.buckets - 1))
    key = np.concatenate(keys).astype(np.int64)
    if 8 * len(key) < p.buckets:
        return np.unique(key, return_counts=True)
    count = np.bincount(key, minlength=p.buckets)
    bucket = np.flatnonzero(count)
    return bucket, count[bucket]


def weigh(bucket: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length, with logarithmic term frequencies."""
    x = (1 + np.log(count)) * idf[bucket]
    return x / max(np.sqrt((x * x).sum()), 1e-300)


class Ftrl:
    """Follow-the-regularised-leader for multinomial logistic regression; the last row of ``z`` is the bias."""

    def __init__(self, features: int, classes: int, p: Params):
        self.p = p
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n, p = self.z[rows], self.n[rows], self.p
        return np.where(np.abs(z) <= p.l1, 0.0, (np.sign(z) * p.l1 - z) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))

    def learn(self, rows: np.ndarray, x: np.ndarray, y: int) -> None:
        """One example; ``rows`` ends with the bias, whose value in ``x`` is 1."""
        w = self.weights(rows)
        g = softmax(x @ w)
        g[y] -= 1.0
        g = x[:, None] * g
        n = self.n[rows]
        more = n + g * g
        self.z[rows] += g - (np.sqrt(more) - np.sqrt(n)) / self.p.alpha * w
        self.n[rows] = more


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least log loss, by golden section over its logarithm; 1 without rows.

    Of n rows, labels count as right in (n + 1) of (n + 2) cases, so that rows without any error do not
    make every score 1."""
    n, classes = logits.shape
    if not n or classes < 2:
        return 1.0
    share = np.full(logits.shape, 1 / (n + 2) / (classes - 1))
    share[np.arange(n), y] = (n + 1) / (n + 2)

    def loss(t):
        z = logits / np.exp(t)
        z = z - z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - (share * z).sum(1)).mean())
    lo, hi, r = -4.0, 4.0, (5**0.5 - 1) / 2
    while hi - lo > 1e-4:
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray    # features x languages
    bias: np.ndarray
    idf: np.ndarray
    temperature: float
    shift: np.ndarray      # logarithm of the shares of all rows less those of the sample
    params: Params

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        bucket, count = grams(text, self.params)
        z = weigh(bucket, count, self.idf) @ self.weights[bucket] + self.bias
        share = softmax(z / self.temperature + self.shift)
        k = int(share.argmax())
        return self.languages[k], float(share[k])


def _count_rows(p: Params):
    def run(batches):
        df = np.zeros(p.buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                df[grams(text.as_py(), p)[0]] += 1
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(df[k])], ["bucket", "n"])
    return run


def _featurize(p: Params):
    def run(batches):
        for batch in batches:
            got = [grams(t.as_py(), p) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([b.astype(np.int32) for b, _ in got], pa.list_(pa.int32())),
                 pa.array([c.astype(np.int32) for _, c in got], pa.list_(pa.int32()))], ["y", "u", "bucket", "count"])
    return run


_FIT = "key string, vector array<double>"


def _fitter(idf: np.ndarray, classes: int, quota: int, p: Params):
    def run(batches):
        rows = []
        for batch in batches:
            cols = [batch.column(k) for k in range(4)]
            for y, u, bucket, count in zip(*cols):
                b = np.array(bucket.values, dtype=np.int64)
                rows.append((u.as_py(), y.as_py(), b, weigh(b, np.array(count.values), idf)))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2]), r[3].tobytes()))
        rank = [0] * classes
        for k, (_, y, *_) in enumerate(rows):
            rank[y] += 1
            if rank[y] > quota:
                rows[k] = None
        rows = [r for r in rows if r]
        held = int(len(rows) * p.calibration)
        held, rows = rows[:held], rows[held:]
        order, m = np.random.default_rng(p.seed), Ftrl(p.buckets, classes, p)
        ones = [(y, np.append(b, p.buckets), np.append(x, 1.0)) for _, y, b, x in rows]
        for _ in range(p.epochs):
            for k in order.permutation(len(ones)):
                y, b, x = ones[k]
                m.learn(b, x, y)
        w = m.weights()
        logits = np.array([x @ w[b] + w[-1] for _, _, b, x in held]).reshape(-1, classes)
        t = temperature(logits, np.array([r[1] for r in held], dtype=np.int64))
        seen = np.bincount([r[1] for r in rows], minlength=classes)
        out = [("weights", w.ravel()), ("temperature", np.array([t])), ("seen", seen.astype(float))]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out]), pa.array([v for _, v in out], pa.list_(pa.float64()))], ["key", "vector"])
    return run


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", params: Params = Params()) -> Model:
    """The model of the rows with a label and a letter in their text; without any it knows no language."""
    p, spark = params, docs.sparkSession
    d = docs.select(F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{text_col}`").alias("text"))
    d = d.where("label IS NOT NULL AND text RLIKE '\\\\p{L}'")
    counts = d.groupBy("label").count().orderBy(F.desc("count"), "label").limit(p.max_languages).collect()
    if not counts:
        return Model([], np.zeros((p.buckets, 0)), np.zeros(0), np.zeros(p.buckets), 1.0, np.zeros(0), p)
    counts = sorted((r.label, r["count"]) for r in counts)
    languages, total = [x for x, _ in counts], np.array([n for _, n in counts], dtype=float)

    df = np.zeros(p.buckets, dtype=np.int64)  # a row a bucket at most
    for r in d.select("text").mapInArrow(_count_rows(p), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r.bucket] = r.n
    idf = np.log((1 + total.sum()) / (1 + df)) + 1

    # rows below a hash threshold of their language, about a third more than needed; of those the first
    quota = max(1, min(p.per_language, p.max_sample // len(languages)))
    share = spark.createDataFrame([(x, k, min(1.0, (1.33 * quota + 20) / n)) for k, (x, n) in enumerate(counts)], "l string, y int, share double")
    u = F.expr(f"(xxhash64({p.seed}, text, __n) & 4611686018427387903) / 4611686018427387904D")
    picked = (d.withColumn("__n", F.monotonically_increasing_id()).withColumn("u", u).join(F.broadcast(share), F.col("label") == F.col("l"))
              .where("u < share").select("y", "u", "text").mapInArrow(_featurize(p), "y int, u double, bucket array<int>, count array<int>"))
    picked = C.written(picked, "language-sample")
    got = {r.key: np.array(r.vector) for r in picked.repartition(1).mapInArrow(_fitter(idf, len(languages), quota, p), _FIT).collect()}
    w = got["weights"].reshape(p.buckets + 1, len(languages))
    seen = np.maximum(got["seen"], 0.5)
    shift = np.log(total / total.sum()) - np.log(seen / seen.sum())
    return Model(languages, w[:-1], w[-1], idf, float(got["temperature"][0]), shift, p)


def predict(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``docs`` plus the language and its calibrated probability; columns of ``docs`` with these names are replaced.
    ``und`` and 0.0 for a null text, one without a letter, or a model without languages."""
    def run(texts: pa.Array) -> pa.Array:
        got = [model.predict(t) for t in texts.to_pylist()]
        return pa.array([{"lang": x, "score": s} for x, s in got], pa.struct([("lang", pa.string()), ("score", pa.float64())]))
    got = F.arrow_udf(run, "lang string, score double")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), got(F.col(f"`{text_col}`")).alias("got"))
    keep = [F.col(f"row.`{c}`") for c in docs.columns if c not in (lang_col, score_col)]
    return d.select(*keep, F.col("got.lang").alias(lang_col), F.col("got.score").alias(score_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", params: Params = Params()) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` per row.

    The model learns from rows with a label whose id's checksum modulo 4 is not 2; ``held_out`` are the others.
    A null id counts as an empty one (never held out).  Repeated rows count as often as they are there.
    An empty table gives an empty result; extra columns are not read.
    """
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.expr(f"crc32(coalesce(CAST(`{id_col}` AS STRING), '')) % 4 = 2").alias("held_out"),
                    F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").alias("label"))
    model = fit(d.where("NOT held_out"), "text", "label", params)
    return predict(d.drop("label"), model).select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")
