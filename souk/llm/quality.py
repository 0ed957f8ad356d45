"""Quality classifier: Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text.  The weights are
learned from preference pairs (a document labelled 1 over one labelled 0) by
logistic loss on the difference of their features.  The score is then cut at a
quantile of the training scores, the one that classifies the training rows
best, and squashed so that the cut lies at 0.3.

Features use the text alone: shares of character classes and of pairs of
adjacent classes, length, word length, and how much words and lines repeat.

Training reads a bounded sample of the labelled ids (``per_class`` of each
label, those with the smallest seeded hash) and takes one row of each, however
often the id is repeated; scoring reads every document.

Defined cases: a null text scores like the empty one; labels that are null or
other than 0 and 1 are ignored; without rows of both labels every score is 0.5;
repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, packed, ship, sliced, table

PER_CLASS = 6000
CUT = 0.3
CLASSES = 14
N_FEATURES = CLASSES + CLASSES * CLASSES + 6


@cache
def _classes() -> np.ndarray:
    """Character class of every code point of the first plane."""
    out = np.full(65536, 13, np.uint8)
    for i in range(65536):
        c = chr(i)
        k = unicodedata.category(c)
        out[i] = (5 if c in "\n\r" else 4 if c in "\t\v\f" or k[0] == "Z" else 0 if k == "Ll" else 1 if k in ("Lu", "Lt") else 2 if k[0] in "LM"
                  else 3 if k[0] == "N" else 6 if c == "." else 7 if c in ",;:" else 8 if c in "!?" else 9 if k in ("Pi", "Pf", "Pd") or c in "\"'"
                  else 10 if c in "|/\\_=" else 11 if k in ("Ps", "Pe") else 12 if k[0] == "S" or c in "#%&*@" else 13)
    return out


def features(text: str | None) -> np.ndarray:
    x = np.zeros(N_FEATURES, np.float32)
    if not text:
        return x
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    k = _classes()[np.minimum(code, 65535)]
    n = len(k)
    x[:CLASSES] = np.bincount(k, minlength=CLASSES) / n
    pairs = np.bincount(k[:-1] * np.uint8(CLASSES) + k[1:], minlength=CLASSES * CLASSES)
    x[CLASSES:CLASSES + CLASSES * CLASSES] = pairs / max(1, n - 1)
    words, lines = text.split(), text.split("\n")
    kinds = len(set(words))
    x[-6:] = (np.log1p(n), np.log1p(len(words)), sum(map(len, words)) / max(1, len(words)) / 10, kinds / max(1, len(words)),
              np.log1p(kinds) / np.log1p(max(1, len(words))), len(set(lines)) / len(lines))
    return x


class Model:
    """w: weights of the standardised features; gain and cut place the score."""

    def __init__(self, mean, scale, w, cut, gain):
        self.mean, self.scale, self.w, self.cut, self.gain = mean, scale, w, cut, gain

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).astype(np.float64) @ self.w

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.gain * (self.raw(x) - self.cut) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 40_000, epochs: int = 30, batch: int = 512, rate: float = 0.02,
        decay: float = 1e-3, seed: int = 3) -> Model | None:
    """Bradley-Terry by Adam on pairs (good, bad); None without both kinds."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.clip((x - mean) / scale, -8, 8)
    a, b = rng.choice(good, pairs), rng.choice(bad, pairs)
    w = np.zeros(x.shape[1])
    m, v, step = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(epochs):
        order = rng.permutation(pairs)
        for at in range(0, pairs, batch):
            i = order[at:at + batch]
            d = z[a[i]] - z[b[i]]
            p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))  # 1 - P(good wins)
            g = -(p @ d) / len(i) + decay * w
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = Model(mean.astype(np.float32), scale.astype(np.float32), w, 0.0, 1.0)
    s = model.raw(x)
    # both classes weigh as in the sample; the quantile with the fewest errors, the middle one of ties
    cuts = np.quantile(s, np.linspace(0, 1, 1001))
    errors = np.array([np.sum((s >= c) != (y == 1)) for c in cuts])
    best = np.flatnonzero(errors == errors.min())
    model.cut = float(cuts[best[len(best) // 2]])
    model.gain = 2.0 / max(1e-6, float(np.quantile(s, 0.9) - np.quantile(s, 0.1)) / 2)
    return model


def _features_of(batches):
    for b in sliced(batches):
        x = [features(t) for t in b.column("text").to_pylist()]
        yield pa.record_batch([b.column("id"), b.column("quality"), pa.array([v.tobytes() for v in x], pa.binary())], names=["id", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 3, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on at most ``per_class`` labelled documents of each label.

    The sample's ids, at most 2 * per_class rows, are broadcast to the scan.  Rows that
    share an id are reduced to one (the least features) where they are read, so the
    driver gets no more rows than there are ids.
    """
    lab = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("quality")))
    pick = F.xxhash64(F.lit(seed), F.col("id"))
    ids = lab.filter("quality = 0").orderBy(pick).limit(per_class).unionAll(lab.filter("quality = 1").orderBy(pick).limit(per_class))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id").select("id", "quality", "text")
    ship(docs.sparkSession)
    found = sample.mapInArrow(_features_of, T.StructType([*sample.schema.fields[:2], T.StructField("x", T.BinaryType())]))
    rows = found.groupBy("id").agg(F.max("quality").alias("quality"), F.min("x").alias("x")).select("quality", "x").toArrow().to_pandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["quality", "x"])  # the same order on every run
    x = np.stack([np.frombuffer(b, np.float32) for b in rows["x"]])
    return fit(x, rows["quality"].to_numpy(), seed=seed)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """row (the whole row as a struct) and score of every document."""
    src = docs.select(packed(docs, "row"))
    if model is None:
        return src.withColumn("score", F.lit(0.5))
    ship(docs.sparkSession)
    schema = T.StructType([*src.schema.fields, T.StructField("score", T.DoubleType())])

    def scored(batches):
        for b in sliced(batches):
            x = np.stack([features(t) for t in b.column("row").field(text_col).to_pylist()])
            yield pa.record_batch([b.column("row"), pa.array(model.score(x))], names=["row", "score"])

    return src.mapInArrow(scored, schema)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents whose score reaches the cut, with their own columns."""
    fold = labels.filter(crc_mod("doc_id", 5) != 0)
    return score(docs, train(docs, fold, **options)).filter(F.col("score") >= CUT).select("row.*")


def op5(spark, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.filter(crc_mod("doc_id", 5) != 0))
    out = score(docs.select("doc_id", "text"), model)
    return out.select(F.col("row.doc_id").alias("doc_id"), (crc_mod("row.doc_id", 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))
