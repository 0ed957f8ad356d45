"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords (every word between
marks, and its runs of two to four characters, hashed into BUCKETS rows of DIM
numbers); a linear layer and a softmax turn that into a probability of each
language.  Both are trained by stochastic gradient descent in numpy on a
bounded sample (about ``per_lang`` documents of each language, at most, chosen
by a seeded hash of id and text; rows equal in both count once): each gives its
whole text and a short run of its words.  A fifth
of the sample is held back to set a temperature (so that the score is a
probability) and the confidence below which a prediction is rejected.

Prediction reads every whole text.  As the model is linear, a word's part of
the sum is looked up after its first use.

Defined cases: a text that is null or has no letter gets ``und`` with score 0
and is rejected; with no labelled row every text is ``und``; with one language
all texts with letters get it; repeated rows get equal results; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, packed, ship, sliced, table
from .neardup import PRIME, mixed

PER_LANG = 800
BUCKETS, DIM = 1 << 15, 16
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
PRECISION = 0.99
CACHED_WORDS = 300_000


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of all words, and the place in the list of the word each belongs to."""
    c = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32)
    opens = c == ord("<")
    word, start = np.cumsum(opens) - 1, np.flatnonzero(opens)
    letter = mixed(c.astype(np.uint64) + np.uint64(1))
    place = (np.arange(len(c)) - start[word]).astype(np.uint64)
    buckets, owner = [mixed(np.add.reduceat(mixed(letter + PRIME * place), start))], [np.arange(len(words))]
    for n in (2, 3, 4):
        h = np.full(max(0, len(c) - n + 1), n, np.uint64)
        for k in range(n):
            h = h * PRIME + letter[k:k + len(h)]
        inside = word[:len(h)] == word[n - 1:]
        buckets.append(mixed(h[inside]))
        owner.append(word[:len(h)][inside])
    return (np.concatenate(buckets) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owner)


def words_of(text: str | None) -> list[str]:
    """The text's runs of letters; none if only other signs (like superscript digits) look like letters."""
    words = WORD.findall(text.lower()) if text else []
    return words if any(any(map(str.isalpha, w)) for w in words) else []


class Model:
    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray):
        self.langs, self.table, self.bias = langs, table, bias  # table: embeddings times the linear layer
        self.heat, self.floor = 1.0, 0.0

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return counts @ self.table[buckets] / counts.sum() + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.heat
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)


class Reader:
    """Applies a model to texts; a word's sum of logits is computed once."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self):
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.model.langs) + 1))

    def _learn(self, words: list[str]) -> None:
        bucket, owner = subwords(words)
        at, end = len(self.place), len(self.place) + len(words)
        self.place.update(zip(words, range(at, end), strict=True))
        while end > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for k in range(len(self.model.langs)):
            self.rows[at:end, k] = np.bincount(owner, self.model.table[bucket, k], len(words))
        self.rows[at:end, -1] = np.bincount(owner, minlength=len(words))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out, held, n = [], [], 0
        for t in texts:
            held.append(words_of(t))
            n += len(held[-1])
            if n >= 16384:
                out += self._predict(held)
                held, n = [], 0
        return out + self._predict(held)

    def _predict(self, lists: list[list[str]]) -> list[tuple[str, float]]:
        if len(self.place) > CACHED_WORDS:
            self._reset()
        new = [w for w in dict.fromkeys(chain.from_iterable(lists)) if w not in self.place]
        for at in range(0, len(new), 8192):
            self._learn(new[at:at + 8192])
        out = []
        for words in lists:
            if not words:
                out.append((UNKNOWN, 0.0))
                continue
            total = np.zeros(len(self.model.langs) + 1)
            for at in range(0, len(words), 8192):
                total += self.rows[[self.place[w] for w in words[at:at + 8192]]].sum(0)
            p = self.model.probabilities(total[:-1] / total[-1] + self.model.bias)
            best = int(p.argmax())
            out.append((self.model.langs[best], float(p[best])))
        return out


def bag(words: list[str]) -> np.ndarray:
    """Buckets of the words' subwords and how often each occurs: at most BUCKETS columns, however long the text."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(words), 8192):
        total += np.bincount(subwords(words[at:at + 8192])[0], minlength=BUCKETS)
    used = np.flatnonzero(total)
    return np.stack([used, total[used]])


def fit(bags: list[np.ndarray], y: np.ndarray, held: np.ndarray, langs: list[str], epochs: int = 8, batch: int = 64,
        rate: float = 20.0, seed: int = 9) -> Model:
    """bags: subword buckets of each training row with their counts; held marks the rows kept for calibration."""
    g = np.random.Generator(np.random.PCG64(seed))
    n = len(langs)
    emb = g.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = g.normal(0, 0.1, (DIM, n)).astype(np.float32), np.zeros(n, np.float32)
    rows = np.flatnonzero(~held)
    share = np.bincount(y[rows], minlength=n).astype(np.float64)
    weigh = (len(rows) / np.maximum(1, share) / max(1, (share > 0).sum())).astype(np.float32)
    steps, step = max(1, epochs * -(-len(rows) // batch)), 0
    for _ in range(epochs):
        order = g.permutation(rows)
        for at in range(0, len(order), batch):
            i = order[at:at + batch]
            x = np.zeros((len(i), BUCKETS), np.float32)
            for r, k in enumerate(i):
                x[r, bags[k][0]] = bags[k][1]
            x /= x.sum(1, keepdims=True)
            hidden = x @ emb
            z = hidden @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(i)), y[i]] -= 1
            p *= weigh[y[i], None] / len(i)
            lr = np.float32(rate * (1 - step / steps))
            back = p @ out.T
            out -= lr * 0.05 * (hidden.T @ p)
            bias -= lr * 0.005 * p.sum(0)
            emb -= lr * (x.T @ back)
            step += 1
    model = Model(langs, (emb @ out).astype(np.float64), bias.astype(np.float64))
    test = np.flatnonzero(held) if held.any() else rows
    if len(test):
        z = np.stack([model.logits(*bags[k]) for k in test])
        loss = []
        heats = np.geomspace(0.05, 20, 60)
        for t in heats:
            model.heat = t
            loss.append(-np.log(np.maximum(1e-12, model.probabilities(z)[np.arange(len(test)), y[test]])).mean())
        model.heat = float(heats[int(np.argmin(loss))])
        p = model.probabilities(z)
        sure, right = p.max(1), p.argmax(1) == y[test]
        order = np.argsort(-sure)
        precise = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(precise >= PRECISION)
        # the lowest confidence at which the held-back rows at or above it are right often enough
        model.floor = float(sure[order[good[-1]]]) if len(good) else 1.0
    return model


def _bags_of(batches):
    for b in sliced(batches):
        out = []
        for lang, pick, text in zip(*(b.column(c).to_pylist() for c in ("lang", "pick", "text")), strict=True):
            words = words_of(text)
            if not words:
                continue
            held = pick % 5 == 0
            out.append((lang, held, bag(words)))
            n = 1 + (pick >> 8) % 12
            at = (pick >> 16) % max(1, len(words) - n + 1)
            out.append((lang, held, bag(words[at:at + n])))
        yield pa.record_batch([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.bool_()),
                               pa.array([x[2].astype(np.int32).tobytes() for x in out], pa.binary())], names=["lang", "held", "bag"])


def train(docs: DataFrame, per_lang: int = PER_LANG, seed: int = 9, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model | None:
    """Fit on a sample of docs with a language: each with probability per_lang / rows of its language, by a seeded hash of id and text.

    Rows equal in id, text and language are taken together and once, so a repeated row
    cannot fill the sample; rows that share an id but hold other texts are drawn one by one.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("lang is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return None
    pick = F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.col("text")), F.lit(1 << 40))
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, per_lang / n))])[F.col("lang")]
    sample = known.withColumn("pick", pick).filter(F.col("pick") < share * F.lit(float(1 << 40))).select("lang", "pick", "text")
    sample = sample.groupBy("lang", "pick").agg(F.min("text").alias("text"))
    sample = sample.withColumn("pick", F.pmod(F.xxhash64("pick"), F.lit(1 << 40)))  # fresh digits: the sample has small ones
    ship(docs.sparkSession)
    rows = sample.mapInArrow(_bags_of, "lang string, held boolean, bag binary").toArrow().to_pandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["lang", "held", "bag"], kind="stable")  # the same order on every run
    langs = sorted(rows["lang"].unique())
    bags = [np.frombuffer(b, np.int32).reshape(2, -1) for b in rows["bag"]]
    return fit(bags, np.searchsorted(langs, rows["lang"].to_numpy()), rows["held"].to_numpy(), langs, seed=seed)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """row (the whole row as a struct), lang_pred, score, accepted."""
    src = docs.select(packed(docs, "row"))
    if model is None:
        return src.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    ship(docs.sparkSession)
    schema = T.StructType([*src.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("accepted", T.BooleanType())])

    def run(batches):
        reader = Reader(model)
        for b in sliced(batches):
            found = reader.predict(b.column("row").field(text_col).to_pylist())
            yield pa.record_batch([
                b.column("row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[0] != UNKNOWN and f[1] >= model.floor for f in found], pa.bool_())], names=["row", "lang_pred", "score", "accepted"])

    return src.mapInArrow(run, schema)


def op8(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(crc_mod("doc_id", 3) != 1))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select(F.col("row.doc_id").alias("doc_id"), (crc_mod("row.doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")
