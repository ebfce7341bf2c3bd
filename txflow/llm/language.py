"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed; a document is its n-gram counts weighted by idf and
divided by their sum. The regression is trained by follow-the-regularised-leader (FTRL-proximal, with
an L1 and an L2 penalty) on a bounded, stratified sample; a temperature is then fitted on rows of the
sample kept apart. Document frequencies are counted over all learning documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 16                # 2^BITS hashed n-grams
ORDERS = (1, 2, 3)
AT_ONCE = 1 << 18        # characters hashed in one step, so that a long text needs no more memory
SALTS = 64
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)   # odd, to mix the characters
_ascii = np.arange(128, dtype=np.uint32)
LETTERS_ONLY = np.where((_ascii >= 97) & (_ascii <= 122), _ascii, 32).astype(np.uint32)


def gram_numbers(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased text, ASCII other than letters as blanks; a blank stands at both ends."""
    text = f" {text.lower()} "
    for at in range(0, len(text), AT_ONCE):
        part = text[at:at + AT_ONCE + max(ORDERS) - 1]
        own = min(AT_ONCE, len(text) - at)   # n-grams that start here
        chars = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        low = chars < 128
        chars = np.where(low, LETTERS_ONLY[np.where(low, chars, 0)], chars)
        mixed = np.zeros(len(chars), dtype=np.uint32)
        for n in ORDERS:
            if n > len(chars):
                break
            mixed = mixed[:len(chars) - n + 1] * np.uint32(31) + (chars[n - 1:] + np.uint32(n)) * MULTIPLIERS[n - 1]
            hashed = mixed ^ (mixed >> np.uint32(15))
            yield ((hashed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS))[:own].astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray        # one weight per hashed n-gram
    weights: np.ndarray    # (2^BITS + 1, languages), the last row is the bias
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        if not hasattr(self, "_table"):
            self._table = (self.weights[:-1] * self.idf[:, None]).astype(np.float32)
        total, mass = np.zeros(len(self.languages)), 0.0
        for grams in gram_numbers(text):
            total += self._table[grams].sum(0, dtype=np.float64)
            mass += self.idf[grams].sum()
        logits = (total / mass + self.weights[-1]) / self.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text mod 5 is 0; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents that hold each hashed n-gram) over the whole column ``text``, added up in Spark:
    at most 2^BITS + 1 sums come back."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << BITS, dtype=np.int64), 0
        seen = np.zeros(1 << BITS, dtype=np.uint8)
        for batch in batches:
            for value in batch.column(0):
                seen[:] = 0
                for grams in gram_numbers(value.as_py() or ""):
                    seen[grams] = 1
                total += seen
                n += 1
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["gram", "n"])

    sums = texts.select("text").mapInArrow(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    gram, n = table["gram"].to_numpy(), table["n"].to_numpy()
    out = np.zeros(1 << BITS, dtype=np.int64)
    out[gram[gram >= 0]] = n[gram >= 0]
    return int(n[gram < 0].sum()), out


def _sample(rows: DataFrame, per_language: int, rows_at_most: int) -> DataFrame:
    """lang, grams, counts, part of at most ``per_language`` rows of each language and ``rows_at_most`` in all,
    those of lowest hash, one row of each id and language; these are chosen first, so that only their texts move."""
    # one row for each id and language, counted map-side: copies of an id neither fill places nor come along
    lowest = (rows.select("id", "lang").distinct().withColumn("h", F.xxhash64("id", "lang"))
              .withColumn("salt", F.pmod(F.xxhash64("lang", "id"), F.lit(SALTS))))
    for keys in (["lang", "salt"], ["lang"]):   # a frequent language is thinned out in SALTS parts first
        order = Window.partitionBy(*keys).orderBy("h", "id")
        lowest = lowest.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language)
    chosen = lowest.orderBy("r", "h", "id").limit(rows_at_most)
    # at most rows_at_most pairs, whatever the input, and one text of each: that of the lowest hash
    texts = (rows.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"], "left_semi")
             .groupBy("id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                found = list(gram_numbers(text)) if LETTER.search(text) else []
                at, n = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
                grams.append(at.astype(np.int32))
                counts.append(n.astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("lang"),
                 pa.array(grams, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
                names=["id", "lang", "grams", "counts"])

    return texts.select("id", "lang", "text").mapInArrow(
        features, "id string, lang string, grams array<int>, counts array<float>").withColumn("h", F.xxhash64("id", "lang"))


class Ftrl:
    """FTRL-proximal for multinomial logistic regression with L1 and L2 penalties."""

    def __init__(self, features: int, classes: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / step)

    def learn(self, at: np.ndarray, x: np.ndarray, target: int) -> None:
        w = self.weights(at)
        logits = x @ w
        p = np.exp(logits - logits.max())
        p /= p.sum()
        p[target] -= 1.0
        g = x[:, None] * p[None, :]
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """The temperature of lowest log loss, by golden-section search on its logarithm.

    The label counts (n + 1) / (n + 2) and the rest is shared by the others, as in Platt's scaling: n rows
    that are all told right don't show that an error is impossible.
    """
    n, classes = logits.shape
    spared = 1.0 / (n + 2)
    share = np.full(logits.shape, spared / (classes - 1))
    share[np.arange(n), target] = 1.0 - spared

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        scaled = scaled - scaled.max(1, keepdims=True)
        return float((np.log(np.exp(scaled).sum(1)) - (scaled * share).sum(1)).mean())

    low, high, cut = -5.0, 5.0, (np.sqrt(5) - 1) / 2
    for _ in range(50):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 400, rows_at_most: int = 4000, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0,
          l1: float = 0.01, l2: float = 0.01, scale: float = 20.0) -> Model:
    """A model from the labelled rows that are not held out. Rows without id, text, letter or label teach nothing.

    The classifier sees at most ``per_language`` rows of a language and ``rows_at_most`` in all (documented
    bound; their n-gram counts are all that reaches the driver). Every fifth of them fits the temperature only.
    """
    learning = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    learning = learning.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull()
                               & ~held_out(F.col("id")))
    total, df = document_frequencies(learning)
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    sample = _sample(learning, per_language, rows_at_most).toArrow()
    rows = sorted(zip(sample["h"].to_pylist(), sample["id"].to_pylist(), sample["lang"].to_pylist(), range(len(sample))))
    chunked = sample["grams"].combine_chunks(), sample["counts"].combine_chunks()
    rows = [(lang, *(c[i].values.to_numpy() for c in chunked)) for _, _, lang, i in rows if len(chunked[0][i])]
    languages = sorted({r[0] for r in rows})
    number = {x: i for i, x in enumerate(languages)}
    learner = Ftrl((1 << BITS) + 1, max(1, len(languages)), alpha, beta, l1, l2)

    def features(r) -> tuple[np.ndarray, np.ndarray]:
        at = r[1].astype(np.int64)
        x = r[2] * idf[at]
        return np.append(at, 1 << BITS), np.append(x * (scale / x.sum()), 1.0)

    made = [(*features(r), number[r[0]]) for r in rows]
    apart, taught = made[::5], [m for i, m in enumerate(made) if i % 5 or len(made) < 10]
    order = np.random.default_rng(9)
    for _ in range(epochs):
        for i in order.permutation(len(taught)):
            learner.learn(*taught[i])
    w = learner.weights()
    w[:-1] *= scale
    temperature = 1.0
    if len(languages) > 1 and apart:
        back = np.append(np.full(1 << BITS, 1 / scale), 1.0)
        logits = np.array([(x * back[at]) @ w[at] for at, x, _ in apart])
        temperature = _temperature(logits, np.array([t for *_, t in apart]))
    return Model(languages, idf, w, temperature)


def predict(docs: DataFrame, model: Model, *, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a column (lang, score); ``und`` with score 0 for a null text or one without a letter, and
    where nothing was learned. Every row is kept as it is; nothing is shuffled; a whole text is always used."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # 2^BITS rows of a number per language
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def told(texts):
        import pandas as pd

        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    return docs.withColumn(out_col, told(F.col(text_col)))


def keep_identified(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    least: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or told with less than ``least``; columns as they were.

    Repeated rows stay. If nothing could be learned, every row with a letter stays.
    """
    model = train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    if not model.languages:
        return docs.filter(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    mark = "language"
    while mark in {c.lower() for c in docs.columns}:
        mark += "_"
    told = predict(docs, model, text_col=text_col, out_col=mark)
    return told.filter((F.col(mark)["lang"] != UNKNOWN) & (F.col(mark)["score"] >= least)).drop(mark)
