"""Language identification: multinomial logistic regression on TF-IDF character n-grams, trained by FTRL."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import held_out, packed_columns, small_batches, table, text_or_empty

BITS = 15  # n-grams are hashed to 2 ** BITS features
ORDERS = 3  # n-grams of 1 to so many characters
# Documents fitted at most, spread over the languages; one in CALIBRATE of them sets the temperature.
MAX_LABELLED = 2400
CALIBRATE = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
UNKNOWN = "und"
# Tasks that add up document frequencies.
ADDERS = 16

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(features, counts) of a text's n-grams in lower case; all but letters count as a space. None without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32)).astype(np.uint64)
    gram, counts = codes, np.zeros(1 << BITS, np.int64)
    for order in range(1, ORDERS + 1):
        if order > 1:
            gram = gram[:-1] * np.uint64(0x110000) + codes[order - 1:]
        if len(gram):
            mixed = (gram + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((mixed >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # languages x features
    temperature: float = 1.0

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at, counts = found
        value = np.log1p(counts) * self.idf[at]
        return at, value / max(float(np.sqrt(value @ value)), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        found = grams(text) if text and self.names else None
        if found is None:
            return UNKNOWN, 0.0
        at, value = self.vector(found)
        chance = _softmax(self.weights[:, at] @ value / self.temperature)
        best = int(chance.argmax())
        return self.names[best], float(chance[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], answers: list[int], languages: int, features: int) -> np.ndarray:
    """Follow the regularised leader, proximal form: one adaptive rate per weight, elastic-net penalty.

    L1 keeps a weight at zero until its gradients add up to more than the penalty.
    """
    z, n = np.zeros((languages, features)), np.zeros((languages, features))

    def leader(at) -> np.ndarray:
        lean = z[:, at]
        return np.where(np.abs(lean) <= L1, 0.0, -(lean - np.sign(lean) * L1) / ((BETA + np.sqrt(n[:, at])) / ALPHA + L2))

    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(vectors)):
            at, value = vectors[k]
            w = leader(at)
            miss = _softmax(w @ value)
            miss[answers[k]] -= 1
            g = np.outer(miss, value)
            rate = (np.sqrt(n[:, at] + g * g) - np.sqrt(n[:, at])) / ALPHA
            z[:, at] += g - rate * w
            n[:, at] += g * g
    return leader(slice(None))


def temperature(logits: np.ndarray, answers: np.ndarray) -> float:
    """The softmax temperature with the least log loss on rows that were not fitted, by golden section on its logarithm."""
    if not len(answers):
        return 1.0

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(answers)), answers]))

    low, high, ratio = np.log(0.02), np.log(10.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts of the column ``text`` hold each feature, and how many there are, over all rows.

    Each task counts its rows into one vector; a few tasks add the vectors up.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                found = grams(text)
                if found is not None:
                    total[found[0]] += 1
                    total[-1] += 1
        yield pd.DataFrame({"counts": [total.tobytes()]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for counts in batch["counts"]:
                total += np.frombuffer(counts, np.int64)
        yield pd.DataFrame({"counts": [total.tobytes()]})

    sums = texts.select("text").mapInPandas(count, "counts binary").repartition(ADDERS).mapInPandas(add, "counts binary")
    total = np.zeros((1 << BITS) + 1, np.int64)
    for row in sums.collect():  # one vector of fixed length from each adder
        total += np.frombuffer(row.counts, np.int64)
    return total[:-1], int(total[-1])


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", bound: int = MAX_LABELLED) -> Languages:
    """Fit on documents with a language that are not held out.

    Document frequencies come from all of them, the weights from at most ``bound``, about as
    many of each language, chosen by a hash of id and text. Texts without a letter teach
    nothing. Without labelled rows no language is known and every prediction is ``und``.
    """
    usable = small_batches(docs).filter(F.col(lang).isNotNull() & ~held_out(key)).select(F.col(key).alias("id"), text_or_empty(text).alias("text"), F.col(lang).alias("lang"))
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}  # one row per language
    names = tuple(sorted(counts))
    seen, total = document_frequencies(usable)
    idf = np.log((1 + total) / (1 + seen)) + 1
    blank = Languages(names, idf, np.zeros((len(names), 1 << BITS)))
    if not names or not total:
        return Languages((), idf, blank.weights)
    # Twice the even share, as the hash may deal unevenly; the last limit holds the bound.
    share = F.coalesce(*[F.when(F.col("lang") == name, F.lit(2 * bound / len(names) / counts[name])) for name in names])
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)

    @F.pandas_udf("struct<at: binary, counts: binary>")
    def found(texts: pd.Series) -> pd.DataFrame:
        out = [grams(t) for t in texts]
        return pd.DataFrame({
            "at": [None if f is None else f[0].astype(np.uint16).tobytes() for f in out],
            "counts": [None if f is None else f[1].astype(np.uint32).tobytes() for f in out],
        })

    some = usable.withColumn("place", draw / share).filter("place < 1").select("lang", "place", "id", found(F.col("text")).alias("f"))
    rows = some.orderBy("place", "id").limit(bound).select("lang", "f.*").collect()
    vectors, answers = [], []
    for row in rows:
        if row["at"] is not None:
            vectors.append(blank.vector((np.frombuffer(row["at"], np.uint16), np.frombuffer(row["counts"], np.uint32))))
            answers.append(names.index(row["lang"]))
    fitted = [k for k in range(len(vectors)) if k % CALIBRATE]
    weights = ftrl([vectors[k] for k in fitted], [answers[k] for k in fitted], len(names), 1 << BITS)
    kept = [k for k in range(len(vectors)) if not k % CALIBRATE]
    logits = np.array([weights[:, vectors[k][0]] @ vectors[k][1] for k in kept]).reshape(-1, len(names))
    return Languages(names, idf, weights, temperature(logits, np.array([answers[k] for k in kept], int)))


def identify(docs: DataFrame, model: Languages, *, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The input row (or the columns in ``carry``) as ``doc`` with ``lang_pred`` and its calibrated ``score``.

    The whole text counts. A null text, or one without a letter, is ``und`` with score 0;
    equal texts have equal results; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x features, fixed by BITS

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    body: Column = F.col(text)
    return small_batches(docs).select(packed_columns(docs, carry), predict(body).alias("p")).select("doc", "p.lang_pred", "p.score")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = identify(docs, train(docs), carry=["doc_id"])
    return named.select(F.col("doc.doc_id").alias("doc_id"), held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")
