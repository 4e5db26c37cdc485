"""Quality scores learned from preference pairs (Bradley-Terry), cut at a quantile of the scores."""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm.frames import BROADCAST_BYTES, held_out, packed_columns, running, small_batches, table, text_or_empty
from fleetpulse.session import stage

# Labelled rows fitted at most, half of them of either label: the first by a hash of id and text.
MAX_LABELLED = 8000
PAIRS = 60_000
# A label in memory; labels are broadcast only if they all stay below BROADCAST_BYTES.
LABEL_BYTES = 100
PENALTY = 1e-3
# Kinds of characters.
KINDS = ("lower", "upper", "letter", "digit", "space", "sign")

_TABLE: np.ndarray | None = None


def _kinds() -> np.ndarray:
    """Kind of each character of the basic plane; built once in a process."""
    global _TABLE
    if _TABLE is None:
        def kind(code: int) -> int:
            char = chr(code)
            major = unicodedata.category(char)
            if major == "Ll":
                return 0
            if major == "Lu":
                return 1
            if major[0] in "LM":
                return 2
            if major[0] == "N":
                return 3
            return 4 if char.isspace() else 5

        _TABLE = np.array([kind(c) for c in range(0x10000)], np.uint8)
    return _TABLE


FEATURES = (
    "log_words", "word_length", "long_words", "distinct", "stutter", "top_word", "bare_signs", "sign_runs", "capital_words",
    "shouted", "lower", "upper", "letter", "digit", "space", "sign", "repeated_lines", "repeated_text", "log_line", "distinct_pairs",
)


def features(text: str) -> list[float]:
    """What a text looks like, whatever its language: shares of its words, characters and lines, each once over the whole text."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[np.minimum(codes, 0xFFFF)]
    shares = np.bincount(kinds, minlength=len(KINDS))[: len(KINDS)] / chars
    signs = kinds == 5
    runs = np.count_nonzero(signs[1:] & signs[:-1]) / n if chars > 1 else 0.0
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    capital = sum(c for w, c in counts.items() if w[0].isupper())
    shouted = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    stutter = sum(map(str.__eq__, words, words[1:]))
    lines = [line for line in text.split("\n") if line.strip()]
    seen = Counter(lines)
    again = sum(c - 1 for c in seen.values())
    again_chars = sum((c - 1) * len(line) for line, c in seen.items())
    pairs = len(set(zip(words, words[1:])))
    return [
        float(np.log1p(n)), float(lengths.mean()), float((lengths > 12).mean()), len(counts) / n, stutter / n, max(counts.values()) / n,
        bare / n, float(runs), capital / n, shouted / n, *shares.tolist(), again / len(lines), again_chars / chars,
        float(np.log1p(chars / len(lines))), pairs / max(1, n - 1),
    ]


@dataclass(frozen=True)
class Ranking:
    """A document's score is the logistic of (weights . scaled features - cut) / spread."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return _widened(rows, self.mean, self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        margin = (self.strength(rows) - self.cut) / self.spread
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _widened(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Scaled features and their squares: too much of a thing can be as bad as too little."""
    scaled = np.clip((rows - mean) / scale, -8, 8)
    return np.concatenate([scaled, scaled**2], axis=1)


def fit(good: np.ndarray, bad: np.ndarray, rejected: float) -> Ranking:
    """Bradley-Terry strengths that are linear in the features.

    Each pair says that a good row is preferred to a bad one; the loss is logistic in the
    difference of their features, with a small quadratic penalty, minimised by Newton steps.
    ``rejected`` is the share of bad rows among all labelled rows, and the cut is that
    quantile of the given rows' scores; ``train`` takes it anew from all labelled rows.
    Without rows of both kinds every score is one half.
    """
    both = np.concatenate([good, bad])
    width = len(FEATURES)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(2 * width), 0.0, 1.0)
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x, y = _widened(good, mean, scale), _widened(bad, mean, scale)
    random = np.random.default_rng(7)
    ahead = x[random.integers(len(x), size=PAIRS)] - y[random.integers(len(y), size=PAIRS)]
    weights = np.zeros(2 * width)
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(ahead @ weights, -500, 500)))  # that the pair is turned round
        gradient = PENALTY * weights - ahead.T @ p / PAIRS
        hessian = (ahead * (p * (1 - p))[:, None]).T @ ahead / PAIRS + PENALTY * np.eye(2 * width)
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    # Rows count as often as their kind has labelled rows, as the sample takes both kinds alike.
    scores = np.concatenate([x @ weights, y @ weights])
    mass = np.concatenate([np.full(len(x), (1 - rejected) / len(x)), np.full(len(y), rejected / len(y))])
    order = np.argsort(scores, kind="stable")
    at = int(np.searchsorted(np.cumsum(mass[order]), rejected))
    at = min(max(at, 0), len(order) - 2)
    cut = float(scores[order[at]] + scores[order[at + 1]]) / 2
    return Ranking(mean, scale, weights, cut, float(scores.std()) / 4 or 1.0)


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", bound: int = MAX_LABELLED) -> Ranking:
    """Fit on labelled rows that are not held out, at most ``bound`` of them, and cut at a quantile of the scores of all of them.

    Null ids and labels other than 0 and 1 teach nothing.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    if len(counts) < 2:
        return fit(np.zeros((0, len(FEATURES))), np.zeros((0, len(FEATURES))), 0.0)
    rows = {}
    measured = small_batches(docs).select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    for value in (0, 1):
        some = usable.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(bound // 2).select("id").distinct()
        # The chosen ids are bounded; so are the rows, should an id be shared by many.
        chosen = measured.join(F.broadcast(some), "id").select("id", F.xxhash64("id", "text").alias("h"), _features(F.col("text")).alias("f"))
        rows[value] = np.array([r.f for r in chosen.orderBy("h", "id").limit(bound // 2).collect()], float).reshape(-1, len(FEATURES))
    model = fit(rows[1], rows[0], counts[0] / (counts[0] + counts[1]))
    return _cut_over_all(model, docs, usable, key, text) if len(rows[0]) and len(rows[1]) else model


def _cut_over_all(model: Ranking, docs: DataFrame, usable: DataFrame, key: str, text: str) -> Ranking:
    """The model with the cut and the spread of all labelled documents' scores, both exact.

    The cut lies between the scores on either side of as many rows as are rejected, found by
    a global order. A document counts once for each of its labels. Few labels go to the
    texts; with many, texts are scored where they are and only ids and scores are joined.
    """

    @F.pandas_udf("double")
    def strength(texts: pd.Series) -> pd.Series:
        return pd.Series(model.strength(np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))))

    labels = stage(usable.groupBy("id").agg(F.count("*").alias("times"), F.count_if(F.col("label") == 0).alias("bad")), "quality_labels")
    texts = small_batches(docs).filter(F.col(key).isNotNull() & ~held_out(key)).select(F.col(key).alias("id"), text_or_empty(text).alias("text"))
    if labels.count() * LABEL_BYTES <= BROADCAST_BYTES:
        scored = texts.join(F.broadcast(labels), "id").select(strength("text").alias("strength"), "times", "bad")
    else:
        scored = texts.select("id", strength("text").alias("strength")).join(labels.hint("merge"), "id").select("strength", "times", "bad")
    scored = stage(scored, "quality_strengths")
    total = scored.agg(
        F.sum("bad").alias("bad"), (F.sum(F.col("strength") * F.col("times")) / F.sum("times")).alias("mean"), F.sum("times").alias("rows")
    ).first()
    off = F.col("strength") - F.lit(total["mean"])
    spread = scored.agg(F.sqrt(F.sum(off * off * F.col("times")) / total["rows"])).first()[0]
    ordered, _ = running(scored, [F.col("strength").asc()], ["times"], "quality_order")
    low, high = ordered.filter(
        (F.col("times_before") <= total["bad"]) & (F.col("times_before") + F.col("times") >= total["bad"])
    ).agg(F.min("strength"), F.max("strength")).first()
    return replace(model, cut=(low + high) / 2, spread=spread / 4 or 1.0)


def _features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    return of(text)


def quality_scores(docs: DataFrame, model: Ranking, *, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The input row (or the columns in ``carry``) as ``doc`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    The score depends on the text alone. Null and empty texts have the features of no
    words; equal texts have equal scores; no rows give no rows.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(rows))

    scored = small_batches(docs).select(packed_columns(docs, carry), score(text_or_empty(text)).alias("score"))
    return scored.select("doc", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = quality_scores(docs, model, carry=["doc_id"])
    return scored.select(F.col("doc.doc_id").alias("doc_id"), held_out(F.col("doc.doc_id")).alias("held_out"), "score", "predicted")
