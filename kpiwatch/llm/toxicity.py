"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (P) and a sample of all documents without regard to labels (U) train a
linear classifier over the presence of words and of word beginnings. With prior p, the risk is

    p * R_P(+1) + max(0, R_U(-1) - p * R_P(-1))

(Kiryo et al. 2017): the negative part is estimated from U, corrected by the prior for the toxic
documents that U holds, and kept from going below zero, where it would only overfit. The prior is the
toxic share of all labelled training rows. Labels of rows whose crc32(doc_id as text) mod FOLDS is 0
are held out: never read for training, for the prior or for features.

Only two bounded samples are ever gathered: up to about MOST_POSITIVE and MOST_UNLABELLED documents,
chosen by hash of doc_id; an id that stands in many rows is one of them, with one of its texts. Feature counts over the samples are taken by Spark; the driver sees at most MOST_FEATURES features and,
for each sampled document, the numbers of those it has. Every whole text is scored, in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut

FOLDS = 5
MOST_POSITIVE = 5_000
MOST_UNLABELLED = 10_000
#: Only the features with the highest ratios are kept, this many.
MOST_FEATURES = 1_024
BEGINNINGS = (4, 5, 6, 7)
#: Features enter the model if their rates in P and U differ by this log-likelihood ratio, with P's higher.
LEAST_G2 = 20.0
MODELS = 3
EPOCHS = 40
BATCH = 512
RATE = 0.05
DECAY = 3e-4

_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """The distinct lower-cased words, and their beginnings marked by ^."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*({"^" + w[:k] for w in words if len(w) > k} for k in BEGINNINGS))


@dataclass(frozen=True)
class Model:
    """weights by feature; a text's score is the logistic of `bias` plus the weights of its distinct features."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def score(self, text: str | None) -> float:
        has = self.weights.keys() & features(text)
        # Sorted, as a float sum depends on its order.
        return float(1 / (1 + np.exp(-(self.bias + sum(self.weights[w] for w in sorted(has))))))


def _sampled(df: DataFrame, key: Column, most: int, rows: int) -> DataFrame:
    """Rows whose key hashes below the share that leaves about `most` of `rows` rows."""
    if rows <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(most / rows * (1 << 30)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _losses(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic loss of margin z and its derivative."""
    return np.logaddexp(0, -z), -1 / (1 + np.exp(z))


def fit(pos: list[np.ndarray], unl: list[np.ndarray], words: int, prior: float, seed: int) -> np.ndarray:
    """Weights (the last is the bias) that minimise the non-negative risk, by Adam on mini-batches."""
    rng = np.random.default_rng(seed)
    w = np.zeros(words + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0

    def dense(rows: list[np.ndarray], at: np.ndarray) -> np.ndarray:
        x = np.zeros((len(at), words + 1))
        x[:, -1] = 1
        for i, r in enumerate(at):
            x[i, rows[r]] = 1
        return x

    for _ in range(EPOCHS):
        order = rng.permutation(len(unl))
        for start in range(0, len(order), BATCH):
            xu = dense(unl, order[start : start + BATCH])
            xp = dense(pos, rng.integers(len(pos), size=BATCH))
            fp, fu = xp @ w, xu @ w
            _, dp_pos = _losses(fp)
            lp_neg, dp_neg = _losses(-fp)
            lu_neg, du_neg = _losses(-fu)
            negative = lu_neg.mean() - prior * lp_neg.mean()
            grad_negative = -(du_neg @ xu) / len(xu) + prior * (dp_neg @ xp) / len(xp)
            g = prior * (dp_pos @ xp) / len(xp)
            if negative > 0:
                g += grad_negative
            g[:-1] += DECAY * w[:-1]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, toxic).

    A document is confirmed toxic if any of its training labels is 1. Null labels and ids are
    ignored. Without confirmed examples that `docs` holds, every score is the prior (0 without labels).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return Model(bias=-50.0)
    prior = min(max(n_toxic / n_known, 1e-4), 0.9)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL")
    texts = texts.filter(~held_out(F.col("doc_id")))
    p_ids = F.broadcast(_sampled(known.filter("toxic = 1").select("doc_id"), F.col("doc_id"), MOST_POSITIVE, n_toxic).withColumn("p", F.lit(True)))
    share = MOST_UNLABELLED / max(texts.select("doc_id").count(), MOST_UNLABELLED)
    u = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = texts.withColumn("u", u).join(p_ids, "doc_id", "left").withColumn("p", F.coalesce("p", F.lit(False))).filter("p OR u")
    # Labels and the prior count ids, so an id that stands in many rows is one example: its text of least hash.
    sample = sample.groupBy("doc_id", "p", "u").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("t")).select("doc_id", "p", "u", "t.text")

    @F.pandas_udf("array<string>")
    def present(text: pd.Series) -> pd.Series:
        return text.map(lambda x: sorted(features(x)))

    sample = cut(sample.select("p", "u", F.col("doc_id").alias("row"), present("text").alias("features")))
    n_p, n_u = (x or 0 for x in sample.agg(F.sum(F.col("p").cast("int")), F.sum(F.col("u").cast("int"))).first())
    if not n_p or not n_u:
        return Model(bias=float(np.log(prior / (1 - prior))))
    has = sample.select("row", "p", "u", F.explode("features").alias("feature"))
    rates = has.groupBy("feature").agg(F.sum(F.col("p").cast("int")).alias("a"), F.sum(F.col("u").cast("int")).alias("b"))
    share = (F.col("a") + F.col("b")) / float(n_p + n_u)
    g2 = 2 * (F.col("a") * F.log((F.col("a") + 1e-9) / (n_p * share)) + F.col("b") * F.log((F.col("b") + 1e-9) / (n_u * share)))
    telling = rates.withColumn("g2", g2).filter(F.col("a") * n_u > F.col("b") * n_p).filter(F.col("g2") >= LEAST_G2)
    names = [r.feature for r in telling.orderBy(F.desc("g2"), "feature").limit(MOST_FEATURES).collect()]
    number = {w: i for i, w in enumerate(names)}

    @F.pandas_udf("array<int>")
    def numbers(fs: pd.Series) -> pd.Series:
        return fs.map(lambda x: [number[w] for w in x if w in number])

    rows = sample.select("row", "p", "u", numbers("features").alias("x")).toPandas().sort_values("row")
    pos = [np.asarray(x, int) for x in rows.loc[rows.p, "x"]]
    unl = [np.asarray(x, int) for x in rows.loc[rows.u, "x"]]
    w = np.mean([fit(pos, unl, len(names), prior, seed) for seed in range(MODELS)], axis=0)
    return Model(dict(zip(names, w[:-1].tolist())), float(w[-1]))


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with each whole text's score, 0 to 1; null texts are empty. All columns are kept."""
    of = model.score  # goes with the job: at most MOST_FEATURES features

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(of)

    return docs.withColumn(name, score(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of `docs`. A null doc_id is not held out.

    An empty table gives an empty result; equal texts have equal scores.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = scored(rows, train(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that score below 0.5, with all their columns."""
    return scored(docs, train(docs, labels), "__score").filter("__score < 0.5").drop("__score")
