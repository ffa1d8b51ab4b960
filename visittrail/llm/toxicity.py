"""Toxicity from confirmed toxic examples and unlabelled text (non-negative PU learning).

A logistic classifier in numpy over the presence of hashed words. Its risk takes the share of toxic
documents (the class prior) into account: toxic examples stand for the toxic part, and the clean
part's risk is that of unlabelled text less what its toxic part adds; where that difference falls
below zero, the step goes the other way, so that the classifier cannot gain by overfitting.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visittrail.llm.common import kept, plain_words, prepare, utf8

#: Words are hashed to so many features.
FEATURES = 1 << 20
#: At most so many toxic and unlabelled documents are learnt from.
POSITIVES, UNLABELLED = 3000, 9000
#: Features whose share among toxic examples differs by so many standard errors, and how many.
LEAST_Z, MOST_FEATURES = 5.0, 512
FOLDS = 5


@dataclass
class Model:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, features: set[int]) -> float:
        g = self.bias + sum(self.weights[f] for f in features & self.weights.keys())
        return float(1 / (1 + np.exp(-np.clip(g, -40, 40))))


def features_of(text: bytes) -> set[int]:
    return {zlib.crc32(w) % FEATURES for w in set(plain_words(text))}


def in_fold(doc_id: Column) -> Column:
    """True for rows that are never learnt from; a row without an id is one of them."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def nn_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 400,
          rate: float = 0.05, shrink: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that lessen the non-negative risk (logistic loss, Adam steps)."""
    w = np.zeros(positive.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    p = np.hstack([positive, np.ones((len(positive), 1))])
    u = np.hstack([unlabelled, np.ones((len(unlabelled), 1))])
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        at_p, at_u = _sigmoid(p @ w), _sigmoid(u @ w)
        up = p.T @ (at_p - 1) / len(p)  # gradient of the loss of toxic examples as toxic
        down = u.T @ at_u / len(u) - prior * (p.T @ at_p) / len(p)
        clean = _as_clean(u @ w) - prior * _as_clean(p @ w)
        gradient = prior * up + down if clean >= 0 else -down
        gradient = gradient + shrink * np.r_[w[:-1], 0]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        w = w - rate * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _as_clean(x: np.ndarray) -> float:
    return float(np.logaddexp(0, x).mean())


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """A model from each document's distinct features; without examples it gives the prior."""
    prior = float(np.clip(prior, 1e-3, 0.5))
    bias = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(bias)
    n_p, n_u = len(positive), len(unlabelled)
    df_p = np.bincount(np.concatenate(positive), minlength=FEATURES)
    df_u = np.bincount(np.concatenate(unlabelled), minlength=FEATURES)
    share = (df_p + df_u) / (n_p + n_u)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_p + 1 / n_u))
    z = np.abs(df_p / n_p - df_u / n_u) / error
    z[df_p + df_u < 3] = 0
    order = np.argsort(-z, kind="stable")[:MOST_FEATURES]
    chosen = order[z[order] >= LEAST_Z]
    if not len(chosen):
        return Model(bias)
    column = np.full(FEATURES, -1)
    column[chosen] = np.arange(len(chosen))

    def matrix(docs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(docs), len(chosen)))
        for i, own in enumerate(docs):
            at = column[own]
            out[i, at[at >= 0]] = 1
        return out

    weights, bias = nn_pu(matrix(positive), matrix(unlabelled), prior)
    return Model(bias, dict(zip(chosen.tolist(), weights.tolist(), strict=True)))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          toxic: str = "toxic", positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> Model:
    """Learns from rows outside the held-out fold only.

    Toxic examples are documents labelled 1; unlabelled text is a sample of all documents, labels
    unseen; the prior is the share of 1 among labels. Both samples are the documents with the
    smallest hashes of their ids, at most `positives` and `unlabelled` of them. Labels that are
    null, or whose document is missing, are not learnt from; a document labelled twice counts as
    toxic if one of its labels says so.
    """
    prepare(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("toxic"))
    known = known.filter(~in_fold(F.col("id")) & F.col("toxic").isNotNull())
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    order = F.xxhash64(F.col("id").cast("string"))
    p_ids = known.filter("toxic = 1").select("id").distinct().orderBy(order, "id").limit(positives)
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    own = own.filter(~in_fold(F.col("id")))
    u_ids = own.select("id").distinct().orderBy(order, "id").limit(unlabelled)
    wanted = p_ids.withColumn("p", F.lit(1)).join(u_ids.withColumn("u", F.lit(1)), "id", "full")
    rows = own.join(F.broadcast(wanted), "id").select("p", "u", _features(F.col("text")).alias("x"))
    found = rows.toArrow()
    x = found.column("x").to_pylist()
    p, u = found.column("p").to_pylist(), found.column("u").to_pylist()
    x = [np.array(own or [], dtype=np.int64) for own in x]
    return fit([a for a, k in zip(x, p, strict=True) if k],
               [a for a, k in zip(x, u, strict=True) if k], prior or 0.0)


def _features(text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def features(texts: pa.Array) -> pa.Array:
        kept("toxicity", dict)
        return pa.array([sorted(features_of(t)) for t in utf8(texts)], pa.list_(pa.int32()))

    return features(text)


def toxicity(model: Model):
    """A column function: text to score; null and empty texts get that of a text without words."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        kept("toxicity", dict)
        return pa.array([model.score(features_of(t)) for t in utf8(texts)], pa.float64())

    return score


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
           **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, repeated rows included."""
    model = train(docs, labels, text=text, doc_id=doc_id, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), in_fold(F.col(doc_id)).alias("held_out"),
                       toxicity(model)(F.col(text)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def not_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of docs whose text is not scored toxic, all columns as they are."""
    model = train(docs, labels, text=text, **options)
    return docs.filter(toxicity(model)(F.col(text)) < 0.5)
