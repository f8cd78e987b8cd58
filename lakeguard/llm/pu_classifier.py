"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train an additive model with the
non-negative unbiased risk: pi * R+(positives) + max(0, R-(unlabelled) - pi *
R-(positives)), with logistic losses.  pi, the share of positives in the text,
is estimated from the training labels.  Where the bracket turns negative, its
gradient is followed upwards, as the method has it.

A text's features are statistics of its whole content, measured once per
document.  They are cut into bins at quantiles drawn from mergeable sketches
over all training documents; the model adds one weight per bin.

Every training document is unlabelled data.  They are dealt to shards by a hash
of their id; in each of ROUNDS rounds every shard takes LOCAL_STEPS steps on its
own documents from the common weights, and the new common weights are the mean
of the shards' weights by their documents.  A shard holds about SHARD_DOCS
feature vectors, and only sums of weights (one number per bin) reach the driver.
Of the labelled documents at most MAX_LABELLED of either class (by a hash of the
id, so reruns agree) are gathered: the positives of the risk, and both for the
last step, which maps margins to probabilities with two numbers.

Defined cases: null and empty texts have all features 0 and get a score like
any other; labels that are null are ignored; of several labels of one id the
largest counts; a null doc_id is scored but never a training row; without any
positive the score is the prior (0.5 if there are no labels at all); an empty
table gives an empty result; rows that share an id are one training document
(the smallest vector) and scored each; other columns are kept or ignored, under
any name.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeguard.llm.common import WORD, discard, made, map_rows, materialise, shared, small_batches

MAX_LABELLED = 4000
SHARD_DOCS = 8000
BINS = 16
ROUNDS, LOCAL_STEPS = 5, 60
STEP = 0.05
DECAY = 1e-4
FOLDS = 5
THRESHOLD = 0.3   # fixed value of the contract

_WORD = re.compile(WORD)
_RUN = re.compile(r"(\S)\1{3,}")


def features(text: str | None) -> list[float]:
    """Statistics of a whole text, each free of its length where a rate says more."""
    text = text or ""
    words = _WORD.findall(text)
    n, chars = max(len(words), 1), max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    tops = counts.most_common(2)
    letters = upper = digits = spaces = marks = 0
    for char, times in Counter(text).items():
        if char.isalpha():
            letters += times
            upper += times * char.isupper()
        elif char.isdigit():
            digits += times
        elif char.isspace():
            spaces += times
        elif char not in ".,":
            marks += times
    repeats = sum(c for c in pairs.values() if c > 1)
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    ended = sum(w[-1] in ".!?" for w in words)
    shouted = sum(w.isupper() and len(w) > 1 for w in words)
    signed = sum(not unicodedata.category(w[-1]).startswith("L") and w[-1] not in ".," for w in words)
    bare = sum(not any(c.isalpha() for c in w) for w in words)
    return [float(x) for x in (
        np.log1p(len(words)), sum(map(len, words)) / n, letters / chars, upper / max(letters, 1), digits / chars,
        spaces / chars, marks / chars, len(counts) / n, len(counts) / n ** 0.7, repeats / n, adjacent / n,
        (tops[0][1] if tops else 0) / n, (tops[1][1] if len(tops) > 1 else 0) / n, ended / n, shouted / n, signed / n,
        bare / n, 1 - len(set(lines)) / max(len(lines), 1), len(words) / max(len(lines), 1), len(_RUN.findall(text)) / n,
        max(map(len, words), default=0))]


N_FEATURES = len(features(""))


_INNER = [i / BINS for i in range(1, BINS)]
_TAILS = [0.005, 0.02, 0.98, 0.995]      # junk lies beyond the inner quantiles


class AdditiveModel:
    """Bin edges per feature, one weight per bin, and the map from margins to probabilities."""

    def __init__(self, edges: list[np.ndarray]):
        self.edges = edges
        self.starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
        self.weights = np.zeros(self.starts[-1] + 1)      # the last one is the bias
        self.scale, self.shift = 1.0, 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([self.starts[j] + np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.weights[bins].sum(axis=1) + self.weights[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * self.margin(self.bins(x)) + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def descend(model: AdditiveModel, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Weights after LOCAL_STEPS full-batch Adam steps on the non-negative risk of binned positives and unlabelled rows."""
    start, size = model.weights, len(model.weights)
    first, second = np.zeros(size), np.zeros(size)

    def gradient(bins, slope, weight):
        share = slope * weight / len(bins)
        out = np.bincount(bins.ravel(), np.repeat(share, bins.shape[1]), size)
        out[-1] = share.sum()
        return out

    for t in range(1, LOCAL_STEPS + 1):
        mp, mu = model.margin(p), model.margin(u)
        sp, su = sigmoid(mp), sigmoid(mu)
        negative_risk = np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()
        of_negatives = gradient(u, su, 1.0) - gradient(p, sp, prior)
        step = gradient(p, sp - 1, prior) + of_negatives if negative_risk >= 0 else -of_negatives
        step[:-1] += DECAY * model.weights[:-1]
        first, second = 0.9 * first + 0.1 * step, 0.999 * second + 0.001 * step ** 2
        model.weights = model.weights - STEP * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    end, model.weights = model.weights, start
    return end


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift that turn margins into probabilities of label 1, by logistic regression on smoothed labels."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    unit = max(float(np.abs(margins).mean()), 1e-9)
    x = np.column_stack([margins / unit, np.ones(len(margins))])
    w = np.zeros(2)
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - goal) + 1e-3 * w)
        w = w - np.clip(step, -2, 2)
    return float(w[0]) / unit, float(w[1])


class Constant:
    def __init__(self, value: float):
        self.value = value

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def fold(doc_id) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (the columns ``keep``) and the features ``x`` of every whole text, written once."""
    rows = map_rows(docs, keep, lambda texts: {"x": [features(t) for t in texts]},
                    {"x": pa.list_(pa.float32())}, "x array<float>")
    return materialise(rows, "features")


def training_rows(measured: DataFrame) -> DataFrame:
    """(doc_id, x) of the training folds, one row for each id."""
    rows = measured.select(F.col("row.doc_id").alias("doc_id"), "x")
    rows = rows.where(F.col("doc_id").isNotNull() & (fold("doc_id") != 0)).groupBy("doc_id").agg(F.min("x").alias("x"))
    return materialise(rows, "training")


def bin_edges(rows: DataFrame) -> list[np.ndarray]:
    """Distinct quantiles of every feature, from sketches that are merged over all tasks."""
    shares = F.array(*[F.lit(q) for q in sorted({*_INNER, *_TAILS})])
    found = rows.agg(*[F.percentile_approx(F.col("x")[j], shares, F.lit(2000)).alias(f"q{j}") for j in range(N_FEATURES)]).first()
    return [np.unique(np.array(found[f"q{j}"], float)) for j in range(N_FEATURES)]


def labelled(rows: DataFrame, known: DataFrame, value: int) -> np.ndarray:
    """Feature vectors of at most MAX_LABELLED training documents with this label, by a hash of the id."""
    some = known.where(F.col("y") == value).select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(MAX_LABELLED)
    found = rows.join(some, "doc_id", "left_semi").orderBy("doc_id").toArrow()
    return np.array(found.column("x").to_pylist(), np.float32).reshape(-1, N_FEATURES)


def local_steps(common):
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        model, p, prior = common()
        u = model.bins(np.stack(batch["x"].to_list()))
        return pd.DataFrame({"n": [len(u)], "w": [descend(model, p, u, prior).tolist()]})

    return run


def fit(rows: DataFrame, positives: np.ndarray, prior: float) -> AdditiveModel:
    """Minimise the risk over all of ``rows`` by rounds of steps within shards and means over them."""
    spark = rows.sparkSession
    model = AdditiveModel(bin_edges(rows))
    p = model.bins(positives)
    n_shards = max(1, -(-rows.count() // SHARD_DOCS))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(n_shards)).alias("shard"), "x")
    for _ in range(ROUNDS):
        # One number per bin, and at most MAX_LABELLED short vectors.
        done = dealt.groupBy("shard").applyInPandas(local_steps(shared(spark, (model, p, prior))), "n long, w array<double>")
        # Sums of decimals, so that reruns agree whatever the order of the shards.
        mean = (done.select("n", F.posexplode("w").alias("i", "v")).groupBy("i")
                .agg((F.sum((F.col("v") * F.col("n")).cast("decimal(38,9)")) / F.sum("n")).cast("double").alias("v")))
        found = mean.orderBy("i").toArrow()
        model.weights = found.column("v").to_numpy()
    return model


def train(measured: DataFrame, labels: DataFrame, label: str = "quality"):
    """Model of ``label`` from the training folds (fold 0 is held out) of ``featured`` documents."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
             .groupBy("doc_id").agg(F.max(label).alias("y")))
    found = known.agg(F.count("*").alias("n"), F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("p")).first()
    if not found["n"]:
        return Constant(0.5)
    prior = (found["p"] + 1) / (found["n"] + 2)
    if not found["p"]:
        return Constant(prior)
    spark, already = measured.sparkSession, made()
    rows = training_rows(measured)
    positives, negatives = labelled(rows, known, 1), labelled(rows, known, 0)
    if not len(positives):
        return Constant(prior)
    model = fit(rows, positives, prior)
    if len(negatives):
        margins = model.margin(model.bins(np.vstack([positives, negatives])))
        model.scale, model.shift = calibrate(margins, np.repeat([1, 0], [len(positives), len(negatives)]))
    discard(spark, already)      # the model holds no row
    return model


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    measured = featured(docs, ["doc_id"])
    model = shared(spark, train(measured, labels, label))
    schema = T.StructType([measured.schema["row"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model().score(x), pa.float64())], names=["row", "score"])

    scored = measured.mapInArrow(run, schema).select("row.doc_id", "score")
    return scored.select("doc_id", (F.coalesce(fold("doc_id"), F.lit(-1)) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their own columns.

    Texts are measured again for that, so that no copy of them is written beside the features.
    """
    spark = docs.sparkSession
    small_batches(spark)
    already = made()
    model = shared(spark, train(featured(docs, ["doc_id"]), labels, label))
    discard(spark, already)

    def fn(texts):
        x = np.array([features(t) for t in texts], np.float32).reshape(-1, N_FEATURES)
        return {"score": model().score(x).tolist()}

    scored = map_rows(docs, docs.columns, fn, {"score": pa.float64()}, "score double")
    return scored.where(F.col("score") >= THRESHOLD).select("row.*")
