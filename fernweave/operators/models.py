"""Supervised models: random Fourier features with linear margins, and the cascade around them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernweave.functions.vectors import argmax_label
from fernweave.operators.aggregate import most_frequent_pair
from fernweave.operators.metrics import weighted
from fernweave.session import left, shared_dir


class FourierFeatures:
    """cos(Wx + b) of a Gaussian kernel of the given scale; W and b are drawn from a seed."""

    def __init__(self, dim: int, n: int, scale: float, seed: int = 0):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.w = draw.normal(size=(n, dim)) / scale
        self.b = draw.uniform(0, 2 * np.pi, n)


def with_features(df: DataFrame, vector: str, fourier: FourierFeatures) -> DataFrame:
    """Append ``features``, an ML vector: a product in Arrow batches, whatever the number of weights.

    Each row's sums are taken in one order, so they do not depend on the batch it comes in.
    """
    w, b = fourier.w, fourier.b

    @F.pandas_udf("array<double>")
    def mapped(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()).astype(np.float64) if len(v) else np.zeros((0, w.shape[1]))
        dot = np.einsum("ij,kj->ik", x, w, optimize=False)
        return pd.Series(list(np.sqrt(2 / len(b)) * np.cos(dot + b)))

    return df.withColumn("features", array_to_vector(mapped(F.col(vector))))


class Margins:
    """Linear margins as plain numbers, one for each label, which can be kept and applied within the row.

    With one margin the label is the first if it is positive, else ``other``; with
    several it is that of the largest.
    """

    def __init__(self, labels: list[str], coefficients: list[list[float]], intercepts: list[float], other: str = "normal"):
        self.labels, self.coefficients, self.intercepts, self.other = labels, coefficients, intercepts, other

    def margins(self, features: str = "features") -> Column:
        own = vector_to_array(F.col(features))
        rows = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in w]).alias("w"), F.lit(float(b)).alias("b")) for w, b in zip(self.coefficients, self.intercepts, strict=True)])
        return F.transform(rows, lambda r: F.aggregate(F.zip_with(own, r["w"], lambda a, c: a * c), r["b"], lambda s, x: s + x))

    def label(self, features: str = "features") -> Column:
        if len(self.labels) == 1:
            return F.when(F.get(self.margins(features), 0) > 0, self.labels[0]).otherwise(self.other)
        return argmax_label(self.margins(features), self.labels)

    def state(self) -> dict:
        return {"labels": self.labels, "coefficients": self.coefficients, "intercepts": self.intercepts, "other": self.other}

    @classmethod
    def of(cls, state: dict) -> Margins:
        return cls(state["labels"], state["coefficients"], state["intercepts"], state["other"])


def rechecked(label: Column, checks: dict[str, Margins], features: str = "features") -> Column:
    """A label that a class's own model denies becomes what that model says; classes without one stay."""
    out = label
    for name, check in checks.items():
        out = F.when(label == name, check.label(features)).otherwise(out)
    return out


def binary_margins(model, wanted: str, other: str = "normal") -> Margins:
    """The margin of a fitted ``fit_binary``."""
    return Margins([wanted], [model.coefficients.toArray().tolist()], [float(model.intercept)], other)


def fit_binary(df: DataFrame, label: str, wanted: str, iterations: int = 30):
    """One class against all others; expects ``features``."""
    rows = df.withColumn("y", (F.col(label) == wanted).cast("double"))
    return LinearSVC(featuresCol="features", labelCol="y", maxIter=iterations, predictionCol="p", rawPredictionCol="raw").fit(rows)


class MultiClass:
    """One-versus-rest margins; restarts with more iterations until the weighted F1 on ``valid`` suffices."""

    #: The stopping target and the most restarts.
    TARGET, RESTARTS = 0.925, 30
    #: Labels at most.
    LABELS = 1000

    def fit(self, train: DataFrame, valid: DataFrame, label: str, iterations: int = 5, restarts: int | None = None) -> MultiClass:
        found = train.select(label).distinct().limit(self.LABELS + 1).collect()
        if len(found) > self.LABELS:
            raise ValueError(f"more than {self.LABELS} labels")
        self.labels = sorted((r[0] for r in found), key=lambda x: (x is not None, x))
        # Written once: features of a lost executor are read again, not computed again for each of the fits.
        at = shared_dir(train.sparkSession)
        self._indexed(train, label).select("y", "features").write.parquet(at)
        left(train.sparkSession, at)
        rows = train.sparkSession.read.parquet(at)
        best = -1.0
        for k in range(restarts or self.RESTARTS):
            model = OneVsRest(classifier=LinearSVC(maxIter=iterations + 5 * k), featuresCol="features", labelCol="y", predictionCol="p").fit(rows)
            f1 = weighted(self._named(model.transform(valid)), label, "ai_label").first()["weighted_f1"]
            if f1 > best:
                best, self.model = f1, model
            if f1 > self.TARGET:
                break
        return self

    def _indexed(self, df: DataFrame, label: str) -> DataFrame:
        return df.withColumn("y", (F.array_position(F.array(*[F.lit(x) for x in self.labels]), F.col(label)) - 1).cast("double"))

    def _named(self, df: DataFrame) -> DataFrame:
        return df.withColumn("ai_label", F.element_at(F.array(*[F.lit(x) for x in self.labels]), F.col("p").cast("int") + 1)).drop("p")

    def predict(self, df: DataFrame) -> DataFrame:
        return self._named(self.model.transform(df))

    def margins(self) -> Margins:
        own = self.model.models
        return Margins(self.labels, [m.coefficients.toArray().tolist() for m in own], [float(m.intercept) for m in own])


def pca_coordinates(df: DataFrame, key: str, vector: str, k: int = 2) -> DataFrame:
    """(key, pca): each row's first ``k`` principal coordinates, for plots."""
    rows = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(rows)
    return model.transform(rows).select(key, vector_to_array("p").alias("pca"))


def label_map(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """For each true label the most frequent prediction."""
    return most_frequent_pair(df, truth, predicted)
