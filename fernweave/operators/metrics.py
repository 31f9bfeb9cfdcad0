"""Classification metrics from one aggregate of (truth, prediction) counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n) for the pairs that occur."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: list[str]) -> DataFrame:
    """One row a true label in the given order, one count column a predicted label."""
    spark = df.sparkSession
    order = spark.createDataFrame(list(enumerate(labels)), "pos int, truth string")
    counts = confusion(df, truth, predicted).groupBy("truth").pivot("predicted", labels).agg(F.sum("n"))
    return order.join(counts, "truth", "left").fillna(0, labels).select("pos", "truth", *labels)


def per_class(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, support, prec, recall, f1); a ratio without cases is 0."""
    counts = confusion(df, truth, predicted)
    rows = counts.select(F.inline(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"), F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"), F.lit(0).cast("long").alias("hit")),
    )))
    sums = rows.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    out = sums.withColumn("prec", ratio("hit", "called")).withColumn("recall", ratio("hit", "support"))
    f1 = F.coalesce(2 * F.col("prec") * F.col("recall") / F.nullif(F.col("prec") + F.col("recall"), F.lit(0.0)), F.lit(0.0))
    return out.withColumn("f1", f1).select("label", "support", "prec", "recall", "f1", "hit")


def weighted(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1."""
    by = per_class(df, truth, predicted)
    mean = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}")
    return by.agg((F.sum("hit") / F.sum("support")).alias("accuracy"), mean("prec"), mean("recall"), mean("f1"))
