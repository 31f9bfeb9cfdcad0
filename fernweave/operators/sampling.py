"""Samples, splits, slices and row numbers that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernweave.operators.selection import first_by_hash
from fernweave.session import left, shared_dir

#: How many times the limit each class is drawn.
ATTACK_FACTORS = {"SQL_Injection": 1.5, "Cross_Site_Scripting": 1.2, "Path_Traversal": 1.2}


def hash28(*parts: Column) -> Column:
    """28 bits of the MD5 of the joined parts, the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 7), 16, 10).cast("long")


def numbered(df: DataFrame, key: str, name: str = "index") -> DataFrame:
    """Row numbers from 0 in key order, so that no task sees all rows.

    Rows are dealt by ranges of the key and written with their range's number,
    for the ranges are sampled and may differ from run to run; then each range
    is numbered on its own, after the rows of the ranges before it.
    """
    spark = df.sparkSession
    at = shared_dir(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(ranges, key).withColumn("__p", F.spark_partition_id()).write.parquet(at)
    left(spark, at)
    dealt = spark.read.parquet(at)
    sizes = dealt.groupBy("__p").count()  # a row a range
    before = sizes.withColumn("__b", F.coalesce(F.sum("count").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("__p").orderBy(key)) - 1
    return dealt.join(F.broadcast(before.drop("count")), "__p").withColumn(name, (F.col("__b") + rank).cast("long")).drop("__p", "__b")


def bootstrap(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement: (draw, key)."""
    rows = df.agg(F.count("*").alias("c"))
    draws = df.sparkSession.range(n).select(F.col("id").alias("draw"), (hash28(F.lit(seed), F.col("id").cast("string")) % rows.scalar()).alias("index"))
    return draws.join(numbered(df.select(key), key), "index").select("draw", key)


def attack_sample_size(label: str, limit: int) -> int:
    return int(limit * ATTACK_FACTORS.get(label, 1.0))


def class_bootstrap(df: DataFrame, label: str, key: str, limit: int, seed: str, factors: dict[str, float] = ATTACK_FACTORS) -> DataFrame:
    """Rows of each class drawn with replacement, exactly ``limit`` times its factor of it, with their ``draw``.

    Classes are few; their sizes come from the row numbers in (label, key) order.
    """
    rows = numbered(df.where(F.col(label).isNotNull()).withColumn("__k", F.struct(label, key)), "__k", "__i").drop("__k")
    size = F.lit(limit)
    for name, factor in factors.items():
        size = F.when(F.col(label) == name, F.lit(int(limit * factor))).otherwise(size)
    classes = rows.groupBy(label).agg(F.min("__i").alias("first"), F.count("*").alias("n")).withColumn("size", size).where("size > 0")
    draws = classes.select(label, "first", "n", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("draw"))
    at = F.col("first") + hash28(F.lit(seed), F.col(label), F.col("draw").cast("string")) % F.col("n")
    return draws.select("draw", at.alias("__i")).join(rows, "__i").drop("__i")


def split(df: DataFrame, key: str, ratio: float, seed: str) -> DataFrame:
    """Add ``part``: the ``floor(n * ratio)`` rows first by hash are ``train``, the others ``test``; ties by key.

    Nothing is sorted, shuffled or written: the bound is found by histograms.
    Rows that repeat a key are in one part, so there the first may be fewer.
    """
    hashed = df.withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))))
    first = first_by_hash(hashed, "__h", key, share=ratio)
    return hashed.withColumn("part", F.when(first, "train").otherwise("test")).drop("__h")


def refreshed(valid: DataFrame, new: DataFrame, key: str, label: str, seed: str, normal: str = "normal") -> tuple[DataFrame, DataFrame]:
    """The validation set for training that goes on, and the rows of ``new`` left to train on.

    Attacks stay, of the normal rows a half by hash; as many of ``new``, whose rows all count as normal, join them.
    Rows without a label stay like attacks.
    """

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))))

    old = valid.where(F.col(label).eqNullSafe(normal))
    half = old.agg(F.floor(F.count("*") / 2).cast("long").alias("n")).first()["n"]
    own, fresh = hashed(old), hashed(new.withColumn(label, F.lit(normal)))
    taken = first_by_hash(fresh, "__h", key, n=half)
    kept = valid.where(~F.col(label).eqNullSafe(normal))
    for part in (own.where(first_by_hash(own, "__h", key, n=half)), fresh.where(taken)):
        kept = kept.unionByName(part.drop("__h"))
    return kept, fresh.where(~taken).drop("__h")


def slices(df: DataFrame, index: str, tasks: int) -> DataFrame:
    """(task, first, last): equal index ranges, the last taking the remainder."""
    span = df.agg(F.min(index).alias("lo"), F.max(index).alias("hi")).withColumn("bat", F.floor((F.col("hi") - F.col("lo") + 1) / tasks).cast("long"))
    return span.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "lo", "hi", "bat").select(
        "task",
        (F.col("lo") + F.col("task") * F.col("bat")).alias("first"),
        F.when(F.col("task") == tasks - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("task") + 1) * F.col("bat") - 1).alias("last"),
    )


def next_id(df: DataFrame, column: str) -> DataFrame:
    """The largest id plus one; 0 for an empty table."""
    return df.agg((F.coalesce(F.max(column), F.lit(-1)) + 1).alias("next_id"))


def first_per_group(df: DataFrame, by: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in a total order."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("__r") <= n).drop("__r")
