"""Aggregates beyond the built-in ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_union(c: Column | str) -> Column:
    """Aggregate: the distinct elements of the arrays of a group, in order."""
    return F.sort_array(F.array_distinct(F.flatten(F.collect_set(c))))


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def most_frequent_pair(df: DataFrame, by: str, value: str) -> DataFrame:
    """For each ``by`` the most frequent ``value``, the smallest of equals, with its count."""
    counts = value_counts(df, by, value)
    smallest = counts.groupBy(by, "n").agg(F.min(value).alias(value))
    return smallest.groupBy(by).agg(F.max_by(value, "n").alias(value), F.max("n").alias("n"))


def mode_label(c: Column | str) -> Column:
    """Aggregate: the most frequent value, the smallest of equals."""
    return F.mode(c, True)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n): distinct values of each column, nulls not counted; one pass over the table."""
    row = df.agg(*[F.countDistinct(c).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    return row.select(F.inline(pairs))


def nonzero_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, rate): share of rows in which a column is not zero; null counts as not zero, as a missing number does."""
    row = df.agg(*[F.avg(F.when(F.col(c) == 0, 0.0).otherwise(1.0)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("rate")) for c in columns])
    return row.select(F.inline(pairs))


def most_wanted(df: DataFrame, columns: list[str], label: str, n: int) -> DataFrame:
    """The ``n`` features with the largest rate among attacks or among all rows; ties by name."""
    both = nonzero_rates(df.where(F.col(label) != "normal"), columns).union(nonzero_rates(df, columns))
    best = both.groupBy("feature").agg(F.max("rate").alias("rate"))
    return best.orderBy(F.desc("rate"), "feature").limit(n)


def status_ratios(df: DataFrame, keys: list[Column | str], code: str) -> DataFrame:
    """Shares of status families by group: the code's text holds 10, 20, ... or is a dash."""
    share = lambda p: F.avg(F.when(F.contains(F.col(code), F.lit(p)), 1.0).otherwise(0.0))
    families = [("info_st", "10"), ("succ_st", "20"), ("redir_st", "30"), ("cler_st", "40"), ("serer_st", "50")]
    return df.groupBy(*keys).agg(
        F.countDistinct("dst_port").alias("dst_port_cnt"),
        *[share(p).alias(name) for name, p in families],
        F.avg(F.when(F.col(code) == "-", 1.0).otherwise(0.0)).alias("oth_st"),
    )
