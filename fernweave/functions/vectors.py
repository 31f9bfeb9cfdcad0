"""Array expressions: distances, order, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fernweave.functions.text import column


def squared_distance(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two arrays of one length, summed in order."""
    return F.aggregate(
        F.zip_with(column(a), column(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def total(a: Column | str) -> Column:
    return F.aggregate(column(a), F.lit(0.0), lambda s, x: s + x.cast("double"))


def rounded(x: Column, digits: int) -> Column:
    """A double rounded as SQL does it: scaled as a double, halves away from zero, scaled back.

    ``F.round`` takes the shortest decimal form instead, and so parts from it near halves.
    """
    return F.round(x * 10.0**digits) / 10.0**digits


def argmax_label(scores: Column | str, labels: list[str]) -> Column:
    """The label of the largest score, the first of equals."""
    at = F.array_position(column(scores), F.array_max(column(scores)))
    return F.element_at(F.array(*[F.lit(x) for x in labels]), at.cast("int"))


def pairs(features: Column | str, scores: Column | str) -> Column:
    """Array of (term, score, pos) from two arrays of one length."""
    return F.transform(
        F.arrays_zip(column(features).alias("f"), column(scores).alias("s")),
        lambda x, i: F.struct(x["f"].alias("term"), x["s"].alias("score"), i.alias("pos")),
    )


def by_score(features: Column | str, scores: Column | str, descending: bool = True) -> Column:
    """Pairs ordered by score, ties in their given order."""
    sign = -1 if descending else 1
    keyed = F.transform(
        pairs(features, scores),
        lambda x: F.struct((x["score"] * sign).alias("key"), x["pos"].alias("pos"), x["term"].alias("term"), x["score"].alias("score")),
    )
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["term"].alias("term"), x["score"].alias("score")))
