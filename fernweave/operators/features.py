"""Type routing, null filling, scaling and one-hot encoding: fit, then transform."""

from __future__ import annotations

import math
from itertools import accumulate, groupby, pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.operators.aggregate import distinct_counts
from fernweave.operators.selection import doubles, order_statistics, place

#: Distinct values of a category column.
CATEGORY = (2, 10)
#: What fills a null of each kind.
FILLS = {"number": -1, "string": "-", "category": "empty"}


def routed(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, n, kind): category for 2 to 10 distinct values, else number or string by type."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    kind = F.when(F.col("n").between(*CATEGORY), "category").when(F.col("column_name").isin(numeric), "number").otherwise("string")
    return distinct_counts(df, columns).withColumn("kind", kind)


def cast_kinds(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast by their saved kind: numbers to long, others to string."""
    return df.withColumns({c: F.col(c).try_cast("bigint") if k == "number" else F.col(c).cast("string") for c, k in kinds.items()})


def short_features(df: DataFrame, keys: list[str], longest: int = 30) -> DataFrame:
    """Columns outside the key whose names are not too long."""
    return df.select(*[c for c in df.columns if c in keys or len(c) <= longest])


def null_filled(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Nulls filled by kind: -1 for numbers, a dash for strings, ``empty`` for categories."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(FILLS[k])) for c, k in kinds.items()})


class Scaler:
    """``min_max``, ``standard``, ``max_abs``, ``robust``, ``quantile`` or ``power`` scaling of numeric columns.

    ``fit`` takes one pass for all columns, ``robust`` and ``quantile`` a few histograms. A constant column scales to 0; null
    stays null. ``standard`` uses the population deviation, ``robust`` centres
    at the median, ``quantile`` is the share of fitted quantiles below,
    ``power`` the Yeo-Johnson transform of the best of a grid of exponents.
    """

    QUANTILES, GRID = 100, [x / 4 for x in range(-8, 13)]

    def __init__(self, kind: str, columns: list[str]):
        self.kind, self.columns, self.fitted = kind, columns, {}

    def fit(self, df: DataFrame) -> Scaler:
        if self.kind == "robust":
            self.fitted = order_statistics(df, self.columns, [0.25, 0.5, 0.75])
            return self
        if self.kind == "quantile":
            marks = order_statistics(df, self.columns, [i / self.QUANTILES for i in range(self.QUANTILES + 1)])
            self.fitted = {c: [own if own[0] is not None else None] for c, own in marks.items()}
            return self
        aggs = {
            "min_max": lambda c: [F.min(c), F.max(c)],
            "standard": lambda c: [F.avg(c), F.stddev_pop(c)],
            "max_abs": lambda c: [F.max(F.abs(c))],
            "power": lambda c: [x for e in self.GRID for x in (F.var_pop(self.yeo_johnson(c, e)), F.avg(F.signum(c) * F.log1p(F.abs(c))), F.count(c), F.avg(self.yeo_johnson(c, e)))],
        }[self.kind]
        flat = [(c, a) for c in self.columns for a in aggs(F.col(c).cast("double"))]
        row = df.agg(*[a.alias(f"c{i}") for i, (_, a) in enumerate(flat)]).first()
        for i, (c, _) in enumerate(flat):
            self.fitted.setdefault(c, []).append(row[i])
        if self.kind == "power":
            self.fitted = {c: self._best(v) for c, v in self.fitted.items()}
        return self

    @staticmethod
    def yeo_johnson(c: Column, e: float) -> Column:
        up = F.log1p(c) if abs(e) < 1e-9 else (F.pow(c + 1, F.lit(e)) - 1) / e
        down = -F.log1p(-c) if abs(e - 2) < 1e-9 else -(F.pow(1 - c, F.lit(2 - e)) - 1) / (2 - e)
        return F.when(c >= 0, up).otherwise(down)

    def _best(self, v: list) -> list:
        """Exponent, mean and deviation with the largest log-likelihood of the grid."""
        best = None
        for i, e in enumerate(self.GRID):
            var, logs, n, mean = v[4 * i : 4 * i + 4]
            if var is None or not var > 0 or not math.isfinite(var):
                continue
            like = -n / 2 * math.log(var) + (e - 1) * logs * n
            if best is None or like > best[0]:
                best = (like, e, mean, math.sqrt(var))
        return [1.0, 0.0, None] if best is None else list(best[1:])

    def expression(self, name: str) -> Column:
        c, v = F.col(name).cast("double"), self.fitted[name]
        ratio = lambda top, below: F.when(c.isNotNull(), F.coalesce(top / F.nullif(F.lit(below), F.lit(0.0)), F.lit(0.0)))
        if v[0] is None:
            return F.when(c.isNotNull(), F.lit(0.0))
        if self.kind == "min_max":
            return ratio(c - v[0], float(v[1] - v[0]))
        if self.kind == "standard":
            return ratio(c - v[0], float(v[1]))
        if self.kind == "max_abs":
            return ratio(c, float(v[0]))
        if self.kind == "robust":
            return ratio(c - v[1], float(v[2] - v[0]))
        if v[2] is None:
            return F.when(c.isNotNull(), F.lit(0.0))
        return (self.yeo_johnson(c, v[0]) - v[1]) / v[2]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        if self.kind == "quantile":
            return self._shares(df, suffix)
        return df.withColumns({f"{c}{suffix}": self.expression(c) for c in self.columns})

    def _shares(self, df: DataFrame, suffix: str) -> DataFrame:
        """The share of quantiles below each value, by its place among the distinct ones; the middle of those that equal it."""
        order = lambda x: (math.isnan(x), 0.0 if math.isnan(x) else x)
        share = lambda below, upto: min(1.0, max(0.0, (below + max(upto, below + 1) - 1) / 2 / self.QUANTILES))
        places, values = {}, {}
        for i, c in enumerate(self.columns):
            own = self.fitted[c][0]
            if own is None:
                values[f"{c}{suffix}"] = F.when(F.col(c).isNotNull(), F.lit(0.0))
                continue
            runs = [[float(x) for x in g] for _, g in groupby(sorted(own, key=order), order)]
            ends = [0, *accumulate(len(g) for g in runs)]
            x, at = F.col(f"__x{i}"), F.col(f"__at{i}")
            places[f"__at{i}"] = place(x, [g[0] for g in runs])
            equal = F.get(doubles([g[0] for g in runs]), at - 1) == x
            values[f"{c}{suffix}"] = F.when(
                x.isNotNull(),
                F.when(equal, F.get(doubles([share(a, b) for a, b in pairwise(ends)]), at - 1)).otherwise(F.get(doubles([share(n, n) for n in ends]), at)),
            )
        sides = {f"__x{i}": F.col(c).cast("double") for i, c in enumerate(self.columns)}
        return df.withColumns(sides).withColumns(places).withColumns(values).drop(*sides, *places)

    def state(self) -> dict:
        return {"kind": self.kind, "columns": self.columns, "fitted": self.fitted}

    @classmethod
    def of(cls, state: dict) -> Scaler:
        out = cls(state["kind"], state["columns"])
        out.fitted = state["fitted"]
        return out


class OneHot:
    """A 0/1 column ``<column>_<value>`` for each category seen in ``fit``, in sorted order; others give zeros."""

    def __init__(self, columns: list[str]):
        self.columns, self.categories = columns, {}

    #: Categories of a column at most; a column with more is none of categories, and an error.
    MOST = 1000

    def fit(self, df: DataFrame) -> OneHot:
        """Distinct values are told apart before they are counted, and come to the driver only if they are few."""
        every = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("string").alias("v")) for i, c in enumerate(self.columns)])
        rows = df.select(F.inline(every)).where("v IS NOT NULL").distinct()
        found = rows.limit(self.MOST * len(self.columns) + 1).collect()
        self.categories = {c: sorted(r["v"] for r in found if r["c"] == i) for i, c in enumerate(self.columns)}
        many = [c for c, own in self.categories.items() if len(own) > self.MOST]
        if many or len(found) > self.MOST * len(self.columns):
            raise ValueError(f"more than {self.MOST} categories in {many or self.columns}")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {f"{c}_{v}": F.when(F.col(c).cast("string") == v, 1.0).otherwise(0.0) for c, vs in self.categories.items() for v in vs}
        )

    def state(self) -> dict:
        return {"columns": self.columns, "categories": self.categories}

    @classmethod
    def of(cls, state: dict) -> OneHot:
        out = cls(state["columns"])
        out.categories = state["categories"]
        return out

    def inverse(self, name: str) -> Column:
        """The category whose column is largest, the first of equals; null if all are zero."""
        values = self.categories[name]
        scores = F.array(*[F.col(f"{name}_{v}") for v in values])
        at = F.array_position(scores, F.array_max(scores)).cast("int")
        return F.when(F.array_max(scores) > 0, F.element_at(F.array(*[F.lit(v) for v in values]), at))
