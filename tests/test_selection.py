"""Exact k-th values by histograms: heavy ties, wide ranges, hot keys, and no table written."""

import math
import random

import numpy as np
import pytest

from fernweave.operators import features, sampling, selection
from fernweave.plans import catalog

SHARES = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame([tuple(None if v is None else float(v) for v in r) for r in zip(*columns.values(), strict=True)], ", ".join(f"{n} double" for n in names)).repartition(5)


@pytest.mark.parametrize("bins, few", [(1024, 1024), (4, 2), (2, 0)])
def test_order_statistics_equal_a_sort(spark, monkeypatch, bins, few):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "FEW", few)
    draw, n = np.random.Generator(np.random.PCG64(2)), 700
    ties = [7.5] * 400 + [7.5000000001] * 100 + list(range(200))
    wide = [float(s * 2.0**e) for s, e in zip(draw.choice([-1, 1], n), draw.integers(-1000, 1000, n), strict=True)]
    near = list(1.0 + np.arange(n) * 2.0**-52)
    columns = dict(ties=ties, wide=wide, near=near, normal=draw.normal(size=n), zeros=[0.0, -0.0] * (n // 2), nulls=[None] * n, one=[None] * (n - 1) + [3.0], whole=draw.integers(0, 9, n))
    found = selection.order_statistics(frame(spark, **columns), list(columns), SHARES)
    for name, values in columns.items():
        own = [v for v in values if v is not None]
        if not own:
            assert found[name] == [None] * len(SHARES)
            continue
        expected = []
        for s in SHARES:
            x, by_size = s * (len(own) - 1), sorted(own)
            low, high = by_size[math.floor(x)], by_size[math.ceil(x)]
            expected.append(low if low == high else low + (high - low) * (x - math.floor(x)))
        assert found[name] == expected, name


def test_infinite_values(spark):
    values = [math.inf, -math.inf, 1.0, 2.0, math.nan]
    found = selection.order_statistics(frame(spark, x=values), ["x"], [0.0, 0.25, 0.5, 0.75, 1.0])["x"]
    assert found[:4] == [-math.inf, 1.0, 2.0, math.inf] and math.isnan(found[4])


def test_a_step_brings_few_counters(spark, monkeypatch):
    sizes, counted = [], selection._counted
    monkeypatch.setattr(selection, "_counted", lambda rows, keys: (lambda r: (sizes.append(len(r)), r)[1])(counted(rows, keys)))
    df = spark.range(200_000).select((selection.F.rand(3) * 1e6).alias("x"))
    found = selection.order_statistics(df, ["x"], [0.25, 0.5, 0.75])["x"]
    assert np.allclose(found, np.quantile([r["x"] for r in df.collect()], [0.25, 0.5, 0.75]), rtol=1e-12)
    assert max(sizes) <= 6 * max(selection.BINS + 1, selection.FEW) and len(sizes) <= 4


def by_sort(keys, seed, ratio):
    import hashlib

    ordered = sorted((hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k) for k in keys)
    return {k for _, k in ordered[: math.floor(len(keys) * ratio)]}


@pytest.mark.parametrize("few", [1024, 1])
@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.95, 1.0])
def test_split_equals_a_sort(spark, monkeypatch, few, ratio):
    monkeypatch.setattr(selection, "FEW", few)
    keys = random.Random(4).sample(range(10_000), 1500)
    parts = sampling.split(spark.createDataFrame([(k,) for k in keys], "k long").repartition(6), "k", ratio, "s").collect()
    assert {r["k"] for r in parts if r["part"] == "train"} == by_sort(keys, "s", ratio)


def test_split_with_a_hot_key_and_nulls(spark):
    rows = [(5,)] * 4000 + [(None,)] * 3 + [(k,) for k in range(100, 300)]
    df = spark.createDataFrame(rows, "k long").repartition(4)
    parts = {(r["k"], r["part"]) for r in sampling.split(df, "k", 0.5, "s").collect()}
    assert len({k for k, _ in parts}) == len(parts) == 202  # copies of a key are in one part
    assert sampling.split(df.limit(0), "k", 0.5, "s").count() == 0


@pytest.mark.parametrize("name", ["split_ratio", "robust_scale", "quantile_scale"])
def test_nothing_is_written(spark, name, monkeypatch):
    for module in (sampling, selection, features):
        if hasattr(module, "shared_dir"):
            monkeypatch.setattr(module, "shared_dir", lambda _: pytest.fail("a table is written"))
    out = catalog.queries()[name](spark, "/root/testdata/sf0.001")
    text = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert out.count() > 0 and "Exchange" not in text


def test_steps_meet_their_bins_without_a_join_and_few_values_take_one_step(spark, monkeypatch):
    plans, counted = [], selection._counted
    monkeypatch.setattr(selection, "_counted", lambda rows, keys: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), counted(rows, keys))[1])
    df = spark.range(20_000).selectExpr("(id % 50 + 1) * 1D AS quantity", "(id % 11) / 100D AS discount", "rand(3) * 1e5 AS price")
    shares = [i / 100 for i in range(101)]
    selection.order_statistics(df, ["quantity", "discount"], shares)
    assert len(plans) == 1
    selection.order_statistics(df, ["quantity", "discount", "price"], shares)
    assert len(plans) > 2 and not any("Join" in p for p in plans)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 8, 100, 202])
def test_place_equals_a_count(spark, n):
    marks = sorted({float(x) for x in np.random.Generator(np.random.PCG64(n)).integers(-60, 60, n)} | set(np.arange(max(n, 1) - 1) + 0.5))[:n]
    marks = [-math.inf, *marks[1:-1], math.nan] if n > 2 else marks
    values = [None, -0.0, 0.0, math.inf, -math.inf, math.nan, *marks, *(m + 1e-9 for m in marks if math.isfinite(m))]
    df = frame(spark, x=values)
    found = df.select("x", selection.place(selection.F.col("x"), marks)).collect()
    at_most = lambda m, x: math.isnan(x) or m <= x
    assert len(found) == len(values) and all(k == (0 if x is None else sum(at_most(m, x) for m in marks)) for x, k in found)


def test_quantile_scaler_equals_a_count_of_its_quantiles(spark):
    """By a binary search, not by a look at every quantile for each row."""
    draw = np.random.Generator(np.random.PCG64(6))
    columns = dict(ties=draw.integers(0, 7, 500), normal=draw.normal(size=500), one=[4.0] * 500, nulls=[None] * 500, odd=[math.nan] * 100 + [-0.0] * 100 + [math.inf, -math.inf] * 100 + [None] * 100)
    df = frame(spark, **columns)
    model = features.Scaler("quantile", list(columns)).fit(df)
    model.fitted["odd"] = [[-math.inf, math.nan, 0.0, 1.0, math.nan, 2.0] + [math.inf] * 95]
    again = features.Scaler.of(model.state())
    out = again.transform(df, "_s")
    assert out.columns == [*columns, *(f"{c}_s" for c in columns)] and "filter(" not in out._jdf.queryExecution().optimizedPlan().toString()
    before = lambda m, x: not math.isnan(m) and (math.isnan(x) or m < x)
    for r in out.collect():
        for c in columns:
            x, marks = r[c], model.fitted[c][0]
            if x is None or marks is None:
                assert r[f"{c}_s"] is None
                continue
            below = sum(before(m, x) for m in marks)
            equal = sum(m == x or (math.isnan(m) and math.isnan(x)) for m in marks)
            assert r[f"{c}_s"] == min(1.0, max(0.0, (below + max(below + equal, below + 1) - 1) / 2 / 100)), (c, x)
