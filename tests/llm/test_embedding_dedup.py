import numpy as np
import pandas as pd
import pytest
from compare import DATA, of_spark, of_sql
from pyspark.sql import functions as F

from fernweave.llm import embedding_dedup as E


def test_bounds_hold():
    draw = np.random.Generator(np.random.PCG64(0))
    x = draw.normal(size=(300, 16)) * draw.uniform(1e-3, 1e3, (300, 1))
    q, s, n, e = E.quantised(x)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (np.abs(near - u @ u.T) <= n[:, None] * e[None, :] + e[:, None] + E.SLACK).all()


def rows():
    draw = np.random.Generator(np.random.PCG64(2))
    base = draw.normal(size=(12, 8))
    out = []
    for i in range(150):
        v = base[i % 12] + draw.normal(size=8) * 0.12 * (i % 5)
        out.append((i, [float(np.float32(x)) for x in v], i % 3))
    out += [(200 + i, out[0][1], 0) for i in range(4)] + [(300, out[0][1], 1)]
    out += [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] + [1.0] * 7, 0), (403, [float("inf")] + [1.0] * 7, 0), (404, [], 0), (405, [None] + [1.0] * 7, 0)]
    return [*out, (406, out[0][1], None), (407, [1.0, 2.0], 0), (408, [2.0, 4.0], 0), (409, [1e-30] * 8, 2), (410, [2e-30] * 8, 2)]


@pytest.mark.parametrize("tile", [7, 4096])
def test_edges_equal_sql(spark, folder, tile, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    at = folder(embeddings=rows())
    got = E.near_vectors(spark.read.parquet(f"{at}/embeddings.parquet"), least=tile, most=tile)
    assert of_spark(got) == of_sql(E.ORACLE, at)


def test_query_equals_sql(spark):
    assert of_spark(E.op5_embedding_dedup(spark, DATA)) == of_sql(E.ORACLE)


def test_empty_table_and_null_key(spark, folder):
    assert E.op5_embedding_dedup(spark, folder(embeddings=[])).count() == 0
    df = spark.createDataFrame([(None, [1.0], 0, "x"), (1, [1.0], 0, "y")], "vec_id long, embedding array<float>, label int, id string")
    out = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.near_vectors(df).collect()}
    assert out == {None: (0, None, True), 1: (0, 1, True)}


def test_each_pair_of_tiles_stands_once(spark):
    for n in range(1, 9):
        tiles = spark.createDataFrame([("l", 2, i, n) for i in range(n)], "label string, dim int, tile int, tiles int")
        pairs = [tuple(sorted((r["tile"], r["tile2"]))) for r in E.tile_pairs(tiles).collect()]
        assert sorted(pairs) == [(i, j) for i in range(n) for j in range(i, n)]


def test_one_label_of_many_vectors(spark):
    """All of one label, in several tiles, against plain products."""
    draw = np.random.Generator(np.random.PCG64(7))
    x = draw.normal(size=(12_000, 16)).astype(np.float32)
    x[6000:] = x[draw.integers(0, 6000, 6000)] + 0.1 * draw.normal(size=(6000, 16))
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}), "vec_id long, embedding array<float>").withColumn("label", F.lit("one"))
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    n = np.concatenate([(u[i : i + 1000] @ u.T >= E.THRESHOLD).sum(axis=1) - 1 for i in range(0, len(u), 1000)])
    out = {r["vec_id"]: r for r in E.near_vectors(df, least=1000, most=2000).collect()}
    assert [out[i]["n_links"] for i in range(len(x))] == n.tolist() and n.max() > 0
    assert all(out[i]["kept"] == (out[i]["component_id"] == i) for i in out)


def test_repeated_keys_and_components_beyond_squares(spark):
    rows = [(1, [1e200, 1e200], 0), (1, [1e200, 1e200], 0), (2, [3e-200, 3e-200], 0), (3, [5e-324, 0.0], 0), (4, [1e308, 0.0], 0), (5, [-1e308, 1.0], 0)]
    got = E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True)
    ]
