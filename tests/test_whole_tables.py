"""Registered queries use all rows of their tables, whatever their ids are."""

import numpy as np
from compare import DATA

from fernweave.operators import soinn
from fernweave.plans import lifecycle, modelling


def test_sink_stores_all_rows_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lifecycle, "shared_dir", lambda _: str(tmp_path))
    lifecycle.idempotent_sink(spark, DATA)
    stored = sorted(map(tuple, lifecycle.store.versioned(spark, str(tmp_path / "docs"), "20240101000000", ["doc_id", "lang"]).collect()))
    assert stored == sorted(map(tuple, spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()))


def clouds(spark, tmp_path, start):
    """600 vectors with ids from ``start``: normal ones, then, from the 500th, others far away."""
    draw = np.random.Generator(np.random.PCG64(1))
    rows = [(start + i, draw.normal(9.0 * (i >= 500), 0.2, 64).tolist(), 9 * (i >= 500)) for i in range(600)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    return str(tmp_path)


def test_network_sees_late_rows(spark, tmp_path):
    at = clouds(spark, tmp_path, 0)
    for query in (modelling.soinn_fit, modelling.soinn_transfer):
        assert "attack" in {r["label"] for r in query(spark, at).collect()}


def test_networks_of_high_ids_only(spark, tmp_path):
    at = clouds(spark, tmp_path, 1000)
    assert modelling.soinn_fit(spark, at).count() and modelling.soinn_transfer(spark, at).count()
    assert modelling.cascade(spark, at).first()["weighted_f1"] > 0


def test_sample_is_bounded_and_no_prefix(spark):
    df = spark.range(1000).selectExpr("id", "array(id * 1.0D, 0.0D) v", "'normal' l")
    nodes, _ = soinn.fit(df, "id", "v", "l", 100, holdout=0, most=20)
    values = [r["node_vec"][0] for r in nodes.collect()]
    assert 1 < len(values) <= 20 and max(values) > 500
