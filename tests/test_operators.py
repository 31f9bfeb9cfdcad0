"""Operators on small hand-made frames, edge rows first."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernweave.functions import net
from fernweave.operators import features, fingerprint, joins, metrics, rules, sampling, soinn, vectorize
from fernweave.sources import store

LOG = "logtime timestamp_ntz, src_ip string, dst_ip string, http_method string, http_host string, http_agent string, http_path string, http_query string, http_tenc string, http_server string"


def log_row(at, src="1.1.1.1", agent="a", server="x"):
    return (at, src, "2.2.2.2", "GET", "h", agent, "/p", "q", "-", server)


def test_boundary_row_stands_in_two_slots(spark):
    log = spark.createDataFrame([log_row(datetime(2024, 1, 1, 6)), log_row(datetime(2024, 1, 1, 7))], LOG)
    out = fingerprint.normal_fingerprint(log, [], datetime(2024, 1, 1), datetime(2024, 1, 2), None)
    assert sorted(r["slot"] for r in out.collect()) == [0, 1, 1]


def test_blocked_sources_are_out_and_null_blocks_nothing(spark):
    log = spark.createDataFrame([log_row(datetime(2024, 1, 1, 1), s) for s in ("a", "b")], LOG)
    blocked = spark.createDataFrame([(datetime(2024, 1, 1, 2), "a"), (datetime(2024, 1, 1, 2), None), (datetime(2023, 1, 1), "b")], "logtime timestamp_ntz, src_ip string")
    out = fingerprint.normal_fingerprint(log, [blocked], datetime(2024, 1, 1), datetime(2024, 1, 2), 5)
    assert [r["src_ip"] for r in out.collect()] == ["b"]


def test_network_edges_and_overlaps(spark):
    cidrs = ["10.0.1.0/24", "10.0.1.7/25"]
    nets = net.networks(spark, cidrs)
    table = net.network_ranges(spark.createDataFrame([(c,) for c in [*cidrs, "bad", "10.0.0.1"]], "network string"))
    assert {tuple(r) for r in nets.collect()} == {tuple(r) for r in table.where("network LIKE '%/%'").collect()} and table.count() == 3
    rows = spark.createDataFrame([(1, "10.0.1.0"), (2, "10.0.1.255"), (3, "10.0.2.0"), (4, None), (5, "x")], "k int, ip string")
    out = {r["k"]: r["ip_flag"] for r in joins.network_flags(rows, nets, ["ip"]).collect()}
    assert out == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


@pytest.mark.parametrize("most", [0, 100_000])
def test_networks_wider_than_an_octet(spark, monkeypatch, most):
    monkeypatch.setattr(joins, "BROADCAST_NETWORKS", most)
    nets = net.networks(spark, ["16.0.0.0/4", "17.0.0.0/9", "31.255.0.0/16", "31.255.255.255/32", "200.1.2.3/32", "200.1.2.0/30"])
    ips = ["15.255.255.255", "16.0.0.0", "17.200.0.1", "31.255.255.255", "32.0.0.0", "200.1.2.3", "200.1.2.4", None]
    rows = spark.createDataFrame(list(enumerate(ips)), "k int, ip string")
    out = sorted((r["k"], r["ip_flag"]) for r in joins.network_flags(rows, nets, ["ip"]).collect())
    assert out == list(enumerate([0, 1, 1, 1, 0, 1, 0, 0]))  # each row once


def test_nearest_ties_take_the_lower_node(spark):
    nodes = spark.createDataFrame([(2, [0.0, 1.0]), (1, [0.0, 1.0]), (3, [5.0, 5.0])], "node_id long, node_vec array<double>")
    rows = spark.createDataFrame([(0, [0.0, 0.0])], "k long, v array<double>")
    assert [(r["rank"], r["node_id"]) for r in joins.nearest(rows, nodes, 2, "k", "v").orderBy("rank").collect()] == [(1, 1), (2, 2)]


@pytest.mark.parametrize("kind", ["min_max", "standard", "robust", "quantile", "power"])
def test_constant_column_scales_to_zero(spark, kind):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    out = [r[0] for r in features.Scaler(kind, ["x"]).fit(df).transform(df).collect()]
    assert out[2] is None and out[0] == out[1] and out[0] in (0.0, 0.5)


def test_one_hot_unseen_category(spark):
    hot = features.OneHot(["c"]).fit(spark.createDataFrame([("b",), ("a",)], "c string"))
    out = hot.transform(spark.createDataFrame([("a",), ("z",), (None,)], "c string"))
    assert [tuple(r)[1:] for r in out.collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    assert out.columns == ["c", "c_a", "c_b"]


def test_vector_norm_is_one_or_zero(spark):
    df = spark.createDataFrame([(1, "bot bot head"), (2, "nothing here"), (3, None)], "k int, t string")
    out = vectorize.KeywordTfidf(["bot", "head"]).arrays(df, "t").orderBy("k").collect()
    assert np.allclose(out[0]["score"], [2 / 5**0.5, 1 / 5**0.5]) and out[1]["score"] == [0.0, 0.0] and out[2]["score"] in (None, [0.0, 0.0])


def test_rule_needs_no_other_keyword(spark):
    df = spark.createDataFrame([(["bot"],), (["bot", "union"],), ([],)], "p array<string>").withColumn("l", F.lit("SQL_Injection"))
    out = [r[0] for r in df.select(rules.bypassed(F.col("l"), F.col("p"), ["bot", "union"])).collect()]
    assert out == ["normal", "SQL_Injection", "SQL_Injection"]


def test_version_is_written_once(spark, tmp_path):
    at = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "a int")
    assert store.insert_version(df, at, "v1") and not store.insert_version(df, at, "v1") and store.insert_version(df, at, "v2")
    assert store.versioned(spark, at, "v1").count() == 1
    store.drop_table(spark, at)
    assert not store.exists(spark, at)


def test_vocabulary_csv_and_manifest(spark, tmp_path):
    (tmp_path / "w.txt").write_text(" Bot \n\nhead\n")
    assert [tuple(r) for r in store.vocabulary(spark, str(tmp_path / "w.txt")).orderBy("pos").collect()] == [(0, "bot"), (2, "head")]
    (tmp_path / "a.csv").write_text("hash,n\nx,1\ny,2\n")
    assert store.read_csv(spark, str(tmp_path / "*.csv"), "hash string, n int", "hash", ["x"]).count() == 1
    store.manifest(spark, str(tmp_path / "m"), model_version="v")
    assert store.read_manifest(spark, str(tmp_path / "m")) == {"model_version": "v"}


def test_models_come_back(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, "bot x"), ("b", 3.0, "head")], "c string, x double, t string")
    for i, (model, apply) in enumerate(
        [
            (features.OneHot(["c"]).fit(df), lambda m: m.transform(df)),
            (features.Scaler("robust", ["x"]).fit(df), lambda m: m.transform(df)),
            (vectorize.KeywordTfidf(["bot", "head"], "true").fit(df, "t"), lambda m: m.rows(df, ["c"], "t")),
        ]
    ):
        assert store.save_model(spark, str(tmp_path), f"f{i}", "v1", model.state()) and not store.save_model(spark, str(tmp_path), f"f{i}", "v1", {})
        again = type(model).of(store.load_model(spark, str(tmp_path), f"f{i}", "v1"))
        assert sorted(map(tuple, apply(again).collect())) == sorted(map(tuple, apply(model).collect()))
    store.log_size(df, str(tmp_path / "log"), "t", "2024-01-01")
    store.log_size(df, str(tmp_path / "log"), "t", "2024-01-02")
    assert [r["rows"] for r in spark.read.csv(str(tmp_path / "log"), header=True).collect()] == ["2", "2"]


def test_types_and_names():
    assert store.column_types("prep_number", ["src_ip", "other"]) == {"src_ip": "string", "other": "double"}
    assert store.valid_name("a_1") and not store.valid_name("1a") and not store.valid_name("a-b")


def test_numbers_and_split_cover_all_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    out = sampling.numbered(df.repartition(7), "k").collect()
    assert all(r["k"] == r["index"] for r in out)
    parts = sampling.split(df, "k", 0.95, "s").groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 950, "test": 50}
    assert sampling.bootstrap(df, "k", 2500, "s").count() == 2500


def test_metrics_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a")], "t string, p string")
    out = metrics.weighted(df, "t", "p").first()
    assert out["accuracy"] == 0.5 and abs(out["weighted_f1"] - (2 / 3) / 2) < 1e-12


def test_soinn_steps():
    net_ = soinn.Soinn(soinn.Settings(iteration_threshold=1000))
    for i, x in enumerate([[0.0, 0.0], [4.0, 0.0]]):
        net_.learn(np.array(x), i)
    assert net_.threshold(0) == 16.0
    net_.learn(np.array([1.0, 0.0]), 2)  # within both thresholds: an edge, and both nodes move
    assert net_.nodes[0].age == {1: 1} and net_.nodes[0].wins == 2
    assert np.allclose(net_.nodes[0].vector, [0.5, 0.0]) and np.allclose(net_.nodes[1].vector, [3.97, 0.0])
    assert np.isclose(net_.nodes[0].density, 1 / 25)
    net_.learn(np.array([100.0, 0.0]), 3)  # beyond: a new node, which is noise without neighbours
    assert len(net_.nodes) == 3 and net_.noise()[-1] == 2
    net_.settle()
    assert 2 not in net_.nodes
    assert soinn.Soinn.alpha(1, 4) == 1.0 and soinn.Soinn.alpha(1, 2.5) == 0.5 and soinn.Soinn.alpha(1, 2) == 0.0


def test_soinn_separates_two_clouds():
    draw = np.random.Generator(np.random.PCG64(1))
    x = np.concatenate([draw.normal(0, 0.2, (100, 2)), draw.normal(5, 0.2, (100, 2))])
    y = ["normal"] * 100 + ["attack"] * 100
    nodes, _, history = soinn.Soinn(soinn.Settings(iteration_threshold=50)).fit(x, y, 1000, (x[::10], y[::10]))
    assert {n[2] for n in nodes} == {"normal", "attack"} and len(history) == 20


def test_micro_batches_are_idempotent(spark, tmp_path):
    from fernweave.streaming import micro_batch

    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    for _ in range(2):
        micro_batch.predict_batches(stream, lambda df: df.withColumn("l", F.lit("x")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_versions_stay_strings(spark, tmp_path):
    at = str(tmp_path / "t")
    store.insert_version(spark.createDataFrame([(1,)], "a int"), at, "00000000000001")
    df = store.versioned(spark, at, "00000000000001")
    assert dict(df.dtypes)["version"] == "string" and df.first()["version"] == "00000000000001"
    assert store.versioned(spark, at, "x").count() == 0


def test_half_written_version_is_written_again(spark, tmp_path):
    at, df = str(tmp_path / "t"), spark.createDataFrame([(1,), (2,)], "a int")
    assert store.insert_version(df, at, "v1")
    (tmp_path / "t" / "version=v2").mkdir()
    spark.createDataFrame([(9,)], "a int").coalesce(1).write.parquet(str(tmp_path / "dead"))
    for f in (tmp_path / "dead").glob("*.parquet"):
        f.rename(tmp_path / "t" / "version=v2" / f.name)  # files of a job that never committed
    assert store.insert_version(df, at, "v2") and not store.insert_version(df, at, "v2")
    assert sorted(r["a"] for r in store.versioned(spark, at, "v2").collect()) == [1, 2]


def test_of_two_writers_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    at, df = str(tmp_path / "t"), spark.range(100)
    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda _: store.insert_version(df, at, "v1"), range(4)))
    assert sum(won) == 1 and store.versioned(spark, at, "v1").count() == 100


def test_order_statistics_are_exact(spark):
    draw = np.random.Generator(np.random.PCG64(3))
    x = draw.normal(size=999).round(2).tolist()
    df = spark.createDataFrame([(v, 5.0, None) for v in x] + [(None, None, None)], "x double, y double, z double").repartition(5)
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    found = features.order_statistics(df, ["x", "y", "z"], shares)
    assert np.allclose(found["x"], np.quantile(x, shares)) and found["y"] == [5.0] * 6 and found["z"] == [None] * 6


def test_null_keys_stay_when_rows_meet_a_network(spark):
    nodes = spark.createDataFrame([(1, [0.0, 0.0], "normal"), (2, [9.0, 9.0], "attack")], "node_id long, node_vec array<double>, label string")
    edges = spark.createDataFrame([], "src long, dst long, age long")
    rows = spark.createDataFrame([(None, [9.0, 9.0]), (1, [0.0, 0.1])], "k long, v array<double>")
    assert {r["k"]: r["ai_label"] for r in soinn.predict(rows, nodes, edges, "k", "v").collect()} == {None: "attack", 1: "normal"}


def test_schema_names_and_jdbc(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert store.same_schema(df, {"b": "int", "a": "string"}) and not store.same_schema(df, {"b": "int", "a": "int"})
    assert store.ordered_columns(df, ["b"]).columns == ["b", "a"]


def test_jdbc_reads_a_query(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    spark.range(5).write.format("jdbc").options(url=url, driver=driver, dbtable="T").save()
    got = store.read_jdbc(spark, url, 'SELECT "id" FROM T WHERE "id" > 2', driver=driver)
    assert sorted(r[0] for r in got.collect()) == [3, 4]


def test_jdbc_reads_by_ranges_of_a_key(spark, tmp_path, monkeypatch):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    rows = [(i * 7 - 50, f"r{i}") for i in range(40)] + [(None, "none"), (None, "none"), (-50, "again")]
    spark.createDataFrame(rows, "k long, s string").write.format("jdbc").options(url=url, driver=driver, dbtable="T").save()
    whole = sorted(rows, key=repr)
    for n, parts in ((1, 1), (4, 4), (7, 7), (1000, 5)):
        monkeypatch.setattr(store, "CONNECTIONS", 5 if n == 1000 else 32)
        got = store.read_jdbc(spark, url, "SELECT * FROM T", "k", n, driver=driver)
        assert got.rdd.getNumPartitions() == parts and sorted(map(tuple, got.collect()), key=repr) == whole
    doubles = store.read_jdbc(spark, url, 'SELECT CAST("k" AS DOUBLE) / 3 AS "x", "s" FROM T', "x", 3, driver=driver)
    assert doubles.rdd.getNumPartitions() == 3 and sorted(r["s"] for r in doubles.collect()) == sorted(s for _, s in rows)
    one = store.read_jdbc(spark, url, 'SELECT * FROM T WHERE "k" = -50', "k", 4, driver=driver)
    assert one.rdd.getNumPartitions() == 1 and one.count() == 2
    assert store.read_jdbc(spark, url, 'SELECT * FROM T WHERE "k" > 10000', "k", 4, driver=driver).count() == 0


@pytest.mark.parametrize("low, high, n", [(0, 9, 3), (-5, 5, 4), (1, 2, 8), (0, 1, 2), (3, 1000, 7)])
def test_ranges_cover_each_value_once(low, high, n):
    told = [c.format("x") for c in store.ranges(low, high, n)]
    for x in range(low, high + 1):
        assert sum(eval(f"x {c.replace('AND', 'and')}", {"x": x}) for c in told if "IS" not in c) == 1


def test_many_categories_and_labels_are_refused(spark, monkeypatch):
    monkeypatch.setattr(features.OneHot, "MOST", 3)
    df = spark.createDataFrame([(str(i % 4), "a") for i in range(20)] + [(None, "b")], "c string, d string")
    with pytest.raises(ValueError):
        features.OneHot(["c", "d"]).fit(df)
    assert features.OneHot(["d"]).fit(df).categories == {"d": ["a", "b"]}
    from fernweave.operators import models

    monkeypatch.setattr(models.MultiClass, "LABELS", 3)
    with pytest.raises(ValueError):
        models.MultiClass().fit(df, df, "c")


def test_networks_of_a_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("network\n10.0.0.7/30\n192.168.1.1\nnone\n")
    nets = net.network_ranges(store.read_csv(spark, str(tmp_path / "*.csv"), "network string"))
    assert sorted((r["low"], r["high"]) for r in nets.collect()) == [(167772164, 167772167), (3232235777, 3232235777)]


def test_refreshed_validation(spark):
    valid = spark.createDataFrame([(i, "normal") for i in range(7)] + [(9, "attack"), (10, None)], "k int, label string")
    new = spark.createDataFrame([(i, "x") for i in range(100, 105)], "k int, label string")
    kept, rest = (sorted(map(tuple, p.collect()), key=repr) for p in sampling.refreshed(valid, new, "k", "label", "s"))
    old = [r for r in kept if r[0] < 9]
    assert len(old) == 3 and (9, "attack") in kept and (10, None) in kept and len(kept) == 8
    assert {r[0] for r in kept + rest} - {r[0] for r in old} == {9, 10, *range(100, 105)} and len(rest) == 2
    assert all(label == "normal" for k, label in kept + rest if k >= 100)
    kept, rest = sampling.refreshed(valid, new.limit(0), "k", "label", "s")
    assert kept.count() == 5 and rest.count() == 0
