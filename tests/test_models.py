"""Models against plain versions: margins, features, coordinates, the clustering network step by step, a whole run."""

import json
from collections import Counter
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from compare import DATA
from pyspark.sql import functions as F

from fernweave.operators import models, rules, soinn
from fernweave.plans import lifecycle, modelling
from fernweave.sources import http_log, store


def embeddings():
    df = pd.read_parquet(f"{DATA}/embeddings.parquet").sort_values("vec_id", ignore_index=True)
    return df["vec_id"].tolist(), np.stack(df["embedding"].to_numpy()).astype(np.float64), ["normal" if x < 5 else "attack" for x in df["label"]]


def fourier(x, f):
    return np.sqrt(2 / len(f.b)) * np.cos(x @ f.w.T + f.b)


def scores(truth, guess):
    """Accuracy and weighted F1 by plain counts."""
    f1 = 0.0
    for c in set(truth):
        hit = sum(t == g == c for t, g in zip(truth, guess, strict=True))
        prec, rec = hit / max(1, guess.count(c)), hit / truth.count(c)
        f1 += (2 * prec * rec / (prec + rec) if hit else 0.0) * truth.count(c) / len(truth)
    return sum(t == g for t, g in zip(truth, guess, strict=True)) / len(truth), f1


@pytest.mark.parametrize("n", [8, 300])
def test_fourier_features(spark, n):
    """Features are the plain ones, bit for bit the same in batches of any size."""
    f, key, found = models.FourierFeatures(64, n, 10.0), "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    for rows in ("3", "10000"):
        spark.conf.set(key, rows)
        found.append([r["features"].toArray().tolist() for r in models.with_features(modelling._labelled(spark, DATA), "embedding", f).orderBy("vec_id").collect()])
    spark.conf.set(key, before)
    assert found[0] == found[1] and np.allclose(found[0], fourier(embeddings()[1], f))


def test_margins_are_the_library_s(spark):
    f = models.FourierFeatures(64, 64, 10.0)
    rows = models.with_features(modelling._labelled(spark, DATA), "embedding", f).withColumn("label", F.concat("label", (F.col("vec_id") % 2).cast("string")))
    multi = models.MultiClass().fit(rows, rows, "label", restarts=1)
    again = models.Margins.of(json.loads(json.dumps(multi.margins().state())))
    both = multi.predict(rows).withColumn("own", again.label()).orderBy("vec_id").collect()
    x = fourier(embeddings()[1], f)
    plain = [again.labels[i] for i in np.argmax(x @ np.array(again.coefficients).T + again.intercepts, axis=1)]
    assert [r["ai_label"] for r in both] == [r["own"] for r in both] == plain and len(set(plain)) > 1


def test_svm_query_equals_plain_margins(spark):
    _, x, truth = embeddings()
    f = models.FourierFeatures(64, 64, 10.0)
    model = models.fit_binary(models.with_features(modelling._labelled(spark, DATA), "embedding", f), "label", "attack", 10)
    own = models.binary_margins(model, "attack")
    margin = fourier(x, f) @ np.array(own.coefficients[0]) + own.intercepts[0]
    row = modelling.rff_svm(spark, DATA).first()
    assert np.allclose((row["accuracy"], row["weighted_f1"]), scores(truth, ["attack" if m > 0 else "normal" for m in margin]))


def test_recheck_denies_only_its_own_class(spark):
    df = spark.createDataFrame([("a", [1.0]), ("a", [-1.0]), ("b", [-1.0]), ("normal", [1.0])], "l string, v array<double>")
    df = df.withColumn("features", models.array_to_vector("v"))
    out = df.select(models.rechecked(F.col("l"), {"a": models.Margins(["a"], [[2.0]], [0.5])}).alias("n")).collect()
    assert [r["n"] for r in out] == ["a", "normal", "b", "normal"]


def test_coordinates_up_to_sign(spark):
    _, x, _ = embeddings()
    got = np.array([r["pca"] for r in modelling.pca_coordinates(spark, DATA).orderBy("vec_id").collect()])
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    plain = x @ axes[:2].T
    for k in range(2):
        assert np.allclose(got[:, k], plain[:, k], atol=1e-6) or np.allclose(got[:, k], -plain[:, k], atol=1e-6)


class Plain:
    """The network in plain lists and a matrix of ages (0: no edge); nodes are numbered anew when some go."""

    def __init__(self, period, most_age, c1, c2):
        self.period, self.most_age, self.c1, self.c2 = period, most_age, c1, c2
        self.v, self.members, self.wins, self.periods, self.points, self.density, self.won, self.group = [], [], [], [], [], [], [], []
        self.age, self.seen = np.zeros((0, 0), int), 0

    def add(self, x, m):
        for own, new in zip((self.v, self.members, self.wins, self.periods, self.points, self.density, self.won, self.group), (x.copy(), [m], 1, 1, 0.0, 0.0, False, -1), strict=True):
            own.append(new)
        self.age = np.pad(self.age, ((0, 1), (0, 1)))

    def sq(self, a, b):
        return float(((a - b) ** 2).sum())

    def limit(self, i):
        near = [j for j in range(len(self.v)) if self.age[i, j]]
        return max(self.sq(self.v[i], self.v[j]) for j in near) if near else min((self.sq(self.v[i], self.v[j]) for j in range(len(self.v)) if j != i), default=np.inf)

    def wants(self, a, b):
        if self.group[a] < 0 or self.group[b] < 0 or self.group[a] == self.group[b]:
            return True, False
        low = min(self.density[a], self.density[b])
        for g in (self.group[a], self.group[b]):
            own = [d for d, h in zip(self.density, self.group, strict=True) if h == g]
            mean, top = sum(own) / len(own), max(own)
            alpha = 0.0 if top <= 2 * mean else 0.5 if top <= 3 * mean else 1.0
            if low > alpha * top:
                return True, True
        return False, False

    def learn(self, x, m):
        self.seen += 1
        if len(self.v) < 2:
            return self.add(x, m)
        order = sorted(range(len(self.v)), key=lambda i: (self.sq(x, self.v[i]), i))
        a, b = order[:2]
        if self.sq(x, self.v[a]) > self.limit(a) or self.sq(x, self.v[b]) > self.limit(b):
            self.add(x, m)
        else:
            near = self.age[a] > 0
            self.age[a, near] += 1
            self.age[near, a] += 1
            edge, merge = self.wants(a, b)
            self.age[a, b] = self.age[b, a] = int(edge)
            if merge:
                old = self.group[b]
                self.group = [self.group[a] if g == old else g for g in self.group]
            self.wins[a] += 1
            near = np.flatnonzero(self.age[a])
            if len(near):
                mean = np.mean([self.sq(self.v[a], self.v[j]) ** 0.5 for j in near])
                self.points[a] += 1 / (1 + mean) ** 2
                self.density[a] = self.points[a] / self.periods[a]
                self.won[a] = True
            self.members[a].append(m)
            self.v[a] = self.v[a] + (x - self.v[a]) / self.wins[a]
            for j in near:
                self.v[j] = self.v[j] + (x - self.v[j]) / (100 * self.wins[j])
        self.age[self.age > self.most_age + 1] = 0
        if self.seen % self.period == 0:
            self.periods = [p + w for p, w in zip(self.periods, self.won, strict=True)]
            self.won = [False] * len(self.v)
            mean, degree = np.mean(self.density), (self.age > 0).sum(axis=1)
            stay = [i for i, d in enumerate(self.density) if not (degree[i] == 0 or (degree[i] == 1 and d < self.c2 * mean) or (degree[i] == 2 and d < self.c1 * mean))]
            for name in ("v", "members", "wins", "periods", "points", "density", "won", "group"):
                setattr(self, name, [getattr(self, name)[i] for i in stay])
            self.age = self.age[np.ix_(stay, stay)]
            self.group, g = [-1] * len(stay), 0
            for i in range(len(stay)):
                if self.group[i] < 0:
                    todo = [i]
                    while todo:
                        k = todo.pop()
                        if self.group[k] < 0:
                            self.group[k] = g
                            todo += [j for j in range(len(stay)) if self.age[k, j]]
                    g += 1


@pytest.mark.parametrize("most_age", [3, 50])
def test_network_equals_plain_replay(most_age):
    """Node by node and edge by edge, after several periods with noise, merges and edges that grow old."""
    draw = np.random.Generator(np.random.PCG64(11))
    x = np.concatenate([draw.normal(c, 0.6, (150, 3)) for c in (0, 2, 7)])
    settings = soinn.Settings(max_edge_age=most_age, iteration_threshold=60, c1=0.2)
    net, plain = soinn.Soinn(settings), Plain(60, most_age, 0.2, 1.0)
    old = 0
    for step, i in enumerate(draw.integers(0, len(x), 1500)):
        net.learn(x[i], int(i))
        before = (plain.age > 0).sum()
        plain.learn(x[i], int(i))
        old += (plain.age > 0).sum() < before
        own = [n for _, n in sorted(net.nodes.items())]
        assert len(own) == len(plain.v), step
    number = {i: k for k, i in enumerate(sorted(net.nodes))}
    assert np.allclose([n.vector for n in own], plain.v) and [n.members for n in own] == plain.members
    assert [n.wins for n in own] == plain.wins and [n.periods for n in own] == plain.periods
    assert np.allclose([n.density for n in own], plain.density) and np.allclose([n.points for n in own], plain.points)
    assert [n.group for n in own] == plain.group and len(own) > 3 and old
    edges = {(number[i], number[j]): age for i, n in net.nodes.items() for j, age in n.age.items()}
    assert edges == {(int(i), int(j)): plain.age[i, j] for i, j in zip(*np.nonzero(plain.age), strict=True)} and edges


def test_fit_query_equals_a_plain_run(spark):
    """The query's nodes are those of the network trained directly on all rows but the held-out ones."""
    ids, x, truth = embeddings()
    hashed = modelling._labelled(spark, DATA).select("vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(1000)).alias("h"))
    out = {r["vec_id"]: r["h"] < 50 for r in hashed.collect()}
    train, test = [i for i, k in enumerate(ids) if not out[k]], [i for i, k in enumerate(ids) if out[k]]
    nodes, _, _ = soinn.Soinn(soinn.Settings(patience=5)).fit(x[train], [truth[i] for i in train], 2000, (x[test], [truth[i] for i in test]))
    got = sorted(tuple(r) for r in modelling.soinn_fit(spark, DATA).select("node_id", "label", "class", "wins").collect())
    assert got == sorted((n[0], n[2], n[3], n[5]) for n in nodes)


def test_saved_network_goes_on_as_it_was():
    draw = np.random.Generator(np.random.PCG64(2))
    x, settings = draw.normal(size=(300, 4)), soinn.Settings(iteration_threshold=50)
    net = soinn.Soinn(settings)
    for i in range(200):
        net.learn(x[i], i)
    again = soinn.Soinn.of(*net.state({}), settings)
    again.seen, again.next_id = net.seen, net.next_id
    for i, n in net.nodes.items():
        again.nodes[i].won = n.won
    for i in range(200, 300):
        net.learn(x[i], i)
        again.learn(x[i], i)
    plain = lambda s: [(n[0], np.round(n[1], 9).tolist(), *np.round(n[3:], 9).tolist()) for n in s.state({})[0]]
    assert plain(net) == plain(again) and net.state({})[1] == again.state({})[1]


def test_run_equals_plain_steps(spark):
    """Labels of a whole run, recomputed row by row from what it stored."""
    config = lifecycle._run(spark, DATA)
    read = lambda t: store.versioned(spark, config.path(t), lifecycle.VERSION).collect()
    load = lambda n: store.load_model(spark, config.path("classifier"), n, lifecycle.VERSION)
    collected = Counter(r["label"] for r in read("collect"))
    assert collected["SQL_Injection"] == 300 and collected["Cross_Site_Scripting"] == 240 and collected["normal"] > 0
    f, multi = lifecycle.fourier(config), load("multi")
    nodes = {r["node_id"]: (np.array(r["node_vec"]), r["label"]) for r in read("nodes")}
    ages = {(r["src"], r["dst"]) for r in read("edges")}
    sq = lambda a, b: float(((a - b) ** 2).sum())

    def limit(i):
        near = [sq(nodes[i][0], nodes[j][0]) for j in nodes if (i, j) in ages]
        return max(near) if near else min((sq(nodes[i][0], nodes[j][0]) for j in nodes if j != i), default=np.inf)

    limits = {i: limit(i) for i in nodes}
    got = {r["index"]: r["ai_label"] for r in read("result")}
    rows = read("prep_predict")
    assert len(got) == len(rows) > 0
    for r in rows:
        v = np.array(r["score"][: len(config.keywords)])
        x = fourier(v[None, :], f)[0]
        label = multi["labels"][int(np.argmax(np.array(multi["coefficients"]) @ x + multi["intercepts"]))]
        if label != "normal":
            own = load(f"binary_{label}")
            label = label if float(np.array(own["coefficients"][0]) @ x + own["intercepts"][0]) > 0 else "normal"
        present = [w for w, s in zip(config.keywords, v, strict=True) if s > 0]
        anti = [w for w in rules.ANTI_WORDS.get(label, []) if w in config.keywords]
        if present and anti and set(present) <= set(anti):
            label = rules.EXPOSURE if set(present) & set(rules.EXPOSURE_WORDS) else "normal"
        if label == "normal" and v.sum() != 0:
            near = sorted(nodes, key=lambda i: (sq(v, nodes[i][0]), i))[:2]
            beyond = any(sq(v, nodes[i][0]) > limits[i] for i in near)
            label = "anomaly" if beyond and all(nodes[i][1] != "normal" for i in near) else "normal"
        assert got[r["index"]] == label, r
    again = lifecycle.second_prediction(spark, config, lifecycle.VERSION, one_model=True).collect()
    assert {r["index"]: r["esoinn_label"] for r in again} == {k: v for k, v in got.items() if v != "anomaly"}
    log, day = http_log.http_log(spark, DATA), lifecycle.TRAIN_END - timedelta(days=1)
    attacks = lifecycle._attacks(log)
    found = lifecycle.second_training(log, [], attacks, ["SQL_Injection"], day, lifecycle.TRAIN_END, config, lifecycle.VERSION).collect()
    assert sorted(r["index"] for r in found) == list(range(len(found)))
    counts = Counter(r["label"] for r in found)
    assert set(counts) == {"normal", "SQL_Injection"} and counts["SQL_Injection"] == attacks.where("label = 'SQL_Injection'").count()


def test_network_of_a_version_goes_on_with_the_next(spark, tmp_path):
    draw = np.random.Generator(np.random.PCG64(5))
    config = lifecycle.Config(str(tmp_path), ["a", "b"], signals=600, iterations=5, restarts=1, fourier=8)
    for version, far in (("v1", 4.0), ("v2", 8.0)):
        rows = [(i, (draw.normal(size=2) + far * (i % 2)).tolist(), "normal" if far > 4 or i % 2 == 0 else "SQL_Injection") for i in range(400)]
        store.insert_version(spark.createDataFrame(rows, "index long, score array<double>, label string"), config.path("prep_collect"), version)
    lifecycle.train(spark, config, "v1")
    lifecycle.transfer(spark, config, "v2", "v1")
    read = lambda t, v: store.versioned(spark, config.path(t), v).collect()
    old, new = (Counter(r["label"] for r in read("valid", v)) for v in ("v1", "v2"))
    assert old["normal"] > 1 and new == {"normal": old["normal"] // 2 * 2, "SQL_Injection": old["SQL_Injection"]}
    first, second = ({r["node_id"]: r["label"] for r in read("nodes", v)} for v in ("v1", "v2"))
    assert set(second.values()) <= {"normal", "SQL_Injection"} and max(second) > max(first)
    assert all(second[i] == first[i] for i in set(first) & set(second))
    assert all(second[i] == "normal" for i in set(second) - set(first) if i > max(first))


def test_flags_of_detections(spark):
    rows = lifecycle.lifecycle_blocked(spark, DATA).collect()
    for r in rows:
        a, b = r["src_ip"].split("."), r["dst_ip"].split(".")
        assert r["src_ip_flag"] == int(a[:3] == ["10", "0", "0"] and int(a[3]) < 128)
        assert r["dst_ip_flag"] == int(b[:3] == ["192", "168", "0"] and int(b[3]) < 4)
        assert r["ai_label"] != "normal"


def test_cascade_query_equals_plain_steps(spark):
    ids, x, truth = embeddings()
    f = models.FourierFeatures(64, 64, 10.0)
    rows = models.with_features(modelling._labelled(spark, DATA), "embedding", f)
    multi = models.MultiClass().fit(rows, rows, "label", restarts=1).margins()
    first = [multi.labels[i] for i in np.argmax(fourier(x, f) @ np.array(multi.coefficients).T + multi.intercepts, axis=1)]
    nodes, edges = soinn.fit(rows, "vec_id", "embedding", "label", 1000)
    second = {r["vec_id"]: r["ai_label"] for r in soinn.predict(rows, nodes, edges, "vec_id", "embedding").collect()}
    final = [second[k] if g == "normal" else g for k, g in zip(ids, first, strict=True)]
    row = modelling.cascade(spark, DATA).first()
    accuracy, _ = scores(truth, final)
    assert np.isclose(row["accuracy"], accuracy)
