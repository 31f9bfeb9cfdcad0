"""Incremental clustering by a self-organising network with density (E-SOINN).

Training is order-dependent, so it is one sequential task over a bounded sample
of signals; everything that applies a trained network is a DataFrame plan over
all rows: two nearest nodes, thresholds, labels and explanations.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernweave.functions.vectors import squared_distance, total
from fernweave.operators.joins import nearest
from fernweave.session import shared_dir


@dataclass
class Settings:
    """Defaults of the network."""

    max_edge_age: int = 50
    iteration_threshold: int = 200
    c1: float = 0.001
    c2: float = 1.0
    weight: float = 1.0
    seed: int = 0
    patience: int = 0


@dataclass
class Node:
    vector: np.ndarray
    members: list[int]
    wins: int = 1
    periods: int = 1
    density: float = 0.0
    points: float = 0.0
    won: bool = False
    group: int = -1
    age: dict[int, int] = field(default_factory=dict)  # neighbour: age of the edge


class Soinn:
    """The network under training; nodes have ids that stay when others are removed."""

    def __init__(self, settings: Settings | None = None):
        self.settings = settings or Settings()
        self.nodes: dict[int, Node] = {}
        self.next_id = self.seen = 0

    # --- primitives -----------------------------------------------------
    def add_node(self, x: np.ndarray, member: int) -> int:
        x = np.asarray(x, np.float64)
        if x.ndim != 1 or (self.nodes and len(x) != len(next(iter(self.nodes.values())).vector)):
            raise TypeError("a signal is one vector of the network's dimension")
        self.nodes[self.next_id] = Node(x.copy(), [member])
        self.next_id += 1
        return self.next_id - 1

    def connect(self, a: int, b: int, age: int = 1) -> None:
        self.nodes[a].age[b] = self.nodes[b].age[a] = age

    def disconnect(self, a: int, b: int) -> None:
        self.nodes[a].age.pop(b, None)
        self.nodes[b].age.pop(a, None)

    def remove(self, ids: list[int]) -> None:
        for i in ids:
            for j in list(self.nodes[i].age):
                self.disconnect(i, j)
            del self.nodes[i]

    def distances(self, x: np.ndarray, ids: list[int]) -> np.ndarray:
        return ((np.stack([self.nodes[i].vector for i in ids]) - x) ** 2).sum(axis=1)

    def nearest(self, x: np.ndarray, k: int = 2) -> list[tuple[int, float]]:
        """(id, squared distance) of the ``k`` nearest nodes; ties go to the lower id."""
        ids = sorted(self.nodes)
        d = self.distances(x, ids)
        return [(ids[i], float(d[i])) for i in np.argsort(d, kind="stable")[:k]]

    def threshold(self, i: int) -> float:
        """Largest squared distance to a neighbour; without one, that to the nearest other node."""
        node = self.nodes[i]
        if node.age:
            return float(self.distances(node.vector, list(node.age)).max())
        others = [j for j in self.nodes if j != i]
        return float(self.distances(node.vector, others).min()) if others else float("inf")

    # --- one signal -----------------------------------------------------
    def learn(self, x: np.ndarray, member: int) -> bool:
        """Take in one signal; whether a period of ``iteration_threshold`` signals ends with it."""
        x = np.asarray(x, np.float64)
        self.seen += 1
        if len(self.nodes) < 2:
            self.add_node(x, member)
            return False
        (first, d1), (second, d2) = self.nearest(x)
        w = self.settings.weight
        if d1 > self.threshold(first) * w or d2 > self.threshold(second) * w:
            self.add_node(x, member)
        else:
            winner = self.nodes[first]
            for j in list(winner.age):
                self.connect(first, j, winner.age[j] + 1)
            joined, merged = self.wants_edge(first, second)
            if joined:
                self.connect(first, second)
            else:
                self.disconnect(first, second)
            if merged:
                gone = self.nodes[second].group
                for n in self.nodes.values():
                    if n.group == gone:
                        n.group = winner.group
            winner.wins += 1
            if winner.age:
                mean = float(np.sqrt(self.distances(winner.vector, list(winner.age))).mean())
                winner.points += 1 / (1 + mean) ** 2
                winner.density = winner.points / winner.periods if winner.periods else winner.points
            winner.won = winner.won or winner.points > 0
            winner.members.append(member)
            winner.vector += (x - winner.vector) / winner.wins
            for j in winner.age:
                near = self.nodes[j]
                near.vector += (x - near.vector) / (100 * near.wins)
        for i, n in self.nodes.items():
            for j in [j for j, age in n.age.items() if age > self.settings.max_edge_age + 1 and i < j]:
                self.disconnect(i, j)
        if self.seen % self.settings.iteration_threshold == 0 and self.seen > 1:
            self.settle()
            return True
        return False

    def wants_edge(self, a: int, b: int) -> tuple[bool, bool]:
        """Whether to connect two winners, and whether their classes merge by that."""
        ga, gb = self.nodes[a].group, self.nodes[b].group
        if ga < 0 or gb < 0 or ga == gb:
            return True, False
        low = min(self.nodes[a].density, self.nodes[b].density)
        for g in (ga, gb):
            mean, top = self.group_density(g)
            if self.alpha(mean, top) * top < low:
                return True, True
        return False, False

    def group_density(self, group: int) -> tuple[float, float]:
        own = [n.density for n in self.nodes.values() if n.group == group]
        return sum(own) / len(own), max([0.0, *own])

    @staticmethod
    def alpha(mean: float, top: float) -> float:
        return 1.0 if top > 3 * mean else 0.5 if top > 2 * mean else 0.0

    # --- end of a period ------------------------------------------------
    def settle(self) -> None:
        for n in self.nodes.values():
            n.periods += n.won
            n.won = False
        self.subclasses()
        self.remove(self.noise())
        self.classify()

    def subclasses(self) -> None:
        """Groups grown from density peaks down edges along which density does not rise."""
        left, group = set(self.nodes), 0
        while left:
            stack = [max(sorted(left), key=lambda i: self.nodes[i].density)]
            left.discard(stack[0])
            while stack:
                i = stack.pop()
                self.nodes[i].group = group
                for j in self.nodes[i].age:
                    if j in left and self.nodes[j].density <= self.nodes[i].density:
                        left.discard(j)
                        stack.append(j)
            group += 1

    def noise(self) -> list[int]:
        if not self.nodes:
            return []
        mean = float(np.mean([n.density for n in self.nodes.values()]))
        limit = {0: float("inf"), 1: self.settings.c2 * mean, 2: self.settings.c1 * mean}
        return [i for i, n in self.nodes.items() if len(n.age) in limit and n.density < limit[len(n.age)]]

    def classify(self) -> None:
        """Classes are the connected components."""
        left, group = set(self.nodes), 0
        while left:
            stack = [min(left)]
            left.discard(stack[0])
            while stack:
                i = stack.pop()
                self.nodes[i].group = group
                new = left & set(self.nodes[i].age)
                left -= new
                stack += new
            group += 1

    def labels(self, truth: list[str], known: dict[int, str] | None = None) -> dict[int, str]:
        """Label of each node: the members' most frequent, the smallest of equals; with ``known`` (a network
        trained before), its label, and ``normal`` for newer nodes."""
        if known is not None:
            return {i: known.get(i, "normal") for i in self.nodes}
        out = {}
        for i, n in self.nodes.items():
            own = [truth[m] for m in n.members]
            out[i] = min(set(own), key=lambda x: (-own.count(x), x)) if own else ""
        return out

    def predict(self, x: np.ndarray, labels: dict[int, str]) -> str:
        """Label while training: an outlier is an anomaly, otherwise the nearest node's label."""
        near = self.nearest(np.asarray(x, np.float64))
        if any(d > self.threshold(i) * self.settings.weight for i, d in near):
            return "anomaly"
        return labels[near[0][0]]

    def fit(self, x: np.ndarray, truth: list[str], budget: int, valid: tuple[np.ndarray, list[str]] | None = None, known: dict[int, str] | None = None):
        """Train on up to ``budget`` signals: shuffled repetitions of all rows, or draws with replacement for a
        network trained before. Returns (nodes, edges, accuracies) of the best period on ``valid``."""
        draw = np.random.Generator(np.random.PCG64(self.settings.seed))
        best, history = None, []
        left = budget
        while left > 0 and len(x):
            order = draw.permutation(len(x)) if known is None else draw.integers(0, len(x), min(left, 1000))
            for row in order[:left]:
                if self.learn(x[row], int(row)) and self.nodes:
                    labels = self.labels(truth, known)
                    score = float(np.mean([self.predict(v, labels) == t for v, t in zip(*valid, strict=True)])) if valid and len(self.nodes) > 1 else 0.0
                    if best is None or score > max(history):
                        best = (len(history), self.state(labels))
                    history.append(score)
                    if self.settings.patience and len(history) - 1 - best[0] >= self.settings.patience:
                        return (*best[1], history)
            left -= len(order[:left])
        return (*(best[1] if best else self.state(self.labels(truth, known))), history)

    @classmethod
    def of(cls, nodes: list[tuple], edges: list[tuple], settings: Settings | None = None) -> Soinn:
        """A trained network to go on with; its nodes have no members yet."""
        net = cls(settings)
        for i, v, _, group, density, wins, periods, points in nodes:
            net.nodes[i] = Node(np.array(v, np.float64), [], wins, periods, density, points, False, group)
            net.next_id = max(net.next_id, i + 1)
        for a, b, age in edges:
            net.connect(a, b, age)
        return net

    def state(self, labels: dict[int, str]) -> tuple[list[tuple], list[tuple]]:
        nodes = [(i, n.vector.tolist(), labels.get(i, ""), n.group, n.density, n.wins, n.periods, n.points) for i, n in sorted(self.nodes.items())]
        edges = [(i, j, age) for i, n in sorted(self.nodes.items()) for j, age in sorted(n.age.items())]
        return nodes, edges


NODES = "node_id long, node_vec array<double>, label string, class long, density double, wins long, periods long, points double"
EDGES = "src long, dst long, age long"


#: Rows that a network is trained on at most; the reference's training runs have some 320,000.
ROWS = 400_000


def held_out(key: str, share: float = 0.05) -> Column:
    """Whether ``fit`` holds a row out for validation: by hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(1000)) < share * 1000


def fit(
    df: DataFrame,
    key: str,
    vector: str,
    label: str,
    budget: int,
    settings: Settings | None = None,
    holdout: float = 0.05,
    trained: tuple[DataFrame, DataFrame] | None = None,
    most: int = ROWS,
    valid: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a network trained on ``df`` in one task.

    Of more than ``most`` rows, those with the smallest seeded hashes of the key
    are taken, wherever they stand. Rows are taken in key order; a share by hash of the key is held out for the
    choice of the best period, unless ``valid`` has the rows for it. With ``trained`` (nodes and edges, a bounded
    model) training goes on from there. The network is written once and read back.
    """
    settings = settings or Settings()
    before = tuple([tuple(r) for r in part.collect()] for part in trained) if trained else None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("k", ignore_index=True)
        out = pdf["o"]
        x, y = np.stack(pdf["v"].to_numpy()), pdf["l"].tolist()
        train, test = np.flatnonzero(~out), np.flatnonzero(out)
        if not len(train):
            train = test
        net = Soinn.of(*before, settings) if before else Soinn(settings)
        known = {n[0]: n[2] for n in before[0]} if before else None
        nodes, edges, _ = net.fit(x[train], [y[i] for i in train], budget, (x[test], [y[i] for i in test]) if len(test) else None, known)
        return pd.DataFrame({"nodes": [nodes], "edges": [edges]})

    def shaped(part: DataFrame, out: Column) -> DataFrame:
        return part.select(F.lit(0).alias("g"), F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"), F.col(label).cast("string").alias("l"), out.alias("o"))

    rows = shaped(df, held_out(key, holdout) if valid is None else F.lit(False))
    if valid is not None:
        rows = rows.unionByName(shaped(valid, F.lit(True)))
    rows = rows.orderBy(F.xxhash64(F.lit(settings.seed), "k"), "k").limit(most)
    both = rows.groupBy("g").applyInPandas(run, f"nodes array<struct<{NODES.replace(' ', ':').replace(',:', ',')}>>, edges array<struct<{EDGES.replace(' ', ':').replace(',:', ',')}>>")
    at = shared_dir(df.sparkSession)
    both.write.parquet(at)
    both = df.sparkSession.read.schema(both.schema).parquet(at)
    return both.select(F.inline("nodes")), both.select(F.inline("edges"))


def thresholds(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node_id, threshold): the largest squared distance to a neighbour, else to the nearest other node."""
    a, b = nodes.select(F.col("node_id").alias("src"), F.col("node_vec").alias("va")), nodes.select(F.col("node_id").alias("dst"), F.col("node_vec").alias("vb"))
    linked = edges.select("src", "dst").join(a, "src").join(b, "dst").groupBy("src").agg(F.max(squared_distance("va", "vb")).alias("threshold"))
    other = nearest(nodes.select(F.col("node_id").alias("own"), F.col("node_vec").alias("own_vec")), nodes, 2, "own", "own_vec").where("rank = 2")
    alone = other.select(F.col("own").alias("node_id"), F.col("d2").alias("alone"))
    return alone.join(linked, F.col("node_id") == F.col("src"), "left").select("node_id", F.coalesce("threshold", "alone").alias("threshold"))


def _near(df: DataFrame, nodes: DataFrame, edges: DataFrame, key: str, vector: str) -> DataFrame:
    """Each row (key, vector) with ``n1`` and ``n2``, its two nearest nodes, and ``normals``, the vectors of its two
    nearest normal ones.

    The network, a bounded model, is one array with its thresholds and labels, a
    scalar subquery; rows meet it where they are, so nothing is shuffled or
    joined and rows with a null key stay.
    """
    info = nodes.select("node_id", "label", "node_vec").join(thresholds(nodes, edges), "node_id")
    fields = ["node_id", "threshold", "label", "node_vec"]
    model = info.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("model")).scalar()
    far = F.transform("__model", lambda n: F.struct(squared_distance(F.col(vector), n["node_vec"]).alias("d2"), *[n[f].alias(f) for f in fields]))
    return (
        df.select(key, vector, model.alias("__model"))
        .withColumn("__far", F.array_sort(far))
        .select(
            key,
            vector,
            F.get("__far", 0).alias("n1"),
            F.get("__far", 1).alias("n2"),
            F.transform(F.slice(F.filter("__far", lambda n: n["label"] == "normal"), 1, 2), lambda n: n["node_vec"]).alias("normals"),
        )
    )


def predict(df: DataFrame, nodes: DataFrame, edges: DataFrame, key: str, vector: str, weight: float = 1.0) -> DataFrame:
    """(key, ai_label): a zero vector is normal; an outlier next to a normal node is normal, else one beyond the
    weighted thresholds is an anomaly; everything else has the nearest node's label."""
    rows = _near(df, nodes, edges, key, vector)
    beyond = lambda w: (F.col("n1.d2") > F.col("n1.threshold") * w) | (F.col("n2.d2") > F.col("n2.threshold") * w)
    label = (
        F.when(total(vector) == 0, "normal")
        .when(beyond(1.0) & (F.col("n1.label") == "normal"), "normal")
        .when(beyond(1.0) & (F.col("n2.label") == "normal"), "normal")
        .when(beyond(1.0) & beyond(weight), "anomaly")
        .otherwise(F.col("n1.label"))
    )
    return rows.select(key, label.alias("ai_label"))


def explain(df: DataFrame, nodes: DataFrame, edges: DataFrame, key: str, vector: str, features: list[str]) -> DataFrame:
    """(key, outlier, terms): for an outlier the mean difference to the two nearest normal nodes, largest first;
    else the difference to the nearest node, smallest first; only features that are not zero in the signal."""
    rows = _near(df, nodes, edges, key, vector).withColumn(
        "outlier", (F.col("n1.d2") > F.col("n1.threshold")) | (F.col("n2.d2") > F.col("n2.threshold"))
    )
    names = F.array(*[F.lit(f) for f in features])

    def diffs(node: Column) -> Column:
        return F.zip_with(vector, node, lambda a, b: F.abs(a.cast("double") - b))

    count = F.nullif(F.size("normals"), F.lit(0))
    mean = F.transform(
        F.aggregate("normals", F.transform(F.col(vector), lambda _: F.lit(0.0)), lambda s, v: F.zip_with(s, diffs(v), lambda a, b: a + b)), lambda x: x / count
    )

    def named(d: Column, sign: int) -> Column:
        all_ = F.transform(d, lambda x, i: F.struct((x * sign).alias("key"), F.element_at(names, i + 1).alias("feature"), x.alias("diff"), F.element_at(F.col(vector), i + 1).alias("own"), i.alias("pos")))
        kept = F.filter(all_, lambda x: x["own"] != 0)
        if sign < 0:  # equal means come in descending order of names
            order = F.array_sort(kept, lambda a, b: F.when(a["key"] != b["key"], F.when(a["key"] < b["key"], -1).otherwise(1)).otherwise(F.when(a["feature"] > b["feature"], -1).otherwise(1)))
        else:
            order = F.array_sort(kept, lambda a, b: F.when(a["key"] != b["key"], F.when(a["key"] < b["key"], -1).otherwise(1)).otherwise(F.when(a["pos"] < b["pos"], -1).otherwise(1)))
        return F.transform(order, lambda x: F.struct(x["feature"].alias("feature"), x["diff"].alias("diff")))

    return rows.select(key, "outlier", F.when(F.col("outlier"), named(mean, -1)).otherwise(named(diffs(F.col("n1.node_vec")), 1)).alias("terms"))


def close_to(df: DataFrame, nodes: DataFrame, key: str, vector: str, label: str, k: int = 2) -> DataFrame:
    """(key, close): whether one of the ``k`` nearest nodes has the label; within the row, as all that meets a model."""
    model = nodes.agg(F.sort_array(F.collect_list(F.struct("node_id", "label", "node_vec"))).alias("model")).scalar()
    far = F.transform("__model", lambda n: F.struct(squared_distance(F.col(vector), n["node_vec"]).alias("d2"), n["node_id"].alias("node_id"), n["label"].alias("label")))
    near = F.slice(F.array_sort(far), 1, k)
    return df.select(key, vector, model.alias("__model")).select(key, F.exists(near, lambda n: n["label"] == label).alias("close"))


def noise_nodes(nodes: DataFrame, edges: DataFrame, c1: float = 0.001, c2: float = 1.0) -> DataFrame:
    """Ids of nodes with few neighbours for their density."""
    degree = edges.groupBy(F.col("src").alias("node_id")).agg(F.count("*").alias("degree"))
    mean = nodes.agg(F.avg("density").alias("m")).scalar()
    rows = nodes.select("node_id", "density", mean.alias("mean")).join(degree, "node_id", "left").fillna(0, ["degree"])
    few = (F.col("degree") == 0) | ((F.col("degree") == 1) & (F.col("density") < c2 * F.col("mean"))) | ((F.col("degree") == 2) & (F.col("density") < c1 * F.col("mean")))
    return rows.where(few).select("node_id")


def class_density(nodes: DataFrame) -> DataFrame:
    """(class, mean, max density, alpha) of each class."""
    out = nodes.groupBy("class").agg(F.avg("density").alias("mean_density"), F.max("density").alias("max_density"))
    alpha = F.when(F.col("max_density") > 3 * F.col("mean_density"), 1.0).when(F.col("max_density") > 2 * F.col("mean_density"), 0.5).otherwise(0.0)
    return out.withColumn("alpha", alpha)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node_id, root) with the smallest node of each component. Nodes are a bounded model."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf.loc[pdf["dst"].isna(), "src"].astype("int64").tolist()
        root = {i: i for i in ids}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, b in pdf.dropna().astype("int64").itertuples(index=False):
            if a in root and b in root:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        return pd.DataFrame({"node_id": ids, "root": [find(i) for i in ids]})

    both = nodes.select(F.col("node_id").alias("src"), F.lit(None).cast("long").alias("dst")).union(edges.select("src", "dst"))
    return both.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda pdf: run(pdf[["src", "dst"]]), "node_id long, root long")
