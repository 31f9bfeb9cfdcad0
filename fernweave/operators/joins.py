"""Join operators. Strategy is Spark's choice unless a side's size is bounded by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fernweave.functions.net import ip_number
from fernweave.functions.vectors import squared_distance

#: Rows of a network list that is broadcast; a longer one is joined on the first two octets by a shuffle.
BROADCAST_NETWORKS = 100_000


def anti(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Rows without a partner; null keys on the right are ignored, on the left they stay."""
    right = other.select(*keys).dropna().distinct()
    return df.join(right, list(keys), "left_anti")


def semi(df: DataFrame, other: DataFrame, *keys: str) -> DataFrame:
    """Rows with a partner, each once."""
    return df.join(other.select(*keys).dropna().distinct(), list(keys), "left_semi")


def inner(keys: list[str], *frames: DataFrame) -> DataFrame:
    """Frames joined on all keys."""
    out = frames[0]
    for other in frames[1:]:
        out = out.join(other, keys)
    return out


def filled_from(df: DataFrame, other: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Left join; ``name`` is the right side's ``column``, or this side's where it is null."""
    right = other.select(*keys, F.col(column).alias("__right"))
    return df.join(right, keys, "left").withColumn(name, F.coalesce("__right", column)).drop("__right")


def cut(ranges: DataFrame, name: str, bits: int) -> DataFrame:
    """Ranges (low, high) cut where the address's first bits change: ``name`` has these, ``bits`` are left behind them."""
    size = 1 << bits
    parts = ranges.select(F.explode(F.sequence(F.shiftright("low", bits), F.shiftright("high", bits))).alias(name), "low", "high")
    start = F.col(name) * size
    return parts.select(name, F.greatest("low", start).alias("low"), F.least("high", start + (size - 1)).alias("high"))


def disjoint(nets: DataFrame) -> DataFrame:
    """Networks merged into ranges (octet1, low, high) that do not overlap; wider ones are cut at each first octet."""
    nets = cut(nets, "octet1", 24)
    order = Window.partitionBy("octet1").orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = nets.withColumn("new", F.when(F.col("low") > F.coalesce(before, F.lit(-1)), 1).otherwise(0))
    numbered = begun.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("octet1", "run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("run")


def network_flags(df: DataFrame, nets: DataFrame, addresses: list[str]) -> DataFrame:
    """Add ``<address>_flag``: 1 if the address lies in any network, else 0.

    Overlapping networks are merged first, so an address meets one range at
    most: by its first two octets, then by range. Rows of ``df`` are not shuffled
    while the list is short enough for a broadcast, which is checked.
    """
    ranges = cut(disjoint(nets), "block", 16)  # 65,536 rows more than networks at most
    side = F.broadcast(ranges) if nets.count() <= BROADCAST_NETWORKS else ranges
    out = df
    for a in addresses:
        own = side.select(F.col("block").alias("__o"), F.col("low").alias("__l"), F.col("high").alias("__h"))
        out = out.withColumn("__n", ip_number(a))
        met = (F.shiftright("__n", 16) == F.col("__o")) & F.col("__n").between(F.col("__l"), F.col("__h"))
        out = out.join(own, met, "left").withColumn(f"{a}_flag", F.col("__l").isNotNull().cast("int")).drop("__n", "__o", "__l", "__h")
    return out


def substring_join(df: DataFrame, terms: DataFrame, keys: list[str], text: str, term: str) -> DataFrame:
    """Pairs with equal keys whose text holds the term (as a substring); empty terms match nothing."""
    return df.join(terms, keys).where((F.col(term) != "") & F.expr(f"instr({text}, {term}) > 0"))


def nearest(df: DataFrame, nodes: DataFrame, k: int, key: str, vector: str, node: str = "node_id", node_vector: str = "node_vec") -> DataFrame:
    """The ``k`` nearest nodes of each row by squared distance, ties to the smaller node: key, rank, node, d2.

    The model's nodes are one array, a scalar subquery, so that no pair of rows
    is shuffled; ``nodes`` must be a bounded model, not data.
    """
    model = nodes.agg(F.sort_array(F.collect_list(F.struct(F.col(node).alias("node"), F.col(node_vector).alias("vec")))).alias("model"))
    return (
        df.select(key, vector, model.scalar().alias("model"))
        .withColumn("near", F.transform("model", lambda n: F.struct(squared_distance(F.col(vector), n["vec"]).alias("d2"), n["node"].alias("node"))))
        .select(key, F.posexplode(F.slice(F.array_sort("near"), 1, k)).alias("rank", "n"))
        .select(key, (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.node").alias(node), F.col("n.d2").alias("d2"))
    )


def with_clusters(raw: DataFrame, found: DataFrame, keys: list[str], one_model: bool = False, label: str = "ai_label") -> DataFrame:
    """Raw rows with the label that clustering gave them, for a second model.

    Anomalies are out, and normal rows too unless one model is to see all.
    """
    out = ["anomaly"] if one_model else ["anomaly", "normal"]
    own = found.where(~F.col(label).isin(out)).select(*keys, F.col(label).alias("esoinn_label"))
    return raw.join(own, keys)
