"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Vectors are compared within a label (and a length). Equal vectors are collapsed
first. Each label's vectors are dealt into tiles, larger ones for more vectors,
of ``TILE_BYTES`` at most; a tile holds unit vectors as 8-bit integers with a scale, and for each vector the norm
of what rounding left over. For unit vectors u, v with quantised forms p, q,

    |u.v - p.q| = |p.(v - q) + (u - p).v| <= |p| |v - q| + |u - p|,

so the integer product tells for most pairs on which side of the threshold they
are. Only pairs within the bound of it are computed in double precision. The
pairs of tiles are listed by number, each tile with itself and with half of the
others in turn, and meet the two tiles by joins on (label, tile), so that no key
gathers a label. A pair of tiles gives back each vector's number of links and a
spanning forest of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernweave.llm.common import Scratch, bounded_batches, components, table, written

#: Cosine of a link (fixed by the contract).
THRESHOLD = 0.93
#: Vectors of a tile at least (if the label has as many) and at most, tiles that a label's vectors make before tiles grow,
#: bytes of a tile about, and vectors of a block of the product.
LEAST, MOST, TILES, TILE_BYTES, BLOCK = 4096, 16_384, 16, 4 << 20, 1024
#: Labels whose sizes are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 100_000
#: Slack above all rounding of double precision sums here.
SLACK = 1e-9
#: Pairs that are computed in double precision at once.
PAIRS = 1 << 15


def tamed(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, which changes no direction, so that no square leaves the range of doubles."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit rows, their scales, the norms of the quantised rows and the norms of the errors, for rows of doubles."""
    x = tamed(x)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    p = q * scale[:, None]
    return q, scale, np.linalg.norm(p, axis=1), np.linalg.norm(u - p, axis=1)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two matrices in double precision."""
    x, y = tamed(x), tamed(y)
    return np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))


def merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest indices of the components of ``root``'s forest after the edges (a, b) are added."""
    a, b = root[a], root[b]
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        if np.array_equal(before, root):
            return root


def links(x: np.ndarray, y: np.ndarray | None, threshold: float):
    """Yield arrays (rows of x, rows of y) of the pairs with a cosine of at least ``threshold``; y None: pairs in x."""
    left = quantised(x)
    right = left if y is None else quantised(y)
    full = x if y is None else y
    # Integer products of this length are exact in single precision.
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    for i in range(0, len(x), BLOCK):
        q, s, n, e = (v[i : i + BLOCK] for v in left)
        for j in range(i if y is None else 0, len(full), BLOCK):
            r, t, _, f = (v[j : j + BLOCK] for v in right)
            near = (q.astype(kind) @ r.astype(kind).T).astype(np.float64) * s[:, None] * t[None, :]
            bound = n[:, None] * f[None, :] + e[:, None] + SLACK
            if y is None and i == j:
                near[np.tril_indices(len(q), 0, len(r))] = -2
            sure = near - bound >= threshold
            a, b = np.nonzero(sure)
            yield a + i, b + j
            a, b = np.nonzero((near + bound >= threshold) & ~sure)
            for k in range(0, len(a), PAIRS):
                c, d = a[k : k + PAIRS] + i, b[k : k + PAIRS] + j
                close = cosines(x[c], full[d]) >= threshold
                yield c[close], d[close]


def compared(unit: dict, threshold: float) -> pd.DataFrame:
    """Links of one pair of tiles, or of one tile: id, number of links (copies counted), smallest id of its tree."""
    dim, kind = int(unit["dim"]), unit["kind"]
    read = lambda c: np.frombuffer(unit[c], kind).astype(np.float64).reshape(-1, dim)
    x = read("vectors")
    ids, copies = np.frombuffer(unit["ids"], "<i8"), np.frombuffer(unit["copies"], "<i8")
    y, shift = None, 0
    if unit["tile"] != unit["tile2"]:
        y, shift = read("vectors2"), len(ids)
        ids = np.concatenate((ids, np.frombuffer(unit["ids2"], "<i8")))
        copies = np.concatenate((copies, np.frombuffer(unit["copies2"], "<i8")))
    n, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for a, b in links(x, y, threshold):
        if len(a):
            b = b + shift
            np.add.at(n, a, copies[b])
            np.add.at(n, b, copies[a])
            root = merged(root, a, b)
    low = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(low, root, ids)
    has = n > 0
    return pd.DataFrame({"id": ids[has], "n": n[has], "low": low[root][has]})


def tile_pairs(tiles: DataFrame) -> DataFrame:
    """(label, dim, tile, tile2) of all pairs of a label's tiles, each once, from (label, dim, tile, tiles).

    A tile meets itself and the ``tiles // 2`` after it in a circle, so that all have as many pairs.
    """
    n = F.col("tiles")
    last = F.when((n % 2 == 0) & (F.col("tile") >= n / 2), F.floor(n / 2) - 1).otherwise(F.floor(n / 2)).cast("int")
    ahead = F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0))))
    return tiles.withColumn("ahead", ahead).select("label", "dim", "tile", F.pmod(F.col("tile") + F.col("ahead"), n).cast("int").alias("tile2"))


def near_vectors(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """For each row of ``df``: key, ``n_links``, ``component_id``, ``kept``.

    Vectors that are null, empty or zero, or hold null or non-finite
    components, link with nothing; so do rows with a null label or key, and
    vectors of different lengths. Rows with equal vectors link with each other.
    Components of any size count, also those whose squares no double holds.
    ``component_id`` is the smallest key that links reach (null for a null
    key, which is kept). Rows that repeat a key count as rows and share a
    component. An empty table gives an empty one.
    """
    v = F.col("v")
    good = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & (F.coalesce(F.size(v), F.lit(0)) > 0)
        & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists(v, lambda x: x != 0)
    )
    rows = df.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{label}`").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
    ).withColumn("good", F.coalesce(good, F.lit(False)))
    hashed = {"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")}
    rows = written(rows.withColumns({k: F.when(F.col("good"), c) for k, c in hashed.items()}).drop("good"))
    scratch = Scratch(df.sparkSession)
    classes = scratch.written(
        rows.where("h1 is not null")
        .groupBy("label", "h1", "h2")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )
    # Tiles are as the rows have them: 4 or 8 bytes a component.
    kind = "<f4" if df.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    fit = F.greatest(F.lit(256), F.lit(TILE_BYTES) / F.greatest(F.col("dim") * int(kind[2]), F.lit(1)))
    size = F.least(F.greatest(F.col("n") / TILES, F.lit(least)), F.lit(most), fit)
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    sizes = scratch.written(sizes.select("label", "dim", F.ceil(F.col("n") / size).cast("int").alias("tiles")))
    few = sizes.count() <= BROADCAST_LABELS
    dealt = classes.join(F.broadcast(sizes) if few else sizes, ["label", "dim"])
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    packed_schema = "label {}, dim int, tile int, tiles int, ids binary, copies binary, vectors binary".format(
        classes.schema["label"].dataType.simpleString()
    )

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf[["label", "dim", "tile", "tiles"]].iloc[:1].copy()
        out["ids"], out["copies"] = [pdf["id"].to_numpy("<i8").tobytes()], [pdf["copies"].to_numpy("<i8").tobytes()]
        out["vectors"] = [np.concatenate(list(pdf["v"])).astype(kind).tobytes()]
        return out

    packed = scratch.written(
        dealt.select("label", "dim", "tile", "tiles", "id", "copies", "v").groupBy("label", "dim", "tile").applyInPandas(pack, packed_schema)
    )
    blobs = ["ids", "copies", "vectors"]
    other = packed.select("label", "dim", F.col("tile").alias("tile2"), *[F.col(c).alias(f"{c}2") for c in blobs])
    own = packed.select("label", "dim", "tile", *blobs)
    pairs = scratch.written(tile_pairs(packed.select("label", "dim", "tile", "tiles")))
    # Each row is a unit of work: a pair of tiles, in partitions of their own where there are many.
    units = pairs.hint("shuffle_merge").join(own, ["label", "dim", "tile"]).hint("shuffle_merge").join(other, ["label", "dim", "tile2"]).drop("label")
    bounded_batches(df.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for unit in frame.to_dict("records"):
                yield compared(unit | {"kind": kind}, threshold)

    found = scratch.written(units.mapInPandas(run, "id long, n long, low long"))
    labels = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")), scratch)
    named = written(
        classes.select("label", "h1", "h2", "id", "copies")
        .join(found.groupBy("id").agg(F.sum("n").alias("n")), "id", "left")
        .join(labels, "id", "left")
        .select(
            F.col("label").alias("l"),
            F.col("h1").alias("g1"),
            F.col("h2").alias("g2"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    scratch.drop()
    joined = rows.drop("v").join(named, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & (F.col("label") == F.col("l")), "left")
    own = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == own)).alias("kept"),
    )


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(a, b) AS (
  SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), least AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
), degree AS (
  SELECT a, count(*) AS n FROM link GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN least m ON m.a = e.vec_id
"""

QUERIES = {"op5_embedding_dedup": op5_embedding_dedup}
ORACLES = {"op5_embedding_dedup": ORACLE}
