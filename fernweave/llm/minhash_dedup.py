"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct word 5-grams, each a 64-bit fingerprint.
Circulant MinHash (Li and Li, 2021) needs two permutations only: the first
scatters the shingles over ``SLOTS`` places, the second, shifted circularly by
k, gives the k-th coordinate of the signature. The coordinates of a shingle so
are a slice of one array, and a signature is the minimum over slices.

Signatures are cut into bands; documents that agree in a band are candidates.
At the threshold the bands miss one pair in a million. Texts with equal sets
are collapsed first. Then candidates are verified on full sets, in units of
bounded size that compare all their members at once and give back a spanning
forest of the links found, never the pairs:

* buckets of few members are merged by their smallest member;
* larger ones are cut into tiles; each tile meets the bucket's first tile. Then
  the members outside the bucket's largest component, cut into tiles of their
  own, meet each other and all of that component: what is in it already is not
  compared again.

Components of the forests are found by distributed star contraction.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import Scratch, bounded_batches, components, held, mapped, table, written

#: Words of a shingle, and the similarity of a link in percent.
WIDTH, PERCENT = 5, 85
#: Bands and coordinates of a band: a pair at 0.85 is missed with probability (1 - 0.85 ** 6) ** 30 < 1e-6.
BANDS, ROWS = 30, 6
#: Places that shingles are scattered over.
SLOTS = 1 << 21
#: Members of a bucket that is merged with others, members of a tile, and shingles of a tile about.
FEW, TILE, TILE_SHINGLES = 16, 512, 400_000
#: Keys (8 bytes each) that are broadcast; more are joined by a shuffle of the texts.
BROADCAST_IDS = 1_000_000
#: Buckets (20 bytes each) that are broadcast to find their members; more are joined by a shuffle of the band keys.
BROADCAST_BUCKETS = 300_000


def mixed(z: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct fingerprints of the word ``width``-grams of UTF-8 text with A-Z lower-cased.

    Fewer words give their whole sequence as one shingle, none an empty set.
    ``bytes.split`` parts at space and U+0009..U+000D, ``bytes.lower`` changes A-Z only.
    """
    words = text.lower().split() if text else []
    n = len(words)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    size = min(n, width)
    if not size:
        return h
    with np.errstate(over="ignore"):
        out = np.full(n - size + 1, size, np.uint64)
        for k in range(size):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k : n - size + 1 + k])
    return np.unique(out)


class CirculantMinHash:
    """Signatures of ``n`` coordinates from one permutation before and one shifted permutation after."""

    def __init__(self, n: int, seed: int = 1, slots: int = SLOTS):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.slots = slots
        self.first = draw.permutation(slots).astype(np.int32)
        second = draw.permutation(slots).astype(np.uint32)
        self.shifted = np.lib.stride_tricks.sliding_window_view(np.concatenate((second, second[: n - 1])), n)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        at = self.first[(shingles % np.uint64(self.slots)).astype(np.int64)]
        low = self.shifted[at[:2048]].min(axis=0)
        for i in range(2048, len(at), 2048):
            np.minimum(low, self.shifted[at[i : i + 2048]].min(axis=0), out=low)
        return low


def hasher(n: int) -> CirculantMinHash:
    return held(("minhash", n), lambda: CirculantMinHash(n))


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band, which tells its number too."""
    parts = signature.reshape(bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = mixed(np.arange(1, bands + 1, dtype=np.uint64))
        for k in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key.view(np.int64)


SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("f1", T.LongType()),
        T.StructField("f2", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def sketches(df: DataFrame, text: str, keep: list[str], width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Append the set's size, its 128-bit fingerprint and its band keys (null without words)."""

    def run(texts: list[bytes | None]) -> list[pa.Array]:
        n, f1, f2, keys = [], [], [], []
        for t in texts:
            s = shingles(t, width)
            n.append(len(s))
            if not len(s):
                f1.append(None)
                f2.append(None)
                keys.append(None)
                continue
            a, b = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
            f1.append(int(a))
            f2.append(int(b))
            keys.append(band_keys(hasher(bands * rows).signature(s), bands, rows))
        return [pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]

    return mapped(df.withColumn("__text", F.col(f"`{text}`").cast("binary")), ["__text"], run, SKETCH, keep)


def linked(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest (id, smallest id of its tree) of the links between the sets."""
    n = np.array([len(s) for s in sets], np.int64)
    if len(ids) == 2:
        common = np.array([[n[0], 0], [0, n[1]]])
        common[0, 1] = common[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), n)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        counts = np.diff(np.append(starts, len(values)))
        shared = counts > 1
        column = np.repeat(np.cumsum(shared) - 1, counts)[np.repeat(shared, counts)]
        owner = owner[np.repeat(shared, counts)]
        common, step = np.zeros((len(ids), len(ids)), np.float32), 4096
        edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + step, step))
        for k, (a, z) in enumerate(zip(edges, edges[1:], strict=False)):
            x = np.zeros((len(ids), step), np.float32)
            x[owner[a:z], column[a:z] - k * step] = 1
            common += x @ x.T
        common = np.rint(common).astype(np.int64)
    close = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.triu(close, 1)), strict=True):
        a, b = find(int(i)), find(int(j))
        if a != b:
            low, high = (a, b) if ids[a] <= ids[b] else (b, a)
            root[high] = low
    return [(int(ids[i]), int(ids[find(i)])) for i in range(len(ids)) if ids[find(i)] != ids[i]]


def few_or_not(ids: DataFrame) -> DataFrame:
    """``ids``, a written table, with a broadcast hint if it is small enough; else Spark shuffles both sides."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def verified(units: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Forest edges (a, b) of the links inside each unit, an array ``ids`` of keys, confirmed on full sets."""
    bounded_batches(texts.sparkSession)
    rows = units.select(F.xxhash64("ids").alias("unit"), F.explode("ids").alias("id")).join(texts, "id")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(t, width) for t in pdf["text"]]
        own = [i for i, s in enumerate(sets) if len(s)]
        found = linked(pdf["id"].to_numpy()[own], [sets[i] for i in own], percent) if len(own) > 1 else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("unit").applyInPandas(run, "a long, b long")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    scratch: Scratch | None = None,
) -> DataFrame:
    """For each row of ``df``: key, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the smallest key that links reach, ``kept`` whether it
    is the row's own. A text without words, or null, links with nothing. So
    does a row without a key: its component is null and it is kept. Rows that
    repeat a key are one document, linked by any of their texts. Texts are
    compared whole. An empty table gives an empty one; other columns do not
    matter. The two tables that the result reads are left to ``scratch``.
    """
    own, result = Scratch(df.sparkSession), scratch or Scratch(df.sparkSession)
    sketch = result.written(sketches(df, text, [key], width, bands, rows).withColumnRenamed(key, "id"))
    classes = own.written(
        sketch.where("id is not null and f1 is not null")
        .groupBy("f1", "f2")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    edges = candidate_links(classes, df, key, text, width, percent, own)
    labels = components(edges, own)
    named = result.written(
        classes.select("f1", "f2", "id").join(labels, "id", "left").select("f1", "f2", F.coalesce("root", "id").alias("component_id"))
    )
    own.drop()
    low = F.coalesce("component_id", "id")
    return sketch.select("id", "n_shingles", "f1", "f2").join(named, ["f1", "f2"], "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.when(F.col("id").isNotNull(), low).alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == low)).alias("kept"),
    )


def candidate_links(classes: DataFrame, df: DataFrame, key: str, text: str, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Forest edges of all confirmed links between the classes' documents."""
    keyed = classes.select(F.explode("bands").alias("h"), "id", "n")
    buckets = keyed.groupBy("h").agg(F.count("*").alias("size"), F.sum("n").alias("total")).where("size > 1")
    tiles = F.ceil(F.greatest(F.col("size") / TILE, F.col("total") / TILE_SHINGLES)).cast("int")
    buckets = scratch.written(buckets.withColumn("tiles", tiles).drop("total"))
    members = keyed.join(F.broadcast(buckets) if buckets.count() <= BROADCAST_BUCKETS else buckets, "h")
    lists = scratch.written(
        members.groupBy("h", F.pmod(F.xxhash64("id"), F.col("tiles")).alias("tile"))
        .agg(F.sort_array(F.collect_set("id")).alias("ids"), F.first("size").alias("size"), F.first("tiles").alias("tiles"))
    )
    few = (F.col("size") <= FEW) & (F.col("tiles") == 1)
    merged = (
        lists.where(few & (F.size("ids") > 1))
        .select(F.col("ids")[0].alias("low"), F.explode(F.slice("ids", 2, FEW)).alias("id"))
        .distinct()
        .groupBy("low")
        .agg(F.array_union(F.array("low"), F.sort_array(F.collect_list("id"))).alias("ids"))
        .select("ids")
    )
    many = lists.where(~few)
    first = many.where("tile = 0").select("h", F.col("ids").alias("first"))
    starred = many.join(first, "h", "left").select(
        F.sort_array(F.array_union("ids", F.coalesce("first", F.array().cast("array<long>")))).alias("ids")
    )
    units = scratch.written(merged.union(starred.where("size(ids) > 1").distinct()))
    # Only candidates' texts go on: every member of a later unit stands in one of these.
    ids = scratch.written(units.select(F.explode("ids").alias("id")).distinct())
    texts = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("text"))
    texts = scratch.written(texts.join(few_or_not(ids), "id"))
    edges = scratch.written(verified(units, texts, width, percent))
    cut = lists.where("tiles > 1")
    if cut.isEmpty():
        return edges
    # Links are still wanted only from members outside a bucket's largest component, its main one.
    labels = components(edges, scratch)
    members = scratch.written(
        cut.select("h", "size", "tiles", F.explode("ids").alias("id"))
        .join(labels, "id", "left")
        .select("h", "size", "tiles", "id", F.coalesce("root", "id").alias("root"))
    )
    by_root = members.groupBy("h", "root").agg(F.count("*").alias("n"))
    main = by_root.groupBy("h").agg(F.max_by("root", F.struct("n", -F.col("root"))).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"))
    main = scratch.written(main.where("n > n_main"))
    share = lambda n: F.ceil(F.col(n) * F.col("tiles") / F.col("size")).cast("int")  # noqa: E731  tiles for n of the members
    dealt = (
        members.join(F.broadcast(main) if main.count() <= BROADCAST_BUCKETS else main, "h")
        .withColumn("n_out", F.col("n") - F.col("n_main"))
        .select("h", "id", (F.col("root") != F.col("main")).alias("out"), share("n_out").alias("out_tiles"), share("n_main").alias("main_tiles"))
    )
    at = F.pmod(F.xxhash64("id"), F.when(F.col("out"), F.col("out_tiles")).otherwise(F.col("main_tiles"))).cast("int")
    tiles = scratch.written(
        dealt.groupBy("h", "out", at.alias("tile")).agg(
            F.sort_array(F.collect_set("id")).alias("ids"), F.first("out_tiles").alias("out_tiles"), F.first("main_tiles").alias("main_tiles")
        )
    )
    # Pairs of tiles are listed by number and meet their tiles by (bucket, tile): no key gathers a bucket.
    partner = lambda out: lambda i: F.struct(F.lit(out).alias("out2"), i.alias("tile2"))
    partners = F.concat(
        F.transform(F.sequence(F.col("tile"), F.col("out_tiles") - 1), partner(True)),
        F.transform(F.sequence(F.lit(0), F.col("main_tiles") - 1), partner(False)),
    )
    other = tiles.select("h", F.col("out").alias("out2"), F.col("tile").alias("tile2"), F.col("ids").alias("ids2"))
    rest = (
        tiles.where("out")
        .select("h", "ids", F.explode(partners).alias("p"))
        .select("h", "ids", "p.*")
        .join(other, ["h", "out2", "tile2"])
        .select(F.sort_array(F.array_union("ids", "ids2")).alias("ids"))
        .distinct()
    )
    return edges.union(scratch.written(verified(rest, texts, width, percent)))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``df`` whose document is kept: of each component that with the smallest key."""
    scratch = Scratch(df.sparkSession)
    gone = written(near_duplicates(df, key, text, percent=percent, bands=bands, rows=rows, scratch=scratch).where("not kept").select(F.col(key).alias("__gone")).distinct())
    scratch.drop()
    return df.join(few_or_not(gone), F.col(f"`{key}`") == F.col("__gone"), "left_anti")


def op10_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op10_minhash_dedup": op10_minhash_dedup}
ORACLES: dict[str, str] = {}
