"""Mixing sources to target weights by Sainte-Lague apportionment.

Each source's documents are dealt by a hash into shards of some ``shard_words``
words. The words of a shard, its documents in hash order, form a stream cut
into blocks of ``block_words`` words. The mix's total number of blocks is
apportioned to the sources by highest quotients ``target / (2k + 1)``, and each
source's blocks to its shards by the shards' numbers of blocks, which gives an
integer quota for each shard. A shard with ``n`` blocks and quota ``q`` takes
every block ``q // n`` times and the ``q % n`` blocks with the smallest seeded
hashes once more. As quotas stop at ``2 n``, nothing is taken more than twice.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import WORD, bounded_batches, table, written

#: Words of a block at least and at most. A source's taken words differ from its target by about a block; blocks
#: are as long as the smallest target allows at a deviation of one in ``FINENESS``.
BLOCK_WORDS, FINENESS = (32, 1024), 500
#: Words of a shard at least, and shards of all sources at most (besides one more for each source).
SHARD_WORDS, SHARDS = 1 << 17, 1 << 16
#: Sources up to which their table (some 100 bytes each) is broadcast; beyond, Spark joins by a shuffle.
BROADCAST_SOURCES = 50_000
#: Sources that the driver apportions at most (some 100 MB); a mix of more is refused.
SOURCES = 500_000
#: Weights of the sources in turn and the mix's words for each word there is (fixed by the contract).
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2


def filled(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MOST) -> list[float]:
    """Targets by weight that stop at ``most`` times a size; the excess goes to the others by weight."""
    targets, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = unit * weights[i]
            break
        for i in over:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        open_ -= over
    return targets


def sainte_lague(weights: Sequence[float], seats: int, most: Sequence[int]) -> list[int]:
    """Seats by the highest quotients ``weight / (2k + 1)``, none above its ``most``; ties go to the first.

    All quotients above a bound are granted at once and the last ones in order,
    so the time does not grow with the number of seats.
    """
    total = float(sum(weights))
    if total <= 0 or seats <= 0:
        return [0] * len(weights)

    def granted(divisor: float) -> list[int]:
        return [min(m, max(0, math.ceil(w / divisor - 0.5))) for w, m in zip(weights, most, strict=True)]

    low, high = 0.0, 4 * total
    for _ in range(200):
        middle = (low + high) / 2
        if middle > 0 and sum(granted(middle)) <= seats:
            high = middle
        else:
            low = middle
    out = granted(high)
    heap = [(-w / (2 * k + 1), i) for i, (w, k, m) in enumerate(zip(weights, out, most, strict=True)) if k < m and w > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def scrambled(x: np.ndarray, seed: int) -> np.ndarray:
    """A seeded 64-bit hash of integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(seed & 0xFFFFFFFFFFFFFFFF) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def passes(n_blocks: int, quota: int, seed: int) -> np.ndarray:
    """How often each block of a shard is taken."""
    out = np.full(n_blocks, quota // n_blocks if n_blocks else 0, np.int64)
    rest = quota % n_blocks if n_blocks else 0
    if rest:
        out[np.argsort(scrambled(np.arange(n_blocks), seed), kind="stable")[:rest]] += 1
    return out


def mix(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    spans: bool = False,
    seed: int = 0,
    block_words: int | None = None,
    shard_words: int = SHARD_WORDS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row for each row of ``df``: key, source, ``h``, ``size``, ``source_size``, ``target``, ``taken``.

    ``spans`` adds an array of (first, last, times): word ranges of the document
    and how often they are taken. Null texts have size 0 and are never taken;
    null is a source of its own, the last. ``h`` is a hash of key and text; rows
    that repeat both may change places. The columns ``carry`` go along with
    their rows. The driver sees one row for each source, ``SOURCES`` at most,
    and each shard; shards are bounded in number and each holds a bounded share
    of the words, whatever one source's share is. Without ``block_words`` the
    blocks are as long as ``BLOCK_WORDS`` and ``FINENESS`` allow. An empty table
    gives an empty plan.
    """
    spark = df.sparkSession
    sizes = written(
        df.select(
            F.col(f"`{key}`").alias("key"),
            F.col(f"`{source}`").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), F.col(f"`{key}`"), F.col(f"`{text}`")).alias("h"),
            *carry,
        )
    )
    found = sizes.groupBy("source").agg(F.sum("size").alias("n")).limit(SOURCES + 1).collect()
    if len(found) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    totals = sorted(((r["source"], r["n"]) for r in found), key=lambda r: (r[0] is None, r[0] or ""))
    total = sum(n for _, n in totals)
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(totals))]
    targets = filled([n for _, n in totals], weights, SHARE * total)
    if block_words is None:
        block_words = min(max(int(min((t for t in targets if t > 0), default=0)) // FINENESS, BLOCK_WORDS[0]), BLOCK_WORDS[1])
    per_shard = max(shard_words, -(-total // SHARDS))
    rows = [(s, i, n, t, -(-n // per_shard) or 1) for i, ((s, n), t) in enumerate(zip(totals, targets, strict=True))]
    plan = spark.createDataFrame(rows, "plan_source string, sid int, source_size long, target double, shards int")
    if len(rows) <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    dealt = sizes.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("h"), F.col("shards")).cast("int")).drop("shards")
    empty = dealt.where("size = 0")  # however many there are, no shard gathers them
    dealt = dealt.where("size > 0")
    words = {(r["sid"], r["shard"]): r["n"] for r in dealt.groupBy("sid", "shard").agg(F.sum("size").alias("n")).collect()}
    quotas = spark.sparkContext.broadcast(shard_quotas(words, targets, block_words))

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "key", "size"], kind="stable", ignore_index=True)
        sid, shard = int(pdf["sid"].iloc[0]), int(pdf["shard"].iloc[0])
        ends = np.cumsum(pdf["size"].to_numpy(np.int64))
        n = int(ends[-1])
        lengths = np.full(-(-n // block_words), block_words, np.int64)
        if n % block_words:
            lengths[-1] = n % block_words
        times = passes(len(lengths), quotas.value.get((sid, shard), 0), seed * 1_000_003 + sid * 65_537 + shard)
        before = np.concatenate(([0], np.cumsum(times * lengths)))
        at = np.append(times, 0)

        def upto(x: np.ndarray) -> np.ndarray:
            b = np.minimum(x // block_words, len(lengths))
            return before[b] + at[b] * (x - b * block_words)

        starts = ends - pdf["size"].to_numpy(np.int64)
        pdf["taken"] = upto(ends) - upto(starts)
        if spans:
            pdf["spans"] = [runs(times, int(a), int(b), block_words) for a, b in zip(starts, ends, strict=True)]
        return pdf[out.names]

    out = T.StructType(
        [dealt.schema["key"], dealt.schema["source"]]
        + [T.StructField("h", T.LongType()), *(dealt.schema[c] for c in (*carry, "size", "source_size", "target"))]
        + [T.StructField("taken", T.LongType())]
        + [T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))] * spans
    )
    none = {"taken": F.lit(0).cast("long"), "spans": F.array().cast("array<array<bigint>>")}
    rest = empty.select(*[none[c].alias(c) if c in none else F.col(c) for c in out.names])
    return dealt.groupBy("sid", "shard").applyInPandas(take, out).union(rest).withColumnsRenamed({"key": key, "source": source})


def shard_quotas(words: dict[tuple[int, int], int], targets: Sequence[float], block_words: int) -> dict[tuple[int, int], int]:
    """Blocks that each shard gives, from the words of each (source, shard) and the sources' targets."""
    blocks: list[list[tuple[int, int]]] = [[] for _ in targets]
    sizes = [0] * len(targets)
    for (sid, shard), n in sorted(words.items()):
        blocks[sid].append((shard, -(-n // block_words)))
        sizes[sid] += n
    counts = [sum(n for _, n in b) for b in blocks]
    # In blocks of the source's own mean length: the last block of a shard is short.
    wanted = [t * c / n if n else 0.0 for t, c, n in zip(targets, counts, sizes, strict=True)]
    given = sainte_lague(wanted, round(sum(wanted)), [MOST * c for c in counts])
    quotas = {}
    for sid, (own, seats) in enumerate(zip(blocks, given, strict=True)):
        shares = sainte_lague([n for _, n in own], seats, [MOST * n for _, n in own])
        quotas.update({(sid, shard): q for (shard, _), q in zip(own, shares, strict=True)})
    return quotas


def runs(times: np.ndarray, start: int, end: int, block_words: int) -> list[list[int]]:
    """[first, last, times] of the taken word ranges of a document at ``start`` to ``end`` of its stream."""
    out: list[list[int]] = []
    for b in range(start // block_words, -(-end // block_words)):
        t = int(times[b])
        a, z = max(start, b * block_words) - start, min(end, (b + 1) * block_words) - start
        if t and z > a:
            if out and out[-1][2] == t and out[-1][1] == a:
                out[-1][1] = z
            else:
                out.append([a, z, t])
    return out


def pieces(text: str, spans: list[list[int]]) -> list[str]:
    """The texts that the mix takes from a document: one for the first taking and one for the second.

    A part is the text between its first and last word, parts are joined by a
    line feed, and a text taken whole is left as it is.
    """
    out, at = [], [m.span() for m in WORD.finditer(text)]
    for k in range(1, max((s[2] for s in spans), default=0) + 1):
        own: list[list[int]] = []
        for a, z, t in spans:
            if t >= k:
                if own and own[-1][1] == a:
                    own[-1][1] = z
                else:
                    own.append([a, z])
        if own == [[0, len(at)]]:
            out.append(text)
        else:
            out.append("\n".join(text[at[a][0] : at[z - 1][1]] for a, z in own))
    return out


#: Columns that tell the place of a row: a hash of its file's path and its number in there.
FILE, ROW = "__file", "__row"


def placed(df: DataFrame) -> DataFrame:
    """``df`` with ``FILE`` and ``ROW``; it is written first if it is no plain scan of Parquet files."""
    place = {FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")}
    try:
        return df.select("*", *[c.alias(name) for name, c in place.items()])
    except AnalysisException:
        return written(df).select("*", *[c.alias(name) for name, c in place.items()])


def mixed_documents(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The mix itself: the rows of ``df``, once for each taking, with the words that are taken.

    A document of which nothing is taken is absent; one that is taken twice is
    there twice. The columns are those of ``df``; ``n_chars`` follows the text.
    Rows meet their spans by their places in the table's files, so rows that
    repeat are rows of their own; texts are shuffled once.
    """
    docs = placed(df)
    plan = mix(docs, key, source, text, spans=True, carry=[FILE, ROW]).where(F.size("spans") > 0)
    joined = docs.join(plan.select(FILE, ROW, F.col("spans").alias("__spans")), [FILE, ROW]).drop(FILE, ROW)
    bounded_batches(df.sparkSession)
    names, schema = df.columns, df.schema

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for i, (t, own) in enumerate(zip(batch.column(text).to_pylist(), batch.column("__spans").to_pylist(), strict=True)):
                taken = pieces(t, own)
                rows += [i] * len(taken)
                texts += taken
            out = batch.select(names).take(pa.array(rows, pa.int64()))
            changed = {text: pa.array(texts, pa.string())}
            if n_chars in names:
                changed[n_chars] = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([changed.get(c, out.column(c)) for c in names], names=names)

    return joined.mapInArrow(take, T.StructType([T.StructField(f.name, T.LongType() if f.name == n_chars else f.dataType) for f in schema]))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op9_mixing": op9_mixing}
ORACLES: dict[str, str] = {}
