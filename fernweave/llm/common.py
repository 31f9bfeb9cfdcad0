"""What several operators share: whole-text batches, written tables, components.

Words are runs of characters other than space and U+0009..U+000D (``WORD``).
"""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word of the contracts for quality rules, mixing and near-duplicates.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: The split into pre-tokens of byte-level tokenizers (fixed by these).
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of one Arrow batch sent to a Python worker; long texts then come in smaller batches.
BATCH_BYTES = 2 << 20


#: What a Python worker keeps from task to task, by operator and parameters.
_HELD: dict = {}


def held(key: tuple, build: Callable[[], object]):
    """A worker's tables and caches for one operator; those of the operator that ran before are let go.

    ``key`` begins with the operator's name. A worker that runs one stage after
    another so holds the memory of one operator at a time.
    """
    if key not in _HELD:
        others = [k for k in _HELD if k[0] != key[0]]
        for other in others:
            del _HELD[other]
        if others:
            gc.collect()
            returned()
        _HELD[key] = build()
    return _HELD[key]


def returned() -> None:
    """Give freed memory back to the machine, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    pa.default_memory_pool().release_unused()


#: Temporary folders of sessions without a shared one, by application.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share.

    Where that setting is absent, in a temporary folder if the session is local
    (tests), else an error: executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="fernweave-"))
    return f"{root.rstrip('/')}/fernweave-{uuid.uuid4().hex}"


#: For writes to ``file://``: Hadoop's usual class writes a checksum file beside each file, and starts a ``chmod`` for both and
#: for the attempt's folder; this one has no checksum files. Other file systems do not read these settings.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def written(df: DataFrame, at: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result has no lineage, so a lost executor costs only the tasks it ran.
    """
    spark = df.sparkSession
    at = at or shared_dir(spark)
    df.write.mode("overwrite").options(**PLAIN_FILES).parquet(at)
    left(spark, at)
    return spark.read.schema(df.schema).parquet(at)


#: Folders that operators left, by application.
_LEFT: dict[str, set[str]] = {}


def left(spark: SparkSession, at: str) -> None:
    """Remember a folder that a result may still read, for ``cleared``."""
    _LEFT.setdefault(spark.sparkContext.applicationId, set()).add(at)


def cleared(spark: SparkSession) -> int:
    """Remove all tables that operators of this session left, once no result is read any more; how many."""
    left = _LEFT.pop(spark.sparkContext.applicationId, set())
    for at in left:
        dropped(spark, at)
    return len(left)


def dropped(spark: SparkSession, at: str) -> None:
    """Remove a table that ``written`` left, once nothing reads it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _LEFT.get(spark.sparkContext.applicationId, set()).discard(at)


class Scratch:
    """Written tables that an operator removes once its result no longer reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame) -> DataFrame:
        self.paths.append(shared_dir(self.spark))
        return written(df, self.paths[-1])

    def drop(self) -> None:
        for at in self.paths:
            dropped(self.spark, at)
        self.paths = []


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, so that long texts do not fill a worker's memory.

    The bound is a setting of the session, as Spark has no other place for it; a smaller one is left as it is.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def mapped(
    df: DataFrame,
    inputs: list[str],
    function: Callable[..., Iterable[pa.Array]],
    added: T.StructType,
    keep: list[str] | None = None,
) -> DataFrame:
    """Append the columns ``added`` to each row of ``df``, computed from whole batches.

    ``function`` is called once a batch with one Python list for each of
    ``inputs`` and returns one Arrow array for each field of ``added``. Columns
    of ``df`` with a clashing name give way to the added ones. Only ``keep``
    (default: all other columns) are carried along. There is no shuffle.
    """
    bounded_batches(df.sparkSession)
    names = {f.name.lower() for f in added}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    fields = [f for f in df.schema if f.name in kept]
    side = [f"__in{i}" for i in range(len(inputs))]
    shaped = df.select(
        *[F.col(f"`{f.name}`") for f in fields],
        *[F.col(f"`{c}`").alias(s) for c, s in zip(inputs, side, strict=True)],
    )
    order, new = [f.name for f in fields], [f.name for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = list(function(*[batch.column(s).to_pylist() for s in side]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in order] + arrays, names=order + new)
            del arrays
        returned()

    return shaped.mapInArrow(run, T.StructType(fields + list(added)))


#: Partitions that a sample is taken from at most.
SAMPLE_PARTITIONS = 16


def measured(df: DataFrame, text: str, rows: int, measure: Callable[[list[str]], object]) -> list:
    """``measure`` of a sample of the texts, one result for each sampled partition.

    The first rows of up to ``SAMPLE_PARTITIONS`` partitions, spread evenly over
    the table, ``rows`` in all, whatever their texts' lengths. The executors
    measure; only the results come to the driver. Nothing is shuffled and a
    partition is read no further than its sample. For use where a sample tunes
    the work and decides no result.
    """
    texts = df.select(F.col(f"`{text}`")).rdd
    n = texts.getNumPartitions()
    count = min(n, SAMPLE_PARTITIONS)
    if not count:
        return []
    each = -(-rows // count)

    def run(part: Iterator) -> list:
        return [measure([r[0] for r in islice(part, each) if r[0] is not None])]

    return df.sparkSession.sparkContext.runJob(texts, run, [i * n // count for i in range(count)])


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Connected components: columns ``a`` and ``b`` of longs in, ``id`` and ``root`` out.

    ``root`` is the smallest id of the component; ids without an edge are
    absent. Large-star and small-star steps alternate (Kiveris et al., 2014)
    until the edges stop changing. Each step writes its minima and its edges to
    the shared folder: joins then read plain exchanges, whose large partitions
    Spark can split when one node has very many edges, and no lineage grows.
    """
    spark = edges.sparkSession
    at = [shared_dir(spark)]
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), at[0]
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(df: DataFrame, large: bool) -> DataFrame:
        sides = df.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            sides = sides.union(df.select("b", "a"))
        low_at, out_at = shared_dir(spark), shared_dir(spark)
        low = written(sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), low_at)
        joined = sides.join(low, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
                low.select(F.col("u").alias("a"), F.col("m").alias("b"))
            )
        out = written(out.where("a <> b").distinct(), out_at)
        dropped(spark, low_at)
        dropped(spark, at[0])
        at[0] = out_at
        return out

    seen = state(now)
    while seen[0]:
        now = star(star(now, True), False)
        after = state(now)
        if after == seen:
            break
        seen = after
    if scratch is not None:
        scratch.paths.append(at[0])
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
