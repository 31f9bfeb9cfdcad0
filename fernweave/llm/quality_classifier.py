"""A quality classifier: hashed word n-grams, follow-the-regularised-leader, sparse dot products.

A text's features are its words and pairs of neighbouring words, hashed into
``2 ** BITS`` places: as they stand, and as shapes (kinds of letters, digits,
the symbol itself), so that words never seen still count. Words that repeat
their neighbour share one pair. A feature weighs the root of its count, and a
text's features have length one. A score is the logistic function of the sparse
dot product of these with the weights.

The weights are learnt with FTRL-proximal updates (McMahan et al., 2013) on a
bounded sample of the labelled texts: the ``TRAIN_ROWS`` labels that come first
by a hash of their id, at any size of the tables. Each ``SHARD_ROWS`` of these
labels in turn are a shard; each of ``ROUNDS`` jobs lets every shard go through
its texts once, in the order of that hash, and starts the next from the mean of
the shards' states, summed in their order by executors, one range of places a
group. The mean is two numbers a place: that alone reaches the driver, whatever
the number of shards. Reruns give the same weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import Scratch, bounded_batches, held, mapped, table

#: Labels that the weights are learnt from at most.
TRAIN_ROWS = 16_384
#: Places of the features (as a power of two), labels of a shard and rounds of the training.
BITS, SHARD_ROWS, ROUNDS = 18, 2048, 8
#: Ranges of places whose means are taken apart (as a power of two).
RANGE_BITS = 4
#: Step size, its offset, and the weights of the absolute and squared penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.1
#: Words and symbols of a text.
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
#: Code points of a text that are split into words at a time, and hashes that a worker remembers.
BLOCK, REMEMBERED = 1 << 20, 300_000

_MIX, _SAME = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x5DEECE66D)


def shape(token: str) -> str:
    """What kind of word a token is; a symbol stands for itself, three times at most."""
    if token.isalpha():
        if token.islower():
            return "x"
        return "X" if token.isupper() else "Xx" if token[0].isupper() else "xX"
    return "9" if token.isdigit() else token[0] * min(len(token), 3)


class Hashes(dict):
    """Hashes of tokens, of ``(token, shape)`` both in one number pair; forgets all when full."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        pair = xxhash.xxh3_64_intdigest(token.encode()), xxhash.xxh3_64_intdigest(b"\0" + shape(token).encode())
        if len(token) <= 64:
            self[token] = pair
        return pair


def blocks(text: str) -> Iterator[str]:
    """A text in blocks of about ``BLOCK`` code points that are cut at white space only."""
    cuts = [0]
    while cuts[-1] + BLOCK < len(text):
        found = re.compile(r"\s").search(text, cuts[-1] + BLOCK)
        cuts.append(found.start() if found else len(text))
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return (text[a:b] for a, b in pairwise(cuts))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) and counts of a whole text's features; none for null, empty and blank texts."""
    look, last, found = held(("quality_classifier", "hashes"), Hashes).__getitem__, None, []
    for block in blocks(text or ""):
        tokens = TOKEN.findall(block)
        if not tokens:
            continue
        both = np.array(list(map(look, tokens)), np.uint64)
        found.append(both.ravel())
        if last is not None:
            both = np.concatenate([last, both])
        last = both[-1:]
        one, two = both[:-1], both[1:]
        pair = (one * _MIX ^ two) * _MIX
        pair[one[:, 0] == two[:, 0], 0] = _SAME
        found.append(pair.ravel())
        if len(found) > 8:
            found = [np.concatenate(found)]
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    at, n = np.unique((np.concatenate(found) * _MIX >> np.uint64(64 - BITS)).astype(np.int32), return_counts=True)
    return at, n.astype(np.int32)


def values(n: np.ndarray) -> np.ndarray:
    """What features with these counts weigh."""
    return np.sqrt(n) / np.sqrt(max(n.sum(), 1))


def packed(at: np.ndarray, n: np.ndarray) -> bytes:
    """Places as differences, and counts, in few bytes."""
    return zstandard.compress(np.concatenate([np.diff(at, prepend=np.int32(0)), n]).astype("<i4").tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    step, n = np.frombuffer(zstandard.decompress(data), "<i4").reshape(2, -1)
    return np.cumsum(step, dtype=np.int32), n


class Learner:
    """FTRL-proximal for logistic loss; the last place is the bias."""

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros((1 << BITS) + 1) if z is None else z.copy()
        self.n = np.zeros((1 << BITS) + 1) if n is None else n.copy()

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        at, value = np.append(at, 1 << BITS), np.append(value, 1.0)
        w = self.weights(at)
        g = (logistic(float(w @ value)) - label) * value
        n = self.n[at]
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - step * w
        self.n[at] = n + g * g


def one_round(sent):
    """A shard's part of a round: from the state that was sent, once through its texts; one row a range of places, empty ones too."""

    def learn(group: pa.Table) -> pa.Table:
        learner = Learner(*(sent.value or ()))
        group = group.sort_by([("h", "ascending"), ("key", "ascending")])
        for y, data in zip(group.column("label").to_pylist(), group.column("features"), strict=True):
            at, n = unpacked(data.as_py())
            learner.learn(at, values(n), y)
        at = np.flatnonzero(learner.n).astype(np.int32)
        parts = np.split(at, np.searchsorted(at, np.arange(1, 1 << RANGE_BITS) << BITS - RANGE_BITS))
        shard = group.column("shard")[0].as_py()
        out = [np.arange(len(parts), dtype=np.int32), [shard] * len(parts)]
        out += [[x.tobytes() for x in own] for own in (parts, [learner.z[a] for a in parts], [learner.n[a] for a in parts])]
        return pa.table(out, ["range", "shard", "at", "z", "n"])

    return learn


def range_mean(group: pa.Table) -> pa.Table:
    """The mean of the shards' states in a range of places, summed in the shards' order."""
    size = len(group)
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for r in group.sort_by("shard").to_pylist():
        at = np.frombuffer(r["at"], np.int32)
        z[at] += np.frombuffer(r["z"]) / size
        n[at] += np.frombuffer(r["n"]) / size
    at = np.flatnonzero(n).astype(np.int32)
    return pa.table([[x.tobytes()] for x in (at, z[at], n[at])], ["at", "z", "n"])


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def training_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, rows: int) -> DataFrame:
    """The bounded sample: shard, hash of the id, label (0 or 1) and text, one row an id.

    Of several labels or texts of one id, the least counts. Rows with a null id or label are none.
    """
    chosen = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("label"))
        .where("key is not null and label in (0, 1)")
        .groupBy("key").agg(F.min("label").alias("label"))
        .withColumn("h", F.xxhash64("key")).orderBy("h", "key").limit(rows)
        .withColumn("shard", F.floor((F.row_number().over(Window.orderBy("h", "key")) - 1) / SHARD_ROWS))
    )
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    found = texts.join(F.broadcast(chosen), "key").groupBy("shard", "h", "key", "label").agg(F.min("text").alias("text"))
    return found.select("shard", "h", "key", "label", "text")


_FEATURES = T.StructType([T.StructField("features", T.BinaryType())])
#: With this setting the files of a round's shuffle go when the round is over.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def mixed(sample: DataFrame, state: tuple | None) -> tuple | None:
    """One round: the mean of the shards' states after their texts; None without a sample."""
    sent = sample.sparkSession.sparkContext.broadcast(state)
    states = sample.groupBy("shard").applyInArrow(one_round(sent), "range int, shard long, at binary, z binary, n binary")
    found = states.groupBy("range").applyInArrow(range_mean, "at binary, z binary, n binary").collect()
    sent.destroy()
    mean = Learner()
    for r in found:
        at = np.frombuffer(r["at"], np.int32)
        mean.z[at], mean.n[at] = np.frombuffer(r["z"]), np.frombuffer(r["n"])
    return (mean.z, mean.n) if found else None


def trained(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights learnt from at most ``rows`` labels (columns ``key`` and ``label``) of the texts; zeros without any.

    The caller leaves out of ``labels`` what is not to be learnt from. The
    result has a fixed size, whatever the tables hold.
    """
    scratch = Scratch(docs.sparkSession)

    def run(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([packed(*features(t)) for t in texts], pa.binary())]

    sample = training_rows(docs, labels, text, key, label, rows)
    conf, state = docs.sparkSession.conf, None
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        sample = scratch.written(mapped(sample, ["text"], run, _FEATURES, ["shard", "h", "key", "label"]))
        for _ in range(ROUNDS):
            state = mixed(sample, state)
            if state is None:
                break
    finally:
        conf.set(CLEANUP, before)
    scratch.drop()
    return Learner(*(state or ())).weights()


def scored(df: DataFrame, weights: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1, higher: label 1 likelier) to each row, from its whole text alone.

    Null, empty and blank texts have no features: their score is the bias's.
    Repeated rows score alike, an empty table gives an empty one, a column named
    ``score`` gives way. Very long texts are split into words block by block.
    There is no shuffle; the weights (2 MB) are broadcast.
    """
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def run(texts: list[str | None]) -> list[pa.Array]:
        w = sent.value
        found = (features(t) for t in texts)
        return [pa.array([logistic(float(w[at] @ values(n)) + float(w[-1])) for at, n in found], pa.float64())]

    return mapped(df, [text], run, T.StructType([T.StructField("score", T.DoubleType())]), keep)


def held_out(key: str):
    """Whether a row is left out of the training: CRC-32 of its id as text, mod 5, is 0 (fixed by the contract); null: no."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


#: From this score on the prediction is 1 (fixed by the contract).
THRESHOLD = 0.3


def op11_quality_classifier(spark, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out("doc_id"))
    weights = trained(docs, labels)
    found = scored(docs.withColumn("held_out", held_out("doc_id")), weights, "text", ["doc_id", "held_out"])
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op11_quality_classifier": op11_quality_classifier}
ORACLES: dict[str, str] = {}
