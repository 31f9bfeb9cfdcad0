"""Alignment of two tokenizers' tokens, computed once for each distinct segment of the corpus.

A text is split before those runs of white space that neither vocabulary can
merge across: the byte-level one (A) never joins a word and the white space
behind it, and of the other (B) every entry is looked through for a character
and white space behind it; where an entry holds such a pair, no text is split
between the two. All merges then happen inside segments.

1. Workers replace each text by numbers into a dictionary of its block, a run of
   documents with a bounded number of characters and distinct segments, and hand
   out the dictionary with counts. Documents and dictionaries are written once.
2. Distinct segments of the corpus are tokenised by both and aligned: a whole
   batch of them is one alignment of two sorted arrays of byte offsets.
3. How often each pair of ids is linked is counted over the distinct segments,
   weighted by how often these occur, and summed up for each of them.
4. Alignments are joined to the dictionaries, which meet their block's documents;
   a document's alignment is that of its segments one after another.

A segment goes through a shuffle once a block at most, however often it occurs,
and a key's share of these rows is at most that of one entry in a dictionary.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import Scratch, bounded_batches, held, returned, table
from fernweave.llm.token_counts import ByteLevel

#: White space of the byte-level split (Unicode's property).
SPACE = r"\t-\r \x85\xa0  -     　"
#: Characters and distinct segments of a block (a document is never divided).
BLOCK_CHARS, BLOCK_SEGMENTS = 24 << 20, 1 << 19
#: Rows of an Arrow batch that hands out a dictionary, and segments of a document that are composed at a time.
ROWS, STEP = 1 << 15, 1 << 20
#: Segments and pairs of ids, the most frequent ones, that are broadcast at most.
HOT_SEGMENTS, HOT_PAIRS = 1 << 18, 1 << 17
#: Settings of the tables in between: the files are small, and shuffles that made a table go when it is written.
COMPRESSION, CLEANUP = "spark.sql.parquet.compression.codec", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Vocabularies:
    """Both tokenizers, the bytes of their entries, and where texts may be split."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        if not ByteLevel.fits(a_path):
            raise ValueError(f"not a byte-level tokenizer file: {a_path}")
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(a_path, encoding="utf-8") as f:
            added = {t["id"]: t["content"] for t in json.load(f)["added_tokens"]}
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = np.zeros(max(entries.values()) + 1, np.int64)
        for entry, i in entries.items():  # one character of an entry stands for one byte
            self.a_bytes[i] = len(entry.encode()) if i in added else len(entry)

        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        of_bytes = [self.b.is_byte(i) for i in range(len(pieces))]
        if sum(of_bytes) != 256:
            raise ValueError(f"not a vocabulary with an entry for each byte: {b_path}")
        self.b_bytes = np.array([1 if byte else len(p.replace("▁", " ").encode()) for p, byte in zip(pieces, of_bytes, strict=True)], np.int64)
        merged = [p.replace("▁", " ") for p, byte in zip(pieces, of_bytes, strict=True) if not byte]
        if any("\0" in p for p in merged):
            raise ValueError("an entry holds U+0000, which keeps segments apart")
        #: What stands before a segment that does not begin with the space that the library adds.
        self.guard = self.b.encode("\0")
        self.segments = re.compile(self.pattern(merged)).findall

    @staticmethod
    def pattern(entries: list[str]) -> str:
        """Runs of white space with what follows, up to the next run that no entry reaches over."""
        across: dict[str, set] = {}
        for entry in entries:
            for before, space in pairwise(entry):
                if re.match(f"[^{SPACE}][{SPACE}]", before + space):
                    across.setdefault(space, set()).add(before)
        joined = "|".join(f"(?<=[{''.join(map(re.escape, sorted(c)))}])(?={re.escape(s)})" for s, c in sorted(across.items()))
        run = f"[{SPACE}]++[^{SPACE}]*+"
        return f"{run}(?:(?:{joined}){run})*" if joined else run

    def plain(self, text: str) -> bool:
        """Whether B's tokens spell the text's own bytes: it has no U+2581 and is not normalised."""
        return "▁" not in text and self.b.normalize(text) == "▁" + text.replace(" ", "▁")

    def encode(self, segments: list[str]) -> list[np.ndarray]:
        """Ids and numbers of ids of each segment, for A, then for B."""
        a = [e.ids for e in self.a.encode_batch(segments, add_special_tokens=False)]
        own = [len(s) > 1 and s[0] == " " for s in segments]
        b = self.b.encode([s[1:] if o else "\0" + s for s, o in zip(segments, own, strict=True)], num_threads=1)
        b = [ids if o else ids[len(self.guard) :] for ids, o in zip(b, own, strict=True)]
        return [x for ids in (a, b) for x in (np.array([i for s in ids for i in s], np.int64), np.array([len(s) for s in ids], np.int64))]

    def align(self, segments: list[str]) -> tuple[np.ndarray, ...]:
        """The batch's alignment: ids, ends of segments in these, pairs of links and of the last links of groups."""
        a, n_a, b, n_b = self.encode(segments)
        end_a, end_b = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        last_a, last_b = np.cumsum(n_a) - 1, np.cumsum(n_b) - 1
        ends = np.cumsum([len(s.encode()) for s in segments])
        if not (np.array_equal(end_a[last_a], ends) and np.array_equal(end_b[last_b], ends)):
            raise ValueError("tokens of a segment do not spell it")
        cuts = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        both = (end_a[at_a] == cuts) & (end_b[at_b] == cuts)
        return a, b, at_a, at_b, both, np.searchsorted(cuts, ends) + 1


def stored(df: DataFrame, scratch: Scratch) -> DataFrame:
    """``df`` as a written table; the session's settings are as before afterwards."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in (COMPRESSION, CLEANUP)}
    conf.set(COMPRESSION, "zstd")
    conf.set(CLEANUP, "true")
    try:
        return scratch.written(df)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return held(("token_alignment", a_path, b_path), lambda: Vocabularies(a_path, b_path))


class Block:
    """Numbers of the segments of some documents, in order of their first occurrence, with counts."""

    def __init__(self, number: int):
        self.number, self.chars, self.counts = number, 0, np.zeros(0, np.int64)
        self.index = Index()

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or len(self.index) >= BLOCK_SEGMENTS

    def codes(self, segments: list[str]) -> np.ndarray:
        codes = np.fromiter(map(self.index.__getitem__, segments), np.uint32, len(segments))
        if len(self.index) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(max(len(self.index), ROWS), np.int64)])
        n = np.bincount(codes)
        self.counts[: len(n)] += n
        return codes


class Index(dict):
    """Numbers in the order of first look-up."""

    def __missing__(self, segment: str) -> int:
        n = self[segment] = len(self)
        return n


def packed(codes: np.ndarray) -> bytes:
    """Numbers as four compressed planes of bytes, low ones first: the upper ones are nearly all zero."""
    return zstandard.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


_ENTRY = [T.StructField("idx", T.IntegerType()), T.StructField("seg", T.StringType()), T.StructField("n", T.LongType())]
_DOC = [T.StructField("block", T.LongType()), T.StructField("codes", T.BinaryType())]


def indexed(df: DataFrame, a_path: str, b_path: str, text: str, keep: list[str]) -> DataFrame:
    """Rows of documents (numbers of their segments) and of dictionaries (``seg`` is not null), both with their block.

    Columns kept have a prefix, so that no name clashes. Texts without tokens have no numbers.
    """
    kept = [T.StructField(f"keep_{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    shaped = df.select(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(keep, kept, strict=True)], F.col(f"`{text}`").alias("text"))
    schema = T.StructType(kept + _DOC + _ENTRY)
    names = [f.name for f in schema]

    def dictionary(block: Block, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        segments = list(block.index)
        for i in range(0, len(segments), ROWS):
            part = segments[i : i + ROWS]
            arrays = [pa.nulls(len(part), t) for t in types]
            arrays += [pa.array([block.number] * len(part), pa.int64()), pa.nulls(len(part), pa.binary())]
            arrays += [pa.array(range(i, i + len(part)), pa.int32()), pa.array(part, pa.string()), pa.array(block.counts[i : i + len(part)], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, first = vocabularies(a_path, b_path), TaskContext.get().partitionId() << 32
        block, types = Block(first), []
        for batch in batches:
            types, numbers, codes = [batch.schema.field(f.name).type for f in kept], [], []
            for t in batch.column("text").to_pylist():
                if block.full():
                    yield from dictionary(block, types)
                    block = Block(block.number + 1)
                block.chars += len(t or "")
                codes.append(packed(block.codes(v.segments(" " + t))) if t and v.plain(t) else None)
                numbers.append(block.number)
            arrays = [batch.column(f.name) for f in kept] + [pa.array(numbers, pa.int64()), pa.array(codes, pa.binary())]
            arrays += [pa.nulls(len(codes), t) for t in (pa.int32(), pa.string(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        yield from dictionary(block, types)
        returned()

    return shaped.mapInArrow(run, schema)


def aligned_segments(segments: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Both tokenisations of each distinct segment (``seg``, ``n``): numbers of tokens, groups as text, and linked pairs (A << 32 | B)."""
    schema = "seg string, n long, n_a int, n_b int, groups string, pairs array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(a_path, b_path)
        for batch in batches:
            segments = batch.column("seg").to_pylist()
            if not segments:
                continue
            a, b, at_a, at_b, both, stops = v.align(segments)
            text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            # Tokens before the end of each group, and groups before the end of each segment.
            group_a, group_b = [0, *(at_a[both] + 1).tolist()], [0, *(at_b[both] + 1).tolist()]
            parts = [f"{','.join(text_a[i:j])}|{','.join(text_b[k:m])}" for (i, j), (k, m) in zip(pairwise(group_a), pairwise(group_b), strict=True)]
            groups = np.cumsum(both)[stops - 1]
            n_a, n_b = at_a[stops - 1] + 1, at_b[stops - 1] + 1
            texts = [";".join(parts[i:j]) for i, j in pairwise([0, *groups.tolist()])]
            pairs = pa.ListArray.from_arrays(pa.array([0, *stops.tolist()], pa.int32()), pa.array(a[at_a] << 32 | b[at_b], pa.int64()))
            numbers = [pa.array(np.diff(x, prepend=0), pa.int32()) for x in (n_a, n_b)]
            arrays = [batch.column("seg"), batch.column("n"), *numbers, pa.array(texts, pa.string()), pairs]
            yield pa.RecordBatch.from_arrays(arrays, names=["seg", "n", "n_a", "n_b", "groups", "pairs"])
        returned()

    return segments.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How many links of the corpus hold each pair of ids, and whether no pair of the same B id has more (``best``)."""
    pairs = aligned.select("n", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("n").alias("count"))
    pairs = pairs.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return pairs.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def frequent(df: DataFrame, by: str, most: int) -> Column:
    """A condition that at most ``most`` rows meet: ``by`` is at least a bound, taken from a histogram of its logarithm."""
    step = F.floor(F.log2(by) * 8)
    steps = sorted(df.groupBy(step.alias("step")).count().collect(), reverse=True)
    total, bound = 0, None
    for r in steps:
        total += r["count"]
        if total > most:
            break
        bound = r["step"]
    return F.lit(False) if bound is None else step >= bound


def sums(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``n_best`` and ``count_sum`` of each segment.

    Links of the most frequent pairs, a bounded number of these, meet them in
    place, which spares the shuffle the hot keys too; only links of others go by pair.
    """
    hot = frequent(pairs, "count", HOT_PAIRS)
    links, told = found.select("seg", F.explode("pairs").alias("pair")), pairs.select("pair", "count", "best")
    met = links.join(F.broadcast(told.where(hot)), "pair", "left")
    rest = met.where("count is null").select("seg", "pair").join(told.where(~hot), "pair")
    columns = ["seg", "count", "best"]
    both = met.where("count is not null").select(columns).unionByName(rest.select(columns))
    return both.groupBy("seg").agg(F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("count").alias("count_sum"))


NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
#: Columns of a segment's alignment.
ALIGNMENT = ["n_a", "n_b", "n_best", "count_sum", "groups"]


def table_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (as ``NUMBERS``) and groups of segments' alignments, row by row."""
    texts = np.empty(rows.num_rows, object)
    texts[:] = rows.column("groups").to_pylist()
    numbers = np.zeros((rows.num_rows, len(NUMBERS)), np.int64)
    numbers[:, 2] = [t.count("|") for t in texts]
    for i, c in ((0, "n_a"), (1, "n_b"), (4, "n_best"), (5, "count_sum")):
        numbers[:, i] = rows.column(c).to_numpy()
    numbers[:, 3] = numbers[:, 0] + numbers[:, 1] - numbers[:, 2]
    return numbers, texts


def composer(kept: list[str], digest: bool, hot):
    """A block's documents and dictionary as the documents' alignments; ``hot`` has those of the most frequent segments."""

    def compose(docs: pa.Table, entries: pa.Table) -> pa.Table:
        at, rank = entries.column("idx").to_numpy(), entries.column("rank").to_numpy()
        numbers, texts = np.zeros((len(at), len(NUMBERS)), np.int64), np.empty(len(at), object)
        numbers[at[rank >= 0]], texts[at[rank >= 0]] = (x[rank[rank >= 0]] for x in hot.value)
        rest = entries.filter(pa.array(rank < 0))
        numbers[at[rank < 0]], texts[at[rank < 0]] = table_of(rest)
        totals, groups = np.zeros((docs.num_rows, len(NUMBERS)), np.int64), []
        for row, data in enumerate(docs.column("codes")):
            if not data.is_valid:
                groups.append("")
                continue
            codes, sha = unpacked(data.as_py()), hashlib.sha256()
            for i in range(0, len(codes), STEP):  # long documents in steps of bounded memory
                part = codes[i : i + STEP]
                totals[row] += numbers[part].sum(axis=0)
                if digest:
                    sha.update((";" * (i > 0) + ";".join(texts[part].tolist())).encode())
            groups.append(sha.hexdigest() if digest else ";".join(texts[codes].tolist()))
        columns = [docs.column(c) for c in kept] + [pa.array(totals[:, i], pa.int64()) for i in range(len(NUMBERS))]
        return pa.table([*columns, pa.array(groups, pa.string())], [*kept, *NUMBERS, "groups"])

    return compose


def aligned(df: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[str] | None = None, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Alignment of the tokens of ``a_path`` (byte-level) and ``b_path`` (sentencepiece) on each whole text.

    The first result has the columns ``keep`` (default: all but ``text``) and,
    for a space and the text: ``n_a`` and ``n_b`` tokens, ``n_groups`` between
    byte offsets where tokens of both end, ``n_links`` pairs of tokens that
    overlap, ``n_best`` links whose pair of ids no other pair of the same B id
    outnumbers in the corpus, ``count_sum`` the sum of the pairs' counts, and
    ``groups``, the ids of each group as ``a1,a2|b1`` joined by ``;`` (their
    SHA-256 if ``digest``). The second has a row for each ``pair`` of ids
    (A << 32 | B) with its ``count`` and whether it is ``best``.

    Null and empty texts, and texts that B changes (they hold U+2581 or its
    normaliser alters them), have no tokens: numbers are 0, ``groups`` is empty,
    and they count for no pair. Repeated rows all count and all come out. An
    empty table gives empty ones. Columns named as an added one give way. Very
    long texts are blocks of their own. Both results read written tables.
    """
    spark, names = df.sparkSession, {*NUMBERS, "groups"}
    bounded_batches(spark)
    keep = [c for c in (keep if keep is not None else [c for c in df.columns if c != text]) if c.lower() not in names]
    scratch, own = Scratch(spark), Scratch(spark)
    rows = stored(indexed(df, a_path, b_path, text, keep), scratch)
    entries = rows.where("seg is not null").select("block", "idx", "seg", "n")
    found = stored(aligned_segments(entries.groupBy("seg").agg(F.sum("n").alias("n")), a_path, b_path), own)
    pairs = stored(pair_counts(found), scratch)
    told = stored(found.select("seg", "n", "n_a", "n_b", "groups").join(sums(found, pairs), "seg"), scratch)
    own.drop()  # links are summed up
    is_hot = frequent(told, "n", HOT_SEGMENTS)
    hot = told.where(is_hot).select("seg", *ALIGNMENT).toArrow()
    ranks = spark.createDataFrame(pa.table({"seg": hot.column("seg"), "rank": pa.array(range(hot.num_rows), pa.int32())}))
    sent = spark.sparkContext.broadcast(table_of(hot))
    met = entries.select("block", "idx", "seg").join(F.broadcast(ranks), "seg", "left")
    rest = met.where("rank is null").select("block", "idx", "seg").join(told.where(~is_hot).select("seg", *ALIGNMENT), "seg")
    dictionaries = met.where("rank is not null").select("block", "idx", "rank").unionByName(
        rest.drop("seg").withColumn("rank", F.lit(-1)), allowMissingColumns=True
    )
    kept = [f"keep_{i}" for i in range(len(keep))]
    docs = rows.where("seg is null").select(F.col("block").alias("home"), *kept, "codes")
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in NUMBERS] + [T.StructField("groups", T.StringType())])
    out = docs.groupBy("home").cogroup(dictionaries.groupBy("block")).applyInArrow(composer(kept, digest, sent), schema)
    return out.select(*[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], *NUMBERS, "groups"), pairs


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, _ = aligned(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES = {"op13_token_alignment": op13_token_alignment}
ORACLES: dict[str, str] = {}
