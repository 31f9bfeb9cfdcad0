"""Token counts by a two-tier lookup on the map side.

The driver broadcasts a compact hash table of frequent pre-tokens and their
numbers of tokens. A worker looks each pre-token of a batch up there (first
tier), then in its own bounded cache (second tier), and runs the tokenizer's
model only on what neither holds; within a batch a pre-token is looked up once.
Pre-tokens are never shuffled: the frequent ones come from a bounded sample of
rows from partitions all over the table, which executors count. The sample sets
which lookups are fast, never a count.

A tokenizer file whose split into pre-tokens is not the byte-level one is
applied to whole texts by its own library.
"""

from __future__ import annotations

import json
import uuid
from array import array
from collections import Counter

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import BYTE_LEVEL_SPLIT, held, mapped, measured, table

#: Rows of the sample that the frequent pre-tokens come from, how many of these a partition reports, and how many are broadcast at most.
SAMPLE_ROWS, REPORTED, FREQUENT = 4000, 1 << 14, 1 << 16
#: Longer pre-tokens (in bytes) are not broadcast; with ``FREQUENT`` this bounds the table at 6 MB.
LONG_PIECE = 64
#: Entries of a generation of a worker's cache.
MAX_CACHE = 200_000


class CompactTable:
    """An open-addressing hash table from byte strings to small counts: one blob of keys and one 64-bit number a slot."""

    def __init__(self, items: list[tuple[bytes, int]]):
        slots = 16
        while slots < 2 * len(items):
            slots *= 2
        self.mask = slots - 1
        self.blob = b"".join(k for k, _ in items)
        #: Place of the key << 16 | its length << 8 | its count; 0: an empty slot.
        self.slots = array("Q", bytes(8 * slots))
        at = 0
        for key, n in items:
            slot = self._hash(key)
            while self.slots[slot]:
                slot = slot + 1 & self.mask
            self.slots[slot] = at << 16 | len(key) << 8 | n
            at += len(key)

    def _hash(self, key: bytes) -> int:
        return xxhash.xxh3_64_intdigest(key) & self.mask

    def get(self, key: bytes) -> int:
        """The count of ``key``, 0 if absent."""
        slot = self._hash(key)
        while entry := self.slots[slot]:
            at = entry >> 16
            if self.blob[at : at + (entry >> 8 & 0xFF)] == key:
                return entry & 0xFF
            slot = slot + 1 & self.mask
        return 0


class ByteLevel:
    """Pre-tokens of a byte-level tokenizer file, and the number of tokens of one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.find = regex.compile(BYTE_LEVEL_SPLIT).findall
        # Bytes stand for printable characters: those that print as themselves, the others from U+0100 on.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: b for b in shown} | {b: 0x100 + i for i, b in enumerate(hidden)}

    @staticmethod
    def fits(path: str) -> bool:
        """Whether the file splits and treats texts as this class does."""
        if not path.endswith(".json"):
            return False
        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        split = j.get("pre_tokenizer") or {}
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in j["added_tokens"])
        return (
            j["model"].get("type", "BPE") == "BPE"
            and not j.get("normalizer")
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and plain
        )

    def length(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown)))

    def split(self, text: str) -> tuple[list[list[str]], int]:
        """Pre-tokens between the special strings of a text, and how many of these there are."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        return [self.find(p) for p in parts], len(parts) - 1


class Cache(dict):
    """Second tier: pre-tokens that the broadcast table lacks; when full it becomes the old generation."""

    def __init__(self, own: ByteLevel):
        super().__init__()
        self.own, self.old = own, {}

    def __missing__(self, piece: str) -> int:
        n = self.old.get(piece) or self.own.length(piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= MAX_CACHE:
                self.old = dict(self)
                self.clear()
            self[piece] = n
        return n


class Batch(dict):
    """The numbers of tokens of one batch's pre-tokens: from the broadcast table, else from the second tier."""

    def __init__(self, frequent: CompactTable, second: Cache):
        super().__init__()
        self.frequent, self.second = frequent, second

    def __missing__(self, piece: str) -> int:
        n = self[piece] = self.frequent.get(piece.encode()) or self.second[piece]
        return n


def byte_level(path: str) -> ByteLevel:
    return held(("tokens", path), lambda: ByteLevel(path))


def whole_text(path: str):
    """Counts of whole texts by the file's own library."""
    return held(("tokens", "whole", path), lambda: _whole_text(path))


def _whole_text(path: str):
    if path.endswith(".model"):
        import sentencepiece

        piece = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in piece.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(tokenizer.encode(x, add_special_tokens=False).ids) for x in texts]


def counted(texts: list[str], path: str) -> list[tuple[str, int]]:
    """The most frequent pre-tokens of some texts with their counts."""
    own, counts = byte_level(path), Counter()
    for t in texts:
        for pieces in own.split(t)[0]:
            counts.update(pieces)
    return counts.most_common(REPORTED)


def frequent_lengths(parts: list[list[tuple[str, int]]], path: str) -> CompactTable:
    """The most frequent pre-tokens of a sample's parts with their numbers of tokens."""
    own, counts = ByteLevel(path), Counter()
    for part in parts:
        counts.update(dict(part))
    found = ((p, p.encode()) for p, _ in counts.most_common(FREQUENT))
    return CompactTable(sorted((b, own.length(p)) for p, b in found if len(b) <= LONG_PIECE))


ADDED = T.StructType([T.StructField("n_tokens", T.LongType())])


def count_tokens(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Append ``n_tokens``, the tokens of each whole text by the tokenizer file at ``path``.

    The file must be on every machine. Null and empty texts have no tokens. No
    begin, end or other special token is added; special strings inside a text
    are what the library makes of them by default. Very long texts come in
    batches of bounded bytes. Repeated rows count alike, an empty table gives
    an empty one, a column named ``n_tokens`` gives way. There is no shuffle of
    pre-tokens or texts.
    """
    if not ByteLevel.fits(path):

        def plain(texts: list[str | None]) -> list[pa.Array]:
            return [pa.array(whole_text(path)([t or "" for t in texts]), pa.int64())]

        return mapped(df, [text], plain, ADDED, keep)

    sampled = measured(df, text, sample_rows, lambda texts: counted(texts, path))
    frequent = df.sparkSession.sparkContext.broadcast(frequent_lengths(sampled, path))
    frequent_id = uuid.uuid4().hex

    def run(texts: list[str | None]) -> list[pa.Array]:
        own = byte_level(path)
        tiers = held(("tokens", "tiers", path), dict)
        if frequent_id not in tiers:  # those of an earlier query go
            tiers.clear()
            tiers[frequent_id] = Cache(own)
        look, counts = Batch(frequent.value, tiers[frequent_id]).__getitem__, []
        for t in texts:
            parts, n = own.split(t) if t else ((), 0)
            counts.append(n + sum(sum(map(look, pieces)) for pieces in parts))
        return [pa.array(counts, pa.int64())]

    return mapped(df, [text], run, ADDED, keep)


#: A document with more tokens is over the limit (fixed by the contract).
LIMIT = 512


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), "text", ["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES: dict[str, str] = {}
