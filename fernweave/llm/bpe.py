"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are (Berglund and van der Merwe, 2023): the merges that cross a
boundary can be checked pair by pair. So the encoder is a transducer over
bytes. Its nondeterministic states are "the token that began at byte p is
still open": a node of the vocabulary's trie and the closed token before it. A
set of these is one state of the deterministic machine, built when first
reached and kept in a table of bounded size. At every byte exactly one open
token can close so that it fits the token before it; a transition's output is
that token. Every ``WINDOW`` bytes, and at the end, the tokens are emitted to which
all hypotheses still open lead back: the lookahead is bounded by ``WINDOW`` and
some tokens' lengths, however long a pre-token is.

Pre-tokens (matches of the split pattern) repeat, so a worker keeps the ids of
those it has met; the transducer runs for the others.

Decoding joins the tokens' bytes and passes them through an incremental UTF-8
state machine, which holds back a character cut by a chunk's end and replaces
malformed parts by U+FFFD.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import held, mapped, table

#: States and steps of the transducer, remembered pairs and remembered pre-tokens of a worker; beyond, it starts anew.
MAX_STATES, MAX_STEPS, MAX_PAIRS, MAX_PIECES = 180_000, 400_000, 120_000, 200_000
#: Bits of a token's number in packed integers.
SHIFT = 24
#: Longer pre-tokens are not remembered.
LONG_PIECE = 48
#: Bytes after which the settled tokens of a longer pre-token are emitted, again and again.
WINDOW = 64
#: Tokens of one step of the streaming decoder.
DECODE_TOKENS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes bytes by the ranks of a byte-level BPE vocabulary, which holds all 256 single bytes.

    ``part`` of the bounds is what its tables may hold.
    """

    def __init__(self, ranks: dict[bytes, int], part: float = 1.0):
        self.ranks, self.part = ranks, part
        self.bytes_of = {r: t for t, r in ranks.items()}
        size = max(ranks.values()) + 1
        self.length = [0] * size
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        self.left, self.right = [-1] * size, [-1] * size  # halves of each token
        self.joined: dict[int, int] = {}  # left half << SHIFT | right half: token
        for token, rank in ranks.items():
            a, b = self.left[rank], self.right[rank] = self._halves(token, rank)
            if a >= 0:
                self.joined[a << SHIFT | b] = rank
        self._pairs: dict[int, bool] = {}
        #: By node: byte to (node, the token that it ends if merges can make it, else -1, whether it goes on).
        self.after: list[dict[int, tuple[int, int, bool]]] = self._trie()
        self._clear()

    def _trie(self) -> list[dict[int, tuple[int, int, bool]]]:
        kids: list[dict[int, int]] = [{}]
        ends, self.depth = [-1], [0]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                after = kids[node].get(byte)
                if after is None:
                    after = kids[node][byte] = len(kids)
                    kids.append({})
                    ends.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = after
            if self.reachable(rank):
                ends[node] = rank
        leaf: dict[int, tuple[int, int, bool]] = {}
        return [{byte: (n, ends[n], bool(kids[n])) for byte, n in own.items()} if own else leaf for own in kids]

    def _clear(self) -> None:
        #: The open tokens of a state, a node and the closed token before it (-1: none) in turn.
        self.states: dict[tuple[int, ...], int] = {}
        self.open: list[tuple[int, ...]] = []
        #: By state: the token that closes there.
        self.closes: list[int] = []
        #: By state << 8 | byte: next state.
        self.delta: dict[int, int] = {}
        self._state((0, -1))

    def _state(self, open_: tuple[int, ...]) -> int:
        at = self.states.get(open_)
        if at is None:
            if len(self.open) >= MAX_STATES * self.part or len(self.delta) >= MAX_STEPS * self.part:
                self._clear()  # whatever is being encoded goes on from the new state
            at = self.states[open_] = len(self.open)
            self.open.append(open_)
            self.closes.append(open_[-1])
        return at

    def _halves(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens merged last to make ``token``; (-1, -1) for a byte or a token that merges cannot make."""
        parts = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        ranks, bytes_of = self.ranks, self.bytes_of
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = ranks.get(bytes_of[parts[i]] + bytes_of[parts[i + 1]], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                return -1, -1
            parts[at : at + 2] = [best]
        return (parts[0], parts[1]) if len(parts) == 2 else (-1, -1)

    def reachable(self, token: int) -> bool:
        return self.length[token] == 1 or self.left[token] >= 0

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: no merge across their boundary comes before theirs are done.

        The merges of both sides are undone, latest first; if at some point the
        two tokens at the boundary merge earlier than what was undone, they
        would not have stayed apart.
        """
        undone, joined = 1 << 62, self.joined
        while True:
            joint = joined.get(left << SHIFT | right)
            if joint is not None and joint < undone:
                return False
            a, b = self.right[left], self.left[right]
            # Of two equal merges the left one comes first, so the right one is undone first.
            if b < 0 or (a >= 0 and left > right):
                if a < 0:
                    return True
                undone, left = left, a
            else:
                undone, right = right + 1, b

    def _grow(self, state: int, byte: int) -> int:
        """Determinise one more transition."""
        open_, closed, pairs, all_ = [], -1, self._pairs, self.after
        own, known = iter(self.open[state]), self.states
        for node, last in zip(own, own, strict=True):
            found = all_[node].get(byte)
            if found is None:
                continue
            after, token, goes_on = found
            if token >= 0 > closed:
                if last < 0:
                    closed = token
                else:
                    fits = pairs.get(key := last << SHIFT | token)
                    if fits is None:
                        if len(pairs) >= MAX_PAIRS * self.part:
                            pairs.clear()
                        fits = pairs[key] = self.fits(last, token)
                    if fits:
                        closed = token
            if goes_on:
                open_ += (after, last)
        open_ += (0, closed)
        after = self._state(tuple(open_))
        if known is self.states:  # else the table was begun anew, without the state that this step leaves
            self.delta[state << 8 | byte] = after
        return after

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, closed = 0, []  # closed: the tokens that close after each byte not yet emitted
        delta, closes = self.delta, self.closes
        for byte in piece:
            after = delta.get(state << 8 | byte)
            if after is None:
                after = self._grow(state, byte)
                delta, closes = self.delta, self.closes
            state = after
            closed.append(closes[state])
            if len(closed) >= WINDOW:
                self._emit(closed, [self.depth[node] for node in self.open[state][::2]], out)
        return out + self._chain(closed, len(closed))

    def _chain(self, closed: list[int], end: int) -> list[int]:
        """The tokens that lead to the byte before ``end``."""
        tokens, length = [], self.length
        while end:
            token = closed[end - 1]
            tokens.append(token)
            end -= length[token]
        tokens.reverse()
        return tokens

    def _emit(self, closed: list[int], depths: list[int], out: list[int]) -> None:
        """Emit the tokens on which the hypotheses that began ``depths`` bytes ago agree."""
        chains = {len(closed) - d for d in depths}
        while len(chains) > 1:  # the latest start goes back by the token that closes there, until all meet
            at = max(chains)
            chains.remove(at)
            chains.add(at - self.length[closed[at - 1]])
        end = chains.pop()
        out += self._chain(closed, end)
        del closed[:end]


class Remembered(dict):
    """Strings to the little-endian 32-bit ids of their tokens, from ``make`` where they are new.

    Of bounded size: when full, it becomes the old generation, from which what
    is met again is taken over.
    """

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Utf8Stream:
    """An incremental UTF-8 state machine: ``feed`` bytes, get the text that is complete.

    A state says which bytes may follow and how many; 0 is that between
    characters. The bulk of a chunk ends at its last complete character and is
    decoded at once; the machine walks over what stands behind it, at most three
    bytes, and holds them back if it ends inside a character. Malformed parts
    become U+FFFD.
    """

    #: Lead bytes (first, last), how many bytes follow, and the range of the first of these (fixed by UTF-8).
    LEADS = [
        (0xC2, 0xDF, 1, 0x80, 0xBF),
        (0xE0, 0xE0, 2, 0xA0, 0xBF),
        (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F),
        (0xEE, 0xEF, 2, 0x80, 0xBF),
        (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF),
        (0xF4, 0xF4, 3, 0x80, 0x8F),
    ]

    def __init__(self) -> None:
        self.held = b""

    @classmethod
    def machine(cls) -> list[dict[int, int]]:
        """By state: byte to next state; a byte that is absent cannot follow."""
        steps: list[dict[int, int]] = [dict.fromkeys(range(0x80), 0)]
        for first, last, more, low, high in cls.LEADS:
            entry = len(steps)
            steps[0].update(dict.fromkeys(range(first, last + 1), entry))
            for k in range(more):
                after = 0 if k == more - 1 else entry + k + 1
                steps.append(dict.fromkeys(range(low if k == 0 else 0x80, (high if k == 0 else 0xBF) + 1), after))
        return steps

    @classmethod
    def unfinished(cls, data: bytes) -> int:
        """How many bytes at the end begin a character that more bytes could complete."""
        start = len(data) - 1
        while start >= max(0, len(data) - 3) and data[start] & 0xC0 == 0x80:
            start -= 1
        if start < max(0, len(data) - 3):
            return 0
        state = 0
        for byte in data[start:]:
            state = STEPS[state].get(byte, 0)
            if not state:
                return 0
        return len(data) - start

    def feed(self, data: bytes) -> str:
        data = self.held + data
        n = self.unfinished(data)
        self.held = data[len(data) - n :]
        return data[: len(data) - n].decode("utf-8", "replace")

    def close(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


#: The steps of the UTF-8 machine.
STEPS = Utf8Stream.machine()


class Codec:
    """Encoder and decoder of one vocabulary and split pattern, with a worker's caches, ``part`` of their bounds."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, part: float = 1.0):
        self.find = regex.compile(pattern).findall
        self.transducer = Transducer(ranks, part)
        self.pieces = Remembered(lambda p: array("i", self.transducer.encode(p.encode())).tobytes(), int(MAX_PIECES * part))
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers; none for null."""
        return b"".join(map(self.pieces.__getitem__, self.find(text))) if text else b""

    def decode(self, ids: Iterable[np.ndarray]) -> Iterator[str]:
        """Texts of chunks of ids, whose concatenation is the whole text."""
        stream = Utf8Stream()
        for chunk in ids:
            yield stream.feed(b"".join(map(self.bytes_of.__getitem__, chunk.tolist())))
        yield stream.close()

    def decoded(self, ids: np.ndarray) -> str:
        return "".join(self.decode(ids[i : i + DECODE_TOKENS] for i in range(0, len(ids), DECODE_TOKENS)))


def codec(path: str, pattern: str, part: float = 1.0) -> Codec:
    """One codec a worker process; the file at ``path`` must be on every machine."""
    return held((f"bpe {part}", path, pattern), lambda: Codec(read_ranks(path), pattern, part))


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.StringType())


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, decode_too: bool = False, part: float = 1.0) -> DataFrame:
    """Append ``ids``, the tokens of each whole text; with ``decode_too`` also ``decoded``, the text read back from them.

    ``part`` bounds the workers' caches: less of it is less memory and more time, with the same result.

    Null and empty texts have no ids and decode to the empty text. Special
    tokens are not looked for. Batches are bounded in bytes, so very long texts
    come alone; repeated rows are encoded alike; an empty table gives an empty
    one; columns named like the added ones give way to them. There is no
    shuffle.
    """

    def run(texts: list[str | None]) -> list[pa.Array]:
        own = codec(path, pattern, part)
        each = [own.encode(t) for t in texts]
        ids = np.frombuffer(b"".join(each), "<i4")
        ends = np.cumsum([0, *(len(e) // 4 for e in each)])
        out = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))]
        if decode_too:
            out.append(pa.array([own.decoded(ids[a:z]) for a, z in zip(ends, ends[1:], strict=False)], pa.string()))
        return out

    return mapped(df, [text], run, T.StructType([IDS] + [DECODED] * decode_too), keep)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Append ``decoded``, the text of the token ids of each row; null ids give the empty text."""

    def run(rows: list[list[int] | None]) -> list[pa.Array]:
        own = codec(path, pattern)
        return [pa.array([own.decoded(np.array(r or (), np.int32)) for r in rows], pa.string())]

    return mapped(df, [ids], run, T.StructType([DECODED]), keep)


def digests(df: DataFrame, keep: list[str], ids: bool = False, text: str = "text", part: float = 1.0) -> DataFrame:
    """``keep`` with n_tokens and the digests of ids and decoded bytes; ``ids`` keeps the tokens too."""
    import public_tokenizers

    out = encode(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, text, keep, decode_too=True, part=part)
    return out.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        *(["ids"] if ids else []),
    )


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


QUERIES = {"op1_bpe": op1_bpe}
ORACLES: dict[str, str] = {}
