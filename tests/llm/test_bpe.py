import codecs
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from fernweave.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def pieces():
    draw = random.Random(3)
    tokens = list(bpe.read_ranks(PATH))
    for alphabet in (b"ab", b"aeinotrs ", bytes(range(256)), b".-=*# "):
        for _ in range(1500):
            yield bytes(draw.choice(alphabet) for _ in range(draw.randint(1, 40)))
    for _ in range(5000):
        yield b"".join(draw.choice(tokens) for _ in range(draw.randint(1, 4)))
    yield b"a" * 5000
    yield b"ab" * 3000


def test_transducer_equals_merging(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 3000)  # the table is begun anew many times
    monkeypatch.setattr(bpe, "WINDOW", 64)
    own = bpe.Transducer(bpe.read_ranks(PATH))
    for piece in pieces():
        assert own.encode(piece) == reference._core_bpe.encode_single_piece(piece)


def test_tables_are_bounded_inside_a_pre_token(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 2000)
    monkeypatch.setattr(bpe, "MAX_STEPS", 4000)
    own, draw = bpe.Transducer(bpe.read_ranks(PATH)), random.Random(5)
    piece = bytes(draw.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    ids = own.encode(piece)
    assert len(own.open) <= 2000 and len(own.delta) <= 4000
    assert b"".join(own.bytes_of[i] for i in ids) == piece
    assert all(own.fits(a, b) for a, b in zip(ids, ids[1:], strict=False))
    assert ids[:1000] == reference._core_bpe.encode_single_piece(piece[:8000])[:1000]


def test_smaller_caches_give_the_same_ids(reference, monkeypatch):
    for name, most in (("MAX_STATES", 3000), ("MAX_STEPS", 6000), ("MAX_PAIRS", 300), ("MAX_PIECES", 400)):
        monkeypatch.setattr(bpe, name, most)
    own, draw = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN, 0.5), random.Random(6)
    text = " ".join("".join(draw.choice("aeinotrsé한") for _ in range(draw.randint(1, 12))) for _ in range(20_000))
    assert list(memoryview(own.encode(text)).cast("i")) == reference.encode_ordinary(text)
    assert len(own.pieces) <= 200 and len(own.pieces.old) <= 200
    assert len(own.transducer.open) <= 1500 and len(own.transducer.delta) <= 3000 and len(own.transducer._pairs) <= 150


def test_stream_joins_cut_characters():
    data = "aé한😀z".encode() + b"\xff\xc3(\xed\xa0\x80" + "é".encode()[:1]
    for step in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        text = "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.close()
        assert text.startswith("aé한😀z") and "\ufffd" in text
    assert bpe.Utf8Stream().feed("aé한😀z".encode()) == "aé한😀z"
    draw = random.Random(4)
    for _ in range(2000):  # any bytes in any chunks, as the library's own incremental decoder
        data = b"".join(draw.choice([b"a", "é".encode(), "한".encode(), "😀".encode(), bytes([draw.randrange(256)])]) for _ in range(6))
        stream, known = bpe.Utf8Stream(), codecs.getincrementaldecoder("utf-8")("replace")
        cut = draw.randint(0, len(data))
        assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.close() == known.decode(data[:cut]) + known.decode(data[cut:], True)


def digests(text, reference):
    ids = reference.encode_ordinary(text)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(" ".join(map(str, ids)).encode()), sha(text.encode())


def test_query_equals_library(spark, folder, odd_documents, reference):
    rows = bpe.op1_bpe(spark, folder(documents=odd_documents)).collect()
    assert len(rows) == len(odd_documents)
    by = {(r[0], r[1] or ""): digests(r[1] or "", reference) for r in odd_documents}
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) in [v for (k, _), v in by.items() if k == r["doc_id"]]


def test_round_trip_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "héllo wörld", 5), (2, None, 6)], "k int, text string, ids int")
    out = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["k", "text", "ids"]
    back = bpe.decode(out, PATH, public_tokenizers.PATTERN).orderBy("k").collect()
    assert [r["decoded"] for r in back] == ["héllo wörld", ""]


def test_empty_table(spark, folder):
    assert bpe.op1_bpe(spark, folder(documents=[])).count() == 0
