import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fernweave.llm import token_alignment as L

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTES = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def tokens(libraries, text):
    """Ids and bytes of both tokenizers on the whole text."""
    a, b = libraries
    e = a.encode(" " + text, add_special_tokens=False)
    first = list(zip(e.ids, [bytes(map(BYTES.__getitem__, t)) for t in e.tokens], strict=True))
    pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
    return first, [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]


def brute(libraries, rows):
    """Documents' rows by whole texts, tokens and all pairs of them."""
    linked, groups, counts = {}, {}, Counter()
    for k, (_, text) in enumerate(rows):
        linked[k], groups[k] = [], []
        if not text:
            continue
        a, b = tokens(libraries, text)
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            continue
        at, spans = 0, []
        for side in (a, b):
            at, ends = 0, []
            for i, x in side:
                ends.append((i, at, at + len(x)))
                at += len(x)
            spans.append(ends)
        low = 0
        for i, s, e in spans[0]:
            while spans[1][low][2] <= s:
                low += 1
            j = low
            while j < len(spans[1]) and spans[1][j][1] < e:
                linked[k].append((i, spans[1][j][0]))
                j += 1
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        sides = [Counter(), Counter()]
        for side, found in zip(spans, sides, strict=True):
            at = 0
            for i, _, e in side:
                found[cuts[at]] = f"{found[cuts[at]]},{i}" if found[cuts[at]] else str(i)
                at += e == cuts[at]
        groups[k] = [f"{sides[0][c]}|{sides[1][c]}" for c in cuts]
        counts.update(linked[k])
        groups[k] = groups[k], len(a), len(b)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for k, (key, _) in enumerate(rows):
        parts, n_a, n_b = groups[k] or ([], 0, 0)
        out.append((key, n_a, n_b, len(parts), len(linked[k]), sum(counts[p] == most[p[1]] for p in linked[k]), sum(counts[p] for p in linked[k]), ";".join(parts)))
    return out, counts, most


def compare(libraries, rows, found, pairs):
    expected, counts, most = brute(libraries, rows)
    assert len(found) == len(expected)
    order = lambda r: (r[0] is None, r[0] or 0, r[1:7])
    for got, want in zip(sorted((tuple(r) for r in found), key=order), sorted(expected, key=order), strict=True):
        assert got == want
    assert {(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF): (r["count"], r["best"]) for r in pairs} == {p: (n, n == most[p[1]]) for p, n in counts.items()}


ODD = [
    "a", " ", "  ", "\n", "\r", "a\r\nb;\r\n", "x {\r\n}\r\n\r\n", " lead", "trail ", "a\n  b\n\n\tc", "tab\tend\t", "▁", "a▁b", "<s> </s> <unk> <0x41> <|endoftext|>", "nul\0in \0 text",
    " nbsp　wide em\x85nel\x1cfs", "été 한글 日本語 😀 👩‍👩‍👧 ́", "don't I'll we've 123456 3.14", "word" * 3000, "a" * 5000 + " " * 3000 + "b", "#!$%^&*()\r", "\r\r\r", "﻿bom", "ﬁ ligature ①",
]


def test_whole_results_equal_brute_force(spark, libraries, odd_documents, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_CHARS", 2000)  # several blocks a partition
    monkeypatch.setattr(L, "HOT_SEGMENTS", 20)  # most segments and pairs are joined by a shuffle
    monkeypatch.setattr(L, "HOT_PAIRS", 30)
    rows = [(r[0], r[1]) for r in odd_documents] + [(100 + i, t) for i, t in enumerate(ODD)] + [(100 + i, t) for i, t in enumerate(ODD[:5])]
    found, pairs = L.aligned(spark.createDataFrame(rows, "k long, text string"), A, B)
    assert found.columns == ["k", *L.NUMBERS, "groups"]
    compare(libraries, rows, found.collect(), pairs.collect())


def test_random_texts_equal_brute_force(spark, libraries):
    draw = random.Random(5)
    parts = ["the", " ", "  ", "\r", "\n", "\r\n", "\t", ";", "{", "}", "été", "한", "x1", "'s", "...", " ", "　", "\x85", "\x1c", "A", "zz", "0", "▁" * 0, " ", "*/", '"', "ﬁ", "😀"]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(1, 30)))) for i in range(1500)]
    found, pairs = L.aligned(spark.createDataFrame(rows, "k long, text string").repartition(3), A, B)
    compare(libraries, rows, found.collect(), pairs.collect())


def test_query_equals_brute_force(spark, libraries):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    expected = brute(libraries, docs)[0]
    found = {r["doc_id"]: r for r in L.op13_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(expected)
    for want in expected:
        got = tuple(found[want[0]])
        assert got[:7] == want[:7]
        assert got[7] == (hashlib.sha256(want[7].encode()).hexdigest() if want[1] else "")


def test_splits_stand_only_where_no_entry_reaches():
    segments = L.vocabularies(A, B).segments
    assert segments(" a;\r\n b\r\n") == [" a;\r\n b", "\r\n"] and "".join(segments(" x\t\ty ")) == " x\t\ty "
    split = re.compile(L.Vocabularies.pattern([" a", "a b", ";\r"])).findall
    assert split(" a b;\rc d") == [" a b;\rc", " d"]


def test_long_documents_go_in_steps(spark, libraries):
    text = "one two " * 300_000
    found, _ = L.aligned(spark.createDataFrame([(1, text)], "k long, text string"), A, B, digest=True)
    r = found.first()
    a, b = tokens(libraries, text)
    assert (r["n_a"], r["n_b"]) == (len(a), len(b)) and len(r["groups"]) == 64


def test_clashing_columns_and_empty_tables(spark, folder):
    df = spark.createDataFrame([(1, 2, "x", 3, 4, "b c", "d")], "block int, idx int, `keep_0` string, N_A int, codes int, text string, `a.b` string")
    out, _ = L.aligned(df, A, B)
    assert out.columns == ["block", "idx", "keep_0", "codes", "a.b", *L.NUMBERS, "groups"]
    assert tuple(out.first())[:5] == (1, 2, "x", 4, "d")
    assert L.op13_token_alignment(spark, folder(documents=[])).count() == 0


def test_texts_without_tokens_count_for_no_pair(spark):
    rows = [(1, None), (2, ""), (3, "a▁b")]
    found, pairs = L.aligned(spark.createDataFrame(rows, "k long, text string"), A, B, digest=True)
    assert {tuple(r)[1:] for r in found.collect()} == {(0, 0, 0, 0, 0, 0, "")} and pairs.count() == 0
