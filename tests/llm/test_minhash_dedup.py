import random
import re

import numpy as np
import pytest
from compare import DATA

from fernweave.llm import minhash_dedup as D

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    """All pairs; rows that repeat an id are one document."""
    root = {k: k for k, _ in rows if k is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    own = [(k, sets(t)) for k, t in rows if k is not None]
    for i, (a, s) in enumerate(own):
        for b, t in own[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((k or 0, len(sets(t)), find(k) if k is not None else -1, k is None or find(k) == k) for k, t in rows)


def got(df):
    return sorted((r["doc_id"] or 0, r["n_shingles"], -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in df.collect())


def test_edges(spark, folder, odd_documents):
    rows = [d[:2] for d in odd_documents]
    assert got(D.op10_minhash_dedup(spark, folder(documents=odd_documents))) == brute(rows)


def near_copies(n, seed, words=120, edits=4):
    """One large group of copies with a few words changed, so that links form chains, and some other texts."""
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 5000)}" for _ in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(draw.randint(0, edits)):
            own[draw.randrange(words)] = f"x{draw.randint(0, 10**6)}"
        rows.append((i * 3 + 1, " ".join(own)))
    rows += [(10**6 + i, " ".join(f"y{draw.randint(0, 300)}" for _ in range(60))) for i in range(40)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("tile", "ids"), [(8, 1_000_000), (8, -1), (128, 1_000_000)])
def test_large_group_of_near_copies(spark, folder, monkeypatch, tile, ids):
    monkeypatch.setattr(D, "TILE", tile)
    monkeypatch.setattr(D, "FEW", 4)
    monkeypatch.setattr(D, "BROADCAST_IDS", ids)
    rows = near_copies(150, 4)
    assert got(D.op10_minhash_dedup(spark, folder(documents=rows))) == brute(rows)


def test_bucket_of_members_without_links(spark, monkeypatch):
    """Pages of one template meet in buckets but are no copies: all pairs of tiles are compared, and two copies found."""
    monkeypatch.setattr(D, "TILE", 16)
    monkeypatch.setattr(D, "FEW", 4)
    draw = random.Random(9)
    frame = [f"t{i}" for i in range(150)]
    rows = [(i, " ".join(frame + [f"p{draw.randint(0, 10**6)}" for _ in range(50)])) for i in range(160)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in (5, 77)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(D.near_duplicates(df)) == brute(rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", 5, 6, "x", 7), (2, "A b", 5, 6, "y", 8)], "doc_id long, text string, id int, n_shingles int, bands string, f1 int")
    assert got(D.near_duplicates(df)) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert [tuple(r) for r in D.deduplicated(df).collect()] == [(1, "a b", 5, 6, "x", 7)]


def test_query_equals_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    assert got(D.op10_minhash_dedup(spark, DATA)) == brute([tuple(r) for r in df.collect()])


def test_coordinates_are_one_permutation_shifted():
    h = D.CirculantMinHash(20, slots=64)
    assert sorted(h.first) == sorted(h.shifted[:, 0].tolist()) == list(range(64))
    for x in range(64):
        assert h.shifted[x].tolist() == [h.shifted[(x + k) % 64, 0] for k in range(20)]


def test_signatures_estimate_similarity():
    draw = np.random.Generator(np.random.PCG64(1))
    h = D.hasher(D.BANDS * D.ROWS)
    a = draw.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = np.concatenate((a[:850], draw.integers(0, 1 << 63, 150).astype(np.uint64)))
    share = (h.signature(np.unique(a)) == h.signature(np.unique(b))).mean()
    assert abs(share - 850 / 1150) < 0.12


def test_forest_joins_all_links():
    sets_ = [np.arange(i, i + 100, dtype=np.uint64) for i in range(0, 40, 4)]
    edges = D.linked(np.arange(10), sets_, 85)
    assert {a for a, _ in edges} == set(range(1, 10)) and {b for _, b in edges} == {0}


def test_kept_rows(spark, folder, odd_documents):
    df = spark.read.parquet(folder(documents=odd_documents))
    out = D.deduplicated(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == sorted(k for k, _, _, kept in brute([d[:2] for d in odd_documents]) if kept)


def test_empty_table(spark, folder):
    assert D.op10_minhash_dedup(spark, folder(documents=[])).count() == 0


def test_deduplicated_at_80_percent(spark):
    words = [f"w{i}" for i in range(204)]  # 200 shingles; a changed word in the middle costs 5
    texts = [words, *([f"x{k}" if i in at else w for i, w in enumerate(words)] for k, at in enumerate([(40, 80, 120, 160), (30, 50, 70, 90, 110, 130)]))]
    # Jaccard with the first: 180 of 220 shingles (0.82), and 170 of 230 (0.74).
    rows = [(i, " ".join(t), "en", "a", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = lambda *given: sorted(r["doc_id"] for r in D.deduplicated(docs, "doc_id", "text", *given).collect())
    assert left(80, 35, 5) == [0, 2] and left() == [0, 1, 2]
