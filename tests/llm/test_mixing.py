import random
import re

import duckdb
import numpy as np
import pytest
from compare import DATA
from pyspark.sql import functions as F

from fernweave.llm import mixing as M


def by_quotients(weights, seats, most):
    """Seats one by one to the highest quotient."""
    out = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i, m in enumerate(most) if out[i] < m and weights[i] > 0]
        if not open_:
            break
        out[max(open_, key=lambda i: (weights[i] / (2 * out[i] + 1), -i))] += 1
    return out


def test_sainte_lague():
    draw = random.Random(5)
    for _ in range(200):
        n = draw.randint(1, 8)
        weights = [draw.choice([0, draw.randint(1, 5), draw.random() * 100]) for _ in range(n)]
        most = [draw.randint(0, 40) for _ in range(n)]
        seats = draw.randint(0, 80)
        assert M.sainte_lague(weights, seats, most) == by_quotients(weights, seats, most)
    assert sum(M.sainte_lague([3.0, 1.0, 2.0], 10**9, [10**9] * 3)) == 10**9


def test_targets_stop_and_excess_goes_on():
    assert M.filled([10, 100, 100], [3, 1, 2], 315) == pytest.approx([20, 295 / 3, 590 / 3])
    assert M.filled([0, 10], [1, 1], 15) == [0, 15] and M.filled([], [], 0) == []


def test_every_block_is_taken_evenly():
    p = M.passes(10, 13, 7)
    assert p.sum() == 13 and set(p) == {1, 2} and M.passes(0, 0, 1).tolist() == []
    assert (M.passes(10, 13, 7) == p).all() and (M.passes(100, 50, 8) != M.passes(100, 50, 9)).any()


def plain_mix(spark, rows, shard_words=1 << 17):
    """Words of each row, by place, and how often they are taken: seat by seat, then word by word.

    ``rows`` are (key, source, text); only the hashes are the engine's.
    """
    n = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, _, t in rows]
    df = spark.createDataFrame([(i, k, t) for i, (k, _, t) in enumerate(rows)], "i long, k long, t string")
    hashes = {r["i"]: (r["h"], r["s"]) for r in df.withColumn("h", F.xxhash64(F.lit(0), "k", "t")).withColumn("s", F.xxhash64("h")).collect()}
    order = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(m for m, r in zip(n, rows, strict=True) if r[1] == s) for s in order}
    weight, target, left = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, {}, 1.5 * sum(n)
    while len(target) < len(order):
        open_ = [s for s in order if s not in target]
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > 2 * size[s]]
        target |= {s: 2.0 * size[s] for s in full} if full else {s: unit * weight[s] for s in open_}
        left -= sum(2.0 * size[s] for s in full)
    block = min(max(int(min((t for t in target.values() if t > 0), default=0)) // 500, 32), 1024)
    per_shard = max(shard_words, -(-sum(n) // (1 << 16)))
    shards = {}
    for i, (_, s, _) in enumerate(rows):
        if n[i]:
            shards.setdefault((order.index(s), hashes[i][1] % (-(-size[s] // per_shard) or 1)), []).append(i)
    blocks = {k: -(-sum(n[i] for i in own) // block) for k, own in shards.items()}
    count = [sum(b for (sid, _), b in blocks.items() if sid == j) for j in range(len(order))]
    wanted = [target[s] * c / size[s] if size[s] else 0.0 for s, c in zip(order, count, strict=True)]
    seats = by_quotients(wanted, round(sum(wanted)), [2 * c for c in count])
    taken = [[0] * m for m in n]
    for j in range(len(order)):
        own = sorted(k for k in blocks if k[0] == j)
        for k, quota in zip(own, by_quotients([blocks[k] for k in own], seats[j], [2 * blocks[k] for k in own]), strict=True):
            ranked = sorted(range(blocks[k]), key=lambda b: (int(M.scrambled(np.array([b]), k[0] * 65_537 + k[1])[0]), b))
            times = [quota // blocks[k]] * blocks[k]
            for b in ranked[: quota % blocks[k]]:
                times[b] += 1
            at = 0
            for i in sorted(shards[k], key=lambda i: (hashes[i][0], rows[i][0], n[i])):
                for w in range(n[i]):
                    taken[i][w] = times[(at + w) // block]
                at += n[i]
    return taken


@pytest.mark.parametrize("shard", [512, 1 << 17])
def test_mix_equals_plain_version(spark, shard):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    plain = {r[0]: t for r, t in zip(rows, plain_mix(spark, rows, shard), strict=True)}
    for r in M.mix(docs, spans=True, shard_words=shard).collect():
        times = [0] * r["size"]
        for a, z, t in r["spans"]:
            times[a:z] = [t] * (z - a)
        assert times == plain[r["doc_id"]] and r["taken"] == sum(times)


def check(rows, sources, tolerance):
    total = sum(r["size"] for r in rows)
    size = {}
    for r in rows:
        s = sources[r["doc_id"]]
        size[s] = size.get(s, 0) + r["size"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, M.filled([size[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * total), strict=True))
    taken = dict.fromkeys(order, 0)
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(targets[s]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= tolerance for s in order)


@pytest.mark.parametrize("shard", [64, 1 << 17])
def test_targets_are_met(spark, shard, monkeypatch):
    monkeypatch.setattr(M, "BROADCAST_SOURCES", -1 if shard == 64 else 50_000)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = M.mix(docs, shard_words=shard).collect()
    sizes = dict(duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{DATA}/documents.parquet')").fetchall())
    assert {r["doc_id"]: r["size"] for r in rows} == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in sizes.items()}
    check(rows, {r["doc_id"]: r["source"] for r in docs.collect()}, 3000 if shard == 64 else 64)
    assert sorted(map(tuple, M.mix(docs.repartition(3), shard_words=shard).collect())) == sorted(map(tuple, rows))


def test_edges(spark, folder, odd_documents):
    at = folder(documents=odd_documents)
    rows = M.op9_mixing(spark, at).collect()
    assert len(rows) == len(odd_documents)
    check(rows, {d[0]: d[3] for d in odd_documents}, 96)
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))


def test_texts_follow_the_plan(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    plan = {r["doc_id"]: (r["size"], r["taken"]) for r in M.mix(docs).collect()}
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = M.mixed_documents(docs)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        assert r["n_chars"] == len(r["text"])
        got.setdefault(r["doc_id"], []).append(r["text"])
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    for k, (size, taken) in plan.items():
        texts = got.get(k, [])
        assert sum(len(words(t)) for t in texts) == taken and len(texts) <= 2
        assert not taken or taken < size or whole[k] in texts


def test_repeated_rows_and_empty_table(spark, folder, odd_documents):
    df = spark.read.parquet(folder(documents=odd_documents))
    taken = sum(r["taken"] for r in M.mix(df).collect())
    words = M.mixed_documents(df).select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words == taken
    assert M.mix(df.limit(0)).count() == 0 and M.mixed_documents(df.limit(0)).count() == 0


def test_rows_without_words_are_not_gathered(spark):
    df = spark.range(3000).selectExpr("id doc_id", "'hot' source", "CASE WHEN id % 100 = 0 THEN 'one two three' WHEN id % 3 = 0 THEN ' ' WHEN id % 3 = 1 THEN '' END text")
    out = M.mix(df, spans=True)
    rows = out.collect()
    assert len(rows) == 3000 and all(r["taken"] == 0 and r["spans"] == [] for r in rows if r["size"] == 0)
    grouped = out._jdf.queryExecution().optimizedPlan().toString().split("FlatMapGroupsInPandas")[1]
    assert sum(r["taken"] for r in rows) > 0 and re.search(r"size#\d+L? > 0", grouped)


def test_repeated_rows_take_their_own_spans(spark, tmp_path):
    """Many rows that are equal: their words are taken as planned, and none is gathered by what repeats."""
    spark.range(400).selectExpr("7L doc_id", "'one two three four five' text", "'a' source").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    out = M.mixed_documents(df)
    assert out.select(F.sum(F.size(F.split("text", r"\s+")))).first()[0] == sum(r["taken"] for r in M.mix(df).collect())
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(M, "SOURCES", 3)
    df = spark.range(5).selectExpr("id doc_id", "string(id) source", "'x' text")
    with pytest.raises(ValueError):
        M.mix(df)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", "one two", 5, 6, "x")], "doc_id long, source string, text string, size int, taken int, h string")
    assert M.mix(df).first()["size"] == 2
    assert M.mixed_documents(df).columns == df.columns
