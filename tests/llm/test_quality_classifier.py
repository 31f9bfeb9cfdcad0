import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from fernweave.llm import quality_classifier as Q


def plain_features(text):
    """The same features by a dictionary of counts."""
    tokens = Q.TOKEN.findall(text or "")
    mask, mix = (1 << 64) - 1, int(Q._MIX)
    words = [xxhash.xxh3_64_intdigest(t.encode()) for t in tokens]
    shapes = [xxhash.xxh3_64_intdigest(b"\0" + Q.shape(t).encode()) for t in tokens]
    found = Counter(words + shapes)
    for hashes, same in ((words, True), (shapes, False)):
        for a, b in zip(hashes, hashes[1:]):
            found[int(Q._SAME) if same and a == b else (a * mix & mask ^ b) * mix & mask] += 1
    counts = Counter()
    for h, n in found.items():
        counts[(h * mix & mask) >> 64 - Q.BITS] += n
    norm = math.sqrt(sum(counts.values()))
    return {at: math.sqrt(n) / norm for at, n in counts.items()}


@pytest.mark.parametrize("text", [None, "", " \n", "one", "se se se se", "A b, C*** d%%% 12 x_y été 한글 😀!!", "word " * 50 + "\n| a | b |"])
@pytest.mark.parametrize("block", [4, 1 << 20])
def test_features_equal_plain_ones(text, block, monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", block)
    at, n = Q.features(text)
    value, again = Q.values(n), Q.unpacked(Q.packed(at, n))
    assert np.array_equal(again[0], at) and np.array_equal(again[1], n)
    expected = plain_features(text)
    assert list(at) == sorted(expected) and np.allclose(value, [expected[i] for i in at], atol=1e-6)


def test_learner_equals_scalar_updates():
    rng, z, n, learner = np.random.default_rng(0), Counter(), Counter(), Q.Learner()

    def weight(i):
        if abs(z[i]) <= Q.L1:
            return 0.0
        return -(z[i] - math.copysign(Q.L1, z[i])) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2)

    for _ in range(60):
        at = np.sort(rng.choice(40, 5, replace=False)).astype(np.int32)
        value, label = rng.random(5), int(rng.integers(2))
        learner.learn(at, value, label)
        x = [*zip(at.tolist(), value), (1 << Q.BITS, 1.0)]
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x)))
        for i, v in x:
            g, w = (p - label) * v, weight(i)
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / Q.ALPHA * w
            n[i] += g * g
    assert np.allclose(learner.weights(), [weight(i) for i in range((1 << Q.BITS) + 1)], atol=1e-9)


def test_query_on_held_out_rows(spark):
    out = Q.op11_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    assert len(out) == out.doc_id.nunique() == 1000
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert ((held.predicted == held.quality).mean()) > 0.93


def test_held_out_labels_and_other_columns_change_nothing(spark, folder):
    """Only labels that are not held out, and only texts, decide a score."""
    docs = [(i, f"word{i % 7} *** {'ab ' * (i % 5)}" if i % 3 else "plain words here.", "en", "a", 1) for i in range(60)]
    labels = [(i, int(i % 3 == 0), 0) for i in range(60)]
    first = {r["doc_id"]: r["score"] for r in Q.op11_quality_classifier(spark, folder(documents=docs, labels=labels)).collect()}
    other = spark.createDataFrame([(d[0], d[1], "x", f"s{d[0]}", 9) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    flipped = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q, _ in labels], "doc_id long, quality int")
    weights = Q.trained(other, flipped.where(~Q.held_out("doc_id")))
    again = {r["doc_id"]: r["score"] for r in Q.scored(other, weights, "text", ["doc_id"]).collect()}
    assert first == again and min(first.values()) < 0.5 < max(first.values())


def test_odd_documents_and_labels(spark, folder, odd_documents):
    labels = [(4, 1, 0), (4, 0, 0), (None, 1, 0), (8, None, None), (7, 0, 1), (9, 1, 0), (999, 1, 0), (11, 5, 0)]
    rows = Q.op11_quality_classifier(spark, folder(documents=odd_documents, labels=labels)).collect()
    assert len(rows) == len(odd_documents) and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1 and len({r["score"] for r in rows if r["doc_id"] == 4}) == 1
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]


def test_no_labels_and_no_documents(spark, folder):
    rows = Q.op11_quality_classifier(spark, folder(documents=[(1, "one"), (2, None)], labels=[])).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.5, 1)}


def test_empty_documents(spark, folder):
    assert Q.op11_quality_classifier(spark, folder(documents=[], labels=[(1, 1, 0)])).count() == 0


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "one two", 7, "k")], "id long, text string, SCORE int, shard string")
    out = Q.scored(df, Q.Learner().weights())
    assert out.columns == ["id", "text", "shard", "score"] and out.first()["score"] == 0.5


def test_the_sample_is_bounded_and_one_row_an_id(spark):
    docs = spark.createDataFrame([(i % 50, f"t{i}", "x") for i in range(100)], "doc_id long, text string, h string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    rows = Q.training_rows(docs, labels, "text", "doc_id", "quality", 20).collect()
    assert len(rows) == len({r["key"] for r in rows}) == 20 and {r["shard"] for r in rows} == {0}


def shards(spark, n):
    """Features of ``n`` shards of 12 random texts."""
    rng, rows = np.random.default_rng(n), []
    for i in range(12 * n):
        at = np.unique(rng.integers(0, 1 << Q.BITS, 400)).astype(np.int32)
        rows.append((i // 12, i, i, i % 2, Q.packed(at, rng.integers(1, 5, len(at)).astype(np.int32))))
    return rows, spark.createDataFrame(rows, "shard long, h long, key long, label int, features binary")


def test_the_mean_of_shards_equals_a_plain_one(spark):
    rows, sample = shards(spark, 5)
    state = None
    for _ in range(2):
        own = [Q.Learner(*(state or ())) for _ in range(5)]
        for shard, _, _, label, data in rows:
            at, n = Q.unpacked(data)
            own[shard].learn(at, Q.values(n), label)
        mean = Q.Learner()
        for one in own:
            mean.z += np.where(one.n != 0, one.z, 0) / 5
            mean.n += one.n / 5
        state = Q.mixed(sample, state)
        assert np.array_equal(state[0], mean.z) and np.array_equal(state[1], mean.n)
    assert Q.mixed(sample.limit(0), None) is None


def test_a_round_brings_one_state_to_the_driver(spark, monkeypatch):
    """Not one a shard: what the driver gets is bounded by the places."""
    _, sample = shards(spark, 40)
    kind, got = type(sample), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: (lambda r: (got.append(r), r)[1])(collect(df)))
    state = Q.mixed(sample, None)
    used = np.count_nonzero(state[1])
    (rows,) = got
    assert used > 100_000 and sum(len(v) for r in rows for v in r if isinstance(v, (bytes, bytearray))) == 20 * used
