"""The perfect hash of a vocabulary and the counts by it."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernweave.operators import vectorize


def vocabulary(n, seed=1):
    draw = random.Random(seed)
    words = {"".join(draw.choice("abcdeéñ한字") for _ in range(draw.randint(2, 7))) for _ in range(3 * n)}
    return sorted(words)[:n]


@pytest.mark.parametrize("n", [1, 2, 10, 203, 733])
def test_every_word_has_its_place(spark, n):
    words = vocabulary(n)
    places = vectorize.Places(words)
    assert sorted(p for p in places.slots if p is not None) == list(range(n)) and places.size <= 2 * n + 3
    df = spark.createDataFrame([(w,) for w in [*words, "none", "", *(w + "x" for w in words)]] + [(None,)], "w string")
    found = [tuple(r) for r in df.select("w", places.of(F.col("w"))).collect()]
    assert found[:n] == [(w, i) for i, w in enumerate(words)] and all(p is None for _, p in found[n:])


@pytest.mark.parametrize("n", [1, 10, 733])
def test_counts_and_vectors_equal_plain_ones(spark, n):
    draw, words = random.Random(2), vocabulary(n)
    texts = [" ".join(draw.choice([*words[:50], "other", "zz"]) for _ in range(draw.randint(0, 80))) for _ in range(60)] + [None, ""]
    model = vectorize.KeywordTfidf(words, "true")
    model.idf = {w: 1 + i / 7 for i, w in enumerate(words)}
    rows = model.arrays(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "t").orderBy("k").collect()
    for text, r in zip(texts, rows, strict=True):
        counts = Counter((text or "").split())
        raw = [counts[w] * model.idf[w] for w in words]
        norm = math.sqrt(sum(x * x for x in raw))
        assert r["feature"] == words
        assert (text is None and r["score"] in (None, [0.0] * n)) or np.allclose(r["score"], [x / norm if norm else 0.0 for x in raw])


def test_a_word_that_stands_twice_in_the_vocabulary(spark):
    df = spark.createDataFrame([("aa bb aa",)], "t string")
    assert np.allclose(vectorize.KeywordTfidf(["aa", "cc", "aa"]).arrays(df, "t").first()["score"], [1.0, 0.0, 1.0])


def test_words_with_one_checksum_are_salted(monkeypatch):
    own = vectorize.Places.checksum
    monkeypatch.setattr(vectorize.Places, "checksum", staticmethod(lambda w, s: own(w, s) if s else 7))
    assert vectorize.Places(["aa", "bb", "cc"]).salt == "1"


def test_time_hardly_grows_with_the_vocabulary(spark):
    """Ten times the words cost far less than ten times the time."""
    text = " ".join(f"w{i % 997}" for i in range(4000))
    df = spark.range(200).select(F.concat(F.lit(text), F.col("id").cast("string")).alias("t"))

    def seconds(n):
        plan = vectorize.KeywordTfidf([f"w{i}" for i in range(n)]).arrays(df, "t").agg(F.sum(F.size("score")))
        plan.collect()
        began = time.perf_counter()
        plan.collect()
        return time.perf_counter() - began

    assert seconds(700) < 4 * seconds(20)
