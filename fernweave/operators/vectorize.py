"""Keyword vectors of texts, kept sparse as rows or as a pair of arrays."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable
from itertools import count as numbers

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernweave.functions.text import tokens, unpunctuated

#: Words of each class that other classes do without, and stop words of plain vectors.
CLASS_WORDS = {
    "Client_Server_Protocol_Manipulation": ["scalaj", "redirecturl", "curl", "guzzlehttp"],
    "Exposure_of_Sensitive_Information_to_an_Unauthorized_Actor": [
        "wp",
        "getdata",
        "yisouspider",
        "manifest",
        "getlist",
        "scaninfo",
        "pubmatic",
        "crawler",
    ],
    "Forceful_Browsing": [
        "bot",
        "googlebot",
        "php",
        "robots",
        "bingbot",
        "uptimerobot",
        "well",
        "known",
        "bidswitchbot",
        "propfind",
        "webdav",
    ],
    "Scanning_for_Vulnerable_Software": ["urllib", "zgrab"],
    "SQL_Injection": ["between"],
}


def terms(vocabulary: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in vocabulary])


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` refers to it."""
    return F.get(F.transform(F.array(value), f), 0)


def constants(values: Iterable[str], kind: str) -> Column:
    """An array literal of many values in few expressions: one text that is split and cast when the plan is optimised."""
    return F.split(F.lit("\0".join(values)), "\0", -1).cast(f"array<{kind}>")


class Places:
    """The place of a word in a vocabulary, found in constant time: a perfect hash in two steps.

    A word's checksum names a bucket; the bucket's displacement, chosen so that no
    two words of the vocabulary meet, gives its slot. The slot holds one word,
    which is compared. Both tables are literals, as large as the vocabulary.
    """

    def __init__(self, vocabulary: list[str]):
        self.words = list(dict.fromkeys(vocabulary))
        n = len(self.words)
        prime = (k for k in numbers(max(2, n * 5 // 4 + 1)) if all(k % d for d in range(2, math.isqrt(k) + 1)))
        self.buckets, self.size = max(1, n // 4), next(prime)
        self.salt = next(s for s in (str(i) if i else "" for i in numbers()) if self.placed(s))

    def placed(self, salt: str) -> bool:
        """Whether each bucket finds a displacement with this salt; the largest buckets are placed first."""
        self.moves, self.slots = [0] * self.buckets, [None] * self.size
        own: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for place, w in enumerate(self.words):
            c = self.checksum(w, salt)
            own[c % self.buckets].append((c, place))
        for b in sorted(range(self.buckets), key=lambda b: -len(own[b])):
            for move in range(self.size):
                at = [self.slot(c, move) for c, _ in own[b]]
                if len(set(at)) == len(at) and all(self.slots[i] is None for i in at):
                    break
            else:
                return False
            self.moves[b] = move
            for i, (_, place) in zip(at, own[b], strict=True):
                self.slots[i] = place
        return True

    @staticmethod
    def checksum(word: str, salt: str) -> int:
        return zlib.crc32((salt + word).encode())

    def slot(self, c: int, move: int) -> int:
        return (c // self.buckets + move * (1 + c % 65521)) % self.size

    def of(self, word: Column) -> Column:
        """The place (from 0) of a word, null for one outside the vocabulary."""
        moves, places = constants(map(str, self.moves), "bigint"), constants((str(-1 if p is None else p) for p in self.slots), "int")
        words = constants(("" if p is None else self.words[p] for p in self.slots), "string")
        move = lambda c: F.get(moves, (c % self.buckets).cast("int"))
        slot = lambda c: ((F.floor(c / self.buckets) + move(c) * (1 + c % 65521)) % self.size).cast("int")
        at = F.crc32(F.concat(F.lit(self.salt), word).cast("binary"))
        return bound(bound(at, slot), lambda i: F.when((F.get(words, i) == word) & (F.get(places, i) >= 0), F.get(places, i)))

    def counts(self, words: Column) -> Column:
        """How often each word of the vocabulary stands in an array, in one pass and one sort of the places found.

        Every place is added once and all are sorted; a place's count is the
        distance of its last one from that before, less the one added. Null if the array is.
        """
        every = F.sequence(F.lit(0), F.lit(len(self.words) - 1))
        hits = F.transform(F.filter(words, lambda w: w.isin(self.words)), self.of)  # a hash set keeps other words from the places
        last = lambda a: F.filter(F.transform(a, lambda x, i: F.when(F.get(a, i + 1).eqNullSafe(x), None).otherwise(i)), lambda i: i.isNotNull())
        steps = lambda e: F.transform(e, lambda x, i: x - F.coalesce(F.get(e, i - 1), F.lit(-1)) - 1)
        return F.when(words.isNotNull(), bound(bound(F.sort_array(F.concat(hits, every)), last), steps))


def keyword_counts(df: DataFrame, keys: list[str], text: str, vocabulary: list[str]) -> DataFrame:
    """(keys, term, tf): how often each word of the vocabulary stands in a text; absent words have no row."""
    found = df.select(*keys, F.explode(F.filter(tokens(text), lambda t: t.isin(list(vocabulary)))).alias("term"))
    return found.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def document_frequency(df: DataFrame, text: str) -> DataFrame:
    """(term, tf, df) over the whole table, in one pass and one shuffle: all terms of a text count for tf, its distinct ones for df."""
    both = df.select(tokens(text).alias("t")).select(F.posexplode(F.array("t", F.array_distinct("t"))).alias("once", "terms"))
    rows = both.select("once", F.explode("terms").alias("term"))
    return rows.groupBy("term").agg(F.count_if(F.col("once") == 0).alias("tf"), F.sum("once").alias("df"))


def learned_vocabulary(df: DataFrame, text: str, user: list[str], limit: int) -> DataFrame:
    """(rank, term, tf): the ``limit`` terms, user words first, then by frequency, then by name."""
    counts = df.select(F.explode(tokens(text)).alias("term")).groupBy("term").agg(F.count("*").alias("tf"))
    own = df.sparkSession.createDataFrame([(w,) for w in user], "term string").withColumn("is_user", F.lit(1))
    both = counts.join(own, "term", "full").select("term", F.coalesce("tf", F.lit(0)).cast("long").alias("tf"), F.coalesce("is_user", F.lit(0)).alias("is_user"))
    top = both.orderBy(F.desc("is_user"), F.desc("tf"), "term").limit(limit)
    order = Window.orderBy(F.desc("is_user"), F.desc("tf"), "term")
    return top.withColumn("rank", F.row_number().over(order)).select("rank", "term", "tf")


def bag_of_words(df: DataFrame, keys: list[str], text: str, size: int) -> DataFrame:
    """(keys, term, tf) of the ``size`` most frequent terms of the table; ties by name."""
    words = df.select(*keys, F.explode(tokens(text)).alias("term"))
    top = words.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(size).select("term")
    return words.join(F.broadcast(top), "term", "left_semi").groupBy(*keys, "term").agg(F.count("*").alias("tf"))


class KeywordTfidf:
    """L2-normalised TF-IDF over a fixed vocabulary.

    ``stored``: every word counts as present in every document when document
    frequencies are taken, so each idf is 1 and the vector is the normalised
    term frequency. ``true``: idf = ln((1 + n) / (1 + df)) + 1.
    """

    def __init__(self, vocabulary: list[str], mode: str = "stored"):
        if mode not in ("stored", "true"):
            raise ValueError(mode)
        self.vocabulary, self.mode, self.idf = vocabulary, mode, dict.fromkeys(vocabulary, 1.0)

    def fit(self, df: DataFrame, text: str) -> KeywordTfidf:
        if self.mode == "true":
            hits = F.array_intersect(tokens(text), terms(self.vocabulary))
            rows = df.select(F.explode(hits).alias("term")).groupBy("term").count().collect()  # a row a vocabulary word
            seen, n = {r["term"]: r["count"] for r in rows}, df.count()
            self.idf = {w: math.log((1 + n) / (1 + seen.get(w, 0))) + 1 for w in self.vocabulary}
        return self

    def state(self) -> dict:
        return {"vocabulary": self.vocabulary, "mode": self.mode, "idf": self.idf}

    @classmethod
    def of(cls, state: dict) -> KeywordTfidf:
        out = cls(state["vocabulary"], state["mode"])
        out.idf = state["idf"]
        return out

    def rows(self, df: DataFrame, keys: list[str], text: str) -> DataFrame:
        """(keys, term, weight) of the words present, from the row's own vector: there is no shuffle.

        Rows that repeat their keys have vectors of their own.
        """
        vectors = self.arrays(df.select(*keys, F.col(text).alias("__text")), "__text")
        found = F.filter(F.arrays_zip("feature", "score"), lambda p: p["score"] > 0)
        return vectors.select(*keys, F.inline(found).alias("term", "weight"))

    def arrays(self, df: DataFrame, text: str) -> DataFrame:
        """Append ``feature`` (the vocabulary) and ``score`` (a weight for each word), within the row.

        The work is linear in the tokens and the vocabulary together, not in their product.
        """
        places = Places(self.vocabulary)
        idf = constants((repr(float(self.idf[w])) for w in places.words), "double")
        out = df.withColumn("__r", F.zip_with(places.counts(tokens(text)), idf, lambda a, b: a.cast("double") * b))
        norm = F.sqrt(F.aggregate("__r", F.lit(0.0), lambda s, x: s + x * x))
        out = out.withColumn("__n", norm).withColumn("feature", terms(self.vocabulary))
        score = F.transform("__r", lambda x: F.when(F.col("__n") > 0, x / F.col("__n")).otherwise(0.0))
        if len(places.words) < len(self.vocabulary):  # words that stand there twice have two places
            at = F.array(*[F.lit(places.words.index(w)) for w in self.vocabulary])
            score = bound(score, lambda own: F.transform(at, lambda i: F.get(own, i)))
        return out.withColumn("score", score).drop("__r", "__n")


def keyword_hits(df: DataFrame, text: str, label: str, vocabulary: list[str], class_words: dict[str, list[str]] = CLASS_WORDS) -> DataFrame:
    """Rows whose text holds a word of the vocabulary less the class words of other classes than its own."""
    out = None
    known = list(class_words)
    for name in [*known, None]:
        lost = {w for k, ws in class_words.items() if k != name for w in ws}
        own = [w for w in vocabulary if w not in lost]
        mine = (F.col(label) == name) if name else ~F.coalesce(F.col(label).isin(known), F.lit(False))
        hit = F.arrays_overlap(tokens(text), terms(own)) if own else F.lit(False)
        out = (mine & hit) if out is None else (out | (mine & hit))
    return df.where(out)


def plain_tfidf(df: DataFrame, keys: list[str], text: str, n: int = 1, stop: list[str] = (), max_features: int = 1000, longest: int = 30) -> DataFrame:
    """(keys, term, weight): L2-normalised smooth TF-IDF of word ``n``-grams, without punctuation and stop words.

    The ``max_features`` most frequent terms of at most ``longest`` characters are features.
    """
    words = F.filter(tokens(unpunctuated(text)), lambda t: ~t.isin(list(stop))) if stop else tokens(unpunctuated(text))
    grams = words if n == 1 else F.when(F.size("__w") >= n, F.transform(F.sequence(F.lit(1), F.size("__w") - n + 1), lambda i: F.array_join(F.slice("__w", i, n), " "))).otherwise(F.array().cast("array<string>"))
    long = df.select(*keys, words.alias("__w")).select(*keys, F.explode(grams if n > 1 else F.col("__w")).alias("term")).where(F.length("term") <= longest)
    tf = long.groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    stats = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df")).orderBy(F.desc("total"), "term").limit(max_features)
    total = df.agg(F.count("*").alias("n"))
    weighted = tf.join(stats, "term").withColumn("raw", F.col("tf") * (F.log((1 + total.scalar()) / (1 + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*keys)))
    return weighted.select(*keys, "term", (F.col("raw") / norm).alias("weight"))
