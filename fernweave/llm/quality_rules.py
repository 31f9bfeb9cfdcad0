"""Quality rules as a short-circuit cascade.

A rule rejects a document by a few measures of its whole text. On a bounded
sample of rows (``sample_rows``) from partitions all over the table, executors
measure each rule's time and share of rejections; the rules then run in the order of rejections per second, and a
document leaves the cascade at the first rule that rejects it. Measures are
computed when a rule first asks for them and shared by later rules. The order
changes the time only: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fernweave.llm.common import WORD, held, mapped, measured, table

#: Characters that count as symbols (fixed by the contract).
SYMBOLS = "#*$%&|<>"


class Measures:
    """Measures of one text, each computed once and only if needed; a null text has no words."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_marks(self) -> int:
        return self.text.count("!")

    @cached_property
    def lines(self) -> list[str]:
        return self.text.split("\n")

    @cached_property
    def n_lines(self) -> int:
        """Lines that hold a word."""
        return sum(1 for x in self.lines if WORD.search(x))

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines that hold a word and equal an earlier line."""
        if len(set(self.lines)) == len(self.lines):
            return 0
        return sum(n - 1 for x, n in Counter(self.lines).items() if n > 1 and WORD.search(x))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that stand in a 3-word window found twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        counts = Counter(windows)
        n = end = 0
        for i, x in enumerate(windows):
            if counts[x] > 1:
                n += i + 3 - max(i, end)
                end = i + 3
        return n


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text to reject."""

    name: str
    rejects: Callable[[Measures], bool]


#: The base rules of the contract, then rules for junk that prose does not show.
BASE = [
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
]
MORE = [
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("marks", lambda m: 2 * m.n_marks > m.n_words),
    Rule("short_words", lambda m: m.word_chars < 2 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 25 * m.n_words),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
]
RULES = BASE + MORE

#: Rows on which cost and selectivity are estimated; they set the order of the rules, never a verdict.
SAMPLE_ROWS = 400


def estimates(texts: list[str], rules: list[Rule]) -> tuple[int, list[tuple[float, int]]]:
    """Number of texts, and (seconds, rejected texts) of each rule on its own."""
    out = []
    for rule in rules:
        fresh = [Measures(t) for t in texts]
        began = time.perf_counter()
        rejected = sum(bool(rule.rejects(m)) for m in fresh)
        out.append((time.perf_counter() - began, rejected))
    return len(texts), out


def added_up(parts: list[tuple[int, list[tuple[float, int]]]], rules: list[Rule]) -> list[tuple[str, float, float]]:
    """(rule, seconds a text, share rejected) over the parts of a sample; zeros without texts."""
    n = max(1, sum(count for count, _ in parts))
    return [(r.name, sum(p[i][0] for _, p in parts) / n, sum(p[i][1] for _, p in parts) / n) for i, r in enumerate(rules)]


def ordered(rules: list[Rule], estimated: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per second, most first; ties keep the given order."""
    rate = {name: share / max(s, 1e-9) for name, s, share in estimated}
    return sorted(rules, key=lambda r: -rate[r.name])


def judge_quality(
    df: DataFrame,
    text: str = "text",
    rules: list[Rule] = RULES,
    measures: list[str] = (),
    keep: list[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Append the named ``measures`` (longs) and ``kept`` to each row, without a shuffle.

    Null and empty texts have no words. Texts are read whole, whatever their
    length. Repeated rows are judged alike; an empty table gives an empty one;
    columns named like the added ones give way to them.
    """
    sampled = measured(df, text, sample_rows, lambda texts: estimates(texts, rules))
    cascade = [r.rejects for r in ordered(rules, added_up(sampled, rules))]
    measures = list(measures)

    def run(texts: list[str | None]) -> list[pa.Array]:
        held(("quality",), dict)
        columns: list[list] = [[] for _ in measures]
        kept = []
        for t in texts:
            m = Measures(t)
            kept.append(not any(rejects(m) for rejects in cascade))
            for column, name in zip(columns, measures, strict=True):
                column.append(getattr(m, name))
        return [*(pa.array(c, pa.int64()) for c in columns), pa.array(kept, pa.bool_())]

    added = [T.StructField(m, T.LongType()) for m in measures] + [T.StructField("kept", T.BooleanType())]
    return mapped(df, [text], run, T.StructType(added), keep)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    judged = judge_quality(docs, "text", RULES, names, ["doc_id"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *names, failed.alias("base_failed"), "kept")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM d
), windows AS (
  SELECT rid, i, words[i:i+2] AS g FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid
), line AS (
  SELECT rid, unnest(lines) AS x FROM w
), lines AS (
  SELECT rid, sum(n) AS n_lines, sum(n - 1) AS n_dup FROM (
    SELECT rid, x, count(*) AS n FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid, x) GROUP BY rid
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         (length(text) - length(replace(text, '!', '')))::BIGINT AS n_marks, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN repeated r USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_marks > n_words
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words OR 2 * n_dup_lines > n_lines) AS kept
FROM m
"""

QUERIES = {"op7_quality_rules": op7_quality_rules}
ORACLES = {"op7_quality_rules": ORACLE}
