"""Scalar rules on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fernweave.functions import net
from fernweave.functions import text as X


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_malformed_escapes_and_plus_stay(spark):
    assert values(spark, ["a+b%2Fc", "a%zz", "100%", None], X.url_decoded("t")) == ["a+b/c", "a%zz", "100%", None]


def test_traversal_marker(spark):
    assert values(spark, ["x/..y"], X.normalised("t")) == ["x pathsearcherdetected y"]


def test_punctuation_becomes_spaces(spark):
    assert values(spark, ["a-b%c.d/e_z9"], X.normalised("t")) == ["a b c d e_z "]


def test_after_literal(spark):
    assert values(spark, ["a.php?x", "a"], X.after("t", ".php")) == ["?x", ""]


def test_like_wildcard(spark):
    assert values(spark, ["dev_m_1", "abmcd", "m"], F.col("t").like("%_m_%")) == [True, True, False]


def test_empty_pattern_excludes_nothing(spark):
    assert values(spark, ["", "a", None], X.excluded("t", "")) == [False, False, False]
    assert values(spark, ["xAy", "b", None], X.excluded("t", "A")) == [True, False, False]


def test_tokens(spark):
    assert values(spark, ["Éabc a bb ç_d 한글 x1"], X.tokens("t")) == [["éabc", "bb", "ç_d", "한글", "x1"]]


def test_addresses(spark):
    assert values(spark, ["10.1.2.3", "bad", "1.2.3"], net.ip_number("t")) == [167838211, None, None]
    assert values(spark, ["10.1.2.3"], net.class_c("t")) == ["10.1.2.xxx"]


def test_bucket(spark):
    at = values(spark, ["2024-01-01 10:44:59"], net.bucket(F.col("t").cast("timestamp_ntz")))
    assert at == [datetime(2024, 1, 1, 10, 30)]


@pytest.mark.parametrize(("text", "span"), [("hours=3", timedelta(hours=3)), ("days = 2", timedelta(days=2)), ("x", timedelta(days=1)), (None, timedelta(days=1))])
def test_delta(text, span):
    assert net.parse_delta(text) == span
