"""Plans hold at scale: no pairs of all rows, pruned scans, partial aggregates, limits before the shuffle."""

import pytest
from compare import DATA

from fernweave.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


def plan(spark, name):
    return QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"idempotent_sink", "artifact_lists", "stream_fingerprint", "saved_scaler"}))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    if name != "soinn_components":  # a bounded model in one task
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_limits_come_before_the_shuffle(spark):
    text = plan(spark, "fingerprint_4slot_topn")
    assert text.count("WindowGroupLimit") == 2 and "partial_collect_set" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "fingerprint_columns_only")
    assert "value" not in text.split("FileScan")[1] and "GreaterThanOrEqual(ts" in text
    assert "PushedFilters: [In(lang" in plan(spark, "projection") or "lang" in plan(spark, "projection").split("PushedFilters")[1]


@pytest.mark.parametrize("name", ["soinn_predict", "soinn_explain", "soinn_close_to", "knn2", "keyword_tfidf_stored", "keyword_arrays"])
def test_rows_that_meet_a_model_are_not_shuffled(spark, name):
    """What is trained is a scalar subquery or literal; the rows themselves pass no exchange and no join."""
    text = plan(spark, name).split("Subquery")[0]
    assert "Exchange" not in text and "Join" not in text


def test_one_pass_and_one_shuffle(spark):
    text = plan(spark, "document_frequency")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "Join" not in text


@pytest.mark.parametrize("name", ["report_keywords", "version_scan", "fingerprint_4slot_topn"])
def test_spans_reach_the_scan(spark, name):
    assert all("GreaterThanOrEqual(ts" in scan and "LessThan" in scan for scan in plan(spark, name).split("PushedFilters: ")[1:2])


def test_days_are_one_scan(spark):
    from datetime import datetime, timedelta

    from fernweave.operators import fingerprint
    from fernweave.sources import http_log

    log, start = http_log.http_log(spark, DATA), datetime(2024, 1, 2)
    days = [(start + timedelta(days=d), start + timedelta(days=d + 1)) for d in range(3)]
    out = fingerprint.normal_fingerprints(log, [http_log.blocked(spark, DATA)], days, 5)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2  # the log and its blocked sources
    for d, (a, z) in enumerate(days):
        one = fingerprint.normal_fingerprint(log, [http_log.blocked(spark, DATA)], a, z, 5)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, out.where(f"day = {d}").drop("day").collect())) and one.count()
