"""Every registered query of the engine against its SQL."""

import math
from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pytest
from compare import DATA, of_spark, of_sql

from fernweave.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert of_spark(QUERIES[name](spark, DATA)) == of_sql(ORACLES[name])


def test_prepared_halves_round_as_sql(spark, tmp_path):
    """Over 6,000,000 every sixth number lies half way between two sixth digits, give or take the last bit of a double."""
    ids = "SELECT unnest(range(3000)) AS i UNION ALL SELECT 5999999"
    duckdb.sql(f"SELECT i AS event_id, i % 90 AS user_id, CASE WHEN i % 2 > 0 THEN 'click' ELSE 'view' END AS event_type FROM ({ids})").write_parquet(str(tmp_path / "events.parquet"))
    assert of_spark(QUERIES["prepared_columns"](spark, str(tmp_path))) == of_sql(ORACLES["prepared_columns"], str(tmp_path))


def parting(n):
    """Numbers of hits among ``n`` rows whose mean's decimal form and scaled double round to different sixth digits."""
    return [k for k in range(1, n) if float(Decimal(repr(k / n)).quantize(Decimal("1e-6"), ROUND_HALF_UP)) != math.floor(k / n * 1e6 + 0.5) / 1e6]


@pytest.mark.parametrize("n", [640, 3200])
def test_means_round_as_sql(spark, tmp_path, n):
    hits = parting(n)
    assert hits
    # One source for each number of hits among its events; each hit is an error.
    duckdb.sql(
        f"""SELECT (g * {n} + i)::BIGINT AS event_id, TIMESTAMP '2024-01-01 00:10:00' AS ts, g::BIGINT AS user_id, CASE WHEN i < ({hits}::INT[])[g + 1] THEN 'error' ELSE 'view' END AS event_type,
1.0 AS value, '{{}}' AS props FROM range({len(hits)}) a(g), range({n}) b(i)"""
    ).write_parquet(str(tmp_path / "events.parquet"))
    assert of_spark(QUERIES["scan_status_ratios"](spark, str(tmp_path))) == of_sql(ORACLES["scan_status_ratios"], str(tmp_path))
    for k in hits[:2]:
        duckdb.sql(
            f"SELECT i::BIGINT AS l_orderkey, 1 AS l_linenumber, CASE WHEN i < {k} THEN 0.5 ELSE 0.0 END AS l_discount, CASE WHEN i < {k} THEN 0.0 ELSE 0.5 END AS l_tax, CASE WHEN i % 2 = 0 THEN 'N' ELSE 'A' END AS l_returnflag FROM range({n}) t(i)"
        ).write_parquet(str(tmp_path / "lineitem.parquet"))
        duckdb.sql(f"SELECT i AS doc_id, (i < {k})::INT AS quality, 1 AS toxic FROM range({n}) t(i)").write_parquet(str(tmp_path / "labels.parquet"))
        for name in ("nonzero_rate", "most_wanted", "weighted_prf"):
            assert of_spark(QUERIES[name](spark, str(tmp_path))) == of_sql(ORACLES[name], str(tmp_path)), name


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
