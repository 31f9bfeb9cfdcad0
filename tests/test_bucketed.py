"""Feature tables of the catalog: joins without an exchange, the catalog's checks, cleaning."""

import uuid

import pytest
from compare import DATA, of_spark, of_sql

from fernweave import session
from fernweave.operators import joins
from fernweave.plans import catalog, relational
from fernweave.sources import bucketed


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_join_without_an_exchange(spark):
    names = relational.three_tables(spark, DATA)
    df = bucketed.joined(spark, names)
    text = executed(df)
    text = text.split("== Initial Plan ==")[0]
    assert "Exchange" not in text
    assert text.count("SortMergeJoin") == 2 and text.count("SelectedBucketsCount") == 3
    assert of_spark(df) == of_sql(catalog.oracle_sql()["join_three_frames"])
    filtered = bucketed.joined(spark, names, conditions={names[0]: "num > 10"})
    assert "Exchange" not in executed(filtered) and filtered.count() == df.where("num > 10").count()


def test_equals_a_join_of_frames(spark, name):
    a = spark.createDataFrame([(1, "x", 1.0), (1, None, 2.0), (None, "x", 3.0), (2, "y", 4.0), (2, "y", 5.0)], "k1 long, k2 string, a double")
    b = spark.createDataFrame([(1, "x", 7), (2, "y", 8), (None, "x", 9), (5, "z", 1)], "k1 long, k2 string, b int")
    assert bucketed.save(a, f"{name}_a", ["k1", "k2"], 3) and bucketed.save(b, f"{name}_b", ["k1", "k2"], 3)
    assert of_spark(bucketed.joined(spark, [f"{name}_a", f"{name}_b"])) == of_spark(joins.inner(["k1", "k2"], a, b))
    both = bucketed.with_missing(spark, [f"{name}_a", f"{name}_b"])
    assert "Exchange" not in executed(both)
    assert sorted((r["a"] or 0, r["b"] or 0, r["complete"]) for r in both.collect()) == [(0, 1, False), (0, 9, False), (1, 7, True), (2, 0, False), (3, 0, False), (4, 8, True), (5, 8, True)]


def test_catalog_checks(spark, name):
    df = spark.createDataFrame([(1, "x")], "k long, s string")
    assert not bucketed.exists(spark, name) and not bucketed.drop(spark, name)
    assert bucketed.save(df, name, ["k"], 2) and bucketed.exists(spark, name)
    assert not bucketed.save(df.limit(0), name, ["k"], 2) and spark.table(name).count() == 1  # as it was
    for other, keys, n in ((df, ["k"], 4), (df, ["s"], 2), (df.withColumnRenamed("s", "t"), ["k"], 2)):
        with pytest.raises(ValueError):
            bucketed.save(other, name, keys, n)
    assert bucketed.has_columns(spark, name, {"k": "bigint", "s": "string"}) and not bucketed.has_columns(spark, name, {"k": "int", "s": "string"})
    assert bucketed.layout(spark, name) == (["k"], 2)
    assert bucketed.save(df, f"{name}_b", ["k"], 4)
    with pytest.raises(ValueError):
        bucketed.joined(spark, [name, f"{name}_b"])
    with pytest.raises(ValueError):
        bucketed.save(df, "bad-name", ["k"])
    assert bucketed.drop(spark, name) and not bucketed.exists(spark, name)


def test_a_hot_key_and_an_empty_table(spark, name, monkeypatch):
    monkeypatch.setattr(bucketed, "FEW", 10)
    hot = spark.range(3000).selectExpr("IF(id < 1000, 7, id) AS k", "id AS v")
    assert bucketed.save(hot, f"{name}_a", ["k"], 4) and bucketed.save(spark.createDataFrame([(7, "h")], "k long, w string"), f"{name}_b", ["k"], 4)
    both = bucketed.joined(spark, [f"{name}_a", f"{name}_b"])
    assert both.count() == 1000 and "Exchange hashpartitioning" in executed(both)  # a third of the rows have one key
    bucketed.save(hot.limit(0), f"{name}_c", ["k"], 4)
    assert spark.table(f"{name}_c").count() == 0 and bucketed.with_missing(spark, [f"{name}_c"]).count() == 0


def test_what_operators_left_is_removed(spark, name, tmp_path):
    at = tmp_path / "left"
    spark.range(3).write.parquet(str(at))
    session.left(spark, str(at))
    bucketed.save(spark.range(5).withColumnRenamed("id", "k"), name, ["k"], 2)
    assert session.cleared(spark) >= 2 and not at.exists() and not bucketed.exists(spark, name)
    assert session.cleared(spark) == 0
