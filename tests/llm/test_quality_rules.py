from compare import DATA, of_spark, of_sql

from fernweave.llm import quality_rules as Q
from fernweave.llm.common import measured


def test_edges_equal_sql(spark, folder, odd_documents):
    at = folder(documents=[d for d in odd_documents if d[0] != 7] + [(20, "a b c d a b c d e a b", None, None, None), (21, "word!! " * 60, None, None, None)])
    assert of_spark(Q.op7_quality_rules(spark, at)) == of_sql(Q.ORACLE, at)


def test_query_equals_sql(spark):
    assert of_spark(Q.op7_quality_rules(spark, DATA)) == of_sql(Q.ORACLE)


def test_very_long_text(spark, folder):
    r = Q.op7_quality_rules(spark, folder(documents=[(1, "x " * 200_000)])).first()
    assert (r["n_words"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (200_000, 200_000, True, False)


def test_order_by_rejections_per_second_changes_nothing(spark):
    found = [("a", 1.0, 0.5), ("b", 0.1, 0.2), ("c", 5.0, 0.0)]
    rules = [Q.Rule(n, lambda m: False) for n in "cab"]
    assert [r.name for r in Q.ordered(rules, found)] == ["b", "a", "c"]
    df = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    one = {r["doc_id"]: r["kept"] for r in Q.judge_quality(df, rules=Q.RULES).collect()}
    two = {r["doc_id"]: r["kept"] for r in Q.judge_quality(df, rules=Q.RULES[::-1], sample_rows=1).collect()}
    assert one == two


def test_cascade_stops_at_the_first_rejection():
    seen = []
    rules = [Q.Rule("x", lambda m: seen.append("x") or True), Q.Rule("y", lambda m: seen.append("y") or True)]
    assert any(r.rejects(Q.Measures("t")) for r in rules) and seen == ["x"]


def test_good_prose_is_kept(spark):
    """Documents labelled good are kept, but for those the base rules reject."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = Q.op7_quality_rules(spark, DATA).collect()
    assert all(r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"])
    bad = [r for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad)


def test_sample_spans_the_table(spark, tmp_path):
    """Files sorted by source: the rule that rejects only in the last one is seen by the sample."""
    for i, text in enumerate(["plain prose " * 60, "word!! " * 60]):
        spark.createDataFrame([(text,)] * 50, "text string").coalesce(1).write.parquet(str(tmp_path / "t" / str(i)))
    df = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "t")).repartitionByRange(4, "text")
    parts = measured(df, "text", 40, lambda texts: Q.estimates(texts, Q.RULES))
    found = {name: share for name, _, share in Q.added_up(parts, Q.RULES)}
    assert 0 < found["marks"] < 1 and sum(n for n, _ in parts) <= 40
    assert measured(df.where("false").coalesce(1), "text", 40, len) == [0] and Q.added_up([], Q.RULES)[0][1:] == (0, 0)


def test_clashing_columns(spark):
    df = spark.createDataFrame([("a b", 7, "x")], "text string, n_words int, KEPT string")
    out = Q.judge_quality(df, measures=["n_words"])
    assert out.columns == ["text", "n_words", "kept"] and tuple(out.first())[1:] == (2, False)


def test_empty_table(spark, folder):
    assert Q.op7_quality_rules(spark, folder(documents=[])).count() == 0
