"""Reports: keywords that explain detections, joined back to the raw log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernweave.functions.net import bucket
from fernweave.functions.text import distinct_text
from fernweave.functions.vectors import by_score, pairs
from fernweave.operators.aggregate import distinct_union
from fernweave.operators.fingerprint import train_text
from fernweave.operators.joins import substring_join

RAW = ["logtime_kr", "src_port", "dst_port", "http_method", "http_host", "http_agent", "http_path", "http_query", "http_tenc", "http_retcode"]
KEY = ["lgtime", "src_ip", "dst_ip"]


def explained_terms(xai: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, features): a row for each term whose score is not zero, by number."""
    rows = xai.where(F.col("ai_label") != "normal").select(*keys, F.explode(pairs("feature", "score")).alias("p"))
    return rows.where((F.col("p.score") != 0) & (F.col("p.term") != "")).select(*keys, F.col("p.term").alias("features")).distinct()


def report(log: DataFrame, xai: DataFrame, start, end) -> DataFrame:
    """One row for each (label, bucket, source, destination): distinct raw values and keywords found in the text.

    A keyword counts where it is a substring of the row's normalised text. The
    three key columns are joined as they are; no concatenated key is built.
    """
    nine = F.expr("INTERVAL 9 HOURS")
    # The first condition is implied by the second, and reaches the scan.
    span = (F.col("logtime") >= start - nine) & (F.col("logtime") < end - nine + F.expr("INTERVAL 30 MINUTES"))
    rows = log.where(span).withColumn("lgtime", bucket(F.col("logtime") + nine)).where((F.col("lgtime") >= start) & (F.col("lgtime") < end))
    xai = xai.where((F.col("lgtime") >= start) & (F.col("lgtime") < end))
    rows = rows.select(*KEY, *RAW, train_text().alias("str_prep"))
    found = substring_join(rows, explained_terms(xai, ["ai_label", *KEY]), KEY, "str_prep", "features")
    by_row = found.groupBy("ai_label", *KEY, *RAW).agg(F.collect_set("features").alias("keyword"))
    return by_row.groupBy("ai_label", F.col("lgtime").alias("time_group"), "src_ip", "dst_ip").agg(
        *[distinct_text(F.col(c).cast("string")).alias(c) for c in RAW], distinct_union("keyword").alias("keyword")
    )


def top_terms(df: DataFrame, keys: list[str], n: int, features: str = "feature", scores: str = "score") -> DataFrame:
    """(keys, rank, term, score) of the ``n`` strongest terms; ties keep the vocabulary's order."""
    out = df.select(*keys, F.posexplode(F.slice(by_score(features, scores), 1, n)).alias("rank", "t"))
    return out.select(*keys, (F.col("rank") + 1).alias("rank"), F.col("t.term").alias("term"), F.col("t.score").alias("score"))


def result_table(log: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Raw rows of the earliest predicted bucket with each detection's label; those of the second model in capitals."""
    nine = F.expr("INTERVAL 9 HOURS")
    found = first.where("ai_label <> 'normal'").select(*KEY, "ai_label").union(second.where("ai_label <> 'normal'").select(*KEY, F.upper("ai_label"))).distinct()
    earliest = first.agg(F.min("lgtime").alias("lgtime"))
    rows = log.withColumn("lgtime", bucket(F.col("logtime") + nine)).join(F.broadcast(earliest), "lgtime", "left_semi")
    return rows.where("NOT (http_agent = '-' OR http_path = '-')").join(found, KEY)


def threat_scores(detections: DataFrame, anomalies: DataFrame, severity: DataFrame, ip: str = "src_ip", label: str = "ai_label") -> DataFrame:
    """(ip, label, sum_score, threat_score): how far a source's detections, kinds and anomalies reach the mean, and the label's severity."""
    def ratio(df: DataFrame, n, name: str) -> DataFrame:
        by = df.groupBy(ip).agg(n.alias("n"))
        return by.select(ip, F.least(F.lit(1.0), F.col("n") / by.agg(F.avg("n").alias("m")).scalar()).alias(name))

    attacks = detections.where(F.col(label) != "NORMAL")
    wide = (
        detections.select(ip)
        .distinct()
        .join(ratio(attacks, F.count(label), "att_ratio"), ip, "left")
        .join(ratio(detections, F.countDistinct(label), "type_ratio"), ip, "left")
        .join(ratio(anomalies.where(F.col(label) != "NORMAL"), F.count(label), "anomaly_ratio"), ip, "left")
        .fillna(0.0)
    )
    span = severity.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    scaled = severity.select(label, F.coalesce((F.col("score") - span.select("lo").scalar()) / F.nullif(span.select("hi").scalar() - span.select("lo").scalar(), F.lit(0.0)), F.lit(0.0)).alias("scl_score"))
    rows = detections.select(ip, label).distinct().join(wide, ip).join(scaled, label)
    total = F.col("att_ratio") + F.col("type_ratio") + F.col("anomaly_ratio") + F.col("scl_score")
    return rows.select(ip, label, total.alias("sum_score"), ((-0.0625 * total * total + 0.5 * total) * 100).alias("threat_score"))
