"""Fingerprints: the distinct normalised texts of each (bucket, source, destination)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fernweave.functions import text as X
from fernweave.functions.net import bucket, class_c
from fernweave.operators.joins import anti

TRAIN_TEXT = ["http_method", "http_host", "http_agent", "http_path", "http_query", "http_tenc"]
LOAD_BALANCER = "BigIP"


def ts(at: datetime | str) -> Column:
    return F.lit(str(at)).cast("timestamp_ntz")


def train_text() -> Column:
    return X.normalised(X.joined_text(*TRAIN_TEXT))


def normal_fingerprint(log: DataFrame, blocked: list[DataFrame], start: datetime, end: datetime, limit: int | None, interval: str = "30 minutes") -> DataFrame:
    """Training fingerprints of one day: those of ``normal_fingerprints`` without the day's number."""
    return normal_fingerprints(log, blocked, [(start, end)], limit, interval).drop("day")


def normal_fingerprints(log: DataFrame, blocked: list[DataFrame], days: list[tuple[datetime, datetime]], limit: int | None, interval: str = "30 minutes") -> DataFrame:
    """Training fingerprints of days: of each four overlapping six-hour slots, each with at most ``limit`` rows.

    A slot keeps both its bounds, so a row on a bound stands in two slots. One
    scan feeds all days and slots. Sources blocked within a day are out of it.
    The limit takes the first rows by bucket, source and destination.
    """
    hours = lambda n: F.expr(f"INTERVAL {n} HOURS")
    time = F.col("logtime")
    spans = [(d, ts(a), ts(z)) for d, (a, z) in enumerate(days)]
    slots = F.array_compact(
        F.array(
            *[
                F.when((time >= a + hours(6 * k)) & (time <= z - hours(18 - 6 * k)), F.struct(F.lit(d).alias("day"), F.lit(k).alias("slot")))
                for d, a, z in spans
                for k in range(4)
            ]
        )
    )
    dash = F.lit(True)
    for c in ("http_host", "http_agent", "http_query", "http_path"):
        dash = dash & (F.col(c) == "-")
    within = (time >= F.least(*[a for _, a, _ in spans], ts(days[0][0]))) & (time <= F.greatest(*[z for _, _, z in spans], ts(days[0][1])))  # reaches the scan
    rows = log.where(within & ~(dash & (F.col("http_server") == LOAD_BALANCER))).select("*", F.inline(slots))
    for other in blocked:
        own = F.array_compact(F.array(*[F.when((time >= a) & (time <= z), F.lit(d)) for d, a, z in spans]))
        rows = anti(rows, other.where(within).select(F.explode(own).alias("day"), "src_ip"), "day", "src_ip")
    out = (
        rows.withColumn("text", train_text())
        .groupBy("day", "slot", bucket(time + hours(9), interval).alias("lgtime"), "src_ip", "dst_ip")
        .agg(X.distinct_text("text").alias("agnt_qry"))
        .withColumn("label", F.lit("normal"))
    )
    if limit is None:
        return out
    order = Window.partitionBy("day", "slot").orderBy("lgtime", "src_ip", "dst_ip")
    return out.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= limit).drop("rn")


def exclusions(rows: DataFrame) -> DataFrame:
    """(selectcolumn, pattern) from exceptions (selectcolumn, keyword): the keywords of a column as alternatives.

    Keywords are regular expressions, as they stand; empty ones exclude nothing.
    """
    own = rows.where("selectcolumn IS NOT NULL AND keyword <> ''")
    return own.groupBy("selectcolumn").agg(F.array_join(F.array_sort(F.collect_set("keyword")), "|").alias("pattern"))


#: The columns that exceptions are kept for.
EXCEPTION_COLUMNS = ["http_query", "http_agent", "http_host", "http_path", "src_ip", "dst_ip"]


def exclusion_patterns(rows: DataFrame) -> dict[str, str]:
    """Patterns by column for ``predict_fingerprint``; a row for each known column comes to the driver."""
    found = exclusions(rows.where(F.col("selectcolumn").isin(EXCEPTION_COLUMNS))).collect()
    return {r["selectcolumn"]: r["pattern"] for r in found}


def predict_fingerprint(log: DataFrame, blocked: DataFrame, start: datetime, end: datetime, exclude: dict[str, str], interval: str = "30 minutes") -> DataFrame:
    """Prediction fingerprints of ``[start, end)`` in local time, with exclusions.

    ``exclude`` has a regular expression for each column (an empty or missing
    one excludes nothing); those of src_ip and dst_ip see the class-C text.
    Rows whose agent or path is ``-`` or that the load balancer answered are
    out, and so are sources that devices with an ``_m_`` or ``_bh_`` name
    blocked within 15 minutes of the span.
    """
    nine, grace = F.expr("INTERVAL 9 HOURS"), F.expr("INTERVAL 15 MINUTES")
    rows = log.where((F.col("logtime") >= ts(start) - nine) & (F.col("logtime") < ts(end) - nine))
    for c in ("http_agent", "http_path", "http_query", "http_host"):
        rows = rows.where(~X.excluded(c, exclude.get(c, "")))
    rows = rows.where(~X.excluded(class_c("src_ip"), exclude.get("src_ip", "")))
    both = (F.lower(class_c("src_ip")) == exclude.get("src_ip", "").lower()) & (F.lower(class_c("dst_ip")) == exclude.get("dst_ip", "").lower())
    rows = rows.where(~both)
    rows = rows.where(~((F.col("http_agent") == "-") | (F.col("http_path") == "-") | (F.col("http_server") == LOAD_BALANCER)))
    near = blocked.where(
        (F.col("logtime") >= ts(start) - grace)
        & (F.col("logtime") <= ts(end) + grace)
        & (F.col("dev_nm").like("%_m_%") | F.col("dev_nm").like("%_bh_%"))
    )
    text = X.joined_text("http_method", "http_host", X.without("http_agent", X.AGENT_NOISE), X.without("http_path", X.PATH_NOISE), "http_query", "http_tenc")
    return (
        anti(rows, near, "src_ip")
        .withColumn("text", X.normalised(text, X.PREDICT_CLASS))
        .groupBy(bucket("logtime_kr", interval).alias("lgtime"), "src_ip", "dst_ip")
        .agg(X.distinct_text("text").alias("agnt_qry"))
    )


def columns_fingerprint(log: DataFrame, start: datetime, end: datetime, interval: str = "30 minutes") -> DataFrame:
    """Fingerprints of agent and query only, digits and some punctuation kept; their string columns are the features."""
    nine = F.expr("INTERVAL 9 HOURS")
    rows = log.where((F.col("logtime") >= ts(start) - nine) & (F.col("logtime") < ts(end) - nine))
    return (
        rows.withColumn("text", X.normalised(X.joined_text("http_agent", "http_query"), X.COLUMNS_CLASS))
        .groupBy(bucket(F.col("logtime") + nine, interval).alias("lgtime"), "src_ip", "dst_ip")
        .agg(X.distinct_text("text").alias("agnt_qry"))
    )


def attack_fingerprint(log: DataFrame, label: str, label_column: str, keys: list[str], agent: str, query: str, literal: str, limit: int | None) -> DataFrame:
    """Texts of one class: the agent and what follows ``literal`` in the query, by key; the first ``limit`` by key."""
    text = X.normalised(X.joined_text(agent, X.after(query, literal)), lower=False, host_check=False)
    out = (
        log.where(F.col(label_column) == label)
        .withColumn("text", text)
        .groupBy(*keys)
        .agg(X.distinct_text("text").alias("agnt_qry"))
        .withColumn("label", F.lit(label))
    )
    return out.orderBy(*keys).limit(limit) if limit is not None else out
