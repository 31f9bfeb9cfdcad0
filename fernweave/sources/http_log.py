"""The ``events`` table shaped as an HTTP log; the same expressions are valid in SQL engines (``SQL``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = {
    "event_id": "event_id",
    "logtime": "ts",
    "logtime_kr": "ts + INTERVAL 9 HOURS",
    "src_ip": "concat('10.0.', cast(user_id DIV 64 AS string), '.', cast(user_id % 64 AS string))",
    "src_port": "cast(1024 + user_id AS bigint)",
    "dst_ip": "concat('192.168.', cast(event_id % 2 AS string), '.', cast(event_id % 8 AS string))",
    "dst_port": "CASE WHEN event_id % 3 = 0 THEN 443 ELSE 80 END",
    "http_method": "CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END",
    "http_host": "concat('host', cast(event_id % 4 AS string), '.example.com')",
    "http_agent": "CASE WHEN event_id % 11 = 0 THEN '-' ELSE concat('Agent/', event_type, ' bot%2Fcrawler+x') END",
    "http_path": "CASE WHEN event_id % 13 = 0 THEN '-' ELSE concat('/', event_type, '/../index.php') END",
    "http_query": "props",
    "http_tenc": "'-'",
    "http_retcode": "CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '302' WHEN 'view' THEN '404' ELSE '200' END",
    "http_server": "CASE WHEN event_id % 17 = 0 THEN 'BigIP' ELSE 'nginx' END",
    "dev_nm": "CASE WHEN event_type = 'error' THEN 'fw_m_1' WHEN event_type = 'signup' THEN 'abmcd' ELSE 'fw_x_1' END",
    "value": "value",
}

SQL = "SELECT {} FROM events".format(
    ", ".join(
        f"{sql.replace('DIV', '//').replace('AS string', 'AS VARCHAR').replace('INTERVAL 9 HOURS', 'INTERVAL 9 HOUR')} AS {name}"
        for name, sql in COLUMNS.items()
    )
)


def http_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*[F.expr(sql).alias(name) for name, sql in COLUMNS.items()])


def of_day(log: DataFrame, version: str) -> DataFrame:
    """Rows of one day's version (YYYYMMDD); the range reaches the scan."""
    day = F.to_date(F.lit(version), "yyyyMMdd").cast("timestamp_ntz")
    return log.where((F.col("logtime") >= day) & (F.col("logtime") < day + F.expr("INTERVAL 1 DAY"))).withColumn("version", F.lit(version))


def blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocked sources (logtime, src_ip, dev_nm): error events above a value."""
    return http_log(spark, sf_dir).where("http_retcode = '500' AND value > 60").select("logtime", "src_ip", "dev_nm")


def firewall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that the application firewall stopped (logtime, src_ip)."""
    return http_log(spark, sf_dir).where("http_retcode = '302' AND value > 80").select("logtime", "src_ip")


BLOCKED_SQL = "SELECT logtime, src_ip, dev_nm FROM log WHERE http_retcode = '500' AND value > 60"
FIREWALL_SQL = "SELECT logtime, src_ip FROM log WHERE http_retcode = '302' AND value > 80"
