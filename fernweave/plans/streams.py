"""Streaming queries (an extension)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fernweave.plans.fingerprints import DISTINCT, LOG, SIX_TEXT, stamp
from fernweave.plans.registry import query
from fernweave.session import shared_dir
from fernweave.streaming import micro_batch


@query(
    f"""WITH {LOG}, w AS (SELECT time_bucket(INTERVAL 30 MINUTE, logtime) AS b, * FROM log)
SELECT {stamp("b")} AS lgtime, src_ip, dst_ip, {DISTINCT.format(SIX_TEXT)} AS agnt_qry, count(*) AS n FROM w
WHERE b + INTERVAL 30 MINUTE <= (SELECT max(logtime) FROM log) - INTERVAL 15 MINUTE GROUP BY b, src_ip, dst_ip"""
)
def stream_fingerprint(spark, sf_dir):
    """Windows closed by the watermark once all files are read."""
    at = shared_dir(spark)
    stream = micro_batch.fingerprints(micro_batch.log_stream(spark, f"{sf_dir}/events.parque[t]"))
    micro_batch.run_available(stream, f"{at}/out", f"{at}/checkpoint")
    out = spark.read.schema(stream.schema).parquet(f"{at}/out")
    return out.withColumn("lgtime", F.date_format("lgtime", "yyyy-MM-dd HH:mm:ss"))
