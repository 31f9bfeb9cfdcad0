"""Addresses and time."""

from __future__ import annotations

import ipaddress
import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fernweave.functions.text import column


def ip_number(c: Column | str) -> Column:
    """An IPv4 text as a long; null if it is none."""
    parts = F.transform(F.split(column(c), "[.]"), lambda p: p.try_cast("long"))
    return F.when(F.size(parts) == 4, F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p))


def class_c(c: Column | str) -> Column:
    """The address with its last number hidden: ``10.1.2.xxx``."""
    return F.regexp_replace(column(c), "[.][0-9]+$", ".xxx")


def networks(spark: SparkSession, cidrs: list[str]) -> DataFrame:
    """(network, octet1, low, high) of each CIDR; host bits are allowed."""
    rows = []
    for text in cidrs:
        net = ipaddress.ip_network(text.strip(), strict=False)
        low = int(net.network_address)
        rows.append((text, low >> 24, low, int(net.broadcast_address)))
    return spark.createDataFrame(rows, "network string, octet1 long, low long, high long")


def network_ranges(df: DataFrame, column_name: str = "network") -> DataFrame:
    """(network, octet1, low, high) of a table's CIDR texts; host bits are cut off, malformed texts left out."""
    text = F.trim(F.col(column_name))
    size = F.pow(F.lit(2), 32 - F.coalesce(F.split_part(text, F.lit("/"), F.lit(2)).try_cast("int"), F.lit(32))).cast("long")
    ip = ip_number(F.split_part(text, F.lit("/"), F.lit(1)))
    rows = df.select(text.alias("network"), (ip - ip % size).alias("low"), size.alias("size")).where("low IS NOT NULL")
    return rows.select("network", F.shiftright("low", 24).alias("octet1"), "low", (F.col("low") + F.col("size") - 1).alias("high"))


def bucket(c: Column | str, interval: str = "30 minutes") -> Column:
    """Start of the tumbling interval, aligned to the epoch."""
    return F.window(column(c), interval)["start"]


def parse_delta(text: str) -> timedelta:
    """``unit=number`` as a time span; one day if it is malformed."""
    m = re.fullmatch(r"\s*(weeks|days|hours|minutes|seconds)\s*=\s*(-?\d+)\s*", text or "")
    return timedelta(**{m[1]: int(m[2])}) if m else timedelta(days=1)


def version_of(at: datetime) -> str:
    """The version string of a run, YYYYMMDDhhmmss."""
    return at.strftime("%Y%m%d%H%M%S")
