"""Feature tables in the catalog, bucketed and sorted by their key, so that joins on it need no exchange.

Number, category and string tables of one run have the same key and the same
number of buckets. Rows are dealt once, when a table is written; every training
and prediction that joins them afterwards reads bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernweave.session import left, shared_dir
from fernweave.sources.store import drop_table, same_schema, valid_name

#: Settings of a table that a reader checks.
KEYS, BUCKETS, EVEN = "fernweave.keys", "fernweave.buckets", "fernweave.even"
#: Rows of one key that are never too many.
FEW = 100_000


def buckets_of(spark: SparkSession) -> int:
    """As many buckets as a shuffle of the session has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def layout(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Key columns and number of buckets of a stored table; an error for any other."""
    own = properties(spark, name) if exists(spark, name) else {}
    if KEYS not in own:
        raise ValueError(f"no feature table: {name}")
    return own[KEYS].split(","), int(own[BUCKETS])


def has_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> bool:
    """Whether a table of the catalog has these names and types (each sorted on its own)."""
    return exists(spark, name) and same_schema(spark.table(name), columns)


def save(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> bool:
    """Store ``df`` as the table ``name``, bucketed and sorted by ``keys``; False if the table is there already.

    A table with other columns or another layout is an error, not overwritten.
    One file a bucket is written: rows are dealt by the keys as buckets deal
    them. Null keys are kept (inner joins meet none of them).
    """
    spark = df.sparkSession
    if not all(map(valid_name, [*name.split("."), *df.columns])):
        raise ValueError(f"not a plain name in {name}: {df.columns}")
    buckets = buckets or buckets_of(spark)
    if exists(spark, name):
        columns = {f.name: f.dataType.simpleString() for f in df.schema}
        if layout(spark, name) != (list(keys), buckets) or not has_columns(spark, name, columns):
            raise ValueError(f"table {name} has other columns, keys or buckets")
        return False
    at = shared_dir(spark)
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.format("parquet").option("path", at).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    left(spark, at, name)
    sizes = spark.table(name).groupBy(*keys).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    even = (sizes["most"] or 0) <= max(FEW, (sizes["all"] or 0) / buckets)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{KEYS}' = '{','.join(keys)}', '{BUCKETS}' = '{buckets}', '{EVEN}' = '{str(even).lower()}')")
    return True


def location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def frame(spark: SparkSession, name: str) -> DataFrame:
    """A stored table bucket by bucket, or as plain files if it has a hot key."""
    if properties(spark, name)[EVEN] == "true":
        return spark.table(name)
    return spark.read.schema(spark.table(name).schema).parquet(location(spark, name))


def drop(spark: SparkSession, name: str) -> bool:
    """Remove a table from the catalog and its files; whether it was there."""
    if not exists(spark, name):
        return False
    layout(spark, name)  # only tables of this module
    at = location(spark, name)
    spark.sql(f"DROP TABLE {name}")
    drop_table(spark, at)
    return True


def joined(spark: SparkSession, names: list[str], how: str = "inner", conditions: dict[str, str] | None = None) -> DataFrame:
    """Feature tables joined on their common key, bucket by bucket.

    All must have the same keys and number of buckets, which the catalog tells.
    The join is asked to merge, for a broadcast of a side would move what is in
    place already. ``conditions`` filter tables by name before they are joined.
    """
    found = {layout(spark, n) == layout(spark, names[0]) for n in names}
    if found != {True}:
        raise ValueError(f"tables with different keys or buckets: {names}")
    keys, _ = layout(spark, names[0])
    frames = [frame(spark, n).where((conditions or {}).get(n, "true")) for n in names]
    out = frames[0]
    for other in frames[1:]:
        out = out.join(other.hint("merge"), keys, how)
    return out


def with_missing(spark: SparkSession, names: list[str], flag: str = "complete") -> DataFrame:
    """All keys of any table, with ``flag``: whether every table has the key (a full join, bucket by bucket)."""
    keys, _ = layout(spark, names[0])
    out, seen = None, []
    for i, n in enumerate(names):
        own = frame(spark, n).withColumn(f"__t{i}", F.lit(True))
        seen.append(F.col(f"__t{i}").isNotNull())
        out = own if out is None else out.join(own.hint("merge"), keys, "full")
    complete = seen[0]
    for c in seen[1:]:
        complete = complete & c
    return out.withColumn(flag, complete).drop(*[f"__t{i}" for i in range(len(names))])
