"""Tables kept by version, artifacts, configuration and text inputs."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of one output file of a versioned table.
FILE_ROWS = 350_000
#: The type of each known column, then of all columns of tables whose name holds a part.
COLUMN_TYPES = {
    "lgtime": "timestamp",
    "logtime": "timestamp",
    "train_start_time": "timestamp",
    "train_end_time": "timestamp",
    "src_ip": "string",
    "dst_ip": "string",
    "version": "string",
    "model_version": "string",
    "label": "string",
    "ai_label": "string",
    "esoinn_label": "string",
    "model_type": "string",
    "attack_type": "string",
    "data_shape": "string",
    "columns": "string",
    "model_name": "string",
    "index": "bigint",
    "model_id": "bigint",
    "epoch": "bigint",
    "loss": "double",
    "feature": "array<string>",
    "score": "array<double>",
}
TABLE_TYPES = [("collect_number", "bigint"), ("collect_string", "string"), ("collect_category", "string"), ("prep_", "double")]


def versioned(spark: SparkSession, path: str, version: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of one version, which stays a string; only its folder is read, and only ``columns`` of it."""
    at = f"{path.rstrip('/')}/version={version}"
    if exists(spark, f"{at}/{COMMITTED}"):
        df = spark.read.parquet(at)
    else:
        df = spark.read.parquet(path).drop("version").where("false")
    df = df.withColumn("version", F.lit(version))
    return df.select(*columns) if columns else df


#: The file that Spark's committer leaves in a folder that is written in full.
COMMITTED = "_SUCCESS"


def insert_version(df: DataFrame, path: str, version: str) -> bool:
    """Write ``df`` as ``version`` unless the table has it already; whether it was written.

    Rows go to a folder of their own, which readers skip, and become the version
    by one rename once they are committed. So what a writer that died left
    behind counts for nothing, and of two writers at once one wins.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    name = uuid.uuid4().hex
    at, staged = f"{root}/version={version}", f"{root}/_staged/{name}"
    if exists(spark, f"{at}/{COMMITTED}"):
        return False
    df.write.option("maxRecordsPerFile", FILE_ROWS).parquet(staged)
    fs, target = _hadoop(spark, at)
    if fs.exists(target) and not exists(spark, f"{at}/{COMMITTED}"):
        fs.delete(target, True)  # half-written
    won = not fs.exists(target) and fs.rename(_hadoop(spark, staged)[1], target)
    if exists(spark, f"{at}/{name}"):  # another writer was first: the folder went into the version's
        drop_table(spark, f"{at}/{name}")
        won = False
    drop_table(spark, staged)
    return won


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table's files if they are there."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def same_schema(df: DataFrame, columns: dict[str, str]) -> bool:
    """Whether the sorted names and the sorted types both equal the given ones (each on its own)."""
    own = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return sorted(n for n, _ in own) == sorted(columns) and sorted(t for _, t in own) == sorted(columns.values())


def column_types(table: str, columns: Iterable[str]) -> dict[str, str]:
    """A Spark type for each column by its name, else by the table's name, else string."""
    fallback = next((t for part, t in TABLE_TYPES if part in table), "string")
    return {c: COLUMN_TYPES.get(c, fallback) for c in columns}


def ordered_columns(df: DataFrame, first: list[str]) -> DataFrame:
    """Key columns first, the others in name order."""
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


def valid_name(name: str) -> bool:
    """Whether a table or column name is a plain identifier."""
    return bool(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name))


def string_columns(df: DataFrame, key: Iterable[str] = ()) -> list[str]:
    """String columns outside the key, from the schema alone."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in set(key)]


def save_artifact(spark: SparkSession, path: str, kind: str, names: list[str], version: str) -> None:
    """Keep an ordered list (key columns, time span, collected columns) under ``kind`` and ``version``."""
    rows = [(kind, i, n) for i, n in enumerate(names)]
    insert_version(spark.createDataFrame(rows, "kind string, pos int, name string").coalesce(1), f"{path}/{kind}", version)


def load_artifact(spark: SparkSession, path: str, kind: str, version: str) -> list[str]:
    rows = versioned(spark, f"{path}/{kind}", version, ["pos", "name"]).orderBy("pos").collect()
    return [r["name"] for r in rows]


def manifest(spark: SparkSession, path: str, **values: str) -> None:
    """Publish values (the model version) as a one-row JSON file."""
    spark.createDataFrame([(json.dumps(values, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict[str, str]:
    return json.loads(spark.read.text(path).first()["value"])


def save_model(spark: SparkSession, path: str, feature: str, version: str, state: dict) -> bool:
    """Keep a fitted model's state as JSON under its feature and version; whether it was new."""
    row = spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1)
    return insert_version(row, f"{path}/{feature}", version)


def load_model(spark: SparkSession, path: str, feature: str, version: str) -> dict:
    return json.loads(versioned(spark, f"{path}/{feature}", version, ["state"]).first()["state"])


def log_size(df: DataFrame, path: str, name: str, at: str) -> None:
    """Append one row with the time, the table's name and its number of rows to a CSV log."""
    df.agg(F.lit(at).alias("at"), F.lit(name).alias("name"), F.count("*").alias("rows")).coalesce(1).write.mode("append").option("header", True).csv(path)


def update_config(df: DataFrame, model_id: int, changes: dict[str, str]) -> DataFrame:
    """Rows (model_id, config JSON) with fields of one model's config replaced or added."""
    fields = F.from_json("config", "map<string,string>")
    new = F.map_concat(F.map_filter(fields, lambda k, _: ~k.isin(list(changes))), F.create_map(*[F.lit(x) for kv in changes.items() for x in kv]))
    return df.withColumn("config", F.when(F.col("model_id") == model_id, F.to_json(new)).otherwise(F.col("config")))


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(pos, term) of a text file with one term a line: trimmed, lower-cased, blank lines out, in file order."""
    lines = spark.read.text(path, wholetext=True)
    rows = lines.select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "term"))
    return rows.select("pos", F.lower(F.trim("term")).alias("term")).where("term <> ''")


def read_csv(spark: SparkSession, path: str, schema: str, column: str | None = None, wanted: list[str] | None = None) -> DataFrame:
    """CSV files of a glob with a header; rows of the wanted classes."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.where(F.col(column).isin(wanted)) if column else df


#: Connections that one partitioned read opens at most.
CONNECTIONS = 32


def read_jdbc(spark: SparkSession, url: str, query: str, key: str | None = None, partitions: int | None = None, **options: str) -> DataFrame:
    """A query's result from a database; the driver's jar must be on the class path.

    With a numeric ``key`` the result is read in as many tasks as ``partitions``
    says (by default a shuffle's, at most ``CONNECTIONS``): the database is asked
    for the key's least and largest value, and each task for an equal range of
    these; rows with a null key come with the first. Without one, or where the
    key has a single value, one task reads all.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if key is None:
        return reader.option("query", query).load()
    quoted = key if key[0] in '"`' else f'"{key}"'
    low, high = reader.option("query", f"SELECT MIN({quoted}) AS low_key, MAX({quoted}) AS high_key FROM ({query}) bounds").load().first()
    n = min(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), CONNECTIONS)
    if low is None or low == high or n < 2:
        return reader.option("query", query).load()
    told = [f"{quoted} {c.format(quoted)}" for c in ranges(low, high, n)]
    predicates = [f"({told[0]} OR {quoted} IS NULL)", *told[1:]]
    return spark.read.jdbc(url, f"({query}) part", predicates=predicates, properties=options)


def ranges(low, high, n: int) -> list[str]:
    """Conditions of at most ``n`` disjoint ranges that cover all values from ``low`` to ``high``: equal parts, the last takes the remainder."""
    whole = isinstance(low, int) and isinstance(high, int)
    step = (high - low + 1) // n or 1 if whole else (high - low) / n
    cuts = [low + i * step for i in range(1, n) if low + i * step <= high]
    if not cuts:
        return ["IS NOT NULL"]
    between = [f">= {a} AND {{}} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"< {cuts[0]}", *between, f">= {cuts[-1]}"]
