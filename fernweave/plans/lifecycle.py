"""The batch lifecycle: collect, prepare, train, predict, report, each a plan over versioned tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fernweave.functions.net import bucket, networks
from fernweave.functions.text import distinct_text
from fernweave.functions.vectors import rounded
from fernweave.operators import features, fingerprint, models, report, rules, sampling, soinn, vectorize
from fernweave.operators.joins import filled_from, network_flags, with_clusters
from fernweave.plans.registry import query
from fernweave.session import shared_dir
from fernweave.sources import http_log, store


@dataclass
class Config:
    """Settings of a run; paths are folders of versioned tables."""

    root: str
    keywords: list[str]
    white: list[str] = field(default_factory=list)
    interval: str = "30 minutes"
    limit: int = 5000
    days: int = 10
    attack_limit: int = 15_000
    signals: int = 3_000_000
    weight: float = 1.0
    fourier: int = 4096
    iterations: int = 5
    restarts: int = 30

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"


def collect_training(log: DataFrame, blocked: list[DataFrame], attacks: DataFrame | None, end: datetime, config: Config, version: str) -> DataFrame:
    """Normal fingerprints of the days before ``end``, one scan for all, and samples of each class of ``attacks``
    (lgtime, src_ip, dst_ip, agnt_qry, label), stored as one version with an index."""
    days = [(end - timedelta(days=d + 1), end - timedelta(days=d)) for d in range(config.days)]
    rows = fingerprint.normal_fingerprints(log, blocked, days, config.limit, config.interval).drop("day", "slot")
    if attacks is not None:
        keyed = attacks.withColumn("key", F.struct("lgtime", "src_ip", "dst_ip", "agnt_qry"))
        drawn = sampling.class_bootstrap(keyed, "label", "key", config.attack_limit, version)
        rows = rows.unionByName(drawn.select(*rows.columns))
    keyed = rows.withColumn("key", F.struct("lgtime", "src_ip", "dst_ip", "label", "agnt_qry"))
    store.insert_version(sampling.numbered(keyed, "key").drop("key"), config.path("collect"), version)
    return store.versioned(log.sparkSession, config.path("collect"), version)


def sampling_data(normal: DataFrame, attacks: DataFrame, classes: list[str], key: list[str], config: Config, version: str, ratio: float) -> tuple[DataFrame, DataFrame]:
    """Normal rows and exactly ``attack_limit`` draws of each wanted class, numbered by label and ``key`` and split by
    ``ratio``: the rows to train on and those to predict, each stored as one version."""
    spark = normal.sparkSession
    keyed = attacks.where(F.col("label").isin(classes)).withColumn("key", F.struct(*key))
    drawn = sampling.class_bootstrap(keyed, "label", "key", config.attack_limit, version, {})
    rows = normal.unionByName(drawn.select(*normal.columns)).withColumn("key", F.struct("label", *key))
    parts = sampling.split(sampling.numbered(rows, "key").drop("key"), "index", ratio, version)
    for table, part in (("sample_train", "train"), ("sample_predict", "test")):
        store.insert_version(parts.where(F.col("part") == part).drop("part"), config.path(table), version)
    return tuple(store.versioned(spark, config.path(t), version) for t in ("sample_train", "sample_predict"))


def collect_prediction(log: DataFrame, blocked: DataFrame, exceptions: DataFrame, start: datetime, end: datetime, config: Config, version: str) -> DataFrame:
    """Fingerprints of a span to predict, without what the table of exceptions names, stored as one version with an index."""
    rows = fingerprint.predict_fingerprint(log, blocked, start, end, fingerprint.exclusion_patterns(exceptions), config.interval)
    keyed = rows.withColumn("key", F.struct("lgtime", "src_ip", "dst_ip", "agnt_qry"))
    store.insert_version(sampling.numbered(keyed, "key").drop("key"), config.path("predict"), version)
    return store.versioned(log.sparkSession, config.path("predict"), version)


def prepare(spark: SparkSession, config: Config, version: str, source: str = "collect") -> DataFrame:
    """Keyword vectors of a version's texts over black and white words, stored under the same version."""
    rows = store.versioned(spark, config.path(source), version).drop("version")
    vectors = vectorize.KeywordTfidf([*config.keywords, *config.white]).arrays(rows, "agnt_qry")
    store.insert_version(vectors, config.path(f"prep_{source}"), version)
    return store.versioned(spark, config.path(f"prep_{source}"), version)


def fit_columns(df: DataFrame, kinds: dict[str, str]) -> tuple[features.Scaler, features.OneHot]:
    """Fits of number and category columns after their nulls are filled."""
    filled = features.null_filled(features.cast_kinds(df, kinds), kinds)
    numbers, categories = ([c for c, k in kinds.items() if k == kind] for kind in ("number", "category"))
    return features.Scaler("min_max", numbers).fit(filled), features.OneHot(categories).fit(filled)


def prepare_columns(df: DataFrame, key: str, kinds: dict[str, str], fits: tuple[features.Scaler, features.OneHot], text_vector: str | None = None) -> DataFrame:
    """(key, vector): scaled numbers, then the categories' 0/1 columns, then the row's text vector if it is named."""
    scaler, hot = fits
    filled = features.null_filled(features.cast_kinds(df, kinds), kinds)
    own = [f"{c}_{v}" for c, vs in hot.categories.items() for v in vs]
    rows = hot.transform(scaler.transform(filled))
    vector = F.array(*[F.col(c).cast("double") for c in [*scaler.columns, *own]])
    return rows.select(key, (F.concat(vector, F.col(text_vector)) if text_vector else vector).alias("vector"))


def black(config: Config) -> Column:
    """The part of the score that models see: the black words, normed with the white ones."""
    return F.slice("score", 1, len(config.keywords))


def fourier(config: Config) -> models.FourierFeatures:
    return models.FourierFeatures(len(config.keywords), config.fourier, 10.0)


def network_settings(config: Config) -> soinn.Settings:
    return soinn.Settings(weight=config.weight, patience=50)


def store_network(config: Config, version: str, network: tuple[DataFrame, DataFrame], valid: DataFrame) -> None:
    """A network's nodes and edges, and the rows that validated it."""
    for table, rows in zip(("nodes", "edges", "valid"), (*network, valid), strict=True):
        store.insert_version(rows, config.path(table), version)


def transfer(spark: SparkSession, config: Config, version: str, before: str) -> None:
    """The network of the version ``before`` trained on with this version's normal rows; half the normal rows that
    validate it are new ones."""
    rows = store.versioned(spark, config.path("prep_collect"), version).where(F.col("label") == rules.NORMAL)
    old = store.versioned(spark, config.path("valid"), before, ["index", "vector", "label"])
    valid, rest = sampling.refreshed(old, rows.select("index", black(config).alias("vector"), "label"), "index", "label", version)
    trained = tuple(store.versioned(spark, config.path(t), before).drop("version") for t in ("nodes", "edges"))
    store_network(config, version, soinn.fit(rest, "index", "vector", "label", config.signals, network_settings(config), trained=trained, valid=valid), valid)


def train(spark: SparkSession, config: Config, version: str) -> None:
    """The clustering network, the classifier and a binary model for each class of attacks, all stored under the version."""
    rows = store.versioned(spark, config.path("prep_collect"), version).withColumn("vector", black(config))
    held = rows.where(soinn.held_out("index")).select("index", "vector", "label")
    store_network(config, version, soinn.fit(rows, "index", "vector", "label", config.signals, network_settings(config)), held)
    parts = sampling.split(models.with_features(rows, "vector", fourier(config)), "index", 0.95, version)
    train_, test = parts.where("part = 'train'"), parts.where("part = 'test'")
    multi = models.MultiClass().fit(train_, test, "label", config.iterations, config.restarts)
    store.save_model(spark, config.path("classifier"), "multi", version, multi.margins().state())
    for name in multi.labels:
        if name != rules.NORMAL:
            own = models.binary_margins(models.fit_binary(train_, "label", name, config.iterations), name)
            store.save_model(spark, config.path("classifier"), f"binary_{name}", version, own.state())


def classified(rows: DataFrame, multi: models.Margins, checks: dict[str, models.Margins], config: Config) -> DataFrame:
    """``rows`` with ``vector``, ``present`` and the classifier's label, after the re-check of each class and the keyword rules."""
    words = F.array(*[F.lit(w) for w in config.keywords])
    present = F.filter(F.transform(words, lambda w, i: F.when(F.get("vector", i) > 0, w)), lambda w: w.isNotNull())
    vectors = models.with_features(rows, "vector", fourier(config))
    first = vectors.withColumn("ai_label", multi.label()).withColumn("ai_label", models.rechecked(F.col("ai_label"), checks)).drop("features")
    first = first.withColumn("present", present)
    return first.withColumn("ai_label", rules.bypassed(F.col("ai_label"), F.col("present"), config.keywords))


def predict(spark: SparkSession, config: Config, version: str, trained: str, source: str = "predict") -> DataFrame:
    """Labels of a version by the models of another, read back from the store: classifier and re-check, keyword rules,
    then the network on what is still normal."""
    rows = store.versioned(spark, config.path(f"prep_{source}"), version).drop("version").withColumn("vector", black(config))
    load = lambda name: models.Margins.of(store.load_model(spark, config.path("classifier"), name, trained))
    multi = load("multi")
    first = classified(rows, multi, {n: load(f"binary_{n}") for n in multi.labels if n != rules.NORMAL}, config)
    nodes = store.versioned(spark, config.path("nodes"), trained).drop("version")
    edges = store.versioned(spark, config.path("edges"), trained).drop("version")
    second = soinn.predict(first.where("ai_label = 'normal'"), nodes, edges, "index", "vector", config.weight)
    second = second.withColumn("ai_label", F.when(F.col("ai_label") == "anomaly", "anomaly").otherwise("normal"))
    final = filled_from(first, second, ["index"], "ai_label", "final").withColumn("ai_label", rules.head_bypassed(F.col("final"), F.col("present")))
    out = final.select("index", "lgtime", "src_ip", "dst_ip", "ai_label", "feature", "score")
    store.insert_version(out, config.path("result"), version)
    return store.versioned(spark, config.path("result"), version)


def second_training(log: DataFrame, blocked: list[DataFrame], attacks: DataFrame, classes: list[str], start: datetime, end: datetime, config: Config, version: str) -> DataFrame:
    """What a second model trains on: normal fingerprints of one day and the attacks of the wanted classes as they
    stand, stored as one version with an index."""
    normal = fingerprint.normal_fingerprint(log, blocked, start, end, config.limit, config.interval).drop("slot")
    rows = normal.unionByName(attacks.where(F.col("label").isin(classes)).select(*normal.columns))
    keyed = rows.withColumn("key", F.struct("lgtime", "src_ip", "dst_ip", "label", "agnt_qry"))
    store.insert_version(sampling.numbered(keyed, "key").drop("key"), config.path("second_collect"), version)
    return store.versioned(log.sparkSession, config.path("second_collect"), version)


def second_prediction(spark: SparkSession, config: Config, version: str, one_model: bool = False) -> DataFrame:
    """What a second model predicts: a version's rows with the classes that the first run gave them, stored."""
    keys = ["index", "lgtime", "src_ip", "dst_ip"]
    found = store.versioned(spark, config.path("result"), version, [*keys, "ai_label"])
    rows = with_clusters(store.versioned(spark, config.path("predict"), version).drop("version"), found, keys, one_model)
    store.insert_version(rows, config.path("second_predict"), version)
    return store.versioned(spark, config.path("second_predict"), version)


def check_blocked(spark: SparkSession, config: Config, version: str, nets: DataFrame) -> DataFrame:
    """Detections of a version with flags of whether source and destination stand in the networks."""
    rows = store.versioned(spark, config.path("result"), version, ["index", "lgtime", "src_ip", "dst_ip", "ai_label"])
    return network_flags(rows.where("ai_label <> 'normal'"), nets, ["src_ip", "dst_ip"])


def publish(spark: SparkSession, config: Config, version: str) -> None:
    store.manifest(spark, config.path("model_version"), model_version=version)


VERSION, TRAIN_END, PREDICT_END = "20240110000000", datetime(2024, 1, 8), datetime(2024, 1, 10)


def _attacks(log: DataFrame) -> DataFrame:
    """Labelled attacks: the fingerprints of rows whose code stands for a class."""
    label = F.when(F.col("http_retcode") == "500", "SQL_Injection").when(F.col("http_retcode") == "302", "Cross_Site_Scripting")
    rows = log.withColumn("label", label).where("label IS NOT NULL").withColumn("text", fingerprint.train_text())
    return rows.groupBy(bucket("logtime").alias("lgtime"), "src_ip", "dst_ip", "label").agg(distinct_text("text").alias("agnt_qry"))


def _run(spark, sf_dir) -> Config:
    """Collect, prepare, train, load what is to be predicted, predict and publish."""
    config = Config(shared_dir(spark), ["crawler", "bot", "error", "signup", "purchase"], ["view"], limit=200, days=3, attack_limit=200, signals=2000, iterations=10, restarts=2, fourier=64)
    log, blocked = http_log.http_log(spark, sf_dir), http_log.blocked(spark, sf_dir)
    collect_training(log, [blocked], _attacks(log), TRAIN_END, config, VERSION)
    prepare(spark, config, VERSION)
    train(spark, config, VERSION)
    exceptions = spark.createDataFrame([("http_query", r'"k": 7\d'), ("dst_ip", r"192\.168\.1\."), ("http_host", "")], "selectcolumn string, keyword string")
    collect_prediction(log, blocked, exceptions, TRAIN_END, PREDICT_END, config, VERSION)
    prepare(spark, config, VERSION, "predict")
    predict(spark, config, VERSION, VERSION)
    publish(spark, config, VERSION)
    return config


@query()
def lifecycle(spark, sf_dir):
    """A whole run and the report of its detections."""
    config = _run(spark, sf_dir)
    found = store.versioned(spark, config.path("result"), VERSION)
    out = report.report(http_log.http_log(spark, sf_dir), found, fingerprint.ts(TRAIN_END), fingerprint.ts(PREDICT_END))
    return out.select("ai_label", F.date_format("time_group", "yyyy-MM-dd HH:mm:ss").alias("time_group"), "src_ip", "dst_ip", F.array_join("keyword", " ").alias("keyword"))


@query()
def lifecycle_blocked(spark, sf_dir):
    """The detections of a run with flags of the networks that their addresses stand in."""
    config = _run(spark, sf_dir)
    out = check_blocked(spark, config, VERSION, networks(spark, ["10.0.0.0/25", "192.168.0.0/30"]))
    return out.withColumn("lgtime", F.date_format("lgtime", "yyyy-MM-dd HH:mm:ss")).drop("index")


HASH28 = "('0x' || substr(md5({}), 1, 7))::BIGINT"
CLASSES = "(SELECT doc_id, CASE lang WHEN 'en' THEN 'SQL_Injection' WHEN 'de' THEN 'Path_Traversal' ELSE lang END AS label FROM documents)"


@query(
    f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM {CLASSES}),
r AS (SELECT label, n, unnest(range(CASE label WHEN 'SQL_Injection' THEN 300 WHEN 'Path_Traversal' THEN 240 ELSE 200 END)) AS draw FROM (SELECT DISTINCT label, n FROM d))
SELECT r.label, draw, doc_id FROM r JOIN d ON d.label = r.label AND d.i = {HASH28.format("'s2:' || r.label || ':' || draw::VARCHAR")} % r.n"""
)
def attack_class_bootstrap(spark, sf_dir):
    """Exactly so many rows of each class, drawn with replacement: 1.5 and 1.2 times the limit for some."""
    label = F.when(F.col("lang") == "en", "SQL_Injection").when(F.col("lang") == "de", "Path_Traversal").otherwise(F.col("lang"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", label.alias("label"))
    return sampling.class_bootstrap(docs, "label", "doc_id", 200, "s2").select("label", "draw", "doc_id")


@query(
    f"""WITH d AS (SELECT lang AS label, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang IN ('de', 'fr')),
r AS (SELECT label, n, unnest(range(100)) AS draw FROM (SELECT DISTINCT label, n FROM d)),
t AS (SELECT 'normal' AS label, doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT r.label, doc_id FROM r JOIN d ON d.label = r.label AND d.i = {HASH28.format("'v1:' || r.label || ':' || draw::VARCHAR")} % r.n),
x AS (SELECT row_number() OVER (ORDER BY label, doc_id) - 1 AS index, * FROM t)
SELECT index, label, doc_id, CASE WHEN row_number() OVER (ORDER BY md5('v1:' || index::VARCHAR), index) <= floor((SELECT count(*) FROM x) * 0.95) THEN 'train' ELSE 'predict' END AS part FROM x"""
)
def sampled_split(spark, sf_dir):
    """Normal rows and draws of two classes, stored as what to train on and what to predict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("lang").alias("label"), "doc_id")
    normal = docs.where("label = 'en'").withColumn("label", F.lit("normal"))
    parts = sampling_data(normal, docs, ["de", "fr"], ["doc_id"], Config(shared_dir(spark), [], attack_limit=100), "v1", 0.95)
    train_, rest = (p.drop("version").withColumn("part", F.lit(name)) for p, name in zip(parts, ("train", "predict"), strict=True))
    return train_.unionByName(rest)


@query(
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 5 > 0 THEN user_id ELSE -1 END AS a, CASE WHEN event_id % 7 > 0 THEN event_id ELSE -1 END AS b, CASE WHEN event_id % 11 > 0 THEN event_type ELSE 'empty' END AS c FROM events),
s AS (SELECT min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1, list_sort(list(DISTINCT c)) AS cs FROM e)
SELECT event_id, list_transform(list_concat([(a - a0) / (a1 - a0), (b - b0) / (b1 - b0)], list_transform(cs, lambda x: CASE WHEN x = c THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)), lambda x: round(x, 6)) AS vector FROM e, s"""
)
def prepared_columns(spark, sf_dir):
    """Numbers and a category with nulls: filled, scaled and one-hot, as one vector; the fits are kept and read back."""
    at, kinds = shared_dir(spark), {"a": "number", "b": "number", "c": "category"}
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.when(F.col("event_id") % 5 > 0, F.col("user_id")).alias("a"), F.when(F.col("event_id") % 7 > 0, F.col("event_id")).alias("b"), F.when(F.col("event_id") % 11 > 0, F.col("event_type")).alias("c")
    )
    for name, fit in zip(("scaler", "hot"), fit_columns(e, kinds), strict=True):
        store.save_model(spark, at, name, "v1", fit.state())
    fits = features.Scaler.of(store.load_model(spark, at, "scaler", "v1")), features.OneHot.of(store.load_model(spark, at, "hot", "v1"))
    return prepare_columns(e, "event_id", kinds, fits).withColumn("vector", F.transform("vector", lambda x: rounded(x, 6)))


@query(
    """SELECT doc_id, lang, '20240101000000' AS version FROM documents"""
)
def idempotent_sink(spark, sf_dir):
    """A version written twice is stored once."""
    at = f"{shared_dir(spark)}/docs"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    for _ in range(2):
        store.insert_version(rows, at, "20240101000000")
    return store.versioned(spark, at, "20240101000000", ["doc_id", "lang", "version"])


@query("SELECT unnest(['se_time', 'idx', 'idx']) AS kind, unnest(['2024-01-01', 'lgtime', 'src_ip']) AS name, unnest([0, 0, 1]) AS pos")
def artifact_lists(spark, sf_dir):
    """Ordered lists saved by kind and version, read back."""
    at = shared_dir(spark)
    lists = {"idx": ["lgtime", "src_ip"], "se_time": ["2024-01-01"]}
    for kind, names in lists.items():
        store.save_artifact(spark, at, kind, names, "v1")
    rows = [(kind, name, i) for kind in lists for i, name in enumerate(store.load_artifact(spark, at, kind, "v1"))]
    return spark.createDataFrame(rows, "kind string, name string, pos int")
