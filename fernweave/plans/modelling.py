"""Queries of features, vectors, rules, metrics and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from fernweave.functions.vectors import argmax_label, rounded
from fernweave.operators import aggregate, features, joins, metrics, models, rules, sampling, soinn, vectorize
from fernweave.plans.registry import query, read
from fernweave.session import shared_dir
from fernweave.sources import store

KEYWORDS = ["the", "and", "of", "die", "le", "la", "bot", "thing", "x1", "ererer"]
WHITE = ["with", "that"]
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
ALL = KEYWORDS + WHITE
TF = f"tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) WHERE term IN {tuple(ALL)} GROUP BY doc_id, term)"


def docs(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "text", "lang")


@query(f"WITH {TF} SELECT * FROM tf")
def keyword_tf(spark, sf_dir):
    return vectorize.keyword_counts(docs(spark, sf_dir), ["doc_id"], "text", ALL)


@query(f"WITH {TF} SELECT doc_id, term, round(tf / sqrt(sum(tf * tf) OVER (PARTITION BY doc_id)), 6) AS weight FROM tf")
def keyword_tfidf_stored(spark, sf_dir):
    model = vectorize.KeywordTfidf(ALL).fit(docs(spark, sf_dir), "text")
    return model.rows(docs(spark, sf_dir), ["doc_id"], "text").withColumn("weight", rounded(F.col("weight"), 6))


@query(
    f"""WITH {TF}, d AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1 AS idf FROM tf GROUP BY term), r AS (SELECT doc_id, term, tf * idf AS raw FROM tf JOIN d USING (term))
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM r"""
)
def keyword_tfidf_true(spark, sf_dir):
    model = vectorize.KeywordTfidf(ALL, "true").fit(docs(spark, sf_dir), "text")
    return model.rows(docs(spark, sf_dir), ["doc_id"], "text").withColumn("weight", rounded(F.col("weight"), 6))


@query(
    f"""WITH {TF}, n AS (SELECT doc_id, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY doc_id)
SELECT doc_id, list(round(coalesce(tf / norm, 0.0), 6) ORDER BY pos) AS score, round(sum(CASE WHEN pos <= {len(KEYWORDS)} THEN coalesce(tf / norm, 0.0) ELSE 0 END), 5) AS black_sum
FROM documents CROSS JOIN (SELECT unnest({ALL}) AS term, unnest(range(1, {len(ALL) + 1})) AS pos) v LEFT JOIN tf USING (doc_id, term) LEFT JOIN n USING (doc_id) GROUP BY doc_id"""
)
def keyword_arrays(spark, sf_dir):
    out = vectorize.KeywordTfidf(ALL).arrays(docs(spark, sf_dir), "text")
    black = F.aggregate(F.slice("score", 1, len(KEYWORDS)), F.lit(0.0), lambda s, x: s + x)
    return out.select("doc_id", F.transform("score", lambda x: rounded(x, 6)).alias("score"), rounded(black, 5).alias("black_sum"))


HIT_WORDS = {"en": ["bot", "thing"], "de": ["die", "of"]}


@query(
    f"""SELECT doc_id FROM (SELECT doc_id, lang, {WORDS} AS t FROM documents) WHERE
(lang = 'en' AND list_has_any(t, ['the', 'and', 'bot', 'thing', 'ererer'])) OR (lang = 'de' AND list_has_any(t, ['the', 'and', 'of', 'die', 'ererer']))
OR (lang NOT IN ('en', 'de') AND list_has_any(t, ['the', 'and', 'ererer']))"""
)
def keyword_hit_filter(spark, sf_dir):
    words = ["the", "and", "of", "die", "bot", "thing", "ererer"]
    return vectorize.keyword_hits(docs(spark, sf_dir), "text", "lang", words, HIT_WORDS).select("doc_id")


@query(
    f"""WITH c AS (SELECT term, count(*) AS tf FROM (SELECT unnest({WORDS}) AS term FROM documents) GROUP BY term),
b AS (SELECT term, coalesce(tf, 0) AS tf, u FROM c FULL JOIN (SELECT unnest(['thing', 'log4j']) AS term, 1 AS u) USING (term))
SELECT rank, term, tf FROM (SELECT row_number() OVER (ORDER BY coalesce(u, 0) DESC, tf DESC, term)::INTEGER AS rank, term, tf FROM b) WHERE rank <= 40"""
)
def vocab_topn(spark, sf_dir):
    return vectorize.learned_vocabulary(docs(spark, sf_dir), "text", ["thing", "log4j"], 40)


@query(f"SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest({WORDS}) AS term FROM documents) GROUP BY term")
def document_frequency(spark, sf_dir):
    return vectorize.document_frequency(docs(spark, sf_dir), "text")


BARE = r"regexp_extract_all(lower(regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g')), '[\p{L}\p{N}_]{2,}')"


@query(
    f"""WITH w AS (SELECT item_id, list_filter({BARE}, lambda x: x NOT IN ('the', 'of')) AS w FROM benchmark),
g AS (SELECT item_id, w[i] || ' ' || w[i + 1] AS term FROM (SELECT item_id, w, unnest(range(1, len(w))) AS i FROM w)), t AS (SELECT item_id, term, count(*) AS tf FROM g WHERE length(term) <= 30 GROUP BY ALL),
s AS (SELECT term, sum(tf) AS total, count(*) AS df FROM t GROUP BY term ORDER BY total DESC, term LIMIT 100),
r AS (SELECT item_id, term, tf * (ln((1 + (SELECT count(*) FROM benchmark)) / (1.0 + df)) + 1) AS raw FROM t JOIN s USING (term))
SELECT item_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)), 6) AS weight FROM r"""
)
def plain_tfidf(spark, sf_dir):
    return vectorize.plain_tfidf(read(spark, sf_dir, "benchmark"), ["item_id"], "text", 2, ["the", "of"], 100).withColumn("weight", rounded(F.col("weight"), 6))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scaled(spark, sf_dir, kind):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS, F.lit(5.0).alias("five"))
    out = features.Scaler(kind, [*NUMBERS, "five"]).fit(li).transform(li)
    return out.withColumns({c: rounded(F.col(c), 6) for c in [*NUMBERS, "five"]})


def _scale_sql(term):
    return f"SELECT l_orderkey, l_linenumber, {', '.join(f'round({term.format(c=c)}, 6) AS {c}' for c in NUMBERS)}, 0.0 AS five FROM lineitem"


@query(_scale_sql("({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"))
def minmax_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "min_max")


@query(_scale_sql("({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)"))
def standard_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query(_scale_sql("{c} / max(abs({c})) OVER ()").replace("0.0 AS five", "1.0 AS five"))
def maxabs_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "max_abs")


@query(_scale_sql("({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem)"))
def robust_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


@query(_scale_sql("({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())"))
def saved_scaler(spark, sf_dir):
    """A scaler fitted, kept under a feature and version, and applied after it is read back."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS, F.lit(5.0).alias("five"))
    at = shared_dir(spark)
    store.save_model(spark, at, "numbers", "v1", features.Scaler("min_max", [*NUMBERS, "five"]).fit(li).state())
    out = features.Scaler.of(store.load_model(spark, at, "numbers", "v1")).transform(li)
    return out.withColumns({c: rounded(F.col(c), 6) for c in [*NUMBERS, "five"]})


@query("SELECT l_orderkey, l_tax, l_quantity FROM lineitem")
def drop_long_features(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_tax", "l_quantity", F.lit(1.0).alias("a_feature_whose_name_is_too_long_to_keep"))
    return features.short_features(li, ["l_orderkey"])


@query(
    f"""WITH w AS (SELECT item_id, unnest({WORDS}) AS term FROM benchmark), t AS (SELECT term FROM w GROUP BY term ORDER BY count(*) DESC, term LIMIT 50)
SELECT item_id, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM t) GROUP BY item_id, term"""
)
def bow_counts(spark, sf_dir):
    return vectorize.bag_of_words(read(spark, sf_dir, "benchmark"), ["item_id"], "text", 50)


QUANTILES = features.Scaler.QUANTILES
_MARKS = ", ".join(f"quantile_cont({{c}}, {i / QUANTILES})" for i in range(QUANTILES + 1))
_SHARE = (
    "least(1.0, greatest(0.0, (len(list_filter(m_{c}, lambda x: x < {c})) + greatest(len(list_filter(m_{c}, lambda x: x <= {c})), len(list_filter(m_{c}, lambda x: x < {c})) + 1) - 1) / 2.0 / "
    + f"{QUANTILES}))"
)


@query(
    f"WITH m AS (SELECT {', '.join(f'[{_MARKS.format(c=c)}] AS m_{c}' for c in NUMBERS)} FROM lineitem) "
    + f"SELECT l_orderkey, l_linenumber, {', '.join(f'round({_SHARE.format(c=c)}, 6) AS {c}' for c in NUMBERS)}, 0.5 AS five FROM lineitem, m"
)
def quantile_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "quantile")


def _yeo_johnson_sql(c: str, e: str) -> str:
    up = f"CASE WHEN abs({e}) < 1e-9 THEN ln(1 + {c}) ELSE (pow({c} + 1, {e}) - 1) / {e} END"
    down = f"CASE WHEN abs({e} - 2) < 1e-9 THEN -ln(1 - {c}) ELSE -(pow(1 - {c}, 2 - {e}) - 1) / (2 - {e}) END"
    return f"(CASE WHEN {c} >= 0 THEN {up} ELSE {down} END)"


def _power_sql() -> str:
    """For each column the exponent of the grid with the largest log-likelihood, then the standardised transform."""
    fits = []
    for c in NUMBERS:
        y = _yeo_johnson_sql(c, "e")
        fits.append(
            f"""f_{c} AS (SELECT e AS e_{c}, m AS m_{c}, sqrt(v) AS s_{c} FROM (SELECT e, avg({y}) AS m, var_pop({y}) AS v,
-count(*) / 2.0 * ln(var_pop({y})) + (e - 1) * avg(sign({c}) * ln(1 + abs({c}))) * count(*) AS l FROM lineitem, grid GROUP BY e) ORDER BY l DESC, e LIMIT 1)"""
        )
    columns = ", ".join(f"round(({_yeo_johnson_sql(c, f'e_{c}')} - m_{c}) / s_{c}, 6) AS {c}" for c in NUMBERS)
    grid = ", ".join(f"({e}::DOUBLE)" for e in features.Scaler.GRID)
    return f"WITH grid(e) AS (VALUES {grid}), {', '.join(fits)} SELECT l_orderkey, l_linenumber, {columns}, 0.0 AS five FROM lineitem, {', '.join(f'f_{c}' for c in NUMBERS)}"


@query(_power_sql())
def power_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "power")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("SELECT o_orderkey, " + ", ".join(f"CASE WHEN o_orderstatus = '{s}' THEN 1.0 ELSE 0.0 END AS o_orderstatus_{s}" for s in "FOP") + " FROM orders")
def one_hot(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    out = features.OneHot(["o_orderstatus"]).fit(o).transform(o)
    for s in "FOP":  # a category that the sample lacks is all zeros
        if f"o_orderstatus_{s}" not in out.columns:
            out = out.withColumn(f"o_orderstatus_{s}", F.lit(0.0))
    return out.drop("o_orderstatus")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus END AS back FROM orders")
def one_hot_inverse(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    hot = features.OneHot(["o_orderstatus"]).fit(o.where("o_orderstatus IN ('F', 'O')"))
    out = hot.transform(o)
    return out.select("o_orderkey", hot.inverse("o_orderstatus").alias("back"))


@query(
    """SELECT unnest(['o_orderstatus', 'o_orderpriority', 'o_custkey']) AS column_name,
unnest([count(DISTINCT o_orderstatus), count(DISTINCT o_orderpriority), count(DISTINCT o_custkey)]) AS n, unnest(['category', 'category', 'number']) AS kind FROM orders"""
)
def type_router(spark, sf_dir):
    return features.routed(read(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("SELECT event_id, CASE WHEN value > 50 THEN event_id ELSE -1 END AS num, CASE WHEN value > 20 THEN props ELSE '-' END AS str, CASE WHEN value < 80 THEN event_type ELSE 'empty' END AS cat FROM events")
def null_fill(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") > 50, F.col("event_id")).alias("num"), F.when(F.col("value") > 20, F.col("props")).alias("str"), F.when(F.col("value") < 80, F.col("event_type")).alias("cat")
    )
    return features.null_filled(e, {"num": "number", "str": "string", "cat": "category"})


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id::VARCHAR AS user_id FROM events")
def cast_kinds(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), "user_id")
    return features.cast_kinds(e, {"k": "number", "user_id": "category"})


RATES = ["l_discount", "l_tax", "l_linenumber"]


@query("SELECT feature, round(rate, 6) AS rate FROM (SELECT unnest(['l_discount', 'l_tax', 'l_linenumber']) AS feature, unnest([avg(CASE WHEN l_discount = 0 THEN 0.0 ELSE 1.0 END), avg(CASE WHEN l_tax = 0 THEN 0.0 ELSE 1.0 END), avg(CASE WHEN l_linenumber = 0 THEN 0.0 ELSE 1.0 END)]) AS rate FROM lineitem)")
def nonzero_rate(spark, sf_dir):
    return aggregate.nonzero_rates(read(spark, sf_dir, "lineitem"), RATES).withColumn("rate", rounded(F.col("rate"), 6))


@query(
    """WITH r AS (SELECT unnest(['l_discount', 'l_tax', 'l_linenumber']) AS feature, unnest([avg(CASE WHEN l_discount = 0 THEN 0.0 ELSE 1.0 END), avg(CASE WHEN l_tax = 0 THEN 0.0 ELSE 1.0 END), avg(CASE WHEN l_linenumber = 0 THEN 0.0 ELSE 1.0 END)]) AS rate FROM lineitem
UNION ALL SELECT unnest(['l_discount', 'l_tax', 'l_linenumber']), unnest([avg(CASE WHEN l_discount = 0 THEN 0.0 ELSE 1.0 END), avg(CASE WHEN l_tax = 0 THEN 0.0 ELSE 1.0 END), avg(CASE WHEN l_linenumber = 0 THEN 0.0 ELSE 1.0 END)]) FROM lineitem WHERE l_returnflag <> 'N')
SELECT feature, round(max(rate), 6) AS rate FROM r GROUP BY feature ORDER BY max(rate) DESC, feature LIMIT 2"""
)
def most_wanted(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn("label", F.when(F.col("l_returnflag") == "N", "normal").otherwise(F.col("l_returnflag")))
    return aggregate.most_wanted(li, RATES, "label", 2).withColumn("rate", rounded(F.col("rate"), 6))


def _labels(spark, sf_dir):
    name = lambda c: F.when(F.col(c) == 1, "attack").otherwise("normal")
    return read(spark, sf_dir, "labels").select("doc_id", name("quality").alias("truth"), name("toxic").alias("guess"))


NAMED = "(SELECT doc_id, CASE WHEN quality = 1 THEN 'attack' ELSE 'normal' END AS truth, CASE WHEN toxic = 1 THEN 'attack' ELSE 'normal' END AS guess FROM labels)"


@query(f"SELECT truth, guess AS predicted, count(*) AS n FROM {NAMED} GROUP BY 1, 2")
def confusion_counts(spark, sf_dir):
    return metrics.confusion(_labels(spark, sf_dir), "truth", "guess")


@query(f"SELECT pos, l AS truth, count(*) FILTER (truth = l AND guess = 'normal') AS normal, count(*) FILTER (truth = l AND guess = 'attack') AS attack, count(*) FILTER (truth = l AND guess = 'anomaly') AS anomaly FROM {NAMED}, (VALUES (0, 'normal'), (1, 'attack'), (2, 'anomaly')) AS o(pos, l) GROUP BY pos, l")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_labels(spark, sf_dir), "truth", "guess", ["normal", "attack", "anomaly"])


@query(
    f"""WITH c AS (SELECT truth, guess, count(*)::DOUBLE AS n FROM {NAMED} GROUP BY 1, 2), l AS (SELECT DISTINCT truth AS l FROM c UNION SELECT DISTINCT guess FROM c),
p AS (SELECT l, coalesce((SELECT sum(n) FROM c WHERE truth = l), 0) AS support, coalesce((SELECT sum(n) FROM c WHERE guess = l), 0) AS called, coalesce((SELECT sum(n) FROM c WHERE truth = l AND guess = l), 0) AS hit FROM l),
q AS (SELECT *, CASE WHEN called > 0 THEN hit / called ELSE 0 END AS prec, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM p)
SELECT round(sum(hit) / sum(support), 6) AS accuracy, round(sum(prec * support) / sum(support), 6) AS weighted_prec, round(sum(recall * support) / sum(support), 6) AS weighted_recall,
round(sum(CASE WHEN prec + recall > 0 THEN 2 * prec * recall / (prec + recall) ELSE 0 END * support) / sum(support), 6) AS weighted_f1 FROM q"""
)
def weighted_prf(spark, sf_dir):
    out = metrics.weighted(_labels(spark, sf_dir), "truth", "guess")
    return out.select(*[rounded(F.col(c), 6).alias(c) for c in out.columns])


@query("SELECT event_id, CASE WHEN event_type <> 'normal' AND event_type <> 'view' THEN 'attack' ELSE 'normal' END AS two, CASE WHEN event_type IN ('click', 'error') THEN 'normal' ELSE event_type END AS some FROM events")
def binary_collapse(spark, sf_dir):
    label = F.when(F.col("event_type") == "view", "normal").otherwise(F.col("event_type"))
    return read(spark, sf_dir, "events").select("event_id", rules.collapsed(label).alias("two"), rules.as_normal(F.col("event_type"), ["click", "error"]).alias("some"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'checked' ELSE event_type END AS ai_label FROM events")
def recheck_overwrite(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("ai_label"))
    second = e.where("event_id % 7 = 0").withColumn("ai_label", F.lit("checked"))
    return rules.rechecked(e, second, "event_id")


CLASSES = list(rules.ANTI_WORDS)
VOCABULARY = ["head", "bot", "python", "union", "yisouspider", "now", "owa", "crawler"]
#: Words present in each row: some subset of the vocabulary by the key's bits; its label by the key.
PRESENT = "list_filter({}, lambda w, i: (event_id >> (i - 1)) % 2 = 1 AND event_id % 3 < 2 OR i = event_id % 9)".format(VOCABULARY)


def _ruled(spark, sf_dir):
    key = F.col("event_id")
    bit = lambda w, i: ((F.call_function("shiftright", key, i) % 2 == 1) & (key % 3 < 2)) | (i + 1 == key % 9)
    names = F.array(*[F.lit(c) for c in [*CLASSES, "anomaly", "normal"]])
    return read(spark, sf_dir, "events").select("event_id", F.filter(F.array(*[F.lit(w) for w in VOCABULARY]), bit).alias("present"), F.element_at(names, (key % 5 + 1).cast("int")).alias("label"))


def _anti(c):
    return [w for w in dict.fromkeys(rules.ANTI_WORDS[c]) if w in VOCABULARY]


RULED = f"(SELECT event_id, {PRESENT} AS present, ({[*CLASSES, 'anomaly', 'normal']})[event_id % 5 + 1] AS label FROM events)"


@query(
    "SELECT event_id, CASE "
    + " ".join(
        f"WHEN label = '{c}' AND len(present) > 0 AND len(list_filter(present, lambda w: NOT list_contains({_anti(c)}, w))) = 0 THEN CASE WHEN list_has_any(present, {rules.EXPOSURE_WORDS}) THEN '{rules.EXPOSURE}' WHEN present = ['owa'] THEN '{rules.SCANNING}' ELSE 'normal' END"
        for c in CLASSES
    )
    + f" ELSE label END AS ai_label FROM {RULED}"
)
def bypass_rules(spark, sf_dir):
    return _ruled(spark, sf_dir).select("event_id", rules.bypassed(F.col("label"), F.col("present"), VOCABULARY).alias("ai_label"))


@query(f"SELECT event_id, CASE WHEN label = 'anomaly' AND present = ['head'] THEN 'normal' ELSE label END AS ai_label FROM {RULED}")
def head_bypass(spark, sf_dir):
    return _ruled(spark, sf_dir).select("event_id", rules.head_bypassed(F.col("label"), F.col("present")).alias("ai_label"))


@query("SELECT vec_id, 'c' || (list_position(embedding, list_max(embedding)) - 1)::VARCHAR AS category FROM embeddings")
def argmax_category(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", argmax_label(F.col("embedding"), [f"c{i}" for i in range(64)]).alias("category"))


# --- the clustering network: the means of all embeddings by label and key as nodes, edges by a rule -----------
N_NODES, WAYS = 20, 2


def _network(spark, sf_dir):
    """A node for each label and parity of the key: the mean of its embeddings to 4 places; every row counts."""
    node = (F.col("label") * WAYS + F.col("vec_id") % WAYS).cast("long").alias("node_id")
    long = read(spark, sf_dir, "embeddings").select(node, "label", F.posexplode("embedding").alias("pos", "x"))
    means = long.groupBy("node_id", "label", "pos").agg(rounded(F.avg(F.col("x").cast("decimal(30,15)")).cast("double"), 4).alias("x"))
    vectors = means.groupBy("node_id", "label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v"))
    nodes = vectors.select(
        "node_id",
        F.transform("v", lambda p: p["x"]).alias("node_vec"),
        F.when(F.col("label") < 4, "normal").otherwise(F.concat(F.lit("attack"), F.col("label").cast("string"))).alias("label"),
        (F.col("node_id") % 3).alias("class"),
        ((F.col("node_id") * 7) % 11 / 10).alias("density"),
    )
    ids = spark.range(N_NODES)
    pairs = ids.select(F.col("id").alias("src"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(N_NODES - 1).cast("long"))).alias("dst"))
    edges = pairs.where("src <> dst AND (src + dst) % 9 = 0 AND src % 4 <> 3 AND dst % 4 <> 3").withColumn("age", F.lit(1).cast("long"))
    return nodes, edges


SQ = "list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)))"
NET = f"""mean AS (SELECT label * {WAYS} + vec_id % {WAYS} AS node_id, label, i, round(avg(embedding[i]::DECIMAL(30,15)), 4) AS x FROM embeddings, range(1, 65) AS r(i) GROUP BY ALL),
node AS (SELECT node_id, list(x ORDER BY i) AS v, CASE WHEN label < 4 THEN 'normal' ELSE 'attack' || label::VARCHAR END AS label, node_id % 3 AS class, ((node_id * 7) % 11) / 10 AS density FROM mean GROUP BY node_id, label),
edge AS (SELECT a.node_id AS src, b.node_id AS dst FROM node a, node b WHERE a.node_id <> b.node_id AND (a.node_id + b.node_id) % 9 = 0 AND a.node_id % 4 <> 3 AND b.node_id % 4 <> 3),
th AS (SELECT a.node_id, coalesce(max(CASE WHEN e.src IS NOT NULL THEN {SQ.format(a="a.v", b="b.v")} END), min({SQ.format(a="a.v", b="b.v")})) AS threshold
  FROM node a JOIN node b ON a.node_id <> b.node_id LEFT JOIN edge e ON e.src = a.node_id AND e.dst = b.node_id GROUP BY a.node_id),
sig AS (SELECT vec_id, CASE WHEN vec_id % 50 = 49 THEN list_transform(embedding, lambda x: 0.0::FLOAT) WHEN vec_id % 3 = 0 THEN list_transform(embedding, lambda x: CASE WHEN x > 0.05 THEN x ELSE 0 END) ELSE embedding END AS x FROM embeddings),
knn AS (SELECT * FROM (SELECT vec_id, x, node_id, v, label, {SQ.format(a="x", b="v")} AS d2, row_number() OVER (PARTITION BY vec_id ORDER BY {SQ.format(a="x", b="v")}, node_id) AS rank FROM sig, node) WHERE rank <= 2),
near AS (SELECT a.vec_id, a.x, a.v, a.node_id AS n1, a.label AS l1, b.label AS l2, a.d2 AS d1, b.d2 AS d2, s.threshold AS t1, t.threshold AS t2 FROM knn a JOIN knn b ON a.vec_id = b.vec_id AND a.rank = 1 AND b.rank = 2 JOIN th s ON s.node_id = a.node_id JOIN th t ON t.node_id = b.node_id)"""


def _signals(spark, sf_dir):
    zero = F.transform("embedding", lambda _: F.lit(0.0).cast("float"))
    cut = F.transform("embedding", lambda x: F.when(x > F.lit(0.05), x).otherwise(F.lit(0.0).cast("float")))
    vec = F.when(F.col("vec_id") % 50 == 49, zero).when(F.col("vec_id") % 3 == 0, cut).otherwise(F.col("embedding"))
    return read(spark, sf_dir, "embeddings").select("vec_id", vec.alias("x"))


@query(f"WITH {NET} SELECT vec_id, rank::INTEGER AS rank, node_id, round(d2, 6) AS d2 FROM knn")
def knn2(spark, sf_dir):
    return joins.nearest(_signals(spark, sf_dir), _network(spark, sf_dir)[0], 2, "vec_id", "x").withColumn("d2", rounded(F.col("d2"), 6))


@query(f"WITH {NET} SELECT node_id, round(threshold, 6) AS threshold FROM th")
def node_threshold(spark, sf_dir):
    return soinn.thresholds(*_network(spark, sf_dir)).withColumn("threshold", rounded(F.col("threshold"), 6))


@query(
    f"""WITH {NET} SELECT vec_id, CASE WHEN list_sum(list_transform(x, lambda y: y::DOUBLE)) = 0 THEN 'normal'
WHEN (d1 > t1 OR d2 > t2) AND (l1 = 'normal' OR l2 = 'normal') THEN 'normal' WHEN (d1 > t1 OR d2 > t2) AND (d1 > t1 * 1.2 OR d2 > t2 * 1.2) THEN 'anomaly' ELSE l1 END AS ai_label FROM near"""
)
def soinn_predict(spark, sf_dir):
    nodes, edges = _network(spark, sf_dir)
    return soinn.predict(_signals(spark, sf_dir), nodes, edges, "vec_id", "x", 1.2)


@query(
    f"""WITH {NET}, o AS (SELECT *, d1 > t1 OR d2 > t2 AS outlier FROM near),
normal AS (SELECT * FROM (SELECT vec_id, x, v, row_number() OVER (PARTITION BY vec_id ORDER BY {SQ.format(a="x", b="v")}, node_id) AS r FROM sig, node WHERE label = 'normal') WHERE r <= 2),
far AS (SELECT vec_id, i, avg(abs(x[i]::DOUBLE - v[i])) AS diff FROM normal, range(1, 65) AS r(i) WHERE x[i] <> 0 GROUP BY vec_id, i),
own AS (SELECT vec_id, i, abs(x[i]::DOUBLE - v[i]) AS diff FROM o, range(1, 65) AS r(i) WHERE x[i] <> 0)
SELECT vec_id, outlier, coalesce(CASE WHEN outlier THEN (SELECT list('f' || (i - 1)::VARCHAR ORDER BY diff DESC, 'f' || (i - 1)::VARCHAR DESC) FROM far f WHERE f.vec_id = o.vec_id)
ELSE (SELECT list('f' || (i - 1)::VARCHAR ORDER BY diff, i) FROM own w WHERE w.vec_id = o.vec_id) END, []) AS terms FROM o"""
)
def soinn_explain(spark, sf_dir):
    nodes, edges = _network(spark, sf_dir)
    out = soinn.explain(_signals(spark, sf_dir), nodes, edges, "vec_id", "x", [f"f{i}" for i in range(64)])
    return out.withColumn("terms", F.transform("terms", lambda t: t["feature"]))


@query(
    f"""WITH {NET}, g AS (SELECT node_id, density, (SELECT count(*) FROM edge WHERE src = node_id) AS degree, (SELECT avg(density) FROM node) AS m FROM node)
SELECT node_id FROM g WHERE degree = 0 OR (degree = 1 AND density < 1.0 * m) OR (degree = 2 AND density < 0.5 * m)"""
)
def soinn_noise_nodes(spark, sf_dir):
    return soinn.noise_nodes(*_network(spark, sf_dir), c1=0.5)


@query(
    f"""WITH {NET}, c AS (SELECT class, avg(density) AS a, max(density) AS m FROM node GROUP BY class)
SELECT class, round(a, 6) AS mean_density, m AS max_density, CASE WHEN m > 3 * a THEN 1.0 WHEN m > 2 * a THEN 0.5 ELSE 0.0 END AS alpha FROM c"""
)
def class_density(spark, sf_dir):
    return soinn.class_density(_network(spark, sf_dir)[0]).withColumn("mean_density", rounded(F.col("mean_density"), 6))


@query(
    f"""WITH RECURSIVE {NET}, reach(a, b) AS (SELECT node_id, node_id FROM node UNION SELECT r.a, e.dst FROM reach r JOIN edge e ON r.b = e.src) SELECT a AS node_id, min(b) AS root FROM reach GROUP BY a"""
)
def soinn_components(spark, sf_dir):
    return soinn.components(*_network(spark, sf_dir))


@query(f"WITH {NET} SELECT vec_id, (l1 = 'normal' OR l2 = 'normal') AS close FROM near")
def soinn_close_to(spark, sf_dir):
    return soinn.close_to(_signals(spark, sf_dir), _network(spark, sf_dir)[0], "vec_id", "x", "normal")


@query(f"WITH {NET} SELECT label, count(*) AS n FROM node GROUP BY label")
def soinn_label_counts(spark, sf_dir):
    return aggregate.value_counts(_network(spark, sf_dir)[0], "label")


@query()
def pca_coordinates(spark, sf_dir):
    return models.pca_coordinates(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 2)


def _labelled(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("label") < 5, "normal").otherwise("attack").alias("label"))


@query()
def soinn_fit(spark, sf_dir):
    nodes, edges = soinn.fit(_labelled(spark, sf_dir), "vec_id", "embedding", "label", 2000, soinn.Settings(patience=5))
    return nodes.select("node_id", "label", "class", "wins")


@query()
def soinn_transfer(spark, sf_dir):
    """Training that goes on from a trained network: its labels stay, newer nodes are normal; half the normal
    validation rows are new ones."""
    before, new = _halves(spark, sf_dir)
    first = soinn.fit(before, "vec_id", "embedding", "label", 800)
    valid, rest = sampling.refreshed(before.where(soinn.held_out("vec_id")), new, "vec_id", "label", "transfer")
    nodes, _ = soinn.fit(rest, "vec_id", "embedding", "label", 800, trained=first, valid=valid)
    return nodes.select("node_id", "label", "class", "wins")


def _halves(spark, sf_dir):
    """All embeddings in two halves by hash, for a first and a second training."""
    rows = _labelled(spark, sf_dir)
    half = sampling.hash28(F.lit("transfer"), F.col("vec_id").cast("string")) % 2
    return rows.where(half == 0), rows.where(half == 1)


@query(
    """WITH e AS (SELECT vec_id, CASE WHEN label < 5 THEN 'normal' ELSE 'attack' END AS label, ('0x' || substr(md5('transfer:' || vec_id::VARCHAR), 1, 7))::BIGINT % 2 AS half FROM embeddings),
old AS (SELECT vec_id, row_number() OVER (ORDER BY md5('v2:' || vec_id::VARCHAR), vec_id) AS i FROM e WHERE half = 0 AND label = 'normal'),
fresh AS (SELECT vec_id, row_number() OVER (ORDER BY md5('v2:' || vec_id::VARCHAR), vec_id) AS i FROM e WHERE half = 1), n AS (SELECT count(*) // 2 AS n FROM old)
SELECT vec_id, label, 'valid' AS part FROM e WHERE half = 0 AND label <> 'normal'
UNION ALL SELECT vec_id, 'normal', 'valid' FROM old, n WHERE i <= n
UNION ALL SELECT vec_id, 'normal', CASE WHEN i <= n THEN 'valid' ELSE 'train' END FROM fresh, n"""
)
def validation_refresh(spark, sf_dir):
    """The rows that validate and train a network that goes on: attacks stay, normal rows are half renewed."""
    valid, rest = sampling.refreshed(*_halves(spark, sf_dir), "vec_id", "label", "v2")
    both = valid.withColumn("part", F.lit("valid")).unionByName(rest.withColumn("part", F.lit("train")))
    return both.select("vec_id", "label", "part")


@query()
def rff_svm(spark, sf_dir):
    rows = models.with_features(_labelled(spark, sf_dir), "embedding", models.FourierFeatures(64, 64, 10.0))
    model = models.fit_binary(rows, "label", "attack", 10)
    return metrics.weighted(model.transform(rows).withColumn("guess", F.when(F.col("p") == 1, "attack").otherwise("normal")), "label", "guess")


@query()
def cascade(spark, sf_dir):
    """Network over all rows that the classifier calls normal; the final label and its metrics."""
    rows = models.with_features(_labelled(spark, sf_dir), "embedding", models.FourierFeatures(64, 64, 10.0))
    multi = models.MultiClass().fit(rows, rows, "label", restarts=1)
    first = multi.predict(rows).select("vec_id", "embedding", "label", "ai_label")
    nodes, edges = soinn.fit(rows, "vec_id", "embedding", "label", 1000)
    second = soinn.predict(first.where("ai_label = 'normal'"), nodes, edges, "vec_id", "embedding")
    both = joins.filled_from(first, second, ["vec_id"], "ai_label", "final")
    return metrics.weighted(both, "label", "final")
