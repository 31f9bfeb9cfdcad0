"""Queries of scalar functions, joins, unions, samples and tops."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fernweave.functions import net, vectors
from fernweave.functions import text as X
from fernweave.functions.vectors import rounded
from fernweave.operators import aggregate, joins, report, rules, sampling
from fernweave.plans.registry import query, read
from fernweave.sources import bucketed, store

NETWORKS = ["10.0.0.0/26", "10.0.0.16/28", "10.0.2.0/24", "192.168.1.1/32"]
NETWORK_ROWS = "(VALUES {}) AS n(low, high)".format(", ".join(f"({lo}, {hi})" for lo, hi in [(167772160, 167772223), (167772176, 167772191), (167772672, 167772927), (3232235777, 3232235777)]))


@query(
    """SELECT page_id, lower(url) AS lowered, upper(split_part(url, '/', 4)) AS lang, replace(url, '//', '/') AS replaced,
regexp_replace(url, '[0-9]+', '#', 'g') AS hashed, split_part(url, '.html', 2) AS after_html, len(regexp_extract_all(url, '[0-9]+')) AS n_numbers,
regexp_extract(url, '[0-9]+', 0) AS first_number, instr(url, 'example') AS at, page_id::VARCHAR || ', ' || url AS joined, trim('  ' || url || ' ') AS trimmed,
regexp_replace(url, '[!-/:-@\\[-`{-~]', '', 'g') AS bare, replace('a\\b' || page_id::VARCHAR, '\\', '/') AS slashed FROM pages""".replace("\\\\", "\\")
)
def scalar_string(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id",
        F.lower(url).alias("lowered"),
        F.upper(F.split_part(url, F.lit("/"), F.lit(4))).alias("lang"),
        F.replace(url, F.lit("//"), F.lit("/")).alias("replaced"),
        F.regexp_replace(url, "[0-9]+", "#").alias("hashed"),
        X.after(url, ".html").alias("after_html"),
        F.size(F.regexp_extract_all(url, F.lit("[0-9]+"), 0)).alias("n_numbers"),
        F.regexp_extract(url, "[0-9]+", 0).alias("first_number"),
        F.instr(url, "example").alias("at"),
        F.concat(F.col("page_id").cast("string"), F.lit(", "), url).alias("joined"),
        F.trim(F.concat(F.lit("  "), url, F.lit(" "))).alias("trimmed"),
        X.unpunctuated(url).alias("bare"),
        X.slashed(F.concat(F.lit("a\\b"), F.col("page_id").cast("string"))).alias("slashed"),
    )


@query("""SELECT event_id, url_decode(replace(props, ' ', '+') || '%2Fx%zz' || '%41' || '100%') AS decoded FROM events""")
def scalar_url_decode(spark, sf_dir):
    text = F.concat(F.replace("props", F.lit(" "), F.lit("+")), F.lit("%2Fx%zz%41100%"))
    return read(spark, sf_dir, "events").select("event_id", X.url_decoded(text).alias("decoded"))


IP = "'10.0.' || (user_id // 64)::VARCHAR || '.' || (user_id % 64)::VARCHAR"


@query(f"SELECT DISTINCT user_id, 167772160 + (user_id // 64) * 256 + user_id % 64 AS number, regexp_replace({IP}, '[.][0-9]+$', '.xxx') AS class_c FROM events")
def scalar_ip(spark, sf_dir):
    ip = F.expr("concat('10.0.', cast(user_id DIV 64 AS string), '.', cast(user_id % 64 AS string))")
    return read(spark, sf_dir, "events").select("user_id", net.ip_number(ip).alias("number"), net.class_c(ip).alias("class_c")).distinct()


FORMAT = "'%Y-%m-%d %H:%M:%S'"


@query(
    f"""SELECT event_id, strftime(time_bucket(INTERVAL 30 MINUTE, ts), {FORMAT}) AS bucket, strftime(ts + INTERVAL 9 HOUR, {FORMAT}) AS local,
strftime(ts - INTERVAL 15 MINUTE, {FORMAT}) AS grace, strftime(date_trunc('day', ts), {FORMAT}) AS day, strftime(ts, '%Y%m%d%H%M%S') AS version,
ts >= TIMESTAMP '2024-01-10' AS late FROM events"""
)
def scalar_time(spark, sf_dir):
    out = read(spark, sf_dir, "events")
    at, fmt = F.col("ts"), "yyyy-MM-dd HH:mm:ss"
    return out.select(
        "event_id",
        F.date_format(net.bucket(at), fmt).alias("bucket"),
        F.date_format(at + F.expr("INTERVAL 9 HOURS"), fmt).alias("local"),
        F.date_format(at - F.expr("INTERVAL 15 MINUTES"), fmt).alias("grace"),
        F.date_format(F.date_trunc("day", at), fmt).alias("day"),
        F.date_format(at, "yyyyMMddHHmmss").alias("version"),
        (at >= F.expr("TIMESTAMP_NTZ '2024-01-10'")).alias("late"),
    )


@query(
    """SELECT vec_id, embedding[1]::DOUBLE AS head, len(list_filter(embedding, lambda x: x > 2)) = 0 AS no_large,
'l' || (list_position(embedding[1:4], list_max(embedding[1:4])) - 1)::VARCHAR AS argmax,
round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS sum_sq, round(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS max_abs,
round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm FROM embeddings"""
)
def scalar_array(spark, sf_dir):
    v = F.transform("embedding", lambda x: x.cast("double"))
    zero = F.transform("embedding", lambda _: F.lit(0.0))
    return read(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.get(v, 0).alias("head"),
        (F.size(F.filter(v, lambda x: x > 2)) == 0).alias("no_large"),
        vectors.argmax_label(F.slice("embedding", 1, 4), ["l0", "l1", "l2", "l3"]).alias("argmax"),
        rounded(vectors.squared_distance("embedding", zero), 6).alias("sum_sq"),
        rounded(F.array_max(F.transform(v, lambda x: F.abs(x))), 6).alias("max_abs"),
        rounded(F.sqrt(vectors.squared_distance("embedding", zero)), 6).alias("norm"),
    )


@query("SELECT l_orderkey, l_linenumber, o_custkey, o_orderpriority, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate WHERE o_orderstatus = 'O'")
def join_inner_multikey(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'O'")
    li = read(spark, sf_dir, "lineitem")
    return li.join(o, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate"))).select("l_orderkey", "l_linenumber", "o_custkey", "o_orderpriority", "l_quantity")


@query(
    """SELECT n.k1, n.k2, n.num, c.cat, s.str FROM (SELECT l_orderkey AS k1, l_linenumber AS k2, l_quantity AS num FROM lineitem) n
JOIN (SELECT l_orderkey AS k1, l_linenumber AS k2, l_returnflag AS cat FROM lineitem WHERE l_discount > 0.02) c USING (k1, k2)
JOIN (SELECT l_orderkey AS k1, l_linenumber AS k2, l_linestatus AS str FROM lineitem WHERE l_tax > 0.02) s USING (k1, k2)"""
)
def join_three_frames(spark, sf_dir):
    """Number, category and string features, stored as bucketed tables and joined from these without an exchange."""
    return bucketed.joined(spark, three_tables(spark, sf_dir))


def three_tables(spark, sf_dir) -> list[str]:
    """The names of the three stored tables, new for each call."""
    li = read(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "k1", "l_linenumber": "k2"})
    frames = {
        "number": li.select("k1", "k2", F.col("l_quantity").alias("num")),
        "category": li.where("l_discount > 0.02").select("k1", "k2", F.col("l_returnflag").alias("cat")),
        "string": li.where("l_tax > 0.02").select("k1", "k2", F.col("l_linestatus").alias("str")),
    }
    run = uuid.uuid4().hex
    for kind, frame in frames.items():
        bucketed.save(frame, f"prep_{kind}_{run}", ["k1", "k2"])
    return [f"prep_{kind}_{run}" for kind in frames]


@query("SELECT doc_id, lang, coalesce(l.label, d.source) AS label FROM (SELECT doc_id, lang, source FROM documents) d LEFT JOIN (SELECT doc_id, 'q' || quality::VARCHAR AS label FROM labels) l USING (doc_id)")
def join_left_coalesce(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("label"))
    own = read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("label"))
    return joins.filled_from(docs, own, ["doc_id"], "label", "label")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def join_anti(spark, sf_dir):
    big = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.anti(read(spark, sf_dir, "customer").select("c_custkey"), big, "c_custkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def join_semi(spark, sf_dir):
    big = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(read(spark, sf_dir, "customer").select("c_custkey"), big, "c_custkey")


@query(
    """SELECT coalesce(a.nk, b.nk) AS nk, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM (SELECT c_nationkey AS nk, count(*) AS customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1) a
FULL JOIN (SELECT s_nationkey AS nk, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) b ON a.nk = b.nk"""
)
def join_full_outer(spark, sf_dir):
    a = read(spark, sf_dir, "customer").where("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("nk")).agg(F.count("*").alias("customers"))
    b = read(spark, sf_dir, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nk")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "nk", "full").fillna(0)


@query(
    f"""SELECT event_id, strftime(strptime(strftime(ts, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS at, round(value)::BIGINT AS whole, user_id::VARCHAR AS user_text,
TRY_CAST(props AS DOUBLE) AS none FROM events"""
)
def dtype_conversion(spark, sf_dir):
    at = F.to_timestamp(F.date_format("ts", "yyyyMMddHHmmss"), "yyyyMMddHHmmss")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.round("value").cast("bigint").alias("whole"),
        F.col("user_id").cast("string").alias("user_text"),
        F.col("props").try_cast("double").alias("none"),
    )


@query(
    f"""WITH e AS (SELECT event_id, 167772160 + (user_id // 64) * 256 + user_id % 64 AS src, 3232235520 + (event_id % 2) * 256 + event_id % 8 AS dst FROM events)
SELECT event_id, CASE WHEN EXISTS (SELECT 1 FROM {NETWORK_ROWS} WHERE src BETWEEN low AND high) THEN 1 ELSE 0 END AS src_ip_flag,
CASE WHEN EXISTS (SELECT 1 FROM {NETWORK_ROWS} WHERE dst BETWEEN low AND high) THEN 1 ELSE 0 END AS dst_ip_flag FROM e"""
)
def join_cidr_flag(spark, sf_dir):
    from fernweave.sources.http_log import http_log

    log = http_log(spark, sf_dir).select("event_id", "src_ip", "dst_ip")
    return joins.network_flags(log, net.network_ranges(spark.createDataFrame([(n,) for n in NETWORKS], "network string")), ["src_ip", "dst_ip"]).drop("src_ip", "dst_ip")


@query(
    """SELECT doc_id, term FROM (SELECT doc_id, lang, lower(text) AS t FROM documents) d JOIN (VALUES ('en', 'thing'), ('en', ''), ('de', 'einen'), ('fr', 'é'), ('en', 'edit')) AS w(lang, term)
USING (lang) WHERE term <> '' AND instr(t, term) > 0"""
)
def join_substring(spark, sf_dir):
    words = spark.createDataFrame([("en", "thing"), ("en", ""), ("de", "einen"), ("fr", "é"), ("en", "edit")], "lang string, term string")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", F.lower("text").alias("t"))
    return joins.substring_join(docs, words, ["lang"], "t", "term").select("doc_id", "term")


@query("SELECT doc_id, lang || ', ' || source AS map, quality FROM documents JOIN labels USING (doc_id) WHERE lang || ', ' || source = 'en, src1' OR quality = 0")
def join_using_key(spark, sf_dir):
    both = joins.inner(["doc_id"], read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return both.select("doc_id", F.concat_ws(", ", "lang", "source").alias("map"), "quality").where("map = 'en, src1' OR quality = 0")


@query("SELECT 'c' AS kind, c_custkey AS id FROM customer UNION ALL SELECT 's', s_suppkey FROM supplier UNION ALL SELECT 'c', c_custkey FROM customer WHERE c_acctbal < 0")
def union_all(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    a = c.select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id"))
    b = read(spark, sf_dir, "supplier").select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b).unionByName(c.where("c_acctbal < 0").select(F.lit("c").alias("kind"), F.col("c_custkey").alias("id")))


@query("SELECT c_custkey AS id, c_mktsegment AS seg, NULL::VARCHAR AS name FROM customer UNION ALL SELECT s_suppkey, NULL, s_name FROM supplier")
def union_by_name(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


WORDS = r"unnest(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}'))"


@query(f"SELECT DISTINCT w FROM (SELECT {WORDS.format('text')} AS w FROM benchmark) EXCEPT SELECT w FROM (SELECT {WORDS.format('text')} AS w FROM conversations WHERE turn = 0)")
def vocab_except(spark, sf_dir):
    words = lambda df: df.select(F.explode(X.tokens("text")).alias("w"))
    return words(read(spark, sf_dir, "benchmark")).distinct().join(words(read(spark, sf_dir, "conversations").where("turn = 0")).distinct(), "w", "left_anti")


@query("SELECT doc_id, list_concat([lang, source], ['en', 'x']) AS both, list_sort(list_filter([lang, source], lambda x: x <> 'en')) AS less FROM documents")
def list_operations(spark, sf_dir):
    two = F.array("lang", "source")
    return read(spark, sf_dir, "documents").select("doc_id", F.concat(two, F.array(F.lit("en"), F.lit("x"))).alias("both"), F.sort_array(F.array_except(two, F.array(F.lit("en")))).alias("less"))


@query("SELECT doc_id, lang AS language, 'v1' AS version, n_chars FROM documents WHERE n_chars BETWEEN 100 AND 900 AND lang IN ('en', 'de') AND NOT (source = 'src0' OR source LIKE '%9')")
def projection(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").where("n_chars BETWEEN 100 AND 900 AND lang IN ('en', 'de') AND NOT (source = 'src0' OR source LIKE '%9')")
    return docs.drop("text").withColumnRenamed("lang", "language").withColumn("version", F.lit("v1")).select("doc_id", "language", "version", "n_chars")


@query("SELECT DISTINCT lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def distinct_rows(spark, sf_dir):
    toxic = read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return joins.semi(read(spark, sf_dir, "documents"), toxic, "doc_id").select("lang", "source").distinct()


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS index FROM documents")
def row_index(spark, sf_dir):
    return sampling.numbered(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


HASH28 = "('0x' || substr(md5({}), 1, 7))::BIGINT"


@query(
    f"""WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)
SELECT draw, doc_id FROM (SELECT r AS draw, {HASH28.format("'s1:' || r::VARCHAR")} % (SELECT count(*) FROM d) AS i FROM range(1500) AS t(r)) JOIN d USING (i)"""
)
def bootstrap_exact_n(spark, sf_dir):
    n = sampling.attack_sample_size("SQL_Injection", 1000)
    return sampling.bootstrap(read(spark, sf_dir, "documents"), "doc_id", n, "s1")


@query(
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('7:' || doc_id::VARCHAR), doc_id) <= floor((SELECT count(*) FROM documents) * 0.95) THEN 'train' ELSE 'test' END AS part FROM documents"""
)
def split_ratio(spark, sf_dir):
    return sampling.split(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.95, "7")


@query("SELECT lang, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 7")
def top_per_group(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("lang", "doc_id", "n_chars")
    return sampling.first_per_group(docs, ["lang"], [F.desc("n_chars"), F.col("doc_id")], 7)


PAIR = "(SELECT vec_id, i - 1 AS pos, 'f' || (i - 1)::VARCHAR AS term, round(embedding[i]::DOUBLE, 2) + 0.0 AS score FROM embeddings, range(1, 65) AS r(i))"


def _scored(spark, sf_dir):
    names = F.array(*[F.lit(f"f{i}") for i in range(64)])
    return read(spark, sf_dir, "embeddings").select("vec_id", names.alias("feature"), F.transform("embedding", lambda x: rounded(x.cast("double"), 2) + 0.0).alias("score"))


@query(f"SELECT vec_id, rank, term, score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, pos)::INTEGER AS rank FROM {PAIR}) WHERE rank <= 3")
def xai_top_terms(spark, sf_dir):
    return report.top_terms(_scored(spark, sf_dir), ["vec_id"], 3)


@query(f"SELECT vec_id, list(term ORDER BY score, pos) AS terms FROM {PAIR} GROUP BY vec_id")
def xai_ascending(spark, sf_dir):
    return _scored(spark, sf_dir).select("vec_id", F.transform(vectors.by_score("feature", "score", False), lambda x: x["term"]).alias("terms"))


@query(f"SELECT term AS feature, round(avg(score), 6) AS diff, row_number() OVER (ORDER BY avg(score) DESC, term DESC)::INTEGER AS rank FROM {PAIR} GROUP BY term")
def mean_per_feature(spark, sf_dir):
    from pyspark.sql import Window

    rows = _scored(spark, sf_dir).select(F.explode(vectors.pairs("feature", "score")).alias("p")).groupBy(F.col("p.term").alias("feature")).agg(F.avg("p.score").alias("m"))
    return rows.select("feature", rounded(F.col("m"), 6).alias("diff"), F.row_number().over(Window.orderBy(F.desc("m"), F.desc("feature"))).alias("rank"))


@query(
    """SELECT o_orderpriority, o_orderstatus, n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, o_orderstatus) AS r
FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE r = 1"""
)
def argmax_pair_map(spark, sf_dir):
    return aggregate.most_frequent_pair(read(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


@query("SELECT o_custkey, o_orderstatus AS mode FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderstatus) AS r FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE r = 1")
def mode_label(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(aggregate.mode_label("o_orderstatus").alias("mode"))


RULE = "and((position(http_query, 'union|select') != 0) or (position(http_path, 'etc') > 0))"


@query("""SELECT unnest(['and (position(http_query, ''union'') != 0)', 'and (position(http_query, ''select'') != 0)', 'and (position(http_path, ''etc'') > 0)']) AS predicate""")
def rule_split(spark, sf_dir):
    return spark.createDataFrame([(p,) for p in rules.split_rule(RULE)], "predicate string")


@query(
    """SELECT model_id, json_extract_string(c, '$.version') AS version, json_extract_string(c, '$.rate') AS rate FROM (SELECT n_nationkey::BIGINT AS model_id,
CASE WHEN n_nationkey = 3 THEN '{"version": "20240101", "rate": "2"}' ELSE '{"version": "' || n_name || '", "rate": "' || n_regionkey::VARCHAR || '"}' END AS c FROM nation)"""
)
def json_config_update(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("model_id"), F.to_json(F.struct(F.col("n_name").alias("version"), F.col("n_regionkey").cast("string").alias("rate"))).alias("config")
    )
    new = store.update_config(rows, 3, {"version": "20240101", "rate": "2"})
    return new.select("model_id", F.get_json_object("config", "$.version").alias("version"), F.get_json_object("config", "$.rate").alias("rate"))


@query("""SELECT unnest(['region', 'customer']) AS tbl, unnest(['r_name', 'c_mktsegment,c_name']) AS columns""")
def schema_scan(spark, sf_dir):
    rows = [(t, ",".join(sorted(store.string_columns(read(spark, sf_dir, t))))) for t in ("region", "customer")]
    return spark.createDataFrame(rows, "tbl string, columns string")
