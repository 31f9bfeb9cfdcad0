"""Queries over the HTTP log: fingerprints, scans and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fernweave.functions import text as X
from fernweave.functions.net import bucket
from fernweave.functions.vectors import rounded
from fernweave.operators import aggregate, fingerprint, report, sampling
from fernweave.operators.joins import anti, with_clusters
from fernweave.plans.registry import query, read
from fernweave.sources import http_log as L

START, END = "2024-01-02 00:00:00", "2024-01-03 00:00:00"
TIME = "yyyy-MM-dd HH:mm:ss"
LIMIT = 5
EXCLUDE = {"http_agent": "Signup", "http_path": "", "http_query": r'\{"k": 7\d\}', "src_ip": r"10\.0\.1\.", "dst_ip": "192.168.1.xxx"}


def norm(text: str, blanked: str = X.TRAIN_CLASS, lower: bool = True, host_check: bool = True) -> str:
    """DuckDB text of ``functions.text.normalised``."""
    out = f"url_decode({text})"
    if lower:
        out = f"lower({out})"
    out = f"replace({out}, '{X.TRAVERSAL}', '{X.TRAVERSAL_MARK}')"
    if host_check:
        out = f"regexp_replace({out}, '{X.HOST_CHECK}', '{X.HOST_CHECK_MARK}', 'g')"
    return f"regexp_replace({out}, '{blanked}', ' ', 'g')"


def without(column: str, parts: list[str]) -> str:
    out = f"lower({column})"
    for p in parts:
        out = f"replace({out}, '{p}', '')"
    return out


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


LOG = f"log AS ({L.SQL})"
SIX = ["http_method", "http_host", "http_agent", "http_path", "http_query", "http_tenc"]
SIX_TEXT = norm(" || ' ' || ".join(SIX))
DISTINCT = "array_to_string(list_sort(list(DISTINCT {})), ' ')"


def stamped(df, *columns):
    return df.withColumns({c: F.date_format(c, TIME) for c in columns})


@query(
    f"""WITH {LOG}, noisy AS (SELECT src_ip FROM log WHERE http_retcode = '500' AND value > 90)
SELECT {stamp("time_bucket(INTERVAL 30 MINUTE, logtime)")} AS lgtime, src_ip, dst_ip, {DISTINCT.format(SIX_TEXT)} AS agnt_qry, count(*) AS n
FROM log WHERE src_ip NOT IN (SELECT src_ip FROM noisy) GROUP BY time_bucket(INTERVAL 30 MINUTE, logtime), src_ip, dst_ip"""
)
def fingerprint_30m(spark, sf_dir):
    log = L.http_log(spark, sf_dir)
    noisy = log.where("http_retcode = '500' AND value > 90")
    rows = anti(log, noisy, "src_ip").withColumn("text", fingerprint.train_text())
    out = rows.groupBy(bucket("logtime").alias("lgtime"), "src_ip", "dst_ip").agg(X.distinct_text("text").alias("agnt_qry"), F.count("*").alias("n"))
    return stamped(out, "lgtime")


def _branch(k: int) -> str:
    return f"""SELECT {k} AS slot, time_bucket(INTERVAL 30 MINUTE, logtime + INTERVAL 9 HOUR) AS b, src_ip, dst_ip, {DISTINCT.format(SIX_TEXT)} AS agnt_qry
FROM kept WHERE logtime BETWEEN TIMESTAMP '{START}' + INTERVAL {6 * k} HOUR AND TIMESTAMP '{END}' - INTERVAL {18 - 6 * k} HOUR GROUP BY ALL"""


@query(
    f"""WITH {LOG}, span AS (SELECT TIMESTAMP '{START}' AS a, TIMESTAMP '{END}' AS z),
blocked AS (SELECT src_ip FROM ({L.BLOCKED_SQL}), span WHERE logtime BETWEEN a AND z),
waf AS (SELECT src_ip FROM ({L.FIREWALL_SQL}), span WHERE logtime BETWEEN a AND z),
kept AS (SELECT * FROM log WHERE NOT (http_host = '-' AND http_agent = '-' AND http_query = '-' AND http_path = '-' AND http_server = 'BigIP')
  AND src_ip NOT IN (SELECT src_ip FROM blocked) AND src_ip NOT IN (SELECT src_ip FROM waf)),
every AS ({" UNION ALL ".join(_branch(k) for k in range(4))})
SELECT slot, {stamp("b")} AS lgtime, src_ip, dst_ip, agnt_qry, 'normal' AS label
FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY b, src_ip, dst_ip) AS rn FROM every) WHERE rn <= {LIMIT}"""
)
def fingerprint_4slot_topn(spark, sf_dir):
    others = [L.blocked(spark, sf_dir), L.firewall(spark, sf_dir)]
    return stamped(fingerprint.normal_fingerprint(L.http_log(spark, sf_dir), others, START, END, LIMIT), "lgtime")


@query(
    f"""WITH {LOG} SELECT {stamp("time_bucket(INTERVAL 30 MINUTE, logtime + INTERVAL 9 HOUR)")} AS lgtime, src_ip, dst_ip,
{DISTINCT.format(norm("http_agent || ' ' || http_query", X.COLUMNS_CLASS))} AS agnt_qry FROM log
WHERE logtime >= TIMESTAMP '{START}' - INTERVAL 9 HOUR AND logtime < TIMESTAMP '{END}' - INTERVAL 9 HOUR
GROUP BY time_bucket(INTERVAL 30 MINUTE, logtime + INTERVAL 9 HOUR), src_ip, dst_ip"""
)
def fingerprint_columns_only(spark, sf_dir):
    return stamped(fingerprint.columns_fingerprint(L.http_log(spark, sf_dir), START, END), "lgtime")


CLASS_C = "regexp_replace({}, '[.][0-9]+$', '.xxx')"
PREDICT_TEXT = norm(
    f"http_method || ' ' || http_host || ' ' || {without('http_agent', X.AGENT_NOISE)} || ' ' || {without('http_path', X.PATH_NOISE)} || ' ' || http_query || ' ' || http_tenc",
    X.PREDICT_CLASS,
)


@query(
    f"""WITH {LOG}, near AS (SELECT src_ip FROM ({L.BLOCKED_SQL}) WHERE logtime >= TIMESTAMP '{START}' - INTERVAL 15 MINUTE
  AND logtime <= TIMESTAMP '{END}' + INTERVAL 15 MINUTE AND (dev_nm LIKE '%_m_%' OR dev_nm LIKE '%_bh_%'))
SELECT {stamp("time_bucket(INTERVAL 30 MINUTE, logtime_kr)")} AS lgtime, src_ip, dst_ip, {DISTINCT.format(PREDICT_TEXT)} AS agnt_qry FROM log
WHERE logtime >= TIMESTAMP '{START}' - INTERVAL 9 HOUR AND logtime < TIMESTAMP '{END}' - INTERVAL 9 HOUR
  AND NOT regexp_matches(lower(http_agent), '{EXCLUDE["http_agent"].lower()}') AND NOT regexp_matches(lower(http_query), '{EXCLUDE["http_query"].lower()}')
  AND NOT regexp_matches(lower({CLASS_C.format("src_ip")}), '{EXCLUDE["src_ip"].lower()}')
  AND NOT (lower({CLASS_C.format("src_ip")}) = '{EXCLUDE["src_ip"].lower()}' AND lower({CLASS_C.format("dst_ip")}) = '{EXCLUDE["dst_ip"].lower()}')
  AND NOT (http_agent = '-' OR http_path = '-' OR http_server = 'BigIP') AND src_ip NOT IN (SELECT src_ip FROM near)
GROUP BY time_bucket(INTERVAL 30 MINUTE, logtime_kr), src_ip, dst_ip"""
)
def predict_fingerprint(spark, sf_dir):
    return stamped(fingerprint.predict_fingerprint(L.http_log(spark, sf_dir), L.blocked(spark, sf_dir), START, END, EXCLUDE), "lgtime")


@query(
    """SELECT c AS selectcolumn, array_to_string(list_sort(list(DISTINCT k)), '|') AS pattern FROM (SELECT CASE WHEN event_id % 3 = 0 THEN 'http_agent' ELSE 'http_query' END AS c, event_type AS k FROM events) GROUP BY c"""
)
def exception_patterns(spark, sf_dir):
    """A table of exceptions (column, keyword) as one pattern a column."""
    column = F.when(F.col("event_id") % 3 == 0, "http_agent").otherwise("http_query")
    rows = read(spark, sf_dir, "events").select(column.alias("selectcolumn"), F.col("event_type").alias("keyword"))
    return fingerprint.exclusions(rows)


@query(
    f"""SELECT lang, {DISTINCT.format(norm("host || ' ' || split_part(url, '?', 2)", lower=False, host_check=False))} AS agnt_qry, 'en' AS label
FROM (SELECT url, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS lang FROM pages) WHERE lang = 'en' GROUP BY lang"""
)
def attack_fingerprint(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("url", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.split_part("url", F.lit("/"), F.lit(4)).alias("lang"))
    return fingerprint.attack_fingerprint(pages, "en", "lang", ["lang"], "host", "url", "?", None)


@query(f"SELECT page_id, {norm('url', X.PREDICT_CLASS)} AS new_regex, split_part(url, '/', 4) AS hash FROM pages")
def corpus_scan(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", X.normalised("url", X.PREDICT_CLASS).alias("new_regex"), F.split_part("url", F.lit("/"), F.lit(4)).alias("hash"))


@query(f"WITH {LOG} SELECT event_id, src_ip, dst_ip FROM log WHERE strftime(logtime, '%Y%m%d') = '20240105' AND http_retcode <> '200'")
def version_scan(spark, sf_dir):
    return L.of_day(L.http_log(spark, sf_dir), "20240105").where("http_retcode <> '200'").select("event_id", "src_ip", "dst_ip")


@query(f"WITH {LOG} SELECT min(event_id) AS first_index, max(event_id) AS last_index FROM log")
def min_max_index(spark, sf_dir):
    return L.http_log(spark, sf_dir).agg(F.min("event_id").alias("first_index"), F.max("event_id").alias("last_index"))


@query(
    """WITH s AS (SELECT min(event_id) AS lo, max(event_id) AS hi, (max(event_id) - min(event_id) + 1) // 7 AS bat FROM events)
SELECT task::INTEGER AS task, lo + task * bat AS first, CASE WHEN task = 6 THEN hi ELSE lo + (task + 1) * bat - 1 END AS last FROM s, range(7) AS r(task)"""
)
def index_slices(spark, sf_dir):
    return sampling.slices(read(spark, sf_dir, "events"), "event_id", 7)


@query("SELECT coalesce(max(event_id), -1) + 1 AS next_id FROM events")
def next_id(spark, sf_dir):
    return sampling.next_id(read(spark, sf_dir, "events"), "event_id")


@query(f"WITH {LOG} SELECT http_method, http_retcode, count(*) AS n FROM log GROUP BY 1, 2")
def value_counts(spark, sf_dir):
    return aggregate.value_counts(L.http_log(spark, sf_dir), "http_method", "http_retcode")


@query(f"WITH {LOG} SELECT DISTINCT src_ip, dev_nm FROM log WHERE dev_nm LIKE '%_m_%' OR dev_nm LIKE '%_bh_%'")
def like_wildcard(spark, sf_dir):
    return L.http_log(spark, sf_dir).where("dev_nm LIKE '%_m_%' OR dev_nm LIKE '%_bh_%'").select("src_ip", "dev_nm").distinct()


@query(f"WITH {LOG} SELECT event_id FROM log WHERE len(regexp_extract_all(lower(http_agent), 'view|sign')) = 0 AND http_path <> '-'")
def regex_exclude(spark, sf_dir):
    log = L.http_log(spark, sf_dir)
    return log.where(~X.excluded("http_agent", "View|Sign") & ~X.excluded("http_path", "")).where("http_path <> '-'").select("event_id")


@query(f"WITH {LOG} SELECT event_id FROM log WHERE lower({CLASS_C.format('src_ip')}) = '10.0.1.xxx'")
def joined_string_in(spark, sf_dir):
    from fernweave.functions.net import class_c

    return L.http_log(spark, sf_dir).where(F.lower(class_c("src_ip")) == "10.0.1.xxx").select("event_id")


@query(f"WITH {LOG} SELECT src_ip, {DISTINCT.format('http_host')} AS hosts, list_sort(list(DISTINCT http_retcode)) AS codes FROM log GROUP BY src_ip")
def distinct_arrays(spark, sf_dir):
    log = L.http_log(spark, sf_dir)
    return log.groupBy("src_ip").agg(X.distinct_text("http_host").alias("hosts"), F.sort_array(F.collect_set("http_retcode")).alias("codes"))


@query(f"WITH {LOG}, a AS (SELECT src_ip, unnest([http_method, http_retcode]) AS x FROM log) SELECT src_ip, list_sort(list(DISTINCT x)) AS merged FROM a GROUP BY src_ip")
def distinct_array_union(spark, sf_dir):
    log = L.http_log(spark, sf_dir).withColumn("two", F.array("http_method", "http_retcode"))
    return log.groupBy("src_ip").agg(aggregate.distinct_union("two").alias("merged"))


@query(
    f"""WITH {LOG} SELECT {stamp("time_bucket(INTERVAL 30 MINUTE, logtime)")} AS lgtime, src_ip, count(DISTINCT dst_port) AS dst_port_cnt,
{", ".join(f"round(avg(CASE WHEN contains(http_retcode, '{p}') THEN 1.0 ELSE 0.0 END), 6) AS {n}" for n, p in [("info_st", "10"), ("succ_st", "20"), ("redir_st", "30"), ("cler_st", "40"), ("serer_st", "50")])},
round(avg(CASE WHEN http_retcode = '-' THEN 1.0 ELSE 0.0 END), 6) AS oth_st FROM log GROUP BY time_bucket(INTERVAL 30 MINUTE, logtime), src_ip"""
)
def scan_status_ratios(spark, sf_dir):
    out = aggregate.status_ratios(L.http_log(spark, sf_dir), [bucket("logtime").alias("lgtime"), "src_ip"], "http_retcode")
    return stamped(out, "lgtime").withColumns({c: rounded(F.col(c), 6) for c in out.columns if c.endswith("_st")})


# Explanations for the report: every source's first buckets, with terms that occur as substrings and some that do not.
XAI = f"""xai AS (SELECT DISTINCT CASE WHEN http_retcode = '500' THEN 'attack' WHEN http_retcode = '404' THEN 'normal' ELSE 'anomaly' END AS ai_label,
time_bucket(INTERVAL 30 MINUTE, logtime + INTERVAL 9 HOUR) AS lgtime, src_ip, dst_ip FROM log)"""
FEATURES, SCORES = ["crawler", "phpx", "index", "post", "", "pathsearcherdetected"], [0.5, 0.25, 0.0, 0.125, 0.7, 0.3]


def xai_rows(spark, sf_dir):
    log = L.http_log(spark, sf_dir)
    label = F.when(F.col("http_retcode") == "500", "attack").when(F.col("http_retcode") == "404", "normal").otherwise("anomaly")
    keys = log.select(label.alias("ai_label"), bucket(F.col("logtime") + F.expr("INTERVAL 9 HOURS")).alias("lgtime"), "src_ip", "dst_ip").distinct()
    return keys.withColumns({"feature": F.array(*[F.lit(f) for f in FEATURES]), "score": F.array(*[F.lit(s) for s in SCORES])})


@query(
    f"""WITH {LOG}, {XAI}, term AS (SELECT ai_label, lgtime, src_ip, dst_ip, f FROM xai, (SELECT unnest({FEATURES}) AS f, unnest({SCORES}) AS s) WHERE ai_label <> 'normal' AND s <> 0 AND f <> ''),
raw AS (SELECT time_bucket(INTERVAL 30 MINUTE, logtime + INTERVAL 9 HOUR) AS lgtime, *, {SIX_TEXT} AS str_prep FROM log),
hit AS (SELECT t.ai_label, t.f, r.* FROM raw r JOIN term t USING (lgtime, src_ip, dst_ip) WHERE instr(r.str_prep, t.f) > 0 AND lgtime >= TIMESTAMP '{START}' AND lgtime < TIMESTAMP '{END}')
SELECT ai_label, {stamp("lgtime")} AS time_group, src_ip, dst_ip,
{", ".join(f"{DISTINCT.format(f'{c}::VARCHAR')} AS {c}" for c in report.RAW if c != "logtime_kr")},
list_sort(list(DISTINCT f)) AS keyword, count(DISTINCT logtime_kr) AS n_rows FROM hit GROUP BY ai_label, lgtime, src_ip, dst_ip"""
)
def report_keywords(spark, sf_dir):
    out = report.report(L.http_log(spark, sf_dir), xai_rows(spark, sf_dir), fingerprint.ts(START), fingerprint.ts(END))
    times = F.size(F.filter(F.split("logtime_kr", " "), lambda x: F.contains(x, F.lit("-"))))
    return stamped(out, "time_group").withColumn("n_rows", times.cast("long")).drop("logtime_kr")


@query(
    f"""WITH {LOG}, {XAI}, first AS (SELECT * FROM xai WHERE ai_label <> 'anomaly'), second AS (SELECT * FROM xai WHERE ai_label <> 'attack'),
found AS (SELECT DISTINCT lgtime, src_ip, dst_ip, ai_label FROM first WHERE ai_label <> 'normal' UNION SELECT lgtime, src_ip, dst_ip, upper(ai_label) FROM second WHERE ai_label <> 'normal')
SELECT f.ai_label, event_id, r.src_ip, r.dst_ip, http_path FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, logtime + INTERVAL 9 HOUR) AS lgtime FROM log) r
JOIN found f USING (lgtime, src_ip, dst_ip) WHERE lgtime = (SELECT min(lgtime) FROM first) AND NOT (http_agent = '-' OR http_path = '-')"""
)
def result_table_join(spark, sf_dir):
    xai = xai_rows(spark, sf_dir)
    out = report.result_table(L.http_log(spark, sf_dir), xai.where("ai_label <> 'anomaly'"), xai.where("ai_label <> 'attack'"))
    return out.select("ai_label", "event_id", "src_ip", "dst_ip", "http_path")


@query(f"WITH {LOG}, {XAI} SELECT DISTINCT ai_label, {stamp('lgtime')} AS lgtime, src_ip, dst_ip FROM xai WHERE ai_label <> 'normal' AND lgtime >= TIMESTAMP '{START}' AND lgtime < TIMESTAMP '{END}'")
def attack_results(spark, sf_dir):
    """Detections of one day."""
    day = (F.col("lgtime") >= fingerprint.ts(START)) & (F.col("lgtime") < fingerprint.ts(END))
    return stamped(xai_rows(spark, sf_dir).where((F.col("ai_label") != "normal") & day).select("ai_label", "lgtime", "src_ip", "dst_ip"), "lgtime")


@query(
    f"""WITH {LOG}, x AS (SELECT *, regexp_extract(http_agent, 'Agent/([a-z]+)', 1) AS event_type FROM log)
SELECT event_id, src_ip, dst_ip, http_path, CASE event_type WHEN 'error' THEN 'anomaly' WHEN 'view' THEN 'normal' ELSE event_type END AS esoinn_label FROM x WHERE event_type NOT IN ('error', 'view')"""
)
def cluster_labels_to_raw(spark, sf_dir):
    """Raw rows that clustering gave a class, for a second model."""
    log = L.http_log(spark, sf_dir)
    kind = F.regexp_extract("http_agent", "Agent/([a-z]+)", 1)
    found = log.select("event_id", "src_ip", "dst_ip", F.when(kind == "error", "anomaly").when(kind == "view", "normal").otherwise(kind).alias("ai_label"))
    return with_clusters(log, found, ["event_id", "src_ip", "dst_ip"]).select("event_id", "src_ip", "dst_ip", "http_path", "esoinn_label")


SEVERITY = [("click", 2.0), ("error", 9.0), ("view", 1.0), ("signup", 4.0)]


@query(
    f"""WITH {LOG}, d AS (SELECT src_ip, event_type AS ai_label FROM (SELECT *, regexp_extract(http_agent, 'Agent/([a-z]+)', 1) AS event_type FROM log) WHERE event_type <> ''),
a AS (SELECT src_ip, count(*)::DOUBLE AS n FROM d WHERE ai_label <> 'NORMAL' GROUP BY 1), t AS (SELECT src_ip, count(DISTINCT ai_label)::DOUBLE AS n FROM d GROUP BY 1),
m AS (SELECT src_ip, count(*)::DOUBLE AS n FROM d WHERE ai_label = 'error' GROUP BY 1), s(ai_label, score) AS (VALUES {", ".join(map(str, SEVERITY))}),
z AS (SELECT ai_label, (score - (SELECT min(score) FROM s)) / ((SELECT max(score) FROM s) - (SELECT min(score) FROM s)) AS scl FROM s),
r AS (SELECT DISTINCT d.src_ip, d.ai_label, coalesce(least(1.0, a.n / (SELECT avg(n) FROM a)), 0) + coalesce(least(1.0, t.n / (SELECT avg(n) FROM t)), 0)
  + coalesce(least(1.0, m.n / (SELECT avg(n) FROM m)), 0) + scl AS total
  FROM d JOIN z USING (ai_label) LEFT JOIN a USING (src_ip) LEFT JOIN t USING (src_ip) LEFT JOIN m USING (src_ip))
SELECT src_ip, ai_label, round(total, 6) AS sum_score, round((-0.0625 * total * total + 0.5 * total) * 100, 6) AS threat_score FROM r"""
)
def threat_score(spark, sf_dir):
    label = F.regexp_extract("http_agent", "Agent/([a-z]+)", 1)
    rows = L.http_log(spark, sf_dir).select("src_ip", label.alias("ai_label")).where("ai_label <> ''")
    severity = spark.createDataFrame(SEVERITY, "ai_label string, score double")
    out = report.threat_scores(rows, rows.where("ai_label = 'error'"), severity)
    return out.withColumns({c: rounded(F.col(c), 6) for c in ("sum_score", "threat_score")})
