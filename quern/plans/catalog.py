"""The operators as queries over the given tables, each with the SQL that it equals where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import dates, politeness, text, urls
from quern.operators import answers, buckets, chunks, consolidate, dedup, freshness, summary, validate
from quern.operators.resolve import SEED, resolve
from quern.plans import bulk, export, signals
from quern.sources import feeds, markup, robots
from quern.streaming import signals as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Addresses ---------------------------------------------------------------------------------------------------------

#: Variants of the pages' addresses, so that all rules are met. The same text in Spark and DuckDB.
VARIED = r"""CASE page_id % 5
    WHEN 1 THEN regexp_replace(url, '^https://([^/]+)/', 'HTTPS://WWW.\1:443//')
    WHEN 2 THEN concat('  ', url, '  ')
    WHEN 3 THEN regexp_replace(url, '^https://([^/?#]+)', 'http://\1:80')
    WHEN 4 THEN concat(split_part(split_part(url, '#', 1), '?', 1), '/?b=2&a=1&UTM_Medium=x&gclid=&from=feed#f')
    ELSE url END"""


def _canonical_sql(column: str, keys: tuple[str, ...]) -> str:
    """The canonical form of a column t of trimmed addresses that need no percent-coding."""
    listed = ", ".join(f"'{k}'" for k in sorted(set(keys)))
    scheme = f"lower(regexp_extract({column}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    rest = f"regexp_replace({column}, '^[A-Za-z][A-Za-z0-9+.-]*:', '')"
    host = f"regexp_replace(lower(regexp_extract({rest}, '^//([^/?#]*)', 1)), CASE WHEN {scheme} = 'http' THEN ':80$' ELSE ':443$' END, '')"
    path = f"regexp_replace(regexp_replace(regexp_extract({rest}, '^(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''), '/+', '/', 'g')"
    path = f"CASE WHEN {path} = '' THEN '/' WHEN length({path}) > 1 THEN regexp_replace({path}, '/$', '') ELSE {path} END"
    asked = f"regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1)"
    kept = f"list_sort(list_filter(string_split({asked}, '&'), lambda p: regexp_matches(p, '=.') AND NOT list_contains([{listed}], lower(split_part(p, '=', 1)))))"
    return f"concat({scheme}, '://', {host}, {path}, CASE WHEN len({kept}) > 0 THEN concat('?', array_to_string({kept}, '&')) ELSE '' END)"


def _varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.expr(VARIED.replace("\\1", "$1")).alias("raw"))


_PLAIN, _SIGNAL = _canonical_sql("t", urls.TRACKING_KEYS), _canonical_sql("t", urls.SIGNAL_KEYS)
_VARIED_SQL = f"SELECT page_id, trim({VARIED}) AS t FROM pages"


@query(f"SELECT page_id, {_PLAIN} AS canonical, {_SIGNAL} AS signal, sha256({_PLAIN}) AS url_hash FROM ({_VARIED_SQL})")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    canonical = urls.canonical_url(F.col("raw"))
    return _varied(spark, sf_dir).select("page_id", canonical.alias("canonical"), urls.signal_url(F.col("raw")).alias("signal"), urls.url_hash(canonical).alias("url_hash"))


@query(f"SELECT min(page_id) AS page_id, canonical FROM (SELECT page_id, {_SIGNAL} AS canonical FROM ({_VARIED_SQL})) GROUP BY canonical")
def page_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _varied(spark, sf_dir).select("page_id", urls.signal_url(F.col("raw")).alias("canonical"))
    return dedup.keep_first(df, "canonical", ["page_id"])


@query(
    r"""SELECT domain, count(*) AS n FROM (
        SELECT regexp_replace(split_part(regexp_extract(lower(url), '^https?://([^/?#]*)', 1), ':', 1), '^www\.', '') AS domain FROM pages
    ) GROUP BY domain"""
)
def host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(urls.domain(F.col("url")).alias("domain")).groupBy("domain").agg(F.count("*").alias("n"))


@query(r"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) ELSE 'default' END AS pacing_key,
    CASE WHEN page_id % 2 = 0 THEN concat('Org_', page_id, '/repo.', page_id % 7) END AS slug FROM pages""")
def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pacing keys and repository slugs, the latter of addresses made of the page's number."""
    df = table(spark, sf_dir, "pages").select("page_id", "url", F.expr("concat('see https://github.com/', CASE WHEN page_id % 2 = 0 THEN concat('Org_', page_id) ELSE 'Topics' END, '/repo.', page_id % 7, CASE WHEN page_id % 4 = 0 THEN '.git' ELSE '' END, '?tab=x')").alias("repo"))
    key = urls.pacing_key(F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.lit("no address")))
    return df.select("page_id", key.alias("pacing_key"), urls.repository_slug(F.col("repo")).alias("slug"))


# --- Copies and stores -----------------------------------------------------------------------------------------------

@query("SELECT min(doc_id) AS doc_id, sha256(coalesce(text, '')) AS text_hash FROM documents GROUP BY sha256(coalesce(text, ''))")
def doc_dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    return dedup.keep_first(df, "text_hash", ["doc_id"])


@query(
    """WITH d AS (SELECT doc_id, source, sha256(coalesce(text, '')) AS h FROM documents)
    SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, h AS content_hash FROM d
    WHERE doc_id % 2 = 1 AND h NOT IN (SELECT h FROM d WHERE doc_id % 2 = 0) GROUP BY h"""
)
def insert_if_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"))
    return dedup.insert_if_new(df.where("doc_id % 2 = 1"), df.where("doc_id % 2 = 0"), "content_hash", ["doc_id"])


@query("SELECT a.doc_id FROM documents a WHERE a.doc_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM documents b WHERE b.doc_id % 2 = 0 AND b.source = a.source AND b.text = a.text)")
def changed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup.change_only(df.where("doc_id % 2 = 1"), df.where("doc_id % 2 = 0"), "source", "text").select("doc_id")


_RECORDS = """SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'STARTUP' WHEN 1 THEN 'PRODUCT' ELSE 'RESEARCH_PAPER' END AS kind, concat(' ', p_name, ' ') AS name, p_brand AS source_name,
    concat('https://www.example.org/', p_size, '/') AS source_url,
    CASE p_partkey % 7 WHEN 0 THEN 'free trial' WHEN 1 THEN 'Open Source' WHEN 2 THEN 'ask for a quote' WHEN 3 THEN '$5' WHEN 4 THEN 'unclear' WHEN 5 THEN NULL ELSE 'subscription' END AS pricing,
    CASE p_partkey % 5 WHEN 0 THEN '12' WHEN 1 THEN '-3' WHEN 2 THEN '12.5' WHEN 3 THEN '' ELSE NULL END AS employees,
    CASE p_partkey % 4 WHEN 0 THEN concat('https://github.com/o/r', p_size, '.git/') WHEN 1 THEN 'https://GitHub.com/o/r' ELSE NULL END AS repository, CAST(p_size - 3 AS BIGINT) AS stars FROM part"""
_PRICED = """CASE WHEN contains(upper(pricing), 'FREE TRIAL') OR contains(upper(pricing), 'FREEMIUM') THEN 'FREEMIUM' WHEN contains(upper(pricing), 'FREE') OR contains(upper(pricing), 'OPEN SOURCE') THEN 'FREE'
    WHEN contains(upper(pricing), 'ENTERPRISE') OR contains(upper(pricing), 'CUSTOM') OR contains(upper(pricing), 'QUOTE') THEN 'ENTERPRISE'
    WHEN contains(upper(pricing), 'PAID') OR contains(upper(pricing), 'COMMERCIAL') OR contains(upper(pricing), 'SUBSCRIPTION') OR contains(pricing, '$') THEN 'PAID' END"""
_ERRORS = f"CASE WHEN kind = 'PRODUCT' AND {_PRICED} IS NULL THEN 'pricingModel: unknown' WHEN kind = 'RESEARCH_PAPER' AND stars < 0 THEN 'github_stars: below 0' ELSE '' END"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("quern_part")
    return spark.sql(_RECORDS.replace("FROM part", "FROM quern_part"))


@query(
    f"""SELECT id, kind, {_ERRORS} AS errors, CASE WHEN {_ERRORS} = '' THEN {_PRICED} END AS pricing, CASE WHEN {_ERRORS} = '' AND employees = '12' THEN 12 END AS employees,
    CASE WHEN {_ERRORS} = '' AND id % 4 = 0 THEN regexp_replace(repository, '\\.git/$', '') END AS repository FROM ({_RECORDS})"""
)
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = validate.validated(_records(spark, sf_dir))
    ok = good.select("id", "kind", F.lit("").alias("errors"), "pricing", "employees", "repository")
    no = bad.select("id", "kind", F.concat_ws("; ", "errors").alias("errors"), F.lit(None).cast("string").alias("pricing"), F.lit(None).cast("bigint").alias("employees"), F.lit(None).cast("string").alias("repository"))
    return ok.union(no)


@query(
    f"""SELECT id, sha256(CASE kind WHEN 'STARTUP' THEN concat('STARTUP:', lower(trim(name)), ':', u) WHEN 'PRODUCT' THEN concat('PRODUCT:', lower(trim(name)), ':', coalesce(pricing, ''), ':', u)
        ELSE concat('PAPER:', lower(trim(name)), ':', u) END) AS content_hash FROM (SELECT *, regexp_replace(source_url, '/$', '') AS u FROM ({_RECORDS}))"""
)
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("id", dedup.record_hash(F.col("kind"), F.col("name"), F.col("source_url"), F.col("pricing")).alias("content_hash"))


@query(
    f"""WITH v AS (SELECT *, {_PRICED} AS p, regexp_replace(source_url, '/$', '') AS u FROM ({_RECORDS}) WHERE {_ERRORS} = ''),
    h AS (SELECT *, CASE kind WHEN 'STARTUP' THEN concat('STARTUP:', lower(trim(name)), ':', u) WHEN 'PRODUCT' THEN concat('PRODUCT:', lower(trim(name)), ':', p, ':', u) ELSE concat('PAPER:', lower(trim(name)), ':', u) END AS t FROM v)
    SELECT kind, count(DISTINCT t) AS n FROM h WHERE t NOT IN (SELECT t FROM h WHERE id % 10 = 0) GROUP BY kind"""
)
def bulk_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, in two sources, against a store that holds every tenth; new ones counted by kind."""
    df = _records(spark, sf_dir)
    good, _ = validate.validated(df.where("id % 10 = 0"))
    target = good.select(dedup.record_hash(F.col("kind"), F.col("name"), F.col("source_url"), F.col("pricing")).alias("content_hash"))
    new, _ = bulk.ingest([df.where("id % 2 = 0"), df.where("id % 2 = 1")], target)
    return new.groupBy("kind").agg(F.count("*").alias("n"))


@query(
    """WITH e AS (SELECT event_id, event_type AS source_id, concat('u', user_id) AS canonical_url_hash, value, props, concat(event_type, user_id % 40, '-', event_id % 3) AS content_hash FROM events),
    t AS (SELECT source_id, canonical_url_hash, arg_min(event_id, event_id) AS id, arg_min(value, event_id) AS value, arg_min(content_hash, event_id) AS content_hash FROM e WHERE event_id % 2 = 0 GROUP BY ALL),
    t1 AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY content_hash ORDER BY source_id, canonical_url_hash) = 1),
    b AS (SELECT source_id, canonical_url_hash, max(event_id) AS id, arg_max(value, event_id) AS value, arg_max(content_hash, event_id) AS content_hash FROM e WHERE event_id % 2 = 1 GROUP BY ALL),
    new AS (SELECT b.* FROM b ANTI JOIN t1 USING (source_id, canonical_url_hash) WHERE b.content_hash NOT IN (SELECT content_hash FROM t1) QUALIFY row_number() OVER (PARTITION BY b.content_hash ORDER BY b.source_id, b.canonical_url_hash) = 1)
    SELECT t1.source_id, t1.canonical_url_hash, t1.id, coalesce(b.value, t1.value) AS value, coalesce(b.content_hash, t1.content_hash) AS content_hash FROM t1 LEFT JOIN b USING (source_id, canonical_url_hash)
    UNION ALL SELECT source_id, canonical_url_hash, id, value, content_hash FROM new"""
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("source_id"), F.expr("concat('u', user_id)").alias("canonical_url_hash"), "value", F.expr("concat(event_type, user_id % 40, '-', event_id % 3)").alias("content_hash"), F.col("event_id").alias("ingested_at")
    )
    cols = ["source_id", "canonical_url_hash", "id", "value", "content_hash", "ingested_at"]
    first = e.where("id % 2 = 0").groupBy("source_id", "canonical_url_hash").agg(F.min_by(F.struct("id", "value", "content_hash", "ingested_at"), "id").alias("r")).select("source_id", "canonical_url_hash", "r.*")
    target = dedup.keep_first(first.select(*cols), "content_hash", ["source_id", "canonical_url_hash"]).select(*cols)
    return dedup.upsert(target, e.where("id % 2 = 1").select(*cols)).drop("ingested_at")


# --- Freshness and runs ----------------------------------------------------------------------------------------------

REFERENCE = "TIMESTAMP '2024-01-15 00:00:00'"
_GATE_SQL = f"CASE WHEN ts > {REFERENCE} + INTERVAL 15 MINUTE THEN 'rejected_stale' WHEN ts >= {REFERENCE} - INTERVAL 24 HOUR THEN 'accepted_verified' ELSE 'rejected_stale' END"


def _reference() -> F.Column:
    return F.to_timestamp(F.lit("2024-01-15 00:00:00"))


@query(f"SELECT event_id, {_GATE_SQL} AS decision FROM events")
def freshness_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", freshness.gate_dated(F.col("ts").cast("timestamp"), _reference()).alias("decision"))


#: Items: events whose date is missing now and then; state: by event type, one without a success, with a snapshot.
_ITEMS_SQL = """SELECT event_type AS source_id, sha256(concat('u', event_id % 500)) AS url_hash, sha256(concat('c', event_id)) AS content_hash, event_id,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS published_at, event_id % 40 AS position FROM events"""
_GATED_SQL = f"""SELECT i.event_id, i.source_id, i.position,
        CASE WHEN published_at IS NOT NULL THEN {_GATE_SQL.replace("ts >", "published_at >")} WHEN i.source_id = 'signup' THEN 'rejected_unknown' WHEN i.event_id % 500 < 250 THEN 'rejected_unknown'
            WHEN i.source_id = 'error' THEN 'rejected_unknown' WHEN position > 25 THEN 'rejected_unknown' ELSE 'accepted_inferred' END AS decision,
        CASE WHEN published_at IS NOT NULL THEN 'given' WHEN i.source_id = 'signup' THEN 'heuristic_missing_baseline' WHEN i.event_id % 500 < 250 THEN 'heuristic_previously_observed'
            WHEN i.source_id = 'error' THEN 'heuristic_stale_first_seen' WHEN position > 25 THEN 'heuristic_deep_listing_position' ELSE 'heuristic_stateful_new_since_last_run' END AS method,
        CAST(CASE WHEN published_at IS NOT NULL THEN 0.9 WHEN i.source_id NOT IN ('signup', 'error') AND i.event_id % 500 >= 250 AND position <= 25 THEN 0.65 ELSE 0 END AS DOUBLE) AS confidence FROM ({_ITEMS_SQL}) i"""


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source_id"), F.sha2(F.expr("concat('u', event_id % 500)"), 256).alias("url_hash"), F.sha2(F.expr("concat('c', event_id)"), 256).alias("content_hash"), "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("timestamp")).alias("published_at"), F.lit(0.9).alias("published_at_confidence"), F.lit("given").alias("date_extraction_method"),
        (F.col("event_id") % 40).cast("int").alias("position"), F.when(F.col("event_type") == "error", F.to_timestamp(F.lit("2024-01-01 00:00:00"))).alias("first_seen_at"), F.expr("concat('u', event_id)").alias("canonical_url"),
    )
    return freshness.gate(items, _state(spark), _reference())


def _state(spark: SparkSession) -> DataFrame:
    types = spark.createDataFrame([(t,) for t in ("view", "signup", "click", "error", "purchase")], "source_id string")
    seen = F.transform(F.sequence(F.lit(0), F.lit(249)), lambda i: F.sha2(F.concat(F.lit("u"), i.cast("string")), 256))
    return types.select(
        "source_id", F.when(F.col("source_id") != "signup", F.to_timestamp(F.lit("2024-01-14 20:00:00"))).alias("last_successful_crawl_at"), F.lit(None).cast("timestamp").alias("last_attempted_crawl_at"),
        F.lit("old").alias("last_boundary_item_id"), seen.alias("observed"), F.lit(10).cast("bigint").alias("total_ingested"),
    )


@query(f"SELECT event_id, decision, method, confidence FROM ({_GATED_SQL})")
def freshness_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).select("event_id", F.col("freshness_decision").alias("decision"), F.col("date_extraction_method").alias("method"), F.col("published_at_confidence").alias("confidence"))


_OUTCOMES_SQL = f"SELECT source_id, CASE WHEN event_id % 11 = 0 THEN 'robots_txt_disallowed' WHEN event_id % 13 = 0 AND source_id = 'click' THEN 'error' ELSE decision END AS outcome FROM ({_GATED_SQL})"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = F.when(F.col("event_id") % 11 == 0, F.lit("robots_txt_disallowed")).when((F.col("event_id") % 13 == 0) & (F.col("source_id") == "click"), F.lit("error")).otherwise(F.col("freshness_decision"))
    return _gated(spark, sf_dir).select("source_id", how.alias("outcome"))


_SUMMARY_SQL = f"""SELECT source_id, count(*) AS candidates_discovered, count(*) FILTER (outcome NOT IN ('robots_txt_disallowed', 'error')) AS candidates_fetched,
    count(*) FILTER (outcome LIKE 'accepted%') AS accepted_count, count(*) FILTER (outcome NOT LIKE 'accepted%' AND outcome != 'error') AS rejected_count, count(*) FILTER (outcome = 'error') AS error_count
    FROM ({_OUTCOMES_SQL}) GROUP BY source_id"""


@query(f"SELECT *, CASE WHEN error_count = 0 THEN 'SUCCESS' WHEN candidates_fetched > 0 AND accepted_count > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS status FROM ({_SUMMARY_SQL})")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.run_summary(_outcomes(spark, sf_dir))


@query(f"SELECT count(*) AS sources, CAST(sum(candidates_discovered) AS BIGINT) AS candidates_discovered, CAST(sum(candidates_fetched) AS BIGINT) AS candidates_fetched, CAST(sum(accepted_count) AS BIGINT) AS accepted_count, CAST(sum(rejected_count) AS BIGINT) AS rejected_count, CAST(sum(error_count) AS BIGINT) AS error_count FROM ({_SUMMARY_SQL})")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.totals(summary.run_summary(_outcomes(spark, sf_dir)))


@query(f"SELECT source_id, outcome, CAST(count(*) AS INT) AS n FROM ({_OUTCOMES_SQL}) WHERE outcome NOT LIKE 'accepted%' AND outcome != 'error' GROUP BY ALL")
def rejection_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.rejection_breakdown(_outcomes(spark, sf_dir)).select("source_id", F.explode("rejection_breakdown").alias("outcome", "n"))


@query(
    f"""WITH a AS (SELECT source_id, position, event_id, sha256(concat('u', event_id % 500)) AS u, sha256(concat('c', event_id)) AS c FROM ({_GATED_SQL}) WHERE decision LIKE 'accepted%'),
    h AS (SELECT source_id, u AS h FROM a UNION SELECT source_id, c FROM a), o AS (SELECT source_id, least(count(*), 5000) AS n_observed, min(h) AS least_observed FROM h GROUP BY source_id),
    f AS (SELECT source_id, count(*) AS n, arg_min(concat('u', event_id), (position, concat('u', event_id))) AS boundary FROM a GROUP BY source_id), s AS (SELECT DISTINCT event_type AS source_id FROM events)
    SELECT s.source_id, CASE WHEN s.source_id = 'signup' THEN NULL WHEN s.source_id = 'click' THEN '2024-01-14 20:00:00' ELSE '2024-01-15 01:00:00' END AS last_success, CASE WHEN s.source_id IN ('click', 'signup') THEN 'old' ELSE coalesce(boundary, 'old') END AS boundary,
        CAST(CASE WHEN s.source_id IN ('click', 'signup') THEN 250 ELSE coalesce(n_observed, 0) END AS BIGINT) AS n_observed, CAST(10 + CASE WHEN s.source_id IN ('click', 'signup') THEN 0 ELSE coalesce(n, 0) END AS BIGINT) AS total_ingested
    FROM s LEFT JOIN o USING (source_id) LEFT JOIN f USING (source_id)"""
)
def watermark_after_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a run in which click and signup fail."""
    state = _state(spark)
    runs = state.select("source_id", F.when(F.col("source_id").isin("click", "signup"), F.lit("PARTIAL")).otherwise(F.lit("SUCCESS")).alias("status"), _reference().alias("started_at"), F.to_timestamp(F.lit("2024-01-15 01:00:00")).alias("completed_at"))
    after = freshness.next_state(state, _gated(spark, sf_dir), runs)
    return after.select("source_id", F.date_format("last_successful_crawl_at", "yyyy-MM-dd HH:mm:ss").alias("last_success"), F.col("last_boundary_item_id").alias("boundary"), F.size("observed").cast("bigint").alias("n_observed"), "total_ingested")


@query("SELECT t.event_type, count(e.event_id) AS n FROM (VALUES ('view'), ('signup'), ('click'), ('error'), ('purchase'), ('refund')) t(event_type) LEFT JOIN events e USING (event_type) GROUP BY t.event_type")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.counts_of(table(spark, sf_dir, "events"), "event_type", ("view", "signup", "click", "error", "purchase", "refund"))


@query("SELECT event_type, count(*) AS n, CAST(grouping(event_type) AS INT) AS is_total FROM events GROUP BY ROLLUP (event_type)")
def counts_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.counts_with_total(table(spark, sf_dir, "events"), "event_type")


@query(f"SELECT kind, count(*) FILTER (e = '') AS valid, count(*) AS total, count(*) FILTER (e = '') / count(*) AS ratio FROM (SELECT kind, {_ERRORS} AS e FROM ({_RECORDS})) GROUP BY kind")
def compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _records(spark, sf_dir)
    errors = validate.record_errors(F.col("kind"), name=F.col("name"), source_name=F.col("source_name"), source_url=F.col("source_url"), pricing=F.col("pricing"), stars=F.col("stars"))
    return summary.compliance(df, "kind", F.size(errors) == 0)


@query("SELECT event_type, min(event_id) AS event_id, arg_min(user_id, event_id) AS user_id FROM events GROUP BY event_type")
def first_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.first_of_each(table(spark, sf_dir, "events").select("event_type", "event_id", "user_id"), "event_type", "event_id")


@query("SELECT event_type AS adapter_name, CAST(max(CASE WHEN event_id % 3 = 0 THEN event_id END) AS BIGINT) AS last_offset, CAST(5 + sum(CASE WHEN event_id % 3 = 0 THEN user_id ELSE 0 END) AS BIGINT) AS total_collected FROM events GROUP BY event_type")
def offset_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    old = e.select(F.col("event_type").alias("adapter_name")).distinct().select("adapter_name", F.lit(-1).cast("bigint").alias("last_offset"), F.lit(5).cast("bigint").alias("total_collected"))
    return freshness.merge_checkpoints(old, e.select(F.col("event_type").alias("adapter_name"), F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("offset"), F.col("user_id").alias("saved"), F.col("event_id").alias("at")))


@query("SELECT event_id AS request_id, event_type AS source_id, CASE WHEN event_type != 'view' AND event_id = min(event_id) OVER (PARTITION BY event_type) THEN 'STARTED' ELSE 'SKIPPED_LOCKED' END AS status FROM events")
def single_flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col("event_type").alias("source_id"))
    return freshness.single_flight(requests, spark.createDataFrame([("view",)], "source_id string"))


# --- Names -------------------------------------------------------------------------------------------------------------

#: A small seed of our own; two entities share an alias and two a set of words, so that no tier goes unasked.
SEED_ROWS = [
    ("e1", "Northwind Robotics, Inc.", ["Northwind", "NW Robots"], ["north wind"], ["northwind.example"]),
    ("e2", "Bluefin AI", ["Blue Fin", "Alpha"], ["bluefin"], ["bluefin.example", "www.bluefin-labs.example"]),
    ("e3", "Café Data GmbH", ["Alpha", "Cafe Insights"], [], ["cafe.example"]),
    ("e4", "Orchard Cloud Systems", ["Beta Works"], [], []),
    ("e5", "Orchard Software", ["Gamma Co"], [], ["orchard.example"]),
    ("e6", "Lumen Forge", ["Forge Lumen Labs"], ["gamma"], []),
]
#: Names and addresses as records have them, with what must come out.
NAME_ROWS = [
    ("Anything", "https://www.Northwind.example:443/about", "e1", "OFFICIAL_DOMAIN", 1.0), ("  bluefin ai ", None, "e2", "EXACT_CANONICAL_NAME", 1.0), ("blue fin", "", "e2", "EXACT_CONFIGURED_ALIAS", 1.0),
    ("ALPHA", None, None, "AMBIGUOUS_MULTI_CANDIDATE", 0.0), ("Northwind Robotics", None, "e1", "EXACT_CANONICAL_NAME", 0.99), ("Cafe Data", None, "e3", "EXACT_CANONICAL_NAME", 0.99), ("North Wind Ltd.", None, "e1", "EXACT_NORMALIZED_ALIAS", 0.98),
    ("gamma", None, None, "AMBIGUOUS_MULTI_CANDIDATE", 0.0), ("Orchard Technologies", None, None, "AMBIGUOUS_MULTI_CANDIDATE", 0.0), ("Forge, Lumen", None, "e6", "CONSERVATIVE_TOKEN_MATCH", 0.9), ("Works Beta Group", None, "e4", "CONSERVATIVE_TOKEN_MATCH", 0.88),
    ("AI Labs", None, None, "UNRESOLVED", 0.0), ("Unheard Of", "nowhere.example", None, "UNRESOLVED", 0.0), ("", "", None, "UNRESOLVED", 0.0), (None, None, None, "UNRESOLVED", 0.0), ("Orchard", "orchard.example/x", "e5", "OFFICIAL_DOMAIN", 1.0),
]


def _quoted(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


_EXPECTED = ", ".join(f"({i}, {_quoted(cid)}, '{how}', {score})" for i, (_, _, cid, how, score) in enumerate(NAME_ROWS))


@query(f"SELECT s.s_suppkey AS record_id, e.cid AS canonical_entity_id, e.how AS match_strategy, CAST(e.score AS DOUBLE) AS confidence FROM supplier s JOIN (VALUES {_EXPECTED}) e(i, cid, how, score) ON s.s_suppkey % {len(NAME_ROWS)} = e.i")
def resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the names above for each supplier."""
    names = spark.createDataFrame([(i, n, d) for i, (n, d, *_) in enumerate(NAME_ROWS)], "i int, raw_name string, domain string")
    records = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("record_id")).join(F.broadcast(names), F.col("record_id") % len(NAME_ROWS) == F.col("i")).drop("i")
    return resolve(records, spark.createDataFrame(SEED_ROWS, SEED)).select("record_id", "canonical_entity_id", "match_strategy", "confidence")


# --- Texts -------------------------------------------------------------------------------------------------------------

@query(
    """SELECT doc_id, CAST(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE greatest(ceil(length(text) / 3.7::DOUBLE), ceil(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w != '')) * 1.35::DOUBLE), 1) END AS BIGINT) AS tokens,
    CAST(greatest(500, coalesce(n_chars, 0) - 3300) AS BIGINT) AS budget FROM documents"""
)
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", text.token_estimate(F.col("text")).alias("tokens"), text.safe_budget(F.coalesce("n_chars", F.lit(0))).cast("bigint").alias("budget"))


@query()
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_documents(table(spark, sf_dir, "documents"), chunks.Limits(max_chars=2000)).drop("content")


@query("SELECT p.page_id, CAST(i AS INT) AS index, CAST(i * 52 AS INT) AS start_offset, CAST(CASE WHEN i < 25 THEN 50 END AS INT) AS char_count FROM pages p, range(25) r(i) WHERE i < 3 + p.page_id % 20")
def chunk_hard_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of one letter, which only the last resort can cut."""
    docs = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.repeat(F.lit("A"), (50 * (3 + F.col("page_id") % 20)).cast("int")).alias("text"))
    return chunks.chunk_documents(docs, chunks.Limits(max_chars=50)).select(F.col("doc_id").alias("page_id"), "index", "start_offset", "char_count")


@query()
def rechunk_oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunks.chunk_documents(table(spark, sf_dir, "documents"), chunks.Limits(max_chars=4000))
    return chunks.rechunk_oversized(made, 2500).select("doc_id", "index", "sub_index", F.length("content").alias("char_count"))


_TITLE_SQL = r"""nullif(replace(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), chr(32) || chr(10) || chr(9) || chr(13)), '&amp;', '&'), '')"""


@query(f"SELECT page_id, {_TITLE_SQL} AS title FROM pages")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.html_title(F.col("html")).alias("title"))


def _unescaped_sql(column: str) -> str:
    return f"replace(replace({column}, '&amp;', '&'), '&quot;', '\"')"


#: The pages as the normalizer shows them: no scripts, menus and footers, a heading's mark, a blank line before each paragraph.
_MARKED_SQL = r"regexp_replace(html, '(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g')"
_MARKED_SQL = rf"regexp_replace({_MARKED_SQL}, '(?s)<nav>.*?</nav>|<footer>.*?</footer>|<br>|</(?:p|div|article)>', chr(10), 'g')"
_MARKED_SQL = rf"regexp_replace({_MARKED_SQL}, '(?s)<h1>(.*?)</h1>', concat(chr(10), chr(10), '# \1', chr(10), chr(10)), 'g')"
_MARKED_SQL = rf"regexp_replace(regexp_replace({_MARKED_SQL}, '<(?:p|div|article)(?: [^>]*)?>', repeat(chr(10), 2), 'g'), '<[^>]+>', ' ', 'g')"
_MARKED_SQL = rf"regexp_replace(regexp_replace({_unescaped_sql(_MARKED_SQL)}, '[ \t]+([.,;:!?])', '\1', 'g'), '[ \t]+', ' ', 'g')"
_MARKED_SQL = rf"regexp_replace(regexp_replace({_MARKED_SQL}, ' ?\n ?', chr(10), 'g'), '\n{{3,}}', repeat(chr(10), 2), 'g')"


@query(
    rf"""SELECT page_id, text, CAST(CASE WHEN text = '' THEN 0 ELSE greatest(ceil(length(text) / 3.7::DOUBLE), ceil(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w != '')) * 1.35::DOUBLE), 1) END AS BIGINT) AS tokens
    FROM (SELECT page_id, concat('Document Title: ' || {_TITLE_SQL} || repeat(chr(10), 2), trim({_MARKED_SQL}, chr(32) || chr(10))) AS text FROM pages)"""
)
def html_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = text.normalized_html(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", normal.alias("text"), text.token_estimate(normal).alias("tokens"))


#: The pages' articles: a marked heading and paragraphs. A paragraph that leaves its bold type open holds all that follows.
_ARTICLE_SQL = r"""(SELECT *, array_to_string(list_filter(list_concat([concat('# ', trim(regexp_extract(body, '(?s)<h1>(.*?)</h1>', 1)))], list_transform(list_concat(string_split(split_part(rest, '<p><b>', 1), '</p>'), [substring(rest, length(split_part(rest, '<p><b>', 1)) + 1)]), lambda x: trim(regexp_replace(x, '(?:\s*<[^>]+>\s*)+', ' ', 'g')))), lambda x: x != ''), repeat(chr(10), 2)) AS said
    FROM (SELECT *, regexp_replace(body, '(?s)^.*</h1>', '') AS rest FROM (SELECT *, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages)))"""


@query(f"SELECT page_id, {_TITLE_SQL} AS title, NULL AS author, NULL AS summary, {_unescaped_sql('said')} AS full_text FROM {_ARTICLE_SQL}")
def article_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.extract_articles(table(spark, sf_dir, "pages"))


@query(f"SELECT page_id, {_TITLE_SQL} AS title, 'Unknown Company' AS company, NULL AS location, NULL AS salary, {_unescaped_sql('said')} AS description_full_text FROM {_ARTICLE_SQL}")
def job_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.extract_jobs(table(spark, sf_dir, "pages"))


_REDACTED = "text"
for _p in text.SECRETS:
    _REDACTED = f"regexp_replace({_REDACTED}, '{_p}', '[REDACTED]', 'g')"
_LACED = "CASE doc_id % 5 WHEN 0 THEN concat('sk-', repeat('a1', 20), ' ', text) WHEN 1 THEN concat(text, ' bearer abc.DEF-1 x') WHEN 2 THEN concat('AIza', repeat('x', 35), repeat('y', 300), ' ', text) WHEN 3 THEN concat(text, ' gsk_', repeat('z', 31)) ELSE text END"


@query(f"SELECT doc_id, CASE WHEN length(r) > 200 THEN concat(left(r, 200), '... [TRUNCATED ', length(r), ' chars]') ELSE r END AS text FROM (SELECT doc_id, {_REDACTED} AS r FROM (SELECT doc_id, {_LACED} AS text FROM documents))")
def redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(_LACED).alias("text")).select("doc_id", text.redacted(F.col("text")).alias("text"))


_BROKEN = """CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN concat('```json', chr(10), props, chr(10), '```') WHEN 2 THEN concat('Here it is: ', props, ' - done') WHEN 3 THEN replace(props, '}', ',}') WHEN 4 THEN replace(props, '}', '') ELSE 'no { json' END"""


@query("SELECT event_id, event_id % 6 = 5 AS malformed, CASE WHEN event_id % 6 < 5 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def json_heal(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", text.parsed_json(F.expr(_BROKEN)).alias("v"))
    return df.select("event_id", F.col("v").isNull().alias("malformed"), F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query(
    """SELECT p_partkey AS id, concat_ws('; ', CASE WHEN p_partkey % 4 = 1 THEN '/ must have required property ''tags''' END, CASE WHEN p_name = '' THEN '/name must NOT have fewer than 1 characters' END,
        CASE WHEN p_size > 40 THEN '/size must be <= 40' END, CASE WHEN p_partkey % 4 = 2 THEN '/tags must be array' END, CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL') THEN '/type must be equal to one of the allowed values' END) AS errors FROM part"""
)
def json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = validate.Schema({
        "type": "object", "required": ["name", "tags"],
        "properties": {"name": {"type": "string", "minLength": 1}, "size": {"type": "integer", "minimum": 0, "maximum": 40}, "tags": {"type": "array"}, "type": {"enum": ["ECONOMY", "SMALL"]}, "more": {"anyOf": [{"type": "integer"}, {"type": "null"}]}},
    })
    tags = F.expr("CASE p_partkey % 4 WHEN 1 THEN '' WHEN 2 THEN ', \"tags\": \"a\"' ELSE ', \"tags\": [\"a\"]' END")
    record = F.concat(F.lit('{"name": "'), "p_name", F.lit('", "size": '), F.col("p_size").cast("string"), F.lit(', "type": "'), "p_type", F.lit('", "more": null'), tags, F.lit("}"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), schema.message(F.parse_json(record)).alias("errors"))


_KINDS = ("STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB")
#: The content of a valid record of each kind but for its last field, and that.
_PARTS = {
    "STARTUP": ('"data": {"employeeCount": null}', '"entityName": "e"', "entityName"), "PRODUCT": ('"startupName": "e"', '"pricingModel": "FREE"', "pricingModel"),
    "RESEARCH_PAPER": ('"title": "e", "authors": ["a"], "paper_url": "u", "github_stars": 1', '"published_date": "d"', "published_date"), "JOB": ('"company": "c", "date": "d", "is_remote": true', '"role_family": "r"', "role_family"),
}


@query(
    "SELECT p_partkey AS id, CASE p_partkey // 4 % 4 WHEN 1 THEN '/schemaVersion must be equal to one of the allowed values' WHEN 2 THEN concat('/content must have required property ''', CASE p_partkey % 4 "
    + " ".join(f"WHEN {i} THEN '{_PARTS[k][2]}'" for i, k in enumerate(_KINDS))
    + " END, '''') WHEN 3 THEN CASE WHEN p_partkey % 4 = 3 THEN '' ELSE '/ must have required property ''source''; / must have required property ''collectedAt''' END ELSE '' END AS errors FROM part"
)
def canonical_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the four kinds: valid, of another version, without their last field, without source and time."""
    df = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.floor(F.col("p_partkey") / 4) % 4).alias("v"))
    errors = F.lit(None).cast("string")
    for i, kind in enumerate(_KINDS):
        most, last, _ = _PARTS[kind]
        content = F.when(F.col("v") == 2, F.lit(f"{{{most}}}")).otherwise(F.lit(f"{{{most}, {last}}}"))
        version = F.when(F.col("v") == 1, F.lit("2.0")).otherwise(F.lit("1.0"))
        rest = F.when(F.col("v") == 3, F.lit("")).otherwise(F.lit(', "source": {"name": "n", "url": "u"}, "collectedAt": "t"'))
        record = F.concat(F.lit('{"schemaVersion": "'), version, F.lit(f'", "recordType": "{kind}", "content": '), content, rest, F.lit("}"))
        errors = F.when(F.col("id") % 4 == i, validate.Schema(validate.canonical_schema(kind)).message(F.parse_json(record))).otherwise(errors)
    return df.select("id", errors.alias("errors"))


@query(
    """SELECT CASE WHEN n = 1 THEN 1 ELSE 2 END AS place, key, concat('  ', CASE WHEN n > 1 THEN ',' ELSE '' END, line) AS value FROM (SELECT *, row_number() OVER (ORDER BY key NULLS FIRST, line) AS n FROM
        (SELECT CASE WHEN p_size > 5 THEN p_size END AS key, concat('{"size":', coalesce(CAST(CASE WHEN p_size > 5 THEN p_size END AS VARCHAR), 'null'), ',"brand":"', p_brand, '"}') AS line FROM part))
    UNION ALL SELECT 0, NULL, '[' UNION ALL SELECT 3, NULL, ']'"""
)
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an array of rows that share their place in the order, have none, or are the same."""
    df = table(spark, sf_dir, "part").select(F.when(F.col("p_size") > 5, F.col("p_size")).alias("size"), F.col("p_brand").alias("brand"))
    return export.json_lines(df, "size")


@query(
    """SELECT l_orderkey, arg_max(l_shipinstruct, (length(trim(l_shipinstruct)), -l_linenumber)) FILTER (trim(l_shipinstruct) != '') AS longest, max(l_quantity) AS most, list_sort(list(DISTINCT l_returnflag)).array_to_string(',') AS flags, count(*) AS n
    FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS l_linenumber, CASE WHEN l_partkey % 3 = 0 THEN '  ' ELSE repeat('x', CAST(l_partkey % 17 AS INT)) || l_suppkey END AS l_shipinstruct, l_quantity, l_returnflag FROM lineitem) GROUP BY l_orderkey"""
)
def consolidate_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("l_linenumber * 1000000000L + l_partkey * 10000 + l_suppkey").alias("place"), F.expr("CASE WHEN l_partkey % 3 = 0 THEN '  ' ELSE concat(repeat('x', CAST(l_partkey % 17 AS INT)), l_suppkey) END").alias("longest"), F.col("l_quantity").alias("most"), F.array("l_returnflag").alias("flags"))
    done = consolidate.consolidate_typed(parts, "l_orderkey", "place", texts=("longest",), numbers=("most",), arrays=("flags",))
    return done.withColumn("flags", F.array_join(F.array_sort("flags"), ","))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, max(CAST(l_quantity AS BIGINT)) AS most, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def consolidate_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_json(F.struct(F.col("l_quantity").cast("bigint").alias("q"), F.array("l_returnflag").alias("f"))).alias("part"))
    return consolidate.consolidate(parts, "l_orderkey", "l_linenumber", "part").select("l_orderkey", F.get_json_object("merged", "$.q").cast("bigint").alias("most"), "n")


@query("SELECT conv_id, string_agg(concat(role, ': ', text), chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def chat_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return turns.select("conv_id", F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n\n").alias("text"))


# --- Dates -------------------------------------------------------------------------------------------------------------

_FORMS = ["yyyy-MM-dd", "yyyyMMdd", "dd MMM yyyy", "MMMM d, yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "dd MMM yyyy HH:mm:ss '+0200'"]


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 7 THEN NULL WHEN o_orderkey % 8 = 6 THEN o_orderdate - INTERVAL 2 HOUR ELSE o_orderdate END AS ts FROM orders")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in seven ways, and something that is no date."""
    day = F.col("o_orderdate").cast("timestamp")
    shown = F.lit("13th of never")
    for i, form in enumerate(_FORMS):
        shown = F.when(F.col("o_orderkey") % 8 == i, F.date_format(day, form)).otherwise(shown)
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(shown).cast("timestamp_ntz").alias("ts"))


@query("SELECT o_orderkey, o_orderdate AS month_first, CASE WHEN day(o_orderdate) <= 12 THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate), 0, 0, 0) ELSE o_orderdate END AS day_first FROM orders")
def numeric_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.date_format("o_orderdate", "M/d/yyyy")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_numeric(shown).cast("timestamp_ntz").alias("month_first"), dates.parse_numeric(shown, "en_GB").cast("timestamp_ntz").alias("day_first"))


@query(
    f"""SELECT event_id, {REFERENCE} - CASE event_id % 6 WHEN 0 THEN to_seconds(user_id) WHEN 1 THEN to_minutes(user_id) WHEN 2 THEN to_hours(user_id) WHEN 3 THEN to_days(CAST(user_id AS INT)) WHEN 4 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS ts FROM events"""
)
def relative_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.expr("CASE event_id % 6 WHEN 0 THEN concat(user_id, ' secs ago') WHEN 1 THEN concat(user_id, 'm ago') WHEN 2 THEN concat('about ', user_id, ' Hours ago') WHEN 3 THEN concat('Posted ', user_id, ' days ago') WHEN 4 THEN 'Yesterday' ELSE 'just now' END")
    return table(spark, sf_dir, "events").select("event_id", dates.parse_relative(said, _reference()).cast("timestamp_ntz").alias("ts"))


@query("SELECT page_id, CASE WHEN page_id % 14 < 12 THEN make_timestamp(2020 + page_id % 5, 1 + page_id % 14, 1 + page_id % 28, 0, 0, 0) END AS ts FROM pages")
def url_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = F.expr("concat('https://x.example/', 2020 + page_id % 5, '/', 1 + page_id % 14, '/', 1 + page_id % 28, '/story')")
    return table(spark, sf_dir, "pages").select("page_id", dates.url_date(address).cast("timestamp_ntz").alias("ts"))


@query(
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'structured_json_ld_published' WHEN 1 THEN 'structured_feed_pubdate' WHEN 2 THEN 'meta_date' WHEN 3 THEN 'visible_time_datetime' WHEN 4 THEN 'visible_time_relative' ELSE 'not_found' END AS method,
    CAST(CASE page_id % 6 WHEN 0 THEN 0.98 WHEN 1 THEN 0.95 WHEN 2 THEN 0.88 WHEN 3 THEN 0.85 WHEN 4 THEN 0.8 ELSE 0 END AS DOUBLE) AS confidence FROM pages"""
)
def extract_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a date put in one of five places, or none."""
    put = F.expr("""CASE page_id % 6 WHEN 0 THEN '<script type="application/ld+json">{"@graph": [{"datePublished": "2024-01-14T10:00:00Z"}]}</script>' WHEN 2 THEN '<meta content="2024-01-14" name="date">' WHEN 3 THEN '<time class="x" datetime="2024-01-14T10:00:00+01:00">now</time>' WHEN 4 THEN '<time>3 hours ago</time>' ELSE '' END""")
    feed = F.when(F.col("page_id") % 6 == 1, F.lit("Sun, 14 Jan 2024 10:00:00 +0000"))
    found = dates.extract_date(F.concat(put, "html"), feed, F.col("url"), _reference())
    return table(spark, sf_dir, "pages").select("page_id", found.alias("d")).select("page_id", "d.method", "d.confidence")


# --- Errors, retries, pacing -------------------------------------------------------------------------------------------

_FAILURES = "SELECT event_id, CASE event_id % 9 WHEN 0 THEN 403 WHEN 1 THEN 429 WHEN 2 THEN 413 WHEN 3 THEN 408 WHEN 4 THEN 503 WHEN 5 THEN 200 ELSE NULL END AS status, CASE event_id % 9 WHEN 6 THEN 'Read Timeout' WHEN 7 THEN 'JSON is cut off' WHEN 8 THEN 'odd' END AS message, CASE WHEN event_id % 9 = 5 THEN '<h1>Just a moment...</h1>' END AS body FROM {0}"


@query(
    f"""SELECT event_id, CASE WHEN status IN (403, 200) THEN 'BLOCKED_ACCESS' WHEN status = 429 THEN 'HTTP_429_RATE_LIMITED' WHEN status = 413 THEN 'HTTP_413_PAYLOAD_TOO_LARGE' WHEN status = 408 OR event_id % 9 = 6 THEN 'NETWORK_TIMEOUT' WHEN status = 503 THEN 'HTTP_5XX_SERVER_ERROR'
        WHEN event_id % 9 = 7 THEN 'PARSING_FAILURE' ELSE 'UNKNOWN_ERROR' END AS error_code, CAST(CASE WHEN event_id % 9 = 6 THEN 408 ELSE status END AS INT) AS status_code, event_id % 9 IN (1, 2, 3, 4, 6) AS is_transient,
        CAST(CASE WHEN status = 429 THEN 5 WHEN status = 408 OR event_id % 9 = 6 THEN 2 WHEN status = 503 THEN 3 END AS DOUBLE) AS suggested_backoff_seconds, coalesce(status IN (429, 503), false) AS retried_fetch, coalesce(status IN (408, 413, 429, 503), false) AS retried_call FROM ({_FAILURES.format("events")})"""
)
def classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("quern_events")
    df = spark.sql(_FAILURES.format("quern_events"))
    code = politeness.classify_error(F.col("status"), F.col("message"), F.col("body"))
    return df.select("event_id", code.alias("e"), politeness.is_retried(F.col("status")).alias("retried_fetch"), politeness.is_retried(F.col("status"), call=True).alias("retried_call")).select("event_id", "e.*", "retried_fetch", "retried_call")


@query(
    """SELECT event_id, CAST(i AS INT) AS attempt, greatest(power(2, i), CASE WHEN event_id % 4 = 0 THEN 7 ELSE 0 END) * 0.75::DOUBLE AS fetch_seconds,
    CAST(CASE WHEN event_id % 4 = 0 THEN floor(4000 + 4000 * 0.5 * 0.1::DOUBLE + 0.5) ELSE floor(least(10000, 500 * power(2, i)) * 0.5 + 0.5) END AS BIGINT) AS call_ms FROM events, range(6) r(i)"""
)
def backoff_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select("event_id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("attempt"))
    asked = F.col("event_id") % 4 == 0
    return df.select("event_id", "attempt", politeness.fetch_backoff(F.col("attempt"), F.when(asked, 7), F.lit(0.75)).alias("fetch_seconds"), politeness.call_backoff(F.col("attempt"), F.when(asked, 4000), F.lit(0.5)).alias("call_ms"))


@query("SELECT event_id, CAST(CASE event_id % 3 WHEN 0 THEN user_id * 1000 WHEN 1 THEN 3600000 END AS BIGINT) AS ms FROM events")
def retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.expr("CASE event_id % 3 WHEN 0 THEN concat(' ', user_id) WHEN 1 THEN 'Mon, 15 Jan 2024 01:00:00 GMT' ELSE 'soon' END")
    return table(spark, sf_dir, "events").select("event_id", politeness.retry_after_ms(header, _reference()).alias("ms"))


def _bucket_sql(t: str, result: str) -> str:
    """Arrivals one after another: t is the time in whole microseconds, tokens are counted in millionths."""
    left = "least(1e7, s.tokens + (a.t - s.t) * 5.0)"
    return f"""WITH RECURSIVE a AS MATERIALIZED (SELECT event_type AS key, event_id AS id, {t} AS t, row_number() OVER (PARTITION BY event_type ORDER BY {t}, event_id) AS rn FROM events),
    s AS (SELECT key, id, t, rn, true AS allowed, CAST(9e6 AS DOUBLE) AS tokens FROM a WHERE rn = 1
        UNION ALL SELECT a.key, a.id, a.t, a.rn, {left} >= 1e6, {left} - CASE WHEN {left} >= 1e6 THEN 1e6 ELSE 0 END FROM s JOIN a ON a.key = s.key AND a.rn = s.rn + 1) {result}"""


def _micros_sql(slower: int) -> str:
    return f"CAST(trunc(CAST(floor(epoch(ts)) AS BIGINT) / {slower} * 1e6) AS BIGINT)"


@query(_bucket_sql(_micros_sql(200), "SELECT key, id, t / 1e6 AS t, allowed, tokens / 1e6 AS tokens FROM s"))
def token_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = table(spark, sf_dir, "events").select("event_type", "event_id", F.expr("timestamp_seconds(unix_seconds(CAST(ts AS timestamp)) / 200)").alias("at"))
    return buckets.token_bucket(arrivals, "event_type", "at", "event_id")


@query(
    f"""SELECT key, id, t / 1e6 AS t, (200000 * n + max(t - 200000 * n) OVER (PARTITION BY key ORDER BY n ROWS UNBOUNDED PRECEDING)) / 1e6 AS starts
    FROM (SELECT event_type AS key, event_id AS id, {_micros_sql(5000)} AS t, row_number() OVER (PARTITION BY event_type ORDER BY {_micros_sql(5000)}, event_id) - 1 AS n FROM events)"""
)
def pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = table(spark, sf_dir, "events").select("event_type", "event_id", F.expr("timestamp_seconds(unix_seconds(CAST(ts AS timestamp)) / 5000)").alias("at"))
    return buckets.pacing(arrivals, "event_type", "at", "event_id")


@query("SELECT page_id, NOT regexp_matches(url, '^https?://[^/]+/(de|fr)/') OR page_id % 2 = 0 AS allowed FROM pages")
def robots_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of odd pages under a host with rules against two folders; the host of even pages answers 404."""
    rules = spark.createDataFrame([("https://odd.example", 200, "User-agent: *\nDisallow: /de/\nDisallow: /fr/"), ("https://even.example", 404, "User-agent: *\nDisallow: /")], "origin string, status int, body string")
    address = F.expr(r"regexp_replace(url, '^https?://[^/]+/', concat('https://', CASE WHEN page_id % 2 = 0 THEN 'even' ELSE 'odd' END, '.example/'))")
    return robots.allowed(table(spark, sf_dir, "pages").select("page_id", address.alias("url")), rules, "quern").select("page_id", "allowed")


# --- Sources -----------------------------------------------------------------------------------------------------------

@query(
    """SELECT concat('s', p.page_id % 5) AS source_id, p.page_id, CAST(row_number() OVER (PARTITION BY p.page_id % 5 ORDER BY p.page_id) - 1 AS INT) AS position FROM pages p WHERE p.page_id % 3 != 0
    QUALIFY position < 50"""
)
def discover_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed for each page, of two items; those of every third page have no address."""
    body = F.expr("""concat('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>T</title><item><title>none</title></item><item><title>Item ', page_id, '</title>', CASE WHEN page_id % 3 = 0 THEN '<guid>urn:x</guid>' WHEN page_id % 3 = 1 THEN concat('<link>/p/', page_id, '</link>') ELSE concat('<guid>https://b.example/p/', page_id, '</guid>') END, '<dc:creator>A</dc:creator><pubDate>Sun, 14 Jan 2024 10:00:00 +0000</pubDate></item></channel></rss>')""")
    payloads = table(spark, sf_dir, "pages").select(F.expr("concat('s', page_id % 5)").alias("source_id"), F.col("page_id").cast("int").alias("payload_no"), body.alias("body"), F.lit("https://b.example").alias("base_url"))
    found, _ = feeds.discover_feed(payloads)
    return found.select("source_id", F.regexp_extract("raw_url", r"/p/(\d+)$", 1).cast("bigint").alias("page_id"), "position")


@query(
    """SELECT concat('s', p.page_id % 5) AS source_id, p.page_id, j, CAST(row_number() OVER (PARTITION BY p.page_id % 5 ORDER BY p.page_id, j) - 1 AS INT) AS position FROM pages p, range(2) r(j) QUALIFY position < 50"""
)
def discover_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON answers, as lists and as objects, each with a notice and two offers, one with an id only."""
    offers = """concat('[{"legal": "notice"}, {"url": "https://j.example/job/', page_id, '-0", "position": "A"}, {"id": "', page_id, '-1", "title": "B"}]')"""
    body = F.expr(f"CASE WHEN page_id % 2 = 0 THEN {offers} ELSE concat('{{\"count\": 3, \"jobs\": ', {offers}, '}}') END")
    payloads = table(spark, sf_dir, "pages").select(F.expr("concat('s', page_id % 5)").alias("source_id"), F.col("page_id").cast("int").alias("payload_no"), body.alias("body"), F.lit("https://j.example").alias("base_url"))
    found = feeds.discover_api(payloads)
    return found.select("source_id", F.regexp_extract("raw_url", r"/job/(\d+)-(\d)$", 1).cast("bigint").alias("page_id"), F.regexp_extract("raw_url", r"/job/(\d+)-(\d)$", 2).cast("bigint").alias("j"), "position")


@query(
    rf"""SELECT source_id, CAST(page_id AS INT) AS payload_no, CAST(row_number() OVER (PARTITION BY source_id ORDER BY page_id, i) - 1 AS INT) AS position,
        concat(regexp_extract(url, '^[a-z]+://[^/?#]+'), regexp_extract(item, 'href="([^"]*)"', 1)) AS raw_url, {_unescaped_sql("regexp_extract(item, '>([^<]*)</a>', 1)")} AS title
    FROM (SELECT page_id, url, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '^www\.', '') AS source_id, unnest(items) AS item, generate_subscripts(items, 1) AS i
        FROM (SELECT *, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a [^>]*>[^<]*</a>') AS items FROM pages))"""
)
def discover_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = table(spark, sf_dir, "pages").select(urls.domain(F.col("url")).alias("source_id"), F.col("page_id").cast("int").alias("payload_no"), F.col("html").alias("body"), F.col("url").alias("base_url"))
    found, _ = feeds.discover_listing(payloads, {"item_container": "nav li, article"}, limit=None)
    return found.select("source_id", "payload_no", "position", "raw_url", "title")


@query(
    """SELECT s_suppkey AS id, 'directory' AS how, concat('Acme-', s_suppkey, ' O''Neil') AS name, concat('https://d.example/?CIK=', lpad(CAST(s_suppkey AS VARCHAR), 10, '0')) AS source_url, NULL AS employees FROM supplier
    UNION ALL SELECT s_suppkey, 'knowledge_base', s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'http://w.example' ELSE concat('http://k.example/Q', s_suppkey) END, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey AS VARCHAR) END FROM supplier WHERE s_suppkey % 5 != 0
    UNION ALL SELECT s_suppkey, 'repositories', concat('Own', s_suppkey, '/tool'), CASE WHEN s_suppkey % 2 = 0 THEN 'https://home.example/' ELSE concat('https://github.com/Own', s_suppkey, '/tool') END, NULL FROM supplier"""
)
def bulk_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload a supplier for three kinds of JSON source."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), "s_name")
    directory = feeds.source("directory")(s.select(F.expr("""concat('{"0": {"cik_str": ', k, ', "ticker": "T", "title": "ACME-', k, ' o\\'neil"}, "1": {"cik_str": 1, "title": " "}}')""").alias("body"), F.lit(None).cast("int").alias("batch_count")), "Directory", "https://d.example/?CIK=")
    base = feeds.source("knowledge_base")(s.select(F.expr("""concat('{"results": {"bindings": [{"item": {"value": "http://k.example/Q', k, '"}, "itemLabel": {"value": "', CASE WHEN k % 5 = 0 THEN concat('Q', k) ELSE s_name END, '"}', CASE WHEN k % 2 = 0 THEN ', "website": {"value": "http://w.example"}' ELSE '' END, CASE WHEN k % 3 = 0 THEN concat(', "employees": {"value": "', k, '.7"}') ELSE '' END, '}]}}')""").alias("body")), "Base")
    code = feeds.source("repositories")(s.select(F.expr("""concat('{"items": [{"name": "tool", "owner": {"login": "Own', k, '"}, "html_url": "https://github.com/Own', k, '/tool/", "homepage": ', CASE WHEN k % 2 = 0 THEN '"https://home.example"' ELSE 'null' END, ', "stargazers_count": 3}]}')""").alias("body")), "Code")
    number = lambda c: F.regexp_extract(c, r"(\d+)", 1).cast("bigint")
    rows = [df.select(number(F.col("name")).alias("id"), F.lit(how).alias("how"), "name", "source_url", "employees") for how, df in (("directory", directory), ("knowledge_base", base), ("repositories", code))]
    return rows[0].union(rows[1]).union(rows[2])


@query(
    """SELECT p_partkey AS id, p_name AS title, 'A B; C' AS authors, CASE WHEN p_partkey % 2 = 0 THEN concat('https://alt.example/', p_partkey) ELSE concat('http://id.example/', p_partkey) END AS paper_url, CASE WHEN p_partkey % 3 = 0 THEN concat('https://github.com/o/r', p_partkey) END AS repository,
    CAST(CASE WHEN p_partkey % 6 = 0 THEN p_size ELSE 0 END AS BIGINT) AS stars FROM part"""
)
def paper_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An Atom payload a part; every sixth has a repository whose stars are known."""
    p = table(spark, sf_dir, "part")
    body = F.expr("""concat('<feed xmlns="http://www.w3.org/2005/Atom" xmlns:x="http://x.example"><entry><id> http://id.example/', p_partkey, ' </id><title> ', replace(p_name, ' ', '\n  '), '</title><author><name> A B </name></author><author><name>C</name></author>', CASE WHEN p_partkey % 2 = 0 THEN concat('<link rel="alternate" href="https://alt.example/', p_partkey, '"/>') ELSE '' END, '<summary>s ', CASE WHEN p_partkey % 3 = 0 THEN concat('see https://github.com/o/r', p_partkey, '.git).') ELSE '' END, '</summary></entry><entry><title> </title></entry></feed>')""")
    stats = p.where("p_partkey % 6 = 0").select(F.expr("concat('O/R', p_partkey)").alias("slug"), F.col("p_size").cast("bigint").alias("stars"))
    found = feeds.source("papers")(p.select(body.alias("body")), "Papers", stats)
    return found.select(F.regexp_extract("source_url", r"(\d+)$", 1).cast("bigint").alias("id"), F.col("name").alias("title"), F.concat_ws("; ", "authors").alias("authors"), F.col("source_url").alias("paper_url"), "repository", "stars")


@query(
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'https://out.example/x' ELSE concat('https://cat.example/t/', p_partkey) END AS source_url, CASE p_partkey % 4 WHEN 0 THEN 'FREEMIUM' WHEN 1 THEN 'ENTERPRISE' WHEN 2 THEN 'FREE' ELSE 'PAID' END AS pricing FROM part"""
)
def catalog_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing a part, with one card and one comparison that doesn't count."""
    body = F.expr("""concat('<div><h3><a href="/t/', p_partkey, '">Featured Tool ', p_partkey, '</a></h3>', CASE WHEN p_partkey % 2 = 0 THEN '<a href="https://out.example/x/">site</a>' ELSE '' END, CASE p_partkey % 4 WHEN 0 THEN '<span class="tag is-price-x">Free trial</span>' WHEN 1 THEN ' for the enterprise' WHEN 2 THEN '<span class="is-price-y">odd</span>' ELSE ' from $5' END, '</div><div><h4><a href="/compare/a">x</a></h4></div>')""")
    found = feeds.source("catalog")(table(spark, sf_dir, "part").select(body.alias("body")), "Catalog", "https://cat.example")
    return found.select(F.regexp_extract("name", r"^Tool (\d+)$", 1).cast("bigint").alias("id"), "source_url", "pricing")


@query("SELECT s_suppkey, CAST(i AS INT) AS page, CAST(10 + i * 100 AS INT) AS offset, CAST(least(100, s_suppkey * 7 - i * 100) AS INT) AS batch_count FROM supplier, range(100000) r(i) WHERE i * 100 < s_suppkey * 7")
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.lit(10).alias("start"), (F.col("s_suppkey") * 7).cast("int").alias("total"))
    return feeds.paged(limits, 100).withColumnRenamed("source_id", "s_suppkey")


# --- Answers -----------------------------------------------------------------------------------------------------------

@query(
    """SELECT p_partkey AS doc_id, CASE p_partkey % 5 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'a' WHEN 3 THEN 'b' END AS provider,
    CASE p_partkey % 5 WHEN 1 THEN 'a: status 429' WHEN 3 THEN 'a: / must have required property ''n''' WHEN 4 THEN 'a: / is not JSON|b: /n must be integer' ELSE '' END AS failures FROM part"""
)
def choose_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two providers and two chunks a part: sound, refused, mended, invalid twice, and hopeless answers."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), (F.col("p_partkey") % 5).alias("c"))
    base = p.join(F.broadcast(spark.createDataFrame([(0, "a", 1), (1, "a", 1), (0, "b", 2), (1, "b", 2)], "chunk_index int, provider string, provider_rank int")), F.lit(True))
    first = F.expr("CASE WHEN provider = 'a' AND c = 2 AND chunk_index = 1 THEN '{\"m\": 1}' WHEN provider = 'a' AND c = 3 THEN '{\"m\": 1}' WHEN provider = 'a' AND c = 4 THEN 'no' WHEN c = 4 THEN '{\"n\": \"x\"}' ELSE '{\"n\": 1,}' END")
    plain = base.select("doc_id", "chunk_index", "provider", "provider_rank", F.lit(False).alias("is_repair"), F.expr("CASE WHEN provider = 'a' AND c = 1 THEN 429 ELSE 200 END").alias("status_code"), first.alias("raw_text"))
    mended = base.where("provider = 'a' AND c IN (2, 3) AND (c = 3 OR chunk_index = 1)").select("doc_id", "chunk_index", "provider", "provider_rank", F.lit(True).alias("is_repair"), F.lit(200).alias("status_code"), F.lit('```{"n": 2}```').alias("raw_text"))
    schema = validate.Schema({"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}})
    chosen = answers.choose_provider(answers.checked(plain.union(mended), schema), p.select("doc_id", F.lit(2).alias("n_chunks")))
    return chosen.select("doc_id", "provider", F.array_join("failures", "|").alias("failures"))


# --- Whole plans, tabs and streams ---------------------------------------------------------------------------------------

@query(
    f"""SELECT sha256(concat('view|', sha256(c.url))) AS id, c.url AS canonical_url, d.title,
        CASE WHEN page_id % 4 != 0 THEN CASE WHEN page_id % 48 <= 24 THEN 'accepted_verified' ELSE 'rejected_stale' END WHEN page_id % 40 > 25 THEN 'rejected_unknown' ELSE 'accepted_inferred' END AS freshness_decision,
        CASE WHEN page_id % 4 != 0 THEN 'structured_feed_pubdate' WHEN page_id % 40 > 25 THEN 'heuristic_deep_listing_position' ELSE 'heuristic_stateful_new_since_last_run' END AS date_extraction_method, d.n_chars
    FROM (SELECT page_id, {_SIGNAL} AS url FROM (SELECT page_id, trim(url) AS t FROM pages)) c
    JOIN (SELECT {_SIGNAL} AS url, arg_min({_TITLE_SQL}, page_id) AS title, CAST(length(arg_min({_unescaped_sql('said')}, page_id)) AS INT) AS n_chars FROM (SELECT *, trim(url) AS t FROM {_ARTICLE_SQL}) GROUP BY ALL) d USING (url)"""
)
def signal_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as news of one source, dated by their feed; decisions by page."""
    pages = table(spark, sf_dir, "pages")
    feed_date = F.date_format(_reference() - F.make_dt_interval(F.lit(0), (F.col("page_id") % 48).cast("int")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    candidates = pages.select(
        F.lit("view").alias("source_id"), F.col("url").alias("raw_url"), F.lit("").alias("title"), F.when(F.col("page_id") % 4 != 0, feed_date).alias("published_date_raw"), F.lit(None).cast("string").alias("author_or_company"), F.lit("").alias("description"),
        (F.col("page_id") % 40).cast("int").alias("position"), F.lit(None).cast("timestamp").alias("first_seen_at"),
    )
    details = dedup.keep_first(pages.select("page_id", urls.signal_url(F.col("url")).alias("canonical_url"), "html"), "canonical_url", ["page_id"])
    sources = spark.createDataFrame([("view", "View", "news", "https://x.example")], "source_id string, name string, type string, base_url string")
    done = signals.ingest(candidates, details, sources, _state(spark), _reference())
    return done.select("id", "canonical_url", "title", "freshness_decision", "date_extraction_method", F.length("full_text").alias("n_chars"))


def _tab_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = validate.validated(_records(spark, sf_dir))
    return good.withColumn("name", urls.stripped(F.col("name"))).withColumn("collected_at", F.lit("2024-01-15T00:00:00Z")).withColumn("authors", F.array(F.lit("A"), F.lit("B"))).withColumn("published_date", F.lit("2024"))


@query(f"SELECT '1.0' AS \"schemaVersion\", kind AS \"recordType\", source_name, source_url, '2024-01-15T00:00:00Z' AS \"collectedAt\", trim(name) AS \"entityName\", CASE WHEN employees = '12' THEN '12' ELSE '' END AS \"employeeCount\" FROM ({_RECORDS}) WHERE kind = 'STARTUP'")
def flat_startups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.flat_records(_tab_records(spark, sf_dir), "STARTUP")


@query(f"SELECT '' AS \"canonicalId\", '' AS \"canonicalName\", trim(name) AS \"rawEntityName\", CASE WHEN employees = '12' THEN '12' ELSE '' END AS \"employeeCount\", source_name AS \"sourceName\", source_url AS \"sourceUrl\", '2024-01-15T00:00:00Z' AS \"collectedAt\", 'UNRESOLVED' AS \"matchStrategy\", CAST(0 AS DOUBLE) AS confidence FROM ({_RECORDS}) WHERE kind = 'STARTUP'")
def tab_startups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.startups_tab(_tab_records(spark, sf_dir), spark.createDataFrame(SEED_ROWS, SEED))


@query(f"SELECT trim(name) AS \"startupName\", '' AS \"canonicalStartupId\", '' AS \"canonicalStartupName\", {_PRICED} AS \"pricingModel\", source_name AS \"sourceName\", source_url AS \"sourceUrl\", '2024-01-15T00:00:00Z' AS \"collectedAt\", 'UNRESOLVED' AS \"matchStrategy\", CAST(0 AS DOUBLE) AS confidence FROM ({_RECORDS}) WHERE kind = 'PRODUCT' AND {_PRICED} IS NOT NULL")
def tab_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.products_tab(_tab_records(spark, sf_dir), spark.createDataFrame(SEED_ROWS, SEED))


@query(f"SELECT trim(name) AS title, 'A; B' AS authors, source_url AS paper_url, CASE WHEN id % 4 = 0 THEN regexp_replace(repository, '\\.git/$', '') ELSE '' END AS github_url, CAST(stars AS VARCHAR) AS github_stars, '2024-01-15T00:00:00Z' AS github_stars_retrieved_at, '2024' AS published_date, source_name AS \"sourceName\", '2024-01-15T00:00:00Z' AS \"collectedAt\" FROM ({_RECORDS}) WHERE kind = 'RESEARCH_PAPER' AND stars >= 0")
def tab_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.papers_tab(_tab_records(spark, sf_dir))


@query(f"SELECT concat(kind, ':', id) AS \"sourceRecordId\", trim(name) AS \"normalizedEntityName\", 'UNRESOLVED' AS \"matchStrategy\", 'NO_MATCHING_ENTITY_FOUND' AS \"unresolvedReason\" FROM ({_RECORDS}) WHERE {_ERRORS} = '' AND kind != 'RESEARCH_PAPER'")
def tab_mapping_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = export.mapping_log(_tab_records(spark, sf_dir), spark.createDataFrame(SEED_ROWS, SEED), _reference())
    return log.select("sourceRecordId", "normalizedEntityName", "matchStrategy", "unresolvedReason")


_JOBS = "SELECT event_id AS id, concat('C', user_id) AS company, event_type AS title, CASE WHEN event_id % 2 = 0 THEN 'Here' END AS location, props AS full_text, CASE WHEN event_id % 3 = 0 THEN 'short' WHEN event_id % 3 = 1 THEN '' END AS summary FROM {0}"


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "events").createOrReplaceTempView("quern_events")
    df = spark.sql(_JOBS.format("quern_events"))
    none = F.lit(None).cast("string")
    return df.select("*", none.alias("employment_type"), none.alias("salary"), none.alias("author"), none.alias("published_at"), F.lit("accepted_verified").alias("freshness_decision"), F.col("title").alias("source_id"), F.lit("u").alias("canonical_url"), F.lit("2024-01-15").alias("ingested_at"))


@query(f"SELECT id, company, title, coalesce(location, '') AS location, '' AS \"employmentType\", '' AS salary, '' AS \"publishedAt\", 'accepted_verified' AS \"freshnessDecision\", title AS \"sourceId\", 'u' AS \"canonicalUrl\", '2024-01-15' AS \"collectedAt\" FROM ({_JOBS.format('events')})")
def tab_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.jobs_tab(_signals(spark, sf_dir))


@query(f"SELECT id, title, '' AS author, '' AS \"publishedAt\", 'accepted_verified' AS \"freshnessDecision\", title AS \"sourceId\", 'u' AS \"canonicalUrl\", coalesce(nullif(summary, ''), left(full_text, 200)) AS summary, '2024-01-15' AS \"collectedAt\" FROM ({_JOBS.format('events')})")
def tab_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.news_tab(_signals(spark, sf_dir))


@query(f"SELECT 'Startups' AS tab, count(*) AS n FROM ({_RECORDS}) WHERE kind = 'STARTUP' UNION ALL SELECT 'Jobs', count(*) FROM events UNION ALL SELECT 'Research Papers', count(*) FROM ({_RECORDS}) WHERE kind = 'RESEARCH_PAPER' AND stars >= 0")
def tab_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _tab_records(spark, sf_dir)
    return export.tab_counts({"Startups": records.where("kind = 'STARTUP'"), "Jobs": _signals(spark, sf_dir), "Research Papers": export.papers_tab(records)})


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    read = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 4).parquet(f"{path}*")
    return read.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT user_id, event_type, count(*) > 0 AS seen FROM events GROUP BY ALL")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrivals of each user and type, by a stream."""
    keyed = _event_stream(spark, sf_dir).withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    done = stream.run_to_end(stream.first_arrivals(keyed, "key", "ts", "60 days"), "dedup", stream.work_folder(spark))
    return done.select("user_id", "event_type", F.lit(True).alias("seen"))


@query(f"SELECT event_id, {_GATE_SQL} AS freshness_decision FROM events")
def stream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gated = stream.gated(_event_stream(spark, sf_dir), "ts", _reference()).select("event_id", "freshness_decision")
    return stream.run_to_end(gated, "gate", stream.work_folder(spark))


#: A run's items are known if the run before accepted their address. Runs in a row in which an address stands within the last
#: place, from the second run on, take turns: accepted, known, accepted and so on.
_UNDATED_SQL = """WITH e AS (SELECT event_type AS source_id, date_trunc('day', ts) AS run_at, sha256(CAST(user_id AS VARCHAR)) AS url_hash, CAST(event_id % 40 AS INT) AS position, dense_rank() OVER (PARTITION BY event_type ORDER BY date_trunc('day', ts)) AS r FROM events),
    k AS (SELECT *, r - row_number() OVER (PARTITION BY source_id, url_hash ORDER BY r) AS chain FROM (SELECT DISTINCT source_id, url_hash, r FROM e WHERE position <= 25 AND r > 1)),
    won AS (SELECT source_id, url_hash, r + 1 AS r FROM (SELECT *, row_number() OVER (PARTITION BY source_id, url_hash, chain ORDER BY r) AS nth FROM k) WHERE nth % 2 = 1),
    m AS (SELECT e.*, CASE WHEN e.r = 1 THEN 'heuristic_missing_baseline' WHEN won.r IS NOT NULL THEN 'heuristic_previously_observed' WHEN position > 25 THEN 'heuristic_deep_listing_position' ELSE 'heuristic_stateful_new_since_last_run' END AS method FROM e LEFT JOIN won USING (source_id, url_hash, r))
    SELECT source_id, strftime(run_at, '%Y-%m-%d') AS run_day, url_hash, position, CASE WHEN method LIKE '%last_run' THEN 'accepted_inferred' ELSE 'rejected_unknown' END AS decision, method FROM m"""


@query(_UNDATED_SQL)
def stream_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are runs of a source; every item is judged once."""
    items = _event_stream(spark, sf_dir).select(F.col("event_type").alias("source_id"), F.date_trunc("day", "ts").alias("run_at"), F.sha2(F.col("user_id").cast("string"), 256).alias("url_hash"), (F.col("event_id") % 40).cast("int").alias("position"))
    done = stream.run_to_end(stream.undated_gate(items), "undated", stream.work_folder(spark))
    return done.select("source_id", F.date_format("run_at", "yyyy-MM-dd").alias("run_day"), "url_hash", "position", "decision", "method")


@query(_bucket_sql("epoch_us(ts)", "SELECT key, allowed, count(*) AS n FROM s GROUP BY ALL"))
def stream_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = stream.run_to_end(stream.bucket(_event_stream(spark, sf_dir), "event_type", "ts"), "bucket", stream.work_folder(spark))
    return done.groupBy("key", "allowed").agg(F.count("*").alias("n"))
