"""Queries of single operators, straight over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import http_last_modified, period_columns
from sluice.functions.names import ingest_name, path_stem, path_suffix, strip_extension
from sluice.functions.numbers import decimal_comma, to_decimal
from sluice.layouts import REPORT_RENAMES, SILVER_KEYS
from sluice.operators import files, manifest, quality
from sluice.operators.quality import Rule
from sluice.operators.versions import unseen_versions
from sluice.plans.silver import VERSION, silver_candidates, silver_current
from checks.standins import before_noon, events_as_bronze
from sluice.sources import portal

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def checked(sql: str, name: str | None = None):
    """Register a query with its SQL, under its function's name unless another is given."""
    def register(query):
        QUERIES[name or query.__name__] = query
        ORACLES[name or query.__name__] = sql
        return query
    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# --- index pages -------------------------------------------------------------------------------------------------

LINKS_SQL = r"""
WITH clean AS (
  SELECT page_id, url AS base,
         regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g') AS html
  FROM pages),
found AS (
  SELECT page_id, base, regexp_extract_all(html,
         '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1) AS quoted
  FROM clean),
links AS (
  SELECT page_id, base, CAST(unnest(range(len(quoted))) AS INT) AS position,
         replace(trim(trim(unnest(quoted), '"'), ''''), '&amp;', '&') AS arquivo
  FROM found)
"""


@checked(LINKS_SQL + "SELECT arquivo, concat(base, arquivo) AS url, page_id, position FROM links "
                     "WHERE ends_with(arquivo, '/de')")
def portal_links(spark, folder):
    return portal.portal_links(read(spark, folder, "pages"), F.col("url"), "/de", order=("page_id",))


@checked(LINKS_SQL + "SELECT arquivo AS nome_arquivo, concat(base, arquivo) AS url FROM links "
                     "WHERE ends_with(arquivo, '/de')")
def portal_links_nodate(spark, folder):
    return portal.portal_links_nodate(read(spark, folder, "pages"), F.col("url"), "/de")


HEADERS_SQL = """
headers AS (
  SELECT concat(url, '/de') AS url, CASE WHEN contains(url, '?') THEN 'unknown' ELSE
         strftime(TIMESTAMP '2024-01-01' + to_seconds(length(html)), '%a, %d %b %Y %H:%M:%S GMT') END AS last_modified
  FROM pages)
"""


def page_headers(pages: DataFrame) -> DataFrame:
    """``Last-Modified`` texts as a server would send them, one per page; none it can tell for addresses with a query."""
    moment = F.timestamp_add("SECOND", F.length("html"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return pages.select(F.concat("url", F.lit("/de")).alias("url"),
                        F.when(F.contains("url", F.lit("?")), "unknown").otherwise(http_text(moment))
                        .alias("last_modified"))


def utc_naive(instant):
    """The UTC reading of an instant, whatever zone the session is in."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def http_text(moment):
    return F.concat(F.date_format(moment, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


@checked(LINKS_SQL + "," + HEADERS_SQL + """
SELECT arquivo, concat(base, arquivo) AS url, data_modificacao
FROM links LEFT JOIN (SELECT url, max(try_strptime(last_modified, '%a, %d %b %Y %H:%M:%S GMT')) AS data_modificacao
                      FROM headers GROUP BY url) times ON times.url = concat(base, arquivo)
WHERE ends_with(arquivo, '/de')
""")
def portal_listing(spark, folder):
    pages = read(spark, folder, "pages")
    listing = portal.portal_listing(portal.portal_links(pages, F.col("url"), "/de"), page_headers(pages))
    return listing.withColumn("data_modificacao", utc_naive(F.col("data_modificacao")))


# --- scalar functions --------------------------------------------------------------------------------------------

@checked("""
WITH texts AS (
  SELECT event_id, CASE event_type WHEN 'error' THEN props WHEN 'signup' THEN NULL
                   WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                   ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') END AS text
  FROM events)
SELECT event_id, try_strptime(text, '%a, %d %b %Y %H:%M:%S GMT') AS data_modificacao FROM texts
""", "http_last_modified")
def http_dates(spark, folder):
    kind = F.col("event_type")
    text = (F.when(kind == "error", F.col("props")).when(kind == "signup", None)
            .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise(http_text(F.col("ts"))))
    return read(spark, folder, "events").select(
        "event_id", utc_naive(http_last_modified(text)).alias("data_modificacao"))

FILE_NAMES_SQL = r"""
WITH names AS (
  SELECT event_id, ts, CASE event_type
    WHEN 'click' THEN concat('day.', user_id, '.zip') WHEN 'view' THEN concat('plain', user_id)
    WHEN 'error' THEN concat('d.x/', user_id, '.csv') WHEN 'signup' THEN concat('d.x/none', user_id)
    ELSE concat('.hidden', user_id) END AS path
  FROM events),
parts AS (SELECT *, split_part(path, '/', -1) AS base FROM names),
cut AS (SELECT *, CASE WHEN regexp_matches(base, '^.+\.[^.]+$') THEN regexp_extract(base, '(\.[^.]+)$', 1)
                  ELSE '' END AS suffix FROM parts)
"""


def file_names(events: DataFrame) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    path = (F.when(kind == "click", F.concat(F.lit("day."), user, F.lit(".zip")))
            .when(kind == "view", F.concat(F.lit("plain"), user))
            .when(kind == "error", F.concat(F.lit("d.x/"), user, F.lit(".csv")))
            .when(kind == "signup", F.concat(F.lit("d.x/none"), user))
            .otherwise(F.concat(F.lit(".hidden"), user)))
    return events.select("event_id", "ts", path.alias("path"))


@checked(FILE_NAMES_SQL + """
SELECT event_id, path, CASE WHEN contains(path, '.')
       THEN left(path, CAST(length(path) - length(split_part(path, '.', -1)) - 1 AS INT)) ELSE path END AS nome_arquivo
FROM cut
""", "strip_extension")
def strip_extensions(spark, folder):
    return (file_names(read(spark, folder, "events"))
            .select("event_id", "path", strip_extension(F.col("path")).alias("nome_arquivo")))


@checked(FILE_NAMES_SQL + """
SELECT event_id, left(base, CAST(length(base) - length(suffix) AS INT)) AS stem, suffix,
       concat(left(base, CAST(length(base) - length(suffix) AS INT)), '_', strftime(ts, '%Y%m%d%H%M%S'), suffix)
         AS arquivo_ingestao
FROM cut
""", "ingest_name")
def ingest_names(spark, folder):
    path = F.col("path")
    return file_names(read(spark, folder, "events")).select(
        "event_id", path_stem(path).alias("stem"), path_suffix(path).alias("suffix"),
        ingest_name(path, F.col("ts")).alias("arquivo_ingestao"))


@checked("""
SELECT l_orderkey, l_linenumber, l_partkey,
       TRY_CAST(CAST(l_extendedprice * l_discount AS VARCHAR) AS DECIMAL(18,2)) AS discounted,
       TRY_CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(18,2)) AS tax,
       TRY_CAST(CASE WHEN l_discount = 0 THEN l_returnflag ELSE CAST(l_discount AS VARCHAR) END AS DECIMAL(18,2)) AS discount
FROM lineitem
""")
def decimal_cast(spark, folder):
    product = (F.col("l_extendedprice") * F.col("l_discount")).cast("string")
    sometimes_no_number = F.when(F.col("l_discount") == 0, F.col("l_returnflag")).otherwise(
        F.col("l_discount").cast("string"))
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", to_decimal(product).alias("discounted"),
        to_decimal(F.col("l_tax").cast("string")).alias("tax"), to_decimal(sometimes_no_number).alias("discount"))


DECIMAL_COMMA_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey,
       TRY_CAST(replace(replace(CAST(l_extendedprice AS VARCHAR), '.', ','), ',', '.') AS DECIMAL(18,2)) AS price
FROM lineitem
"""


@checked(DECIMAL_COMMA_SQL, "decimal_comma")
def decimal_commas(spark, folder):
    text = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    return read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                  decimal_comma(text).alias("price"))


# --- headers, lineage, unions ------------------------------------------------------------------------------------

@checked("""
SELECT o_orderstatus AS "TP_FUNDO", o_custkey AS "CNPJ_FUNDO", o_orderdate AS "DT_COMPTC", o_totalprice AS "VL_TOTAL"
FROM orders
""")
def standardise_columns(spark, folder):
    drifted = read(spark, folder, "orders").select(
        F.col("o_orderstatus").alias(" TP_FUNDO_CLASSE "), F.col("o_custkey").alias("CNPJ_FUNDO_CLASSE"),
        F.col("o_orderdate").alias("DT_COMPTC "), F.col("o_totalprice").alias("VL_TOTAL"))
    return quality.standardise_columns(drifted, REPORT_RENAMES)


@checked("""
WITH texts AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE strftime(o_orderdate, '%Y-%m-%d') END
         AS "DT_COMPTC", concat('orders_', year(o_orderdate), '.csv') AS arquivo, o_orderdate AS data_modificacao
  FROM orders)
SELECT *, CAST(year(TRY_CAST("DT_COMPTC" AS DATE)) AS INT) AS ano, CAST(month(TRY_CAST("DT_COMPTC" AS DATE)) AS INT) AS mes
FROM texts
""")
def bronze_enrich(spark, folder):
    rows = read(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("DT_COMPTC"),
        F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string"), F.lit(".csv")).alias("arquivo"),
        F.col("o_orderdate").alias("data_modificacao"))
    return rows.withColumns(period_columns(F.col("DT_COMPTC")))


@checked("""
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier
UNION ALL SELECT n_name, n_nationkey, NULL, NULL FROM nation
""")
def bronze_union(spark, folder):
    return files.union_files([
        read(spark, folder, "customer").selectExpr("c_name name", "c_nationkey nation", "c_acctbal balance",
                                                   "c_mktsegment segment"),
        read(spark, folder, "supplier").selectExpr("s_acctbal balance", "s_name name", "s_nationkey nation"),
        read(spark, folder, "nation").selectExpr("n_nationkey nation", "n_name name")])


# --- file lists --------------------------------------------------------------------------------------------------

PLAN_SQL = """
WITH portal AS (SELECT concat('customer_', o_custkey, '.zip') AS arquivo, concat('orders/', o_custkey) AS url,
                       max(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END) AS data_modificacao
                FROM orders GROUP BY o_custkey),
landed AS (SELECT concat('customer_', o_custkey, '.zip') AS arquivo, o_orderdate AS data_modificacao
           FROM orders WHERE o_orderstatus = 'F'),
latest AS (SELECT arquivo, max(data_modificacao) AS landed_at FROM landed GROUP BY arquivo),
plan AS (SELECT p.* FROM portal p LEFT JOIN latest l ON l.arquivo = p.arquivo
         WHERE l.arquivo IS NULL OR p.data_modificacao > l.landed_at)
"""


def orders_as_manifests(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every customer's orders as one archive: the portal's version of it, and those that landed."""
    name = F.concat(F.lit("customer_"), F.col("o_custkey").cast("string"), F.lit(".zip")).alias("arquivo")
    settled = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    portal_files = (orders.groupBy("o_custkey").agg(F.max(settled).alias("data_modificacao"))
                    .select(name, F.concat(F.lit("orders/"), F.col("o_custkey").cast("string")).alias("url"),
                            "data_modificacao"))
    landed = orders.filter(F.col("o_orderstatus") == "F").select(name, F.col("o_orderdate").alias("data_modificacao"))
    return portal_files, landed


@checked(PLAN_SQL + "SELECT * FROM plan")
def manifest_diff(spark, folder):
    return manifest.manifest_diff(*orders_as_manifests(read(spark, folder, "orders")))


@checked(PLAN_SQL + "SELECT count(*) AS arquivos FROM plan")
def manifest_diff_count(spark, folder):
    return files.row_count(manifest.manifest_diff(*orders_as_manifests(read(spark, folder, "orders"))), "arquivos")


@checked("""
SELECT arg_max(concat('landing/', lang, '/'), doc_id) AS caminho_completo, source AS nome_arquivo
FROM documents GROUP BY source
""")
def ingest_plan(spark, folder):
    links = read(spark, folder, "documents").select(F.concat("source", F.lit(".zip")).alias("nome_arquivo"), "doc_id",
                                                    F.concat(F.lit("landing/"), "lang", F.lit("/")).alias("folder"))
    return manifest.ingest_plan(links, F.col("folder"), ["doc_id"])


@checked("SELECT c_name, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('MACHINERY', 'absent')")
def exclude_list(spark, folder):
    return manifest.exclude_names(read(spark, folder, "customer").select("c_name", "c_mktsegment"),
                                  ["MACHINERY", "absent"], "c_mktsegment")


def order_files(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_custkey").alias("arquivo"), F.col("o_orderdate").alias("data_modificacao"),
                         "o_orderkey", "o_orderstatus")


@checked("SELECT DISTINCT o_custkey AS arquivo, o_orderdate AS data_modificacao FROM orders WHERE o_orderstatus = 'F'")
def loaded_files(spark, folder):
    bronze = order_files(read(spark, folder, "orders")).filter(F.col("o_orderstatus") == "F")
    return files.loaded_files(bronze, ["arquivo", "data_modificacao"])


@checked("""
SELECT o_custkey AS arquivo, o_orderdate AS data_modificacao, o_orderkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderstatus = 'F' AND b.o_custkey = o.o_custkey
                  AND b.o_orderdate = o.o_orderdate)
""")
def bronze_new_rows(spark, folder):
    rows = order_files(read(spark, folder, "orders"))
    return files.new_rows(rows.drop("o_orderstatus"), rows.filter(F.col("o_orderstatus") == "F"),
                          ["arquivo", "data_modificacao"])


def line_members(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("l_orderkey").alias("nome_arquivo"), F.col("l_shipdate").alias("data_modificacao"),
                        F.col("l_suppkey").alias("origem_zip"), "l_linenumber", "l_linestatus", "l_returnflag")


@checked("""
SELECT l_orderkey AS nome_arquivo, l_shipdate AS data_modificacao, l_suppkey AS origem_zip, l_linenumber FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM lineitem c WHERE c.l_linestatus = 'F' AND c.l_orderkey = l.l_orderkey
                  AND c.l_shipdate = l.l_shipdate)
""")
def control_new_files(spark, folder):
    members = line_members(read(spark, folder, "lineitem"))
    return files.new_rows(members.drop("l_linestatus", "l_returnflag"), members.filter("l_linestatus = 'F'"),
                          ["nome_arquivo", "data_modificacao"])


@checked("""
SELECT l_orderkey AS nome_arquivo, l_shipdate AS data_modificacao, l_suppkey AS origem_zip, l_linenumber FROM lineitem l
WHERE EXISTS (SELECT 1 FROM lineitem c WHERE c.l_returnflag = 'R' AND c.l_orderkey = l.l_orderkey
              AND c.l_shipdate = l.l_shipdate)
""")
def members_to_extract(spark, folder):
    members = line_members(read(spark, folder, "lineitem"))
    return files.members_to_extract(members.drop("l_linestatus", "l_returnflag"), members.filter("l_returnflag = 'R'"),
                                    ["nome_arquivo", "data_modificacao"])


@checked("SELECT l_orderkey AS nome_arquivo, count(*) AS qtd_versoes FROM lineitem GROUP BY l_orderkey")
def file_versions(spark, folder):
    return files.file_versions(line_members(read(spark, folder, "lineitem")))


@checked("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, folder):
    return files.row_count(read(spark, folder, "lineitem"))


# --- schema checks -----------------------------------------------------------------------------------------------

CHECKED_ORDERS_SQL = """
WITH checked AS (
  SELECT concat('orders_', o_custkey, '_', year(o_orderdate), '.csv') AS arquivo, o_orderkey, o_orderstatus AS status,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, nullif(o_orderpriority, '5-LOW') AS note,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'pending'
              ELSE CAST(o_custkey AS VARCHAR) END AS quotas
  FROM orders),
failures AS (
  SELECT arquivo, o_orderkey AS row_id, 'priority' AS column_name, 'not_nullable' AS check_name,
         CAST(NULL AS VARCHAR) AS failure_case
  FROM checked WHERE priority IS NULL
  UNION ALL
  SELECT arquivo, o_orderkey, 'quotas', 'dtype(bigint)', quotas FROM checked
  WHERE NOT regexp_matches(quotas, '^[0-9]+$'))
"""
ORDER_RULES = (Rule("status"), Rule("priority"), Rule("note", nullable=True), Rule("quotas", kind="bigint"))


def checked_orders(orders: DataFrame) -> DataFrame:
    """Orders as files of one customer and year, with gaps and texts that break the rules."""
    customer, urgency = F.col("o_custkey").cast("string"), F.col("o_orderpriority")
    return orders.select(
        F.concat(F.lit("orders_"), customer, F.lit("_"), F.year("o_orderdate").cast("string"), F.lit(".csv"))
        .alias("arquivo"), "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.nullif(urgency, F.lit("4-NOT SPECIFIED")).alias("priority"), F.nullif(urgency, F.lit("5-LOW")).alias("note"),
        F.when((F.col("o_orderstatus") == "P") & (urgency == "1-URGENT"), "pending").otherwise(customer)
        .alias("quotas"))


def order_failures(rows: DataFrame) -> DataFrame:
    return quality.schema_failures(rows, ORDER_RULES, ["arquivo"], "o_orderkey")


@checked(CHECKED_ORDERS_SQL + "SELECT * FROM failures")
def schema_failures(spark, folder):
    return order_failures(checked_orders(read(spark, folder, "orders")))


@checked("""
SELECT DISTINCT concat('orders_', o_custkey, '.csv') AS arquivo, CAST(NULL AS BIGINT) AS row_id,
       'quotas' AS column_name, 'column_in_dataframe' AS check_name, 'quotas' AS failure_case
FROM orders
""")
def missing_columns(spark, folder):
    rows = read(spark, folder, "orders").select(
        F.concat(F.lit("orders_"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("arquivo"), "o_orderkey",
        F.col("o_orderstatus").alias("status"))
    return quality.schema_failures(rows, [Rule("status"), Rule("quotas", kind="bigint")], ["arquivo"], "o_orderkey")


@checked(CHECKED_ORDERS_SQL + "SELECT arquivo, count(*) AS failures FROM failures GROUP BY arquivo")
def failure_counts(spark, folder):
    return quality.failure_counts(order_failures(checked_orders(read(spark, folder, "orders"))), ["arquivo"])


@checked(CHECKED_ORDERS_SQL + "SELECT * FROM checked WHERE arquivo NOT IN (SELECT arquivo FROM failures)")
def accepted_rows(spark, folder):
    rows = checked_orders(read(spark, folder, "orders"))
    return quality.accepted_rows(rows, order_failures(rows), ["arquivo"])


@checked(CHECKED_ORDERS_SQL + "SELECT * FROM checked WHERE arquivo IN (SELECT arquivo FROM failures)")
def quarantined_rows(spark, folder):
    rows = checked_orders(read(spark, folder, "orders"))
    return quality.quarantined_rows(rows, order_failures(rows), ["arquivo"])


# --- silver ------------------------------------------------------------------------------------------------------

SILVER_SQL = """
WITH bronze AS (
  SELECT event_type AS tp, CAST(user_id AS VARCHAR) AS cnpj, strftime(ts, '%Y-%m-%d') AS dt,
         CAST(value AS VARCHAR) AS amount, ts, event_id
  FROM events),
latest AS (SELECT *, row_number() OVER (PARTITION BY cnpj, tp, dt ORDER BY ts DESC, amount DESC, event_id DESC) AS nr
           FROM bronze),
morning AS (SELECT *, row_number() OVER (PARTITION BY cnpj, tp, dt ORDER BY ts DESC, amount DESC, event_id DESC) AS nr
            FROM bronze WHERE hour(ts) < 12),
added AS (SELECT * FROM latest t WHERE nr = 1 AND NOT EXISTS (
            SELECT 1 FROM morning m WHERE m.nr = 1 AND m.cnpj = t.cnpj AND m.tp = t.tp AND m.dt = t.dt AND m.ts = t.ts))
"""
SILVER_SELECT = """
SELECT tp AS "TP_FUNDO", cnpj AS "CNPJ_FUNDO", CAST(dt AS DATE) AS "DT_COMPTC",
       CAST(amount AS DECIMAL(18,2)) AS "VL_TOTAL", CAST(amount AS DECIMAL(18,2)) AS "VL_QUOTA",
       CAST(amount AS DECIMAL(18,2)) AS "VL_PATRIM_LIQ", CAST(amount AS DECIMAL(18,2)) AS "CAPTC_DIA",
       CAST(amount AS DECIMAL(18,2)) AS "RESG_DIA", ts AS "DATA_MODIFICACAO"
FROM """


@checked(SILVER_SQL + SILVER_SELECT + "latest WHERE nr = 1")
def silver_latest(spark, folder):
    return silver_candidates(events_as_bronze(read(spark, folder, "events")))


@checked(SILVER_SQL + SILVER_SELECT + "added")
def silver_incremental(spark, folder):
    bronze = events_as_bronze(read(spark, folder, "events"))
    return unseen_versions(silver_candidates(bronze), silver_candidates(before_noon(bronze)), (*SILVER_KEYS, VERSION))


@checked(SILVER_SQL + SILVER_SELECT + "latest WHERE nr = 1", "silver_current")
def silver_state(spark, folder):
    bronze = events_as_bronze(read(spark, folder, "events"))
    loaded = silver_candidates(before_noon(bronze))
    return silver_current(loaded.unionByName(unseen_versions(silver_candidates(bronze), loaded,
                                                             (*SILVER_KEYS, VERSION))))
