"""Driver queries over the test tables and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` and runs over the whole input
tables (registry records, client records, catalogues and sheets are derived
from them, see ``adapters``). Computed columns carry the same aliases in the
Spark code and in the SQL text. Queries that exercise sinks write to a fresh
folder under the session's checkpoint root and read the result back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters
from .functions import canon, html_unescape, norm_date, query_param
from .operators.aggregates import (completeness, distinct_client_ids, duplicate_stats,
                                   providers_summary, run_summary, top_values, trend_per_year, union_all)
from .operators.dedup import dedup_first, dedup_richest, tie_hash
from .operators.flatten import flatten_clients, flatten_items
from .operators.joins import join_on_doi, label_server_name, merge_with_sheet, new_ids
from .operators.labels import label_records
from .operators.ledger import (chain_order, chain_order_problems, expected_vs_harvested, page_chain_problems,
                               read_checkpoints, run_ledger, signature_hash_col)
from .operators.quality import counts_vs_external, duplicate_gate, quality_gates, share_vs_expected, yearly_growth
from .operators.select import by_clients, by_label_type, by_type, in_range
from .operators.shards import read_footers, shard_columns, shard_report, unify_shards
from .plans.enrich import enrich_catalog, enrich_folder
from .plans.harvest import land, select_landed
from .plans.merge import merge_shards
from .plans.sheet import merge_catalog_with_sheet
from .schema import CLIENT_COLUMNS, SLIM_COLUMNS, WIDE_COLUMNS
from .session import scratch_path
from .sinks import write_catalog, write_chunks, write_csv, write_labelled, write_ndjson
from .sources.files import latest_dataset, shard_files
from .sources.items import items_from_text, page_meta, read_items, read_pages, read_rejects
from .sources.tables import read_catalog, read_client_ids, read_sheet
from .streaming.ingest import (compact_best_rows, ingest_records, maintain_best_rows, read_best_rows, read_best_state,
                               read_ingest_rejects, read_ingested, record_stream)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry items from ``orders`` flattened to the 38-column wide row."""
    return flatten_items(items_from_text(adapters.records_from_orders(spark, sf_dir)))


def client_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client records from ``supplier`` x ``nation`` x ``region``, flattened."""
    return flatten_clients(items_from_text(adapters.client_source(spark, sf_dir)))


def label_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client catalogue for labelling, one row per id (first customer wins)."""
    cat = adapters.run_sql(spark, adapters.LABEL_CATALOG_SQL,
                           customer=table(spark, sf_dir, "customer"))
    return dedup_first(cat, "id", ["c_custkey"]).select("id", "name", "displayName")


WIDE_CTE = f"WITH recs AS (\n{adapters.expected_wide_sql('orders')}\n)\n"
RICH_ORDER = ("((provider_id IS NOT NULL)::INT + (alternate_ids_json IS NOT NULL)::INT) DESC, "
              "registered ASC NULLS LAST, updated ASC NULLS LAST, created ASC NULLS LAST, "
              "sha256(raw_attributes_json) ASC NULLS LAST")
LABEL_CAT_CTE = (
    "cat0 AS (" + adapters.LABEL_CATALOG_SQL.replace("@customer@", "customer") + "),\n"
    "cat AS (SELECT id, name, displayName FROM (SELECT *, row_number() OVER "
    "(PARTITION BY id ORDER BY c_custkey) AS rn FROM cat0) t WHERE rn = 1)\n")
SERVER_NAME_SQL = ("coalesce(trim(CASE WHEN cat.name <> '' THEN cat.name "
                   "WHEN cat.displayName <> '' THEN cat.displayName ELSE '' END), '')")
CLIENTS_CTE = f"c AS ({adapters.expected_clients_sql()})\n"
CLIENT_SELECT = ", ".join(f'"{c}"' for c in CLIENT_COLUMNS)

Q = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ A / B / C

@query("q01_flatten_records", WIDE_CTE + "SELECT * FROM recs")
def q01_flatten_records(spark, sf_dir):
    return wide_records(spark, sf_dir)


@query("q02_type_canonical", WIDE_CTE + """
SELECT doi, client_id, resource_type_general, registered FROM recs
WHERE lower(resource_type_general) = 'preprint'""")
def q02_type_canonical(spark, sf_dir):
    return (by_type(wide_records(spark, sf_dir), "canonical", "Preprint")
            .select("doi", "client_id", "resource_type_general", "registered"))


@query("q03_type_label", WIDE_CTE + """
SELECT doi, client_id, resource_type, registered FROM recs
WHERE lower(trim(resource_type)) = 'preprint'""")
def q03_type_label(spark, sf_dir):
    return (by_label_type(wide_records(spark, sf_dir), "preprint")
            .select("doi", "client_id", "resource_type", "registered"))


@query("q04_type_both", WIDE_CTE + f"""
, sel AS (
  SELECT * FROM recs WHERE lower(resource_type_general) = 'preprint'
  UNION ALL
  SELECT * FROM recs WHERE lower(trim(resource_type)) = 'preprint'
)
SELECT doi, client_id, provider_id, resource_type, resource_type_general, registered FROM (
  SELECT *, row_number() OVER (PARTITION BY doi ORDER BY {RICH_ORDER}) AS rn FROM sel
) t WHERE rn = 1""")
def q04_type_both(spark, sf_dir):
    sel = by_type(wide_records(spark, sf_dir), "both", "Preprint", "preprint")
    return dedup_richest(sel).select("doi", "client_id", "provider_id", "resource_type",
                                     "resource_type_general", "registered")


_RANGE = ("1996-01-01", "1997-12-31")


@query("q05_date_range", WIDE_CTE + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS date_field, doi, {f} AS date_value FROM recs "
    f"WHERE substr({f}, 1, 10) BETWEEN '{_RANGE[0]}' AND '{_RANGE[1]}'"
    for f in ("created", "registered", "updated")))
def q05_date_range(spark, sf_dir):
    # One pass over the records: a row comes once for each field in the range.
    fields = ("created", "registered", "updated")
    wide = wide_records(spark, sf_dir).select("doi", *fields)
    hits = F.filter(F.array(*[F.struct(F.lit(f).alias("date_field"), F.col(f).alias("date_value"), in_range(f, *_RANGE).alias("hit"))
                              for f in fields]), lambda x: x["hit"])
    return wide.select("doi", F.explode(hits).alias("x")).select("x.date_field", "doi", "x.date_value")


_CLIENTS = [f"n{i % 25}.c{i % 40}" for i in range(0, 200, 7)] + ["c3", "unknown.client"]


@query("q06_client_filter", WIDE_CTE + "SELECT doi, client_id FROM recs WHERE client_id IN (" +
       ", ".join(f"'{c}'" for c in _CLIENTS) + ")")
def q06_client_filter(spark, sf_dir):
    return by_clients(wide_records(spark, sf_dir), _CLIENTS).select("doi", "client_id")


@query("q07_title_unescape", """
SELECT page_id, replace(replace(replace(replace(replace(
         regexp_extract(html, '<title>(.*?)</title>', 1),
         '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&copy;', '©'), '&amp;', '&') AS title
FROM pages""")
def q07_title_unescape(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    raw = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    return pages.select("page_id", html_unescape(raw).alias("title"))


@query("q08_canonical_json", "SELECT event_id, json(props)::VARCHAR AS props_json FROM events")
def q08_canonical_json(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.try_parse_json("props").alias("v")) \
        .select("event_id", canon("v", "$").alias("props_json"))


@query("q09_prefix_provider", WIDE_CTE + "SELECT doi, prefix, client_id, provider_id FROM recs")
def q09_prefix_provider(spark, sf_dir):
    return wide_records(spark, sf_dir).select("doi", "prefix", "client_id", "provider_id")


def _date_text_forms(ts):
    """``ts`` written in seven textual date forms (by event id)."""
    wk = F.concat(F.expr("cast(extract(YEAROFWEEK FROM ts) as string)"), F.lit("-W"),
                  F.lpad(F.weekofyear(ts).cast("string"), 2, "0"), F.lit("-"),
                  (((F.dayofweek(ts) + 5) % 7) + 1).cast("string"))
    k = F.col("event_id") % 7
    return (F.when(k == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
            .when(k == 1, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
            .when(k == 2, F.date_format(ts, "yyyy-MM"))
            .when(k == 3, F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit("Z")))
            .when(k == 4, F.date_format(ts, "MM/dd/yyyy HH:mm"))
            .when(k == 5, F.lit(""))
            .otherwise(wk))


@query("q10_norm_date", """
SELECT event_id,
       CASE event_id % 7 WHEN 2 THEN strftime(ts, '%Y-%m') WHEN 4 THEN strftime(ts, '%m/%d/%Y')
                         WHEN 5 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS norm_date
FROM events""")
def q10_norm_date(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", norm_date(_date_text_forms(F.col("ts"))).alias("norm_date"))


@query("q11_query_param", """
SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_param FROM pages""")
def q11_query_param(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", query_param("url", "page").alias("page_param"))


# ------------------------------------------------------------------- D

@query("q12_dedup_richest", """
SELECT doc_id, source, lang, n_chars, quality, toxic FROM (
  SELECT d.*, l.quality, l.toxic,
         row_number() OVER (PARTITION BY d.text ORDER BY
           ((l.quality IS NOT NULL)::INT + (l.toxic IS NOT NULL)::INT) DESC,
           d.source ASC NULLS LAST, d.doc_id ASC NULLS LAST) AS rn
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
) t WHERE rn = 1""")
def q12_dedup_richest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    best = dedup_richest(docs, key="text", rich=("quality", "toxic"), order=("source", "doc_id"),
                         tie_break=None)
    return best.select("doc_id", "source", "lang", "n_chars", "quality", "toxic")


@query("q12b_dedup_records", WIDE_CTE + f"""
SELECT doi, client_id, provider_id, alternate_ids_json, registered, updated, created FROM (
  SELECT *, row_number() OVER (PARTITION BY doi ORDER BY {RICH_ORDER}) AS rn FROM recs
) t WHERE rn = 1""")
def q12b_dedup_records(spark, sf_dir):
    return dedup_richest(wide_records(spark, sf_dir)).select(
        "doi", "client_id", "provider_id", "alternate_ids_json", "registered", "updated", "created")


@query("q13_dedup_first", """
SELECT source, lang, doc_id FROM (
  SELECT source, lang, doc_id,
         row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents
) t WHERE rn = 1""")
def q13_dedup_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return dedup_first(docs, ["source", "lang"], ["doc_id"]).select("source", "lang", "doc_id")


@query("q14_duplicate_rate", """
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
       sum(n - 1) / sum(n) AS dup_rate
FROM (SELECT text, count(*) AS n FROM documents GROUP BY text) t""")
def q14_duplicate_rate(spark, sf_dir):
    return duplicate_stats(table(spark, sf_dir, "documents"), "text")


# --------------------------------------------------------- clients (E/F)

@query("q15_distinct_clients", WIDE_CTE + """
SELECT DISTINCT trim(client_id) AS client_id FROM recs WHERE trim(client_id) <> ''""")
def q15_distinct_clients(spark, sf_dir):
    return distinct_client_ids(wide_records(spark, sf_dir))


@query("q15b_client_ids_landed", SQL["q15_distinct_clients"])
def q15b_client_ids_landed(spark, sf_dir):
    path = scratch_path(spark, "merged") + "/merged.parquet"
    wide_records(spark, sf_dir).write.parquet(path)
    return distinct_client_ids(read_client_ids(spark, path))


@query("q16_new_clients", """
SELECT DISTINCT cast(o_custkey AS VARCHAR) AS client_id FROM orders
WHERE cast(o_custkey AS VARCHAR) NOT IN (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'x' END || cast(c_custkey AS VARCHAR) FROM customer)""")
def q16_new_clients(spark, sf_dir):
    ids = distinct_client_ids(table(spark, sf_dir, "orders")
                              .select(F.col("o_custkey").cast("string").alias("client_id")))
    key = F.col("c_custkey").cast("string")  # half of the catalogue goes by other ids
    cat = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 2 == 0, key).otherwise(F.concat(F.lit("x"), key)).alias("id"))
    return new_ids(ids, cat)


@query("q17_client_flatten", "WITH " + CLIENTS_CTE + f"SELECT {CLIENT_SELECT} FROM c")
def q17_client_flatten(spark, sf_dir):
    return client_records(spark, sf_dir)


def _fetched_sql() -> str:
    cols = ", ".join(f"coalesce(c.\"{c}\", '') AS \"{c}\"" for c in CLIENT_COLUMNS if c != "id")
    return (f"SELECT n.id, {cols} FROM new_ids n "
            f"LEFT JOIN (SELECT * REPLACE (CASE WHEN s_suppkey % 10 = 9 THEN 'x' ELSE '' END || id AS id) FROM c) c "
            f"ON n.id = c.id")


@query("q18_catalog_upsert", "WITH " + CLIENTS_CTE + f""",
ids AS (SELECT DISTINCT 's' || cast(l_suppkey AS VARCHAR) AS id FROM lineitem),
existing AS (SELECT {CLIENT_SELECT} FROM c WHERE s_suppkey % 2 = 0),
new_ids AS (SELECT id FROM ids WHERE id NOT IN (SELECT id FROM existing)),
fetched AS ({_fetched_sql()})
SELECT * FROM existing UNION ALL SELECT * FROM fetched""")
def q18_catalog_upsert(spark, sf_dir):
    flat = client_records(spark, sf_dir)
    num = F.regexp_extract("id", r"^s(\d+)$", 1).cast("bigint")
    path = scratch_path(spark, "q18-catalog") + "/clients_catalog.csv"
    write_catalog(flat.filter(num % 2 == 0), path)
    existing = read_catalog(spark, path)
    # one in ten records answers to another id: its client gets a placeholder
    api = flat.withColumn("id", F.when(num % 10 == 9, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("client_id"))
    return enrich_catalog(rows, existing, api)


@query("q19_providers_summary", "WITH " + CLIENTS_CTE + """
SELECT provider_id, count(*) AS n_clients FROM c WHERE provider_id <> '' GROUP BY provider_id""")
def q19_providers_summary(spark, sf_dir):
    return providers_summary(client_records(spark, sf_dir))


@query("q20_label_server_name", WIDE_CTE + ", " + LABEL_CAT_CTE + f"""
SELECT recs.doi, recs.client_id, {SERVER_NAME_SQL} AS server_name
FROM recs LEFT JOIN cat ON trim(recs.client_id) = cat.id""")
def q20_label_server_name(spark, sf_dir):
    rows = wide_records(spark, sf_dir).select("doi", "client_id")
    return label_server_name(rows, label_catalog(spark, sf_dir))


def _year_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}') THEN substr({c}, 1, 4) END"


@query("q21_labelled_slim", WIDE_CTE + ", " + LABEL_CAT_CTE + "SELECT " + ", ".join(
    [f"recs.{c}" for c in SLIM_COLUMNS[:14]] +
    [f"{SERVER_NAME_SQL} AS server_name", f"{_year_sql('recs.created')} AS created_year",
     f"{_year_sql('recs.registered')} AS registered_year"]) +
    "\nFROM recs LEFT JOIN cat ON trim(recs.client_id) = cat.id")
def q21_labelled_slim(spark, sf_dir):
    labelled = label_records(wide_records(spark, sf_dir), label_catalog(spark, sf_dir))
    path = scratch_path(spark, "q21-labelled")
    write_labelled(labelled, path, "parquet")
    return spark.read.parquet(path)


# --------------------------------------------------------------- sheets

_SHEET_EXTRA = [("x1", "1", "0", "Lx1", -5), ("x2", "0", "1", "Lx2", -4), ("x3", "1", "1", "Lx3", -6),
                ("", "0", "0", "Lblank_a", -3), ("", "1", "1", "Lblank_b", -2)]
_CAT_EXTRA = [("", "blank1", "xx"), ("", "blank2", "xx")]

SHEET_CTE = ("WITH cat AS (SELECT cast(doc_id AS VARCHAR) AS id, source AS name, lang FROM documents" +
             "".join(f" UNION ALL SELECT '{a}', '{b}', '{c}'" for a, b, c in _CAT_EXTRA) + "),\n"
             "sheet0 AS (SELECT cast(doc_id AS VARCHAR) AS source_id, cast(quality AS VARCHAR) AS quality, "
             "cast(toxic AS VARCHAR) AS toxic, 'L' || cast(doc_id AS VARCHAR) AS name, doc_id * 10 AS ord "
             "FROM labels UNION ALL SELECT cast(doc_id AS VARCHAR), '9', '9', 'Ldup', doc_id * 10 + 5 "
             "FROM labels WHERE doc_id % 50 = 0" +
             "".join(f" UNION ALL SELECT '{a}', '{b}', '{c}', '{d}', {e}" for a, b, c, d, e in _SHEET_EXTRA) +
             "),\nsheet AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ord) "
             "AS rn FROM sheet0) t WHERE rn = 1)\n")
SHEET_SELECT = ("SELECT cat.id, cat.name AS name_x, cat.lang, sheet.source_id, sheet.quality, "
                "sheet.toxic, sheet.name AS name_y FROM cat ")


def _sheet_inputs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cat = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("name"), "lang")
    cat = cat.unionByName(spark.createDataFrame(_CAT_EXTRA, "id string, name string, lang string"))
    labels = table(spark, sf_dir, "labels")
    s = lambda c: F.col(c).cast("string")
    main = labels.select(s("doc_id").alias("source_id"), s("quality").alias("quality"),
                         s("toxic").alias("toxic"),
                         F.concat(F.lit("L"), s("doc_id")).alias("name"),
                         (F.col("doc_id") * 10).alias("_ord"))
    dup = labels.filter(F.col("doc_id") % 50 == 0).select(
        s("doc_id").alias("source_id"), F.lit("9").alias("quality"), F.lit("9").alias("toxic"),
        F.lit("Ldup").alias("name"), (F.col("doc_id") * 10 + 5).alias("_ord"))
    extra = spark.createDataFrame(_SHEET_EXTRA, "source_id string, quality string, toxic string, "
                                                "name string, _ord long")
    sheet_rows = main.unionByName(dup).unionByName(extra).withColumnRenamed("_ord", "_line")
    path = scratch_path(spark, "sheet") + "/sheet.csv"
    write_csv(sheet_rows, path)
    return cat, read_sheet(spark, path)


def _sheet_query(how):
    def run(spark, sf_dir):
        cat, sheet = _sheet_inputs(spark, sf_dir)
        return merge_with_sheet(cat, sheet, "id", "source_id", ["quality", "toxic", "name"], how)
    return run


_JOIN_SQL = {"left": "LEFT JOIN", "right": "RIGHT JOIN", "inner": "JOIN", "outer": "FULL OUTER JOIN"}
for _how, _name in (("left", "q22_sheet_left"), ("right", "q23_sheet_right"),
                    ("inner", "q24_sheet_inner"), ("outer", "q25_sheet_outer")):
    query(_name, SHEET_CTE + SHEET_SELECT + f"{_JOIN_SQL[_how]} sheet ON cat.id = sheet.source_id")(
        _sheet_query(_how))


# --------------------------------------------------------------- shards

def _shard_frames(orders: DataFrame):
    k = F.col("o_orderkey")
    base = [F.expr(adapters.DOI).alias("doi"), F.expr(adapters.CID).alias("client_id"),
            F.expr(adapters.DAY).alias("registered")]
    year = F.year("o_orderdate")
    a = orders.filter(k % 3 == 0).select(*base, year.cast("bigint").alias("published_year"),
                                         F.lit(None).cast("int").alias("language"),
                                         F.lit("[]").alias("url_alternate_json"))
    b = orders.filter(k % 3 == 1).select(*base, F.when(k % 7 != 0, year).cast("double")
                                         .alias("published_year"),
                                         (k % 10).cast("int").alias("score"),
                                         F.lit("[]").alias("url_alternate_json"))
    c = orders.filter(k % 3 == 2).select(*base, year.cast("bigint").alias("published_year"))
    return [a, b, c, a.limit(0)]


SHARDS_SQL = f"""
SELECT {adapters.DOI} AS doi, {adapters.CID} AS client_id, {adapters.DAY} AS registered,
       CAST(year(o_orderdate) AS BIGINT) AS published_year, CAST(NULL AS VARCHAR) AS language,
       '[]' AS url_alternate_json, CAST(NULL AS DOUBLE) AS score
FROM orders WHERE o_orderkey % 3 = 0
UNION ALL BY NAME
SELECT {adapters.DOI} AS doi, {adapters.CID} AS client_id, {adapters.DAY} AS registered,
       CAST(CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) END AS BIGINT) AS published_year,
       CAST(o_orderkey % 10 AS DOUBLE) AS score, '[]' AS url_alternate_json
FROM orders WHERE o_orderkey % 3 = 1
UNION ALL BY NAME
SELECT {adapters.DOI} AS doi, {adapters.CID} AS client_id, {adapters.DAY} AS registered,
       CAST(year(o_orderdate) AS BIGINT) AS published_year
FROM orders WHERE o_orderkey % 3 = 2"""


def _write_shards(spark, sf_dir) -> str:
    root = scratch_path(spark, "shards")
    for i, df in enumerate(_shard_frames(table(spark, sf_dir, "orders"))):
        df.write.mode("overwrite").parquet(f"{root}/run_2020-01-01_2020-12-31/batches/chunk_{i:05d}")
    return root


@query("q26_unify_shards", SHARDS_SQL)
def q26_unify_shards(spark, sf_dir):
    root = _write_shards(spark, sf_dir)
    return unify_shards(spark, shard_files(spark, [root, f"{root}/run_2020-01-01_2020-12-31"])).data


# ------------------------------------------------------- quality (F/G)

@query("q27_trend_per_year", WIDE_CTE + """
SELECT published_year, count(*) AS n_records FROM recs
WHERE published_year IS NOT NULL GROUP BY published_year""")
def q27_trend_per_year(spark, sf_dir):
    return trend_per_year(wide_records(spark, sf_dir))


@query("q28_top_providers", WIDE_CTE + """
SELECT provider_id, count(*) AS n_records FROM recs WHERE provider_id IS NOT NULL
GROUP BY provider_id ORDER BY n_records DESC, provider_id ASC LIMIT 20""")
def q28_top_providers(spark, sf_dir):
    return top_values(wide_records(spark, sf_dir), "provider_id", n=20)


@query("q29_completeness", WIDE_CTE + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
    f"count_if({c} IS NULL) / count(*) AS null_share FROM recs" for c in WIDE_COLUMNS))
def q29_completeness(spark, sf_dir):
    items = items_from_text(adapters.records_from_orders(spark, sf_dir))
    return completeness(flatten_items(items, render=False))


def _gates_sql() -> str:
    from .schema import COVERAGE_TARGETS, DATE_COLUMNS, REQUIRED_COLUMNS
    parts = []
    for c in REQUIRED_COLUMNS:
        parts.append(f"SELECT 'required' AS \"check\", '{c}' AS \"column\", count(*) AS n_rows, "
                     f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_hits, CAST(NULL AS DOUBLE) AS target, "
                     f"count_if({c} IS NULL) = 0 AS passed FROM recs")
    for c, t in COVERAGE_TARGETS:
        parts.append(f"SELECT 'coverage', '{c}', count(*), count({c}), CAST({t} AS DOUBLE), "
                     f"count({c}) > {t} * count(*) FROM recs")
    for c in DATE_COLUMNS:
        bad = f"count_if({c} IS NOT NULL AND NOT regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'))"
        parts.append(f"SELECT 'dates', '{c}', count(*), CAST({bad} AS BIGINT), CAST(NULL AS DOUBLE), "
                     f"{bad} = 0 FROM recs")
    return WIDE_CTE + "\nUNION ALL\n".join(parts)


@query("q30_quality_gates", _gates_sql())
def q30_quality_gates(spark, sf_dir):
    return quality_gates(wide_records(spark, sf_dir))


@query("q31_doi_join", WIDE_CTE + f"""
, ext AS (
  SELECT {adapters.DOI} AS doi, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
)
SELECT recs.doi, recs.client_id, ext.n_lines, ext.quantity FROM recs JOIN ext ON recs.doi = ext.doi""")
def q31_doi_join(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    ext = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .groupBy(F.expr(adapters.DOI).alias("doi"))
           .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("quantity")))
    recs = wide_records(spark, sf_dir).select("doi", "client_id")
    return join_on_doi(recs, ext)


@query("q32_growth_surge", """
SELECT year, n_records, prev_n,
       CASE WHEN prev_n > 0 THEN (n_records - prev_n) / prev_n END AS growth,
       coalesce(n_records > 2.0 * prev_n, false) AS surge
FROM (SELECT year, n_records, lag(n_records) OVER (ORDER BY year) AS prev_n
      FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n_records FROM lineitem
            WHERE l_shipdate IS NOT NULL GROUP BY 1) a) b""")
def q32_growth_surge(spark, sf_dir):
    return yearly_growth(table(spark, sf_dir, "lineitem"), F.year("l_shipdate"), 2.0)


@query("q33_counts_vs_external", """
SELECT coalesce(a.source, b.source) AS source, coalesce(a.n, 0) AS n_ours,
       coalesce(b.n, 0) AS n_external, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff,
       CASE WHEN coalesce(b.n, 0) > 0 THEN coalesce(a.n, 0) / b.n END AS ratio
FROM (SELECT source, count(*) AS n FROM documents GROUP BY source) a
FULL OUTER JOIN (SELECT d.source, count(*) AS n FROM labels l JOIN documents d ON l.doc_id = d.doc_id
                 GROUP BY d.source) b ON a.source = b.source""")
def q33_counts_vs_external(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    theirs = table(spark, sf_dir, "labels").join(docs.select("doc_id", "source"), "doc_id")
    return counts_vs_external(docs.select("source"), theirs.select("source"), "source")


# --------------------------------------------------------- ledger (H)

_LOST_TURN = 3  # the page of this turn lies under another cursor (and another run)
PAGES_CTE = f"""WITH mx AS (SELECT conv_id, max(turn) AS mt FROM conversations GROUP BY conv_id),
pages AS (SELECT c.conv_id, CASE WHEN c.turn = {_LOST_TURN} THEN 1000 + c.turn ELSE c.turn END AS turn,
                 CASE WHEN c.turn < mx.mt THEN c.turn + 1 END AS next_cursor,
                 CASE WHEN c.turn = {_LOST_TURN} THEN -1 - c.conv_id ELSE c.conv_id END AS run
          FROM conversations c JOIN mx ON c.conv_id = mx.conv_id)
"""


def _pages(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    mx = conv.groupBy("conv_id").agg(F.max("turn").alias("_mt"))
    lost = F.col("turn") == _LOST_TURN
    return conv.join(mx, "conv_id").select(
        "conv_id", F.when(lost, F.col("turn") + 1000).otherwise(F.col("turn")).alias("turn"),
        F.when(F.col("turn") < F.col("_mt"), F.col("turn") + 1).alias("next_cursor"),
        F.when(lost, -1 - F.col("conv_id")).otherwise(F.col("conv_id")).alias("run"))


@query("q34_page_chain", PAGES_CTE + """
SELECT p.conv_id, p.turn, p.next_cursor, 'gap' AS problem FROM pages p
WHERE p.next_cursor IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM pages q WHERE q.conv_id = p.conv_id AND q.turn = p.next_cursor)
UNION ALL SELECT conv_id, turn, next_cursor, 'not_advancing' FROM pages WHERE next_cursor <= turn
UNION ALL SELECT conv_id, max(turn), NULL, 'open_end' FROM pages WHERE next_cursor IS NULL
GROUP BY conv_id HAVING count(*) > 1""")
def q34_page_chain(spark, sf_dir):
    return page_chain_problems(_pages(spark, sf_dir), "conv_id", "turn", "next_cursor")


@query("q35_shard_report", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_over_limit, CAST(0 AS BIGINT) AS n_empty,
       CAST(0 AS BIGINT) AS n_unreadable FROM orders""")
def q35_shard_report(spark, sf_dir):
    root = scratch_path(spark, "chunks")
    rows = table(spark, sf_dir, "orders").select(
        F.expr(adapters.DOI).alias("doi"), F.expr(adapters.CID).alias("client_id"))
    write_chunks(rows, f"{root}/batches", max_rows=1000)
    rep = shard_report(read_footers(spark, shard_files(spark, root)), 1000)
    return rep.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
                   F.count_if("over_limit").alias("n_over_limit"),
                   F.count_if("empty").alias("n_empty"),
                   F.count_if(~F.col("readable")).alias("n_unreadable"))


_FOLDER = ("1800-01-01", "2025-11-07")


@query("q36_run_ledger", WIDE_CTE + f"""
, c AS (SELECT trim(client_id) AS cid, min(registered) AS dfrom, max(registered) AS duntil,
               count(*) AS n, max(doi) AS mdoi
        FROM recs WHERE client_id LIKE '%.%' AND registered IS NOT NULL GROUP BY 1)
SELECT cid AS client_id, CAST(NULL AS VARCHAR) AS query, 'preprint' AS resource_type_id,
       dfrom AS date_from, dfrom IS NULL AS no_range, duntil AS date_until, false AS finished,
       cast(n AS VARCHAR) || ',' || mdoi AS cursor_decoded, true AS hash_ok,
       substr(sha1('{{"client-id": "' || cid || '", "from-registered-date": "' || dfrom ||
                   '", "resource-type-id": "preprint", "until-registered-date": "' || duntil || '"}}'),
              1, 12) AS signature_hash,
       '{_FOLDER[0]}' AS folder_start, '{_FOLDER[1]}' AS folder_end
FROM c
UNION ALL
SELECT cid, 'types.resourceType:"preprint"', CAST(NULL AS VARCHAR), dfrom, dfrom IS NULL, duntil, true,
       CAST(NULL AS VARCHAR), true,
       substr(sha1('{{"client-id": "' || cid || '", "from-registered-date": "' || dfrom ||
                   '", "query": "types.resourceType:\\"preprint\\"", "until-registered-date": "' ||
                   duntil || '"}}'), 1, 12),
       '{_FOLDER[0]}', '{_FOLDER[1]}'
FROM c""")
def q36_run_ledger(spark, sf_dir):
    wide = wide_records(spark, sf_dir).filter(F.col("client_id").contains(".")
                                              & F.col("registered").isNotNull())
    per = wide.groupBy(F.trim("client_id").alias("cid")).agg(
        F.min("registered").alias("dfrom"), F.max("registered").alias("duntil"),
        F.count(F.lit(1)).alias("n"), F.max("doi").alias("mdoi"))
    base = {"from-registered-date": F.col("dfrom"), "until-registered-date": F.col("duntil"),
            "client-id": F.col("cid")}

    def sig(extra):
        items = {**base, **extra}
        return F.create_map(*[x for k, v in items.items() for x in (F.lit(k), v)])

    canonical = per.select(sig({"resource-type-id": F.lit("preprint")}).alias("signature"),
                           F.base64(F.encode(F.concat(F.col("n").cast("string"), F.lit(","),
                                                      F.col("mdoi")), "UTF-8")).alias("next_cursor"))
    label = per.select(sig({"query": F.lit('types.resourceType:"preprint"')}).alias("signature"),
                       F.lit(None).cast("string").alias("next_cursor"))
    docs = canonical.unionByName(label).withColumn("saved_at", F.lit("2025-11-07T00:00:00+00:00")) \
        .withColumn("checkpoint", signature_hash_col("signature"))
    root = f"{scratch_path(spark, 'ledger')}/{_FOLDER[0]}_{_FOLDER[1]}/checkpoints"
    docs.write.partitionBy("checkpoint").mode("overwrite").json(root)
    led = run_ledger(read_checkpoints(spark, root))
    return led.select("client_id", "query", "resource_type_id", "date_from",
                      F.col("date_from").isNull().alias("no_range"), "date_until", "finished",
                      "cursor_decoded", "hash_ok", "signature_hash", "folder_start", "folder_end")


BEST_EVENTS_SQL = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
    ((props IS NOT NULL)::INT + (value IS NOT NULL)::INT) DESC,
    ts ASC NULLS LAST, event_id ASC NULLS LAST) AS rn FROM events
) t WHERE rn = 1"""


def _best_events(spark, sf_dir, root: str, log: str | None):
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ev = table(spark, sf_dir, "events")
    ev.repartitionByRange("event_id").write.option("timestampFormat", fmt).json(f"{root}/landing")
    stream = (spark.readStream.schema(ev.schema).option("timestampFormat", fmt)
              .option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).json(f"{root}/landing"))
    maintain_best_rows(spark, stream, log, f"{root}/_checkpoint", key="user_id",
                       rich=("props", "value"), order=("ts", "event_id"),
                       state_partitions=spark.sparkContext.defaultParallelism)


@query("q37_stream_ingest", BEST_EVENTS_SQL)
def q37_stream_ingest(spark, sf_dir):
    """The best rows as the state store holds them."""
    root = scratch_path(spark, "stream")
    _best_events(spark, sf_dir, root, None)
    return read_best_state(spark, f"{root}/_checkpoint", "user_id").select("user_id", "event_id", "event_type", "value")


@query("q37b_stream_best_rows_state", BEST_EVENTS_SQL)
def q37b_stream_best_rows_state(spark, sf_dir):
    """The same from the log of updates, read from a compacted base."""
    root = scratch_path(spark, "stream-state")
    _best_events(spark, sf_dir, root, f"{root}/log")
    compact_best_rows(spark, f"{root}/log", "user_id")
    return read_best_rows(spark, f"{root}/log", "user_id").select("user_id", "event_id", "event_type", "value")


@query("q38_latest_dataset", """
SELECT 'merged_20240103_000000.parquet' AS name, count(*) AS n_rows FROM orders
WHERE o_orderkey % 3 = 2""")
def q38_latest_dataset(spark, sf_dir):
    root = scratch_path(spark, "merged")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for i in range(3):
        orders.filter(F.col("o_orderkey") % 3 == i).write.parquet(
            f"{root}/merged_2024010{i + 1}_000000.parquet")
    top = latest_dataset(spark, root, "merged_", ".parquet").collect()[0]
    return spark.read.parquet(top["path"]).agg(F.lit(top["name"]).alias("name"),
                                               F.count(F.lit(1)).alias("n_rows"))


@query("q39_expected_vs_harvested", PAGES_CTE + """,
e AS (SELECT conv_id, max(turn) + 1 AS n FROM conversations GROUP BY conv_id),
h AS (SELECT run, count(*) AS n FROM pages GROUP BY run)
SELECT coalesce(e.conv_id, h.run) AS run, coalesce(e.n, 0) AS expected, coalesce(h.n, 0) AS harvested,
       coalesce(e.n, 0) - coalesce(h.n, 0) AS missing, coalesce(e.n, 0) = coalesce(h.n, 0) AS complete
FROM e FULL OUTER JOIN h ON e.conv_id = h.run""")
def q39_expected_vs_harvested(spark, sf_dir):
    announced = (table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("run"))
                 .agg((F.max("turn") + 1).alias("expected")))
    return expected_vs_harvested(announced, _pages(spark, sf_dir).select("run"), "run")


@query("q39b_run_summary", WIDE_CTE + ", " + LABEL_CAT_CTE + """
, ids AS (SELECT trim(client_id) AS id, count(*) AS n FROM recs
          WHERE trim(client_id) <> '' GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS scanned_rows, count(*) AS unique_client_ids,
       CAST(count_if(cat.id IS NULL) AS BIGINT) AS new_clients FROM ids LEFT JOIN cat ON ids.id = cat.id""")
def q39b_run_summary(spark, sf_dir):
    return run_summary(wide_records(spark, sf_dir), label_catalog(spark, sf_dir))


@query("q40_ndjson_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q40_ndjson_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "ndjson")
    write_ndjson(docs, path, gzip=True)
    return spark.read.schema(docs.schema).json(path).select("doc_id", "text", "lang", "source", "n_chars")


# ------------------------------------------------ landed pages (A1, A2, H1)

def _land_pages(spark, sf_dir) -> str:
    path = scratch_path(spark, "landing") + "/pages"
    adapters.pages_from_orders(spark, sf_dir).select("value").write.text(path)
    return path


@query("q41_landed_items", SQL["q01_flatten_records"])
def q41_landed_items(spark, sf_dir):
    return flatten_items(read_items(spark, _land_pages(spark, sf_dir)))


@query("q42_page_meta", adapters.expected_page_meta_sql())
def q42_page_meta(spark, sf_dir):
    pages = read_pages(spark, _land_pages(spark, sf_dir))
    pages = pages.withColumn("page_no", F.try_variant_get("v", "$.meta.page", "bigint"))
    return page_meta(pages, keep=["page_no"]).select("page_no", "total", "n_items", "next_cursor")


@query("q43_stream_ingest_records", SQL["q01_flatten_records"])
def q43_stream_ingest_records(spark, sf_dir):
    landing = _land_pages(spark, sf_dir)
    root = scratch_path(spark, "ingest")
    ingest_records(spark, landing, f"{root}/out", f"{root}/_checkpoint",
                   max_files_per_trigger=spark.sparkContext.defaultParallelism)
    return read_ingested(spark, f"{root}/out")


@query("q44_stream_dedup_records", SQL["q12b_dedup_records"])
def q44_stream_dedup_records(spark, sf_dir):
    """The harvest as a stream: landed pages -> items -> wide rows -> best row
    per DOI kept in the state store, equal to the batch flagship (q12b)."""
    landing = _land_pages(spark, sf_dir)
    root = scratch_path(spark, "stream-harvest")
    cores = spark.sparkContext.defaultParallelism
    wide = flatten_items(record_stream(spark, landing, max_files_per_trigger=cores))
    maintain_best_rows(spark, wide, None, f"{root}/_checkpoint", key="doi",
                       rich=("provider_id", "alternate_ids_json"),
                       order=("registered", "updated", "created"), tie_break="raw_attributes_json",
                       state_partitions=cores)
    return read_best_state(spark, f"{root}/_checkpoint", "doi").select(
        "doi", "client_id", "provider_id", "alternate_ids_json", "registered", "updated", "created")


# ------------------------------------- catalogue, rejects and lookups

@query("q45_catalog_in_place", SQL["q18_catalog_upsert"])
def q45_catalog_in_place(spark, sf_dir):
    """The usual run, twice: the catalogue is read from, extended and replaced
    at one path."""
    flat = client_records(spark, sf_dir)
    num = F.regexp_extract("id", r"^s(\d+)$", 1).cast("bigint")
    path = scratch_path(spark, "q45-catalog") + "/clients_catalog.csv"
    write_catalog(flat.filter(num % 2 == 0), path)
    api = flat.withColumn("id", F.when(num % 10 == 9, F.concat(F.lit("x"), "id")).otherwise(F.col("id")))
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("client_id"))
    for _ in range(2):
        write_catalog(enrich_catalog(rows, read_catalog(spark, path), api), path)
    return read_catalog(spark, path)


_MIXED_SQL = f"""
SELECT CASE o_orderkey % 10 WHEN 1 THEN 'malformed' WHEN 2 THEN 'error' ELSE 'kept' END AS reason,
       {adapters.DOI} AS doi FROM orders"""


def _land_mixed(spark, sf_dir) -> str:
    """Landed lines of which some are cut off and some are error answers."""
    line = F.expr(f"""CASE o_orderkey % 10
      WHEN 1 THEN '{{"id": "' || {adapters.DOI} || '", "attributes": {{'
      WHEN 2 THEN '{{"errors": [{{"status": "404", "title": "' || {adapters.DOI} || '"}}]}}'
      ELSE '{{"id": "' || {adapters.DOI} || '", "attributes": {{"doi": "' || {adapters.DOI} || '"}}}}' END""")
    path = scratch_path(spark, "mixed") + "/landing"
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return path


def _rejected_doi(raw):
    return F.regexp_extract(raw, '"(?:id|title)": "([^"]*)"', 1).alias("doi")


@query("q46_quarantine", _MIXED_SQL)
def q46_quarantine(spark, sf_dir):
    path = _land_mixed(spark, sf_dir)
    bad = read_rejects(spark, path).select("reason", _rejected_doi("raw"))
    good = read_items(spark, path).select(F.lit("kept").alias("reason"),
                                          F.try_variant_get("v", "$.id", "string").alias("doi"))
    return bad.unionByName(good)


@query("q46b_stream_quarantine", _MIXED_SQL)
def q46b_stream_quarantine(spark, sf_dir):
    """The same lines as a stream that writes items and rejects in one pass."""
    root = scratch_path(spark, "q46b")
    ingest_records(spark, _land_mixed(spark, sf_dir), f"{root}/out", f"{root}/_checkpoint",
                   max_files_per_trigger=spark.sparkContext.defaultParallelism)
    bad = read_ingest_rejects(spark, f"{root}/out").select("reason", _rejected_doi("raw"))
    return bad.unionByName(read_ingested(spark, f"{root}/out").select(F.lit("kept").alias("reason"), "doi"))


@query("q47_client_lookup_docs", SQL["q17_client_flatten"])
def q47_client_lookup_docs(spark, sf_dir):
    """Client records landed as answers to single lookups."""
    path = scratch_path(spark, "q47") + "/lookups"
    answers = adapters.client_source(spark, sf_dir).select(F.concat(F.lit('{"data": '), "raw", F.lit("}")).alias("value"))
    answers.write.text(path)
    return flatten_clients(read_items(spark, path))


# --------------------------------------------- shards with faults

def _faulty_shards(spark, sf_dir) -> str:
    root = scratch_path(spark, "faulty-shards")
    orders = table(spark, sf_dir, "orders")
    doi, year, k = F.expr(adapters.DOI).alias("doi"), F.year("o_orderdate"), F.col("o_orderkey")
    text_year = F.when(k % 5 == 0, F.lit("n.d.")).otherwise(year.cast("string"))
    orders.filter(k % 2 == 0).select(doi, text_year.alias("published_year")).write.parquet(f"{root}/a")
    orders.filter(k % 2 == 1).select(doi, year.cast("bigint").alias("published_year"), F.struct(
        F.col("o_orderstatus").alias("en")).alias("publisher")).write.parquet(f"{root}/b")
    orders.select("o_orderstatus").write.text(f"{root}/c")  # no Parquet file at all
    return root


@query("q48_drifting_shards", f"""
SELECT {adapters.DOI} AS doi,
       CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 5 <> 0 THEN CAST(year(o_orderdate) AS BIGINT) END AS published_year,
       CASE WHEN o_orderkey % 2 = 1 THEN '{{"en":"' || o_orderstatus || '"}}' END AS publisher
FROM orders""")
def q48_drifting_shards(spark, sf_dir):
    files = shard_files(spark, _faulty_shards(spark, sf_dir), glob="part-*")
    return unify_shards(spark, files).data.select("doi", "published_year", "publisher")


@query("q48b_shard_faults", """
SELECT 'published_year' AS "column", count(*) AS n_rejected, true AS some_unreadable FROM orders
WHERE o_orderkey % 2 = 0 AND o_orderkey % 5 = 0""")
def q48b_shard_faults(spark, sf_dir):
    shards = unify_shards(spark, shard_files(spark, _faulty_shards(spark, sf_dir), glob="part-*"))
    unreadable = shards.files.where(~F.col("readable") & F.col("error").isNotNull()).limit(1).count() > 0
    return (shards.rejects.groupBy("column").agg(F.sum("n_rejected").alias("n_rejected"))
            .withColumn("some_unreadable", F.lit(unreadable)))


_CHUNK_KEYS = 1500  # keys of one chunk; the second and the third share a file, so there is a gap after them


@query("q52_shard_checks", f"""
WITH c AS (
  SELECT 'main' AS folder, CASE o_orderkey // {_CHUNK_KEYS} WHEN 2 THEN 1 ELSE o_orderkey // {_CHUNK_KEYS} END AS chunk_index
  FROM orders
  UNION ALL SELECT 'odd', o_orderkey // {3 * _CHUNK_KEYS} FROM orders WHERE o_orderkey % 3 = 0),
n AS (SELECT folder, chunk_index, count(*) AS n_rows FROM c GROUP BY ALL)
SELECT folder, chunk_index, n_rows, n_rows > {_CHUNK_KEYS} AS over_limit, n_rows = 0 AS empty,
       coalesce(chunk_index - lag(chunk_index) OVER (PARTITION BY folder ORDER BY chunk_index) > 1, false) AS gap_before,
       folder = 'main' AS schema_equal FROM n""")
def q52_shard_checks(spark, sf_dir):
    """Chunks by key range, so that their number follows the table: with a gap,
    one over the limit, and a folder of another layout."""
    root = scratch_path(spark, "q52")
    orders = table(spark, sf_dir, "orders")
    last = (orders.agg(F.max("o_orderkey")).first()[0] or 0) // _CHUNK_KEYS
    q = F.floor(F.col("o_orderkey") / _CHUNK_KEYS).cast("int")
    doi = F.expr(adapters.DOI).alias("doi")
    orders.select(doi, F.when(q == 2, 1).otherwise(q).alias("n")).repartitionById(last + 1, F.col("n")).select("doi") \
        .write.parquet(f"{root}/main")
    orders.where("o_orderkey % 3 = 0").select(doi, F.floor(q / 3).cast("int").alias("n")) \
        .repartitionById(last // 3 + 1, F.col("n")).write.parquet(f"{root}/odd")
    rep = shard_report(read_footers(spark, shard_files(spark, root)), max_rows=_CHUNK_KEYS, chunk_pattern=r"part-(\d+)")
    # partition 0 is written even without rows
    return rep.where("n_rows > 0").select(F.regexp_extract("folder", "([^/]*)$", 1).alias("folder"), "chunk_index", "n_rows",
                                          "over_limit", "empty", "gap_before", "schema_equal")


@query("q53_merged_output", SHARDS_SQL)
def q53_merged_output(spark, sf_dir):
    """Batch folders of a name are merged, written and read again."""
    done = merge_shards(spark, base_dir=_write_shards(spark, sf_dir), leaf_name="batches", dedup=False,
                        out_base=scratch_path(spark, "q53") + "/merged")
    return spark.read.parquet(done["parquet"])


@query("q54_first_clients", WIDE_CTE + """
SELECT DISTINCT trim(client_id) AS client_id FROM recs WHERE trim(client_id) <> '' ORDER BY client_id LIMIT 25""")
def q54_first_clients(spark, sf_dir):
    return distinct_client_ids(wide_records(spark, sf_dir), max_clients=25)


@query("q55_keep_server_name", WIDE_CTE + "SELECT doi, client_id, upper(client_id) AS server_name FROM recs")
def q55_keep_server_name(spark, sf_dir):
    rows = wide_records(spark, sf_dir).select("doi", "client_id", F.upper("client_id").alias("server_name"))
    return label_server_name(rows, label_catalog(spark, sf_dir), keep_existing=True)


_Q56 = {"a": ("doi", "client_id", "o_comment"), "b": ("doi", "registered")}


@query("q56_column_check", "\nUNION ALL\n".join(
    f"SELECT '{folder}' AS folder, c AS \"column\", CASE WHEN c = 'o_comment' THEN 'unexpected' WHEN c IN "
    f"({', '.join(repr(c) for c in have)}) THEN NULL ELSE 'missing' END AS problem, count(*) AS n_rows, "
    f"CASE WHEN c = 'registered' AND '{folder}' = 'b' THEN min({adapters.DAY}) END AS low, "
    f"CASE WHEN c = 'registered' AND '{folder}' = 'b' THEN max({adapters.DAY}) END AS high, "
    f"CASE WHEN c IN ({', '.join(repr(c) for c in have)}) THEN CAST(count_if(CASE c WHEN 'doi' THEN {adapters.DOI} "
    f"WHEN 'client_id' THEN {adapters.CID} WHEN 'registered' THEN {adapters.DAY} ELSE '' END IS NULL) AS BIGINT) END AS n_null "
    f"FROM orders, (SELECT unnest({[*WIDE_COLUMNS, 'o_comment']}) AS c) "
    f"WHERE o_orderkey % 2 = {i} AND (c <> 'o_comment' OR '{folder}' = 'a') GROUP BY c"
    for i, (folder, have) in enumerate(_Q56.items())))
def q56_column_check(spark, sf_dir):
    """Columns of landed shards against the expected ones, by the files' footers."""
    root = scratch_path(spark, "q56")
    cols = {"doi": F.expr(adapters.DOI), "client_id": F.expr(adapters.CID), "registered": F.expr(adapters.DAY), "o_comment": F.lit("")}
    orders = table(spark, sf_dir, "orders")
    for i, (folder, have) in enumerate(_Q56.items()):
        write_chunks(orders.where(F.col("o_orderkey") % 2 == i).select(*[cols[c].alias(c) for c in have]), f"{root}/{folder}", 2000)
    checked = shard_columns(read_footers(spark, shard_files(spark, root)))
    text = lambda c: F.when(F.col("column") == "registered", F.col(c))  # noqa: E731 - the other columns' bounds may be cut
    return (checked.withColumn("folder", F.regexp_extract("path", "([^/]*)/[^/]*$", 1)).groupBy("folder", "column", "problem")
            .agg(F.sum("n_rows").alias("n_rows"), F.min(text("low")).alias("low"), F.max(text("high")).alias("high"),
                 F.sum("n_null").alias("n_null")))


# ------------------------------------------------- landed pages: chain and totals

_CUT, _BACK = 3, 5  # of seven pages, one leads to no page and one to itself


@query("q49_landed_page_chain", f"""
WITH p AS (SELECT DISTINCT {adapters.K} // {adapters.PAGE_SIZE} AS n FROM orders),
l AS (SELECT n, n < (SELECT max(n) FROM p) AS linked FROM p),
c AS (SELECT n, to_base64(encode(cast(n * {adapters.PAGE_SIZE} AS VARCHAR))) AS cursor,
             to_base64(encode(cast(n * {adapters.PAGE_SIZE} + 1 AS VARCHAR))) AS lost FROM l WHERE linked)
SELECT 'gap' AS problem, cursor, lost AS next_cursor FROM c WHERE n % 7 = {_CUT}
UNION ALL SELECT 'not_advancing', cursor, cursor FROM c WHERE n % 7 = {_BACK}""")
def q49_landed_page_chain(spark, sf_dir):
    return page_chain_problems(_broken_pages(spark, sf_dir), "run").select("problem", "cursor", "next_cursor")


def _cursor(number):
    return F.base64(F.encode(number.cast("string"), "UTF-8"))


def _broken_pages(spark, sf_dir):
    """Landed pages of which some lead to no page and some to themselves."""
    n = F.col("page_no")
    to = F.when(n % 7 == _CUT, n * adapters.PAGE_SIZE + 1).when(n % 7 == _BACK, n * adapters.PAGE_SIZE)
    link = F.concat(F.lit("page%5Bcursor%5D="), F.url_encode(_cursor(to)))
    path = scratch_path(spark, "q49") + "/pages"
    adapters.pages_from_orders(spark, sf_dir).select(F.when(
        to.isNotNull(), F.regexp_replace("value", F.lit('page%5Bcursor%5D=[^&"]*'), link)).otherwise(
        F.col("value")).alias("value")).write.text(path)
    pages = read_pages(spark, path).withColumn("page_no", F.try_variant_get("v", "$.meta.page", "bigint"))
    return page_meta(pages, keep=["page_no"]).select(
        F.lit("run").alias("run"), _cursor(n * adapters.PAGE_SIZE).alias("cursor"), "next_cursor")


@query("q49b_landed_chain_order", f"""
WITH p AS (SELECT DISTINCT {adapters.K} // {adapters.PAGE_SIZE} AS n FROM orders),
last AS (SELECT max(n) AS n FROM p),
c AS (SELECT p.n, p.n < last.n AS linked, to_base64(encode(cast(p.n * {adapters.PAGE_SIZE} AS VARCHAR))) AS cursor,
             CASE p.n % 7 WHEN {_CUT} THEN p.n * {adapters.PAGE_SIZE} + 1 WHEN {_BACK} THEN p.n * {adapters.PAGE_SIZE}
                  ELSE (p.n + 1) * {adapters.PAGE_SIZE} END AS to_number FROM p, last),
l AS (SELECT n, linked, cursor, CASE WHEN linked THEN to_base64(encode(cast(to_number AS VARCHAR))) END AS next_cursor FROM c)
SELECT 'unreachable' AS problem, cursor, next_cursor FROM l WHERE n > {_CUT}
UNION ALL SELECT 'cycle', cursor, next_cursor FROM l WHERE linked AND n % 7 = {_BACK}
UNION ALL SELECT 'doubled_link', least(a.cursor, b.cursor), b.cursor FROM l a JOIN l b ON b.n = a.n + 1
WHERE b.linked AND b.n % 7 = {_BACK}""")
def q49b_landed_chain_order(spark, sf_dir):
    """The same pages as a whole: what the first page does not lead to, and rings."""
    return chain_order_problems(_broken_pages(spark, sf_dir), "run").select("problem", "cursor", "next_cursor")


@query("q50_landed_totals", """
SELECT 'run' AS run, count(*) AS expected, count(*) AS harvested, CAST(0 AS BIGINT) AS missing, true AS complete
FROM orders""")
def q50_landed_totals(spark, sf_dir):
    path = _land_pages(spark, sf_dir)
    announced = (page_meta(read_pages(spark, path)).agg(F.max("total").alias("expected"))
                 .select(F.lit("run").alias("run"), "expected"))
    return expected_vs_harvested(announced, read_items(spark, path).select(F.lit("run").alias("run")), "run")


@query("q51_release_gates", """
WITH d AS (SELECT count(*) AS n, count(DISTINCT coalesce(text, '')) AS k FROM documents),
g AS (SELECT source AS value, count(*) AS n_records FROM documents GROUP BY source)
SELECT 'duplicates' AS gate, CAST(NULL AS VARCHAR) AS value, n - k AS n_records, (n - k) / n AS share,
       CAST(0.01 AS DOUBLE) AS expected_share, (n - k) / n < 0.01 AS passed FROM d
UNION ALL
SELECT 'provider_share', value, n_records, n_records / n, CAST(0.05 AS DOUBLE), abs(n_records / n - 0.05) <= 0.05
FROM g, d""")
def q51_release_gates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    dup = duplicate_gate(docs.withColumn("text", F.coalesce("text", F.lit(""))), "text", 0.01).select(
        F.lit("duplicates").alias("gate"), F.lit(None).cast("string").alias("value"),
        F.col("n_duplicates").alias("n_records"), F.col("dup_rate").alias("share"),
        F.col("limit_rate").alias("expected_share"), "passed")
    want = docs.select(F.col("source").alias("value")).distinct().withColumn("expected_share", F.lit(0.05))
    share = share_vs_expected(docs, want, "source", 0.05).select(
        F.lit("provider_share").alias("gate"), "value", "n_records", "share", "expected_share", "passed")
    return dup.unionByName(share)


@query("q57_canonical_json_of_texts", """
SELECT doc_id, '{"a":' || CAST(n_chars // 4 AS VARCHAR) ||
       CASE n_chars % 4 WHEN 0 THEN '' WHEN 1 THEN '.25' WHEN 2 THEN '.5' ELSE '.75' END ||
       ',"b":["back\\\\slash","tab\\t","quo\\"te"],"z":' || CAST(to_json(text) AS VARCHAR) ||
       ',"é\\"k":null}' AS canonical FROM documents""")
def q57_canonical_json_of_texts(spark, sf_dir):
    """Whole document texts, decimals with needless zeros, escapes and keys out of order."""
    n = F.col("n_chars")
    number = F.concat((n / 4).cast("bigint").cast("string"), F.element_at(
        F.array(*[F.lit(x) for x in (".00", ".25", ".50", ".75")]), (n % 4 + 1).cast("int")))
    text = F.to_json(F.struct(F.col("text").alias("t")))
    raw = F.concat(F.lit('{"\u00e9\\"k": null, "z": '), F.expr("substr(t, 6, length(t) - 6)"),
                   F.lit(', "b": ["back\\\\slash", "tab\\t", "quo\\"te"], "a": '), number, F.lit("}"))
    docs = table(spark, sf_dir, "documents").withColumn("t", text)
    return docs.select("doc_id", canon(F.try_parse_json(raw), "$").alias("canonical"))


# ------------------------------------------------- selections on landed rows

_LANDED = [("canonical", "Preprint", None, ("1996-01-01", "1997-12-31")), ("label", "Preprint", "preprint", ("1995-06-01", "1996")),
           ("both", "Preprint", "preprint", (None, "1996-12-31T00:00:00Z"))]


def _landed_sql() -> str:
    fits = {"canonical": "(lower(resource_type_general) = 'preprint')::INT", "label": "(lower(trim(resource_type)) = 'preprint')::INT"}
    fits["both"] = f"coalesce({fits['canonical']}, 0) + coalesce({fits['label']}, 0)"
    return WIDE_CTE + "\nUNION ALL\n".join(
        f"SELECT '{mode}' AS selection, doi, client_id, registered, coalesce({fits[mode]}, 0) AS times FROM recs "
        f"WHERE coalesce({fits[mode]}, 0) > 0 AND substr(registered, 1, 10) <= '{until}'"
        + (f" AND substr(registered, 1, 10) >= '{since}'" if since else "") for mode, _, _, (since, until) in _LANDED)


@query("q58_landed_selections", _landed_sql())
def q58_landed_selections(spark, sf_dir):
    """Selections over rows landed with folded types and in date order; a row
    that "both" finds twice counts twice."""
    path = scratch_path(spark, "q58") + "/landed"
    land(wide_records(spark, sf_dir), path)
    parts = []
    for mode, type_id, label, (since, until) in _LANDED:
        got = select_landed(spark, path, type_mode=mode, type_id=type_id, label=label, date_start=since, date_end=until)
        # the digest stands for the whole text, which stays out of the shuffle
        parts.append(got.groupBy("doi", "client_id", "registered", tie_hash("raw_attributes_json").alias("record"))
                     .agg(F.count(F.lit(1)).cast("int").alias("times"))
                     .select(F.lit(mode).alias("selection"), "doi", "client_id", "registered", "times"))
    return union_all(parts)


# ------------------------------------------------- enriched sheet and labelled folder

@query("q59_enriched_catalog", SHEET_CTE.replace("source AS name, lang FROM documents", "coalesce(source, '') AS name, "
       "coalesce(lang, '') AS lang FROM documents") + "SELECT * FROM (" + SHEET_SELECT + "LEFT JOIN sheet ON cat.id = sheet.source_id), "
       "(SELECT unnest(['csv', 'parquet']) AS sink)")
def q59_enriched_catalog(spark, sf_dir):
    """Catalogue x sheet as a plan: both written files, read again."""
    root = scratch_path(spark, "q59")
    cat, sheet = _sheet_inputs(spark, sf_dir)
    write_csv(cat, f"{root}/catalog.csv")
    write_csv(sheet.select("source_id", "quality", "toxic", "name", F.col("_line.row").alias("_line")), f"{root}/sheet.csv")
    done = merge_catalog_with_sheet(spark, f"{root}/catalog.csv", f"{root}/sheet.csv", select_cols=["quality", "toxic", "name"],
                                    out_csv=f"{root}/out.csv", out_parquet=f"{root}/out.parquet")
    back = spark.read.parquet(done["out_parquet"])
    if back.count() != done["rows"]:
        raise AssertionError(f"{done['rows']} rows were counted while {back.count()} were written")
    # a CSV file does not tell an empty field from a missing one: unmatched rows are told by their key
    text = spark.read.schema(back.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(done["out_csv"])
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("id", "name_x", "lang")]
    matched = F.col("quality").isNotNull()
    keyed = [F.when(matched, F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("source_id", "quality", "toxic", "name_y")]
    return back.withColumn("sink", F.lit("parquet")).unionByName(text.select(*blank, *keyed).withColumn("sink", F.lit("csv")))


@query("q60_labelled_folder", SQL["q21_labelled_slim"])
def q60_labelled_folder(spark, sf_dir):
    """The usual run over a folder of merged datasets: its newest one extends
    the catalogue in place and is labelled from it."""
    root = scratch_path(spark, "q60")
    wide = wide_records(spark, sf_dir)
    wide.limit(0).write.parquet(f"{root}/merged/merged_20240101_000000.parquet")
    wide.write.parquet(f"{root}/merged/merged_20240102_000000.parquet")
    names = label_catalog(spark, sf_dir)
    write_catalog(names.select(*[F.col(c) if c in names.columns else F.lit("").alias(c) for c in CLIENT_COLUMNS]), f"{root}/catalog.csv")
    done = enrich_folder(spark, f"{root}/merged", "merged_", f"{root}/catalog.csv", client_records(spark, sf_dir))
    return spark.read.parquet(done["labelled_path"])


# ------------------------------------------------- whole chains (H5)

_CHAIN_SQL = """
WITH RECURSIVE mx AS (SELECT conv_id, max(turn) AS mt FROM conversations GROUP BY conv_id),
pages AS (
  SELECT c.conv_id, c.turn, CASE WHEN c.conv_id % 5 = 1 AND c.turn = mt THEN least(1, mt) WHEN c.turn = mt THEN NULL
    WHEN c.conv_id % 5 = 2 AND c.turn = 1 AND mt >= 3 THEN 3 WHEN c.conv_id % 5 = 3 AND c.turn = 1 THEN 1000
    ELSE c.turn + 1 END AS next_turn
  FROM conversations c JOIN mx ON c.conv_id = mx.conv_id),
led AS (SELECT DISTINCT conv_id, next_turn AS turn FROM pages WHERE next_turn <> turn),
first AS (SELECT p.conv_id, coalesce(min(CASE WHEN l.turn IS NULL THEN p.turn END), min(p.turn)) AS turn
          FROM pages p LEFT JOIN led l ON l.conv_id = p.conv_id AND l.turn = p.turn GROUP BY p.conv_id),
walk AS (SELECT conv_id, turn, 0 AS pos FROM first
         UNION SELECT p.conv_id, p.next_turn, pos + 1 FROM walk w JOIN pages p ON p.conv_id = w.conv_id AND p.turn = w.turn
         JOIN mx ON mx.conv_id = p.conv_id WHERE p.next_turn IS NOT NULL AND p.next_turn <= mt AND pos <= mt),
ring AS (SELECT conv_id, turn AS origin, next_turn AS turn, 1 AS n FROM pages WHERE next_turn IS NOT NULL
         UNION SELECT p.conv_id, r.origin, p.next_turn, n + 1 FROM ring r JOIN pages p ON p.conv_id = r.conv_id AND p.turn = r.turn
         JOIN mx ON mx.conv_id = p.conv_id WHERE p.next_turn IS NOT NULL AND n <= mt AND r.turn <> r.origin),
place AS (SELECT conv_id, turn, min(pos) AS position FROM walk GROUP BY ALL),
cycle AS (SELECT DISTINCT conv_id, origin AS turn FROM ring WHERE origin = turn)
"""


def _chain_pages(spark, sf_dir):
    """Conversations as chains of pages: some close to a ring, some leave a
    page out that still leads back in, some break off."""
    conv = table(spark, sf_dir, "conversations")
    last = conv.groupBy("conv_id").agg(F.max("turn").alias("mt"))
    kind, turn, mt = F.col("conv_id") % 5, F.col("turn"), F.col("mt")
    to = (F.when((kind == 1) & (turn == mt), F.least(F.lit(1), mt)).when(turn == mt, None)
          .when((kind == 2) & (turn == 1) & (mt >= 3), 3).when((kind == 3) & (turn == 1), 1000).otherwise(turn + 1))
    return conv.join(last, "conv_id").select("conv_id", "turn", to.cast("long").alias("next_turn"))


@query("q61_chain_order", _CHAIN_SQL + """
SELECT p.conv_id, p.turn, p.next_turn, CAST(position AS BIGINT) AS position, c.turn IS NOT NULL AS on_cycle
FROM pages p LEFT JOIN place ON place.conv_id = p.conv_id AND place.turn = p.turn
LEFT JOIN cycle c ON c.conv_id = p.conv_id AND c.turn = p.turn""")
def q61_chain_order(spark, sf_dir):
    return chain_order(_chain_pages(spark, sf_dir), "conv_id", "turn", "next_turn")


@query("q61b_chain_order_problems", _CHAIN_SQL + """
SELECT p.conv_id, p.turn, p.next_turn, 'unreachable' AS problem FROM pages p
LEFT JOIN place ON place.conv_id = p.conv_id AND place.turn = p.turn WHERE position IS NULL
UNION ALL SELECT p.conv_id, p.turn, p.next_turn, 'cycle' FROM pages p JOIN cycle c ON c.conv_id = p.conv_id AND c.turn = p.turn
UNION ALL SELECT conv_id, min(turn), next_turn, 'doubled_link' FROM pages WHERE next_turn IS NOT NULL
GROUP BY conv_id, next_turn HAVING count(*) > 1""")
def q61b_chain_order_problems(spark, sf_dir):
    return chain_order_problems(_chain_pages(spark, sf_dir), "conv_id", "turn", "next_turn")


QUERIES = Q
ORACLE = SQL
