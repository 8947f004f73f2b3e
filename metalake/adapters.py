"""Registry-shaped inputs derived from the driver's test tables.

The test tables hold no registry records, so records are built from them by
SQL string concatenation; Spark parses the text exactly like landed files.
The same field specification renders

* the *raw* record text (keys in source order, Python's ``", "``/``": "``
  separators), which the Spark jobs parse and flatten, and
* the *canonical* text (sorted keys, compact), which the DuckDB oracle uses
  as the expected output,

so the oracle re-derives every flattened value from the base columns
without parsing JSON. Only ASCII values without quotes or backslashes are
generated, so no escaping is involved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------- JSON nodes


@dataclass
class Node:
    kind: str
    payload: object


def S(expr: str) -> Node:
    """A JSON string from a SQL string expression."""
    return Node("str", expr)


def LIT(text: str) -> Node:
    """A JSON literal written as is (``null``, ``[]``, ``true``...)."""
    return Node("lit", text)


def NUM(expr: str) -> Node:
    return Node("num", expr)


def OBJ(members: list) -> Node:
    return Node("obj", members)


def ARR(items: list) -> Node:
    return Node("arr", items)


def CASE(*branches, default: Node | None = None) -> Node:
    """First matching ``(condition, node)``; no match = absent member."""
    return Node("case", (list(branches), default))


def render(node: Node, canonical: bool) -> str:
    k, p = node.kind, node.payload
    if k == "str":
        return f"('\"' || {p} || '\"')"
    if k == "lit":
        return f"'{p}'"
    if k == "num":
        return f"cast({p} as string)"
    if k == "case":
        branches, default = p
        parts = " ".join(f"WHEN {c} THEN {render(n, canonical) if n is not None else 'NULL'}"
                         for c, n in branches)
        tail = f" ELSE {render(default, canonical)}" if default is not None else ""
        return f"(CASE {parts}{tail} END)"
    sep = "','" if canonical else "', '"
    if k == "arr":
        items = ", ".join(render(n, canonical) for n in p)
        return f"('[' || concat_ws({sep}, {items}) || ']')"
    if k == "obj":
        members = sorted(p, key=lambda m: m[0]) if canonical else p
        colon = ":" if canonical else ": "
        parts = ", ".join(f"('\"{key}\"{colon}' || {render(n, canonical)})" for key, n in members)
        return f"('{{' || concat_ws({sep}, {parts}) || '}}')"
    raise ValueError(k)


# ----------------------------------------------------------- dialect pieces


def _iso_week(day_expr: str, dialect: str) -> str:
    if dialect == "spark":
        return ("concat(cast(extract(YEAROFWEEK FROM {d}) as string), '-W', "
                "lpad(cast(weekofyear({d}) as string), 2, '0'), '-', "
                "cast(((dayofweek({d}) + 5) % 7) + 1 as string))").format(d=day_expr)
    return ("(cast(isoyear({d}) as string) || '-W' || lpad(cast(week({d}) as string), 2, '0') "
            "|| '-' || cast(isodow({d}) as string))").format(d=day_expr)


# ------------------------------------------------- records from ``orders``

K = "o_orderkey"
C = "o_custkey"
DOI = f"('10.' || cast(1000 + {C} % 10 as string) || '/o.' || cast({K} % 4000 as string))"
DOI_PREFIX = f"('10.' || cast(1000 + {C} % 10 as string))"
DAY = "cast(cast(o_orderdate as date) as string)"
YEAR = "cast(year(o_orderdate) as string)"
CID = f"('n' || cast({C} % 25 as string) || '.c' || cast({C} % 40 as string))"
RTG = "(CASE o_orderstatus WHEN 'F' THEN 'Preprint' WHEN 'O' THEN 'Text' ELSE 'Dataset' END)"
RT = ("(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'preprint' WHEN '2' THEN ' Preprint ' "
      "WHEN '3' THEN 'Article' WHEN '4' THEN 'Preprint' ELSE 'Report' END)")
ODD_TITLE = "Q &lt;i&gt; &#233;t&eacute; &quot;x&quot; &amp;amp;"
ODD_TITLE_PLAIN = 'Q <i> été "x" &amp;'


def _k(mod: int, op: str = "=", val: int = 0) -> str:
    return f"{K} % {mod} {op} {val}"


def _attributes(dialect: str) -> Node:
    types = OBJ([("resourceTypeGeneral", S(RTG)), ("resourceType", S(RT))])
    titles = CASE(
        (_k(17), None),
        (_k(19), LIT("[]")),
        (_k(13), ARR([S("o_orderpriority")])),
        (_k(23), ARR([OBJ([("lang", S("'en'"))])])),
        (_k(29), ARR([OBJ([("title", S(f"'{ODD_TITLE}'")), ("lang", S("'fr'"))])])),
        default=ARR([OBJ([("title", S("'P &amp; ' || o_orderpriority")), ("lang", S("'en'"))])]),
    )
    members = [
        ("doi", S(DOI)),
        ("url", CASE((_k(6, "<>", 5), S(f"'https://repo.example.org/o/' || cast({K} as string)")))),
        ("publisher", CASE((_k(10), OBJ([("name", S(f"'Pub ' || cast({C} % 5 as string)")),
                                         ("lang", S("'en'"))])),
                           default=S(f"'Publisher ' || cast({C} % 5 as string)"))),
        ("language", CASE((_k(4), S("'en'")), (_k(4, "=", 1), LIT("null")))),
        ("version", CASE((_k(5), S(f"'1.' || cast({K} % 3 as string)")))),
        ("schemaVersion", S("'http://schema.example.org/kernel-4'")),
        ("state", S("'findable'")),
        ("prefix", CASE((_k(3, "=", 1), S("''")), (_k(3, "=", 2), S(DOI_PREFIX)))),
        ("suffix", S(f"'o.' || cast({K} % 4000 as string)")),
        ("clientId", CASE((_k(8), S(f"' c' || cast({C} % 40 as string) || ' '")),
                          (_k(8, "=", 1), S(f"'c' || cast({C} % 40 as string)")))),
        ("providerId", CASE((_k(16, "=", 6), S(f"'prov' || cast({C} % 3 as string)")),
                            (f"{K} % 16 IN (8, 9)", S("''")))),
        ("types", CASE((_k(11, "<>", 0), types))),
        ("titles", titles),
        ("publicationYear", CASE((_k(14), LIT("null")), (_k(14, "=", 1), S("'n.d.'")),
                                 (_k(14, "=", 2), S(YEAR)), default=NUM(YEAR))),
        ("published", CASE((_k(7, "<>", 3), S(YEAR)))),
        ("created", CASE((_k(5), S(f"{DAY} || 'T08:15:00+02:00'")),
                         (_k(5, "=", 1), S(f"substr({DAY}, 1, 7)")),
                         (_k(5, "=", 2), S(f"replace({DAY}, '-', '')")),
                         (_k(5, "=", 3), S("''")))),
        ("registered", CASE((_k(31, "<>", 0), S(f"{DAY} || 'T00:00:00.000Z'")))),
        ("updated", CASE((_k(9), S(_iso_week("cast(o_orderdate as date)", dialect))),
                         (_k(9, "=", 1), S(f"{DAY} || ' 10:00'")),
                         default=S(f"{DAY} || 'T12:00:00Z'"))),
        ("creators", CASE((_k(4, "=", 1), LIT("null")), (_k(4, "=", 2), LIT("[]")),
                          (_k(4, "=", 3), ARR([OBJ([
                              ("nameType", S("'Personal'")),
                              ("name", S(f"'Customer ' || cast({C} as string)")),
                              ("affiliation", LIT("[]"))])])))),
        ("contributors", CASE((_k(6), ARR([OBJ([("name", S(f"'Editor ' || cast({C} % 7 as string)"))])])))),
        ("subjects", CASE((_k(3), ARR([OBJ([("subjectScheme", S("'priority'")),
                                             ("subject", S("o_orderpriority"))])])))),
        ("descriptions", CASE((_k(2), ARR([OBJ([
            ("descriptionType", S("'Abstract'")),
            ("description", S("'Order total ' || cast(cast(floor(o_totalprice) as bigint) as string)"))])])))),
        ("identifiers", LIT("[]")),
        ("alternateIdentifiers", CASE((_k(5), LIT("[]")), (_k(5, "=", 1), ARR([OBJ([
            ("alternateIdentifierType", S("'order'")),
            ("alternateIdentifier", S(f"cast({K} as string)"))])])))),
        ("relatedIdentifiers", CASE((_k(2, "=", 1), ARR([OBJ([
            ("relationType", S("'IsPartOf'")),
            ("relatedIdentifier", S(f"'10.9999/c.' || cast({C} as string)"))])])))),
        ("container", CASE((_k(8, "=", 3), OBJ([("type", S("'Series'")),
                                                ("title", S(f"'S' || cast({C} % 3 as string)"))])))),
        ("fundingReferences", CASE((_k(10, "=", 1), ARR([OBJ([
            ("funderName", S(f"'F' || cast({C} % 4 as string)"))])])))),
        ("rightsList", ARR([OBJ([("rights", S("'CC BY 4.0'"))])])),
        ("formats", CASE((_k(9, "=", 4), ARR([S("'pdf'")])))),
        ("urlAlternate", CASE((_k(13, "=", 5), LIT("[]")))),
    ]
    return OBJ(members)


def _client_ref() -> Node:
    return OBJ([("data", OBJ([("id", S(CID)), ("type", S("'clients'"))]))])


def _relationships() -> Node:
    provider = OBJ([("data", OBJ([("id", S(f"'n' || cast({C} % 25 as string)")),
                                  ("type", S("'providers'"))]))])
    return CASE(
        (_k(8), None),
        (_k(8, "=", 1), OBJ([("client", OBJ([("data", LIT("null"))]))])),
        (_k(8, "=", 2), OBJ([("client", _client_ref()), ("provider", provider)])),
        default=OBJ([("client", _client_ref())]),
    )


HAS_ATTRIBUTES = _k(50, "<>", 49)


def record_node(dialect: str) -> Node:
    return OBJ([("id", S(DOI)), ("type", S("'dois'")),
                ("attributes", CASE((HAS_ATTRIBUTES, _attributes(dialect)))),
                ("relationships", _relationships())])


def records_sql(dialect: str = "spark", table: str = "orders") -> str:
    """``raw`` JSON text per order (one registry item per row)."""
    return f"SELECT {K}, {render(record_node(dialect), canonical=False)} AS raw FROM {table}"


def expected_wide_sql(table: str = "orders") -> str:
    """Oracle: the 38 flattened columns per order, computed from the base
    columns (items without attributes are left out)."""
    attrs = _attributes("duckdb")
    m = dict(attrs.payload)
    canon = lambda key: render(m[key], True)
    title = (f"CASE WHEN {_k(17)} OR {_k(19)} THEN NULL WHEN {_k(13)} THEN o_orderpriority "
             f"WHEN {_k(23)} THEN NULL WHEN {_k(29)} THEN '{ODD_TITLE_PLAIN}' "
             f"ELSE 'P & ' || o_orderpriority END")
    provider = (f"CASE WHEN {_k(8, '=', 2)} THEN 'n' || cast({C} % 25 as string) "
                f"WHEN {_k(16, '=', 6)} THEN 'prov' || cast({C} % 3 as string) "
                f"WHEN {K} % 8 NOT IN (0, 1) THEN 'n' || cast({C} % 25 as string) "
                f"WHEN {K} % 16 IN (8, 9) THEN '' END")
    client = (f"CASE WHEN {_k(8)} THEN ' c' || cast({C} % 40 as string) || ' ' "
              f"WHEN {_k(8, '=', 1)} THEN 'c' || cast({C} % 40 as string) ELSE {CID} END")
    cols = {
        "doi": DOI,
        "url": f"CASE WHEN {_k(6, '<>', 5)} THEN 'https://repo.example.org/o/' || cast({K} as string) END",
        "publisher": (f"CASE WHEN {_k(10)} THEN '{{\"lang\":\"en\",\"name\":\"Pub ' || "
                      f"cast({C} % 5 as string) || '\"}}' ELSE 'Publisher ' || cast({C} % 5 as string) END"),
        "language": f"CASE WHEN {_k(4)} THEN 'en' END",
        "version": f"CASE WHEN {_k(5)} THEN '1.' || cast({K} % 3 as string) END",
        "schema_version": "'http://schema.example.org/kernel-4'",
        "state": "'findable'",
        "prefix": DOI_PREFIX,
        "client_id": client,
        "provider_id": provider,
        "resource_type": f"CASE WHEN {_k(11, '<>', 0)} THEN {RT} END",
        "resource_type_general": f"CASE WHEN {_k(11, '<>', 0)} THEN {RTG} END",
        "types_json": f"coalesce({canon('types')}, '{{}}')",
        "title": title,
        "titles_json": f"CASE WHEN {_k(17)} THEN '[]' ELSE {canon('titles')} END",
        "created": (f"CASE WHEN {_k(5)} OR {_k(5, '=', 2)} THEN {DAY} "
                    f"WHEN {_k(5, '=', 1)} THEN substr({DAY}, 1, 7) END"),
        "registered": f"CASE WHEN {_k(31, '<>', 0)} THEN {DAY} END",
        "updated": DAY,
        "published": f"CASE WHEN {_k(7, '<>', 3)} THEN {YEAR} END",
        "published_year": f"CAST(CASE WHEN {K} % 14 IN (0, 1) THEN NULL ELSE year(o_orderdate) END AS INTEGER)",
        "creators_json": f"CASE WHEN {K} % 4 IN (0, 1) THEN NULL ELSE {canon('creators')} END",
        "contributors_json": canon("contributors"),
        "subjects_json": canon("subjects"),
        "descriptions_json": canon("descriptions"),
        "identifiers_json": canon("identifiers"),
        "alternate_ids_json": canon("alternateIdentifiers"),
        "related_ids_json": canon("relatedIdentifiers"),
        "container_json": canon("container"),
        "funding_refs_json": canon("fundingReferences"),
        "rights_list_json": canon("rightsList"),
        "sizes_json": "CAST(NULL AS VARCHAR)",
        "formats_json": canon("formats"),
        "geo_locations_json": "CAST(NULL AS VARCHAR)",
        "references_json": "CAST(NULL AS VARCHAR)",
        "citations_json": "CAST(NULL AS VARCHAR)",
        "url_alternate_json": canon("urlAlternate"),
        "raw_attributes_json": _canonical_attributes(),
        "raw_relationships_json": f"coalesce({render(_relationships(), True)}, '{{}}')",
    }
    from .schema import WIDE_COLUMNS
    body = ",\n  ".join(f"{cols[c]} AS {c}" for c in WIDE_COLUMNS)
    return f"SELECT\n  {body}\nFROM {table}\nWHERE {HAS_ATTRIBUTES}"


def _canonical_attributes() -> str:
    """Canonical attributes text. Variant number normalisation leaves the
    integer ``publicationYear`` as is; the ``language: null`` member stays."""
    return render(_attributes("duckdb"), True)


def run_sql(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """``spark.sql`` over DataFrames named ``@name@`` in the text; literal
    braces (JSON text) are escaped for the parameter formatter."""
    text = sql.replace("{", "{{").replace("}", "}}")
    for name in frames:
        text = text.replace(f"@{name}@", "{" + name + "}")
    return spark.sql(text, **frames)


def records_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record per order in column ``raw`` (see ``records_sql``)."""
    from .session import spread_rows
    orders = spread_rows(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return run_sql(spark, records_sql("spark", "@orders@"), orders=orders)


# ------------------------------------------- client records from suppliers

S_K = "s_suppkey"


def _client_node() -> Node:
    attrs = OBJ([
        ("name", CASE((f"{S_K} % 7 = 1", S("''")), (f"{S_K} % 7 <> 0", S("s_name")))),
        ("displayName", CASE((f"{S_K} % 3 = 0", S(f"'Display ' || cast({S_K} as string)")))),
        ("symbol", S(f"'SYM' || cast({S_K} as string)")),
        ("clientType", S("'repository'")),
        ("isActive", CASE((f"{S_K} % 2 = 0", LIT("true")), default=LIT("false"))),
        ("year", NUM("2000 + s_nationkey")),
        ("description", CASE((f"{S_K} % 5 = 0", S("'Repo, nation ' || n_name")))),
        ("systemEmail", S(f"'sys' || cast({S_K} as string) || '@example.org'")),
        ("contactEmail", LIT("null")),
        ("url", S(f"'https://s' || cast({S_K} as string) || '.example.org'")),
        ("domains", CASE((f"{S_K} % 4 = 0", ARR([S(f"'a' || cast({S_K} as string) || '.org'"),
                                                 S("'b.org'")])),
                         (f"{S_K} % 4 = 1", LIT("[]")),
                         (f"{S_K} % 4 = 2", S("'*'")))),
        ("createdAt", S("'2019-01-0' || cast(1 + s_nationkey % 9 as string) || 'T00:00:00Z'")),
        ("updatedAt", S("'2024-02-0' || cast(1 + s_nationkey % 9 as string) || 'T00:00:00Z'")),
    ])
    rel = OBJ([
        ("provider", CASE((f"{S_K} % 6 <> 5", OBJ([("data", OBJ([("id", S("lower(n_name)")),
                                                               ("type", S("'providers'"))]))])))),
        ("member", OBJ([("data", OBJ([("id", S("lower(r_name)")), ("type", S("'members'"))]))])),
    ])
    return OBJ([("id", S(f"'s' || cast({S_K} as string)")), ("type", S("'clients'")),
                ("attributes", attrs), ("relationships", rel)])


def client_source_sql(supplier="supplier", nation="nation", region="region") -> str:
    return (f"SELECT s_suppkey, {render(_client_node(), False)} AS raw "
            f"FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey "
            f"JOIN {region} ON n_regionkey = r_regionkey")


def expected_clients_sql(supplier="supplier", nation="nation", region="region") -> str:
    """Oracle: the 20 catalogue columns of each supplier's client record."""
    name = f"CASE WHEN {S_K} % 7 IN (0, 1) THEN '' ELSE s_name END"
    cols = {
        "id": f"'s' || cast({S_K} as string)",
        "type": "'clients'",
        "name": name,
        "displayName": f"CASE WHEN {S_K} % 3 = 0 THEN 'Display ' || cast({S_K} as string) ELSE {name} END",
        "symbol": f"'SYM' || cast({S_K} as string)",
        "clientType": "'repository'",
        "isActive": f"CASE WHEN {S_K} % 2 = 0 THEN 'True' ELSE 'False' END",
        "year": "cast(2000 + s_nationkey as string)",
        "description": f"CASE WHEN {S_K} % 5 = 0 THEN 'Repo, nation ' || n_name ELSE '' END",
        "systemEmail": f"'sys' || cast({S_K} as string) || '@example.org'",
        "contactEmail": "''",
        "url": f"'https://s' || cast({S_K} as string) || '.example.org'",
        "domains": (f"CASE {S_K} % 4 WHEN 0 THEN 'a' || cast({S_K} as string) || '.org, b.org' "
                    f"WHEN 2 THEN '*' ELSE '' END"),
        "createdAt": "'2019-01-0' || cast(1 + s_nationkey % 9 as string) || 'T00:00:00Z'",
        "updatedAt": "'2024-02-0' || cast(1 + s_nationkey % 9 as string) || 'T00:00:00Z'",
        "provider_id": f"CASE WHEN {S_K} % 6 <> 5 THEN lower(n_name) ELSE '' END",
        "provider_type": f"CASE WHEN {S_K} % 6 <> 5 THEN 'providers' ELSE '' END",
        "member_id": "lower(r_name)",
        "member_type": "'members'",
        "raw_json": render(_client_node(), True),
    }
    from .schema import CLIENT_COLUMNS
    body = ",\n  ".join(f"{cols[c]} AS \"{c}\"" for c in CLIENT_COLUMNS)
    return (f"SELECT s_suppkey,\n  {body}\nFROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey "
            f"JOIN {region} ON n_regionkey = r_regionkey")


def client_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client records (``s_suppkey``, ``raw`` JSON) as the registry would
    return them for the supplier-derived client ids."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return run_sql(spark, client_source_sql("@supplier@", "@nation@", "@region@"),
                   supplier=read("supplier"), nation=read("nation"), region=read("region"))


# ------------------------------------------ labelling catalogue (customers)

LABEL_CATALOG_SQL = """
SELECT id, name, displayName, c_custkey FROM (
  SELECT CASE WHEN c_custkey % 200 < 170 THEN 'n' ELSE 'unused' END ||
         cast(c_custkey % 25 as string) || '.c' || cast(c_custkey % 40 as string) AS id,
         CASE (c_custkey % 200) % 6
              WHEN 0 THEN ''
              WHEN 1 THEN '  '
              ELSE c_name || ' ' END AS name,
         'D-' || c_mktsegment AS displayName,
         c_custkey
  FROM @customer@
) t
"""


# ------------------------------------------------ landed API pages (orders)

PAGE_SIZE = 1000
NEXT_URL = "https://api.example.org/dois?page%5Bcursor%5D="


def pages_from_orders(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """API pages as the harvester lands them: ``{"data": [...], "meta":
    {"total", "page"}, "links": {"next"}}``, one JSON document per row in
    column ``value``. A page holds the records of ``page_size`` consecutive
    order keys (a bounded group); the next link carries the base64 cursor
    of the following page, percent-encoded."""
    from pyspark.sql import functions as F

    from .session import tasks_for
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    stats = orders.agg(F.count(F.lit(1)).alias("n"), F.max(K).alias("mx")).collect()[0]
    last_page = int(stats["mx"]) // page_size if stats["mx"] is not None else 0
    # the narrow rows are dealt by page, to tasks of a bounded number of rows;
    # the records are made where their page is, and are not shuffled
    paged = orders.withColumn("page_no", F.expr(f"{K} div {page_size}")).repartition(tasks_for(spark, stats["n"]), "page_no")
    recs = run_sql(spark, f"SELECT page_no, {render(record_node('spark'), canonical=False)} AS raw FROM @orders@", orders=paged)
    pages = recs.groupBy("page_no").agg(F.concat_ws(", ", F.collect_list("raw")).alias("items"))
    cursor = F.base64(F.encode(((F.col("page_no") + 1) * page_size).cast("string"), "UTF-8"))
    nxt = F.when(F.col("page_no") < last_page,
                 F.concat(F.lit('"' + NEXT_URL), F.url_encode(cursor),
                          F.lit(f'&page%5Bsize%5D={page_size}"'))).otherwise(F.lit("null"))
    value = F.concat(F.lit('{"data": ['), F.col("items"), F.lit('], "meta": {"total": '),
                     F.lit(str(stats["n"])), F.lit(', "page": '), F.col("page_no").cast("string"),
                     F.lit('}, "links": {"next": '), nxt, F.lit("}}"))
    return pages.select("page_no", value.alias("value"))


def expected_page_meta_sql(page_size: int = PAGE_SIZE) -> str:
    return f"""
WITH p AS (SELECT {K} // {page_size} AS page_no, count(*) AS n_items FROM orders GROUP BY 1),
t AS (SELECT count(*) AS total, max({K}) // {page_size} AS last_page FROM orders)
SELECT p.page_no, t.total, CAST(p.n_items AS INTEGER) AS n_items,
       CASE WHEN p.page_no < t.last_page
            THEN to_base64(encode(cast((p.page_no + 1) * {page_size} AS VARCHAR))) END AS next_cursor
FROM p CROSS JOIN t"""
