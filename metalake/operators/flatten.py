"""C1 ``flatten_items`` (38-column wide row) and C8 ``flatten_clients``.

Plain projections of VARIANT path lookups: one step that looks every path up
once, one step that applies the null/empty rules to those columns. The
title's entity decoding is the one Arrow UDF, and only titles with entity
references beyond the five basic ones reach it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (canon, canon_or, doi_prefix, first_truthy, html_unescape,
                         infer_provider, is_missing, is_object, is_string, json_members, joined_members,
                         member, member_or, norm_date, truthy, vget, vstring)
from ..schema import JSON_ATTRIBUTE_COLUMNS, WIDE_COLUMNS


def _attr(key: str) -> str:
    return f"$.attributes.{key}"


def _extracted(v: str, render: bool = True) -> list[Column]:
    """Step 1: every VARIANT path looked up exactly once, as its own column.
    With ``render`` the members of ``attributes`` are made JSON text here, each
    once: the columns of single members and the whole text are taken from them.

    The derived rules in step 2 reference these columns several times; an
    expensive expression referenced more than once is not re-inlined by the
    optimizer, so each lookup runs once per row (and the generated code
    stays small enough to be JIT-compiled).
    """
    s = lambda key: vstring(v, _attr(key)).alias(f"_s_{key}")
    x = lambda path, name: vget(v, path).alias(name)
    first = "$.attributes.titles[0]"
    cols = [s(k) for k in ("doi", "url", "publisher", "language", "version", "schemaVersion",
                           "state", "prefix", "clientId", "providerId", "published")]
    cols += [
        vstring(v, "$.relationships.client.data.id").alias("_rel_client"),
        vstring(v, "$.relationships.provider.data.id").alias("_rel_provider"),
        vstring(v, "$.attributes.types.resourceType").alias("resource_type"),
        vstring(v, "$.attributes.types.resourceTypeGeneral").alias("resource_type_general"),
        vget(v, "$.attributes.publicationYear", "int").alias("published_year"),
        is_object(v, first).alias("_t0_is_object"),
        vstring(v, first + ".title").alias("_t0_title"), vstring(v, first).alias("_t0_text"),
        x("$.attributes", "_x_attributes"), x("$.relationships", "_x_relationships"),
    ]
    for d in ("created", "registered", "updated"):
        cols += [is_string(v, _attr(d)).alias(f"_is_str_{d}"), s(d)]
    if render:
        return cols + [json_members(v, "$.attributes").alias("_json")]
    return cols + [x(_attr(key), f"_x_{name}") for name, key in JSON_ATTRIBUTE_COLUMNS]


def _derived(render: bool = True) -> list[Column]:
    """Step 2: the 38 output columns from the step-1 columns. Without
    ``render`` no JSON or title text is made: such a column is ``""`` where it
    would hold a text and NULL where it would be NULL."""
    c = F.col
    if render:
        js, js_or, decoded = (lambda _, key: member("_json", key)), (lambda key, default: member_or("_json", key, default)), html_unescape
        raw, relationships = joined_members("_json", "_x_attributes"), canon_or("_x_relationships", "$", "{}")
    else:
        js, js_or, decoded = (lambda name, _: F.when(~is_missing(c(f"_x_{name}")), "")), (lambda *_: F.lit("")), (lambda x: x)
        raw, relationships = F.when(~is_missing(c("_x_attributes")), ""), F.lit("")
    client_id = first_truthy("_rel_client", "_s_clientId")
    out = {
        "doi": c("_s_doi"), "url": c("_s_url"), "publisher": c("_s_publisher"),
        "language": c("_s_language"), "version": c("_s_version"),
        "schema_version": c("_s_schemaVersion"), "state": c("_s_state"),
        "prefix": doi_prefix("_s_prefix", "_s_doi"),
        "client_id": client_id,
        "provider_id": infer_provider("_rel_provider", "_s_providerId", client_id),
        "resource_type": c("resource_type"),
        "resource_type_general": c("resource_type_general"),
        "types_json": js_or("types", "{}"),
        "title": decoded(F.when(c("_t0_is_object"), c("_t0_title")).otherwise(c("_t0_text"))),
        "titles_json": js_or("titles", "[]"),
        "published": c("_s_published"),
        "published_year": c("published_year"),
        "raw_attributes_json": raw,
        "raw_relationships_json": relationships,
    }
    for d in ("created", "registered", "updated"):
        out[d] = F.when(c(f"_is_str_{d}"), norm_date(c(f"_s_{d}")))
    for name, key in JSON_ATTRIBUTE_COLUMNS:
        out[name] = js(name, key)
    return [out[col].alias(col) for col in WIDE_COLUMNS]


def flatten_items(items: DataFrame, v: str = "v", keep=(), drop_without_attributes: bool = True,
                  render: bool = True) -> DataFrame:
    """C1 (+B7): one wide row per item; items without ``attributes`` are
    dropped. ``keep`` passes extra input columns through. ``render=False``
    serves counts of missing values (F7): texts are left empty."""
    if drop_without_attributes:
        items = items.filter(~is_missing(vget(v, "$.attributes")))
    keep = list(keep)
    return items.select(*_extracted(v, render), *keep).select(*_derived(render), *keep)


_CLIENT_PATHS = {
    "id": "$.id", "type": "$.type",
    **{k: f"$.attributes.{k}" for k in ("name", "displayName", "symbol", "clientType", "isActive",
                                        "year", "description", "systemEmail", "contactEmail",
                                        "url", "domains", "createdAt", "updatedAt")},
    "provider_id": "$.relationships.provider.data.id",
    "provider_type": "$.relationships.provider.data.type",
    "member_id": "$.relationships.member.data.id",
    "member_type": "$.relationships.member.data.type",
}


def flatten_clients(records: DataFrame, v: str = "v") -> DataFrame:
    """Client records -> the 20 catalogue columns, missing -> ``""``.

    ``displayName`` falls back to ``name``; a ``domains`` list is joined with
    ``", "`` (``[]`` -> ``""``), a plain string is kept; booleans are written
    ``True``/``False`` as the catalogue CSV holds them. ``raw_json`` is the
    canonical JSON of the record (sorted keys, compact separators). Like
    ``flatten_items``, every path is looked up once, then formatted.
    """
    step1 = [col for name, path in _CLIENT_PATHS.items() for col in (
        vstring(v, path).alias(f"_t_{name}"),
        (F.schema_of_variant(vget(v, path)) == F.lit("BOOLEAN")).alias(f"_b_{name}"))]
    step1 += [F.try_variant_get(F.col(v), "$.attributes.domains", "array<string>").alias("_domains"),
              canon(v, "$").alias("raw_json")]

    def text(name: str) -> Column:
        t = F.col(f"_t_{name}")
        return F.when(F.col(f"_b_{name}"), F.initcap(t)).otherwise(t)

    cols = {name: text(name) for name in _CLIENT_PATHS}
    cols["displayName"] = first_truthy(text("displayName"), text("name"))
    cols["domains"] = F.when(F.col("_domains").isNotNull(), F.array_join("_domains", ", ")) \
        .otherwise(text("domains"))
    cols["raw_json"] = F.col("raw_json")
    from ..schema import CLIENT_COLUMNS
    return records.select(*step1).select(
        *[F.coalesce(cols[c], F.lit("")).alias(c) for c in CLIENT_COLUMNS])


__all__ = ["flatten_clients", "flatten_items", "truthy"]
