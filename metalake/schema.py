"""Fixed column sets of the registry data model.

The names and orders below are fixed values: they must equal the source
pipeline's outputs so that downstream users see the same tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the 38 wide-row columns, in output order -----------------
WIDE_COLUMNS = [
    "doi", "url", "publisher", "language", "version", "schema_version", "state",
    "prefix", "client_id", "provider_id", "resource_type", "resource_type_general",
    "types_json", "title", "titles_json", "created", "registered", "updated",
    "published", "published_year", "creators_json", "contributors_json",
    "subjects_json", "descriptions_json", "identifiers_json", "alternate_ids_json",
    "related_ids_json", "container_json", "funding_refs_json", "rights_list_json",
    "sizes_json", "formats_json", "geo_locations_json", "references_json",
    "citations_json", "url_alternate_json", "raw_attributes_json",
    "raw_relationships_json",
]

# --- fixed values: JSON-valued wide columns and their attribute names -------
JSON_ATTRIBUTE_COLUMNS = [
    ("creators_json", "creators"),
    ("contributors_json", "contributors"),
    ("subjects_json", "subjects"),
    ("descriptions_json", "descriptions"),
    ("identifiers_json", "identifiers"),
    ("alternate_ids_json", "alternateIdentifiers"),
    ("related_ids_json", "relatedIdentifiers"),
    ("container_json", "container"),
    ("funding_refs_json", "fundingReferences"),
    ("rights_list_json", "rightsList"),
    ("sizes_json", "sizes"),
    ("formats_json", "formats"),
    ("geo_locations_json", "geoLocations"),
    ("references_json", "references"),
    ("citations_json", "citations"),
    ("url_alternate_json", "urlAlternate"),
]

# --- fixed values: the 20 client-catalogue columns, in output order ---------
CLIENT_COLUMNS = [
    "id", "type", "name", "displayName", "symbol", "clientType", "isActive", "year",
    "description", "systemEmail", "contactEmail", "url", "domains", "createdAt",
    "updatedAt", "provider_id", "provider_type", "member_id", "member_type", "raw_json",
]

# --- fixed values: the 17 labelled-output columns, in output order ----------
SLIM_COLUMNS = [
    "doi", "url", "publisher", "prefix", "client_id", "provider_id", "resource_type",
    "resource_type_general", "title", "created", "registered", "updated", "published",
    "published_year", "server_name", "created_year", "registered_year",
]

# --- fixed values: request filters that make up a run signature -------------
SIGNATURE_KEYS = [
    "resource-type-id", "query",
    "from-registered-date", "until-registered-date",
    "from-created-date", "until-created-date",
    "from-updated-date", "until-updated-date",
    "client-id",
]

# --- fixed values: metadata coverage targets (share of non-null rows) -------
COVERAGE_TARGETS = [
    ("creators_json", 0.85),
    ("subjects_json", 0.30),
    ("funding_refs_json", 0.10),
    ("related_ids_json", 0.40),
]

# --- fixed values: columns that must never be null --------------------------
REQUIRED_COLUMNS = ["doi", "registered"]

# Date columns that are kept as text (possibly partial dates).
DATE_COLUMNS = ["created", "registered", "updated"]

WIDE_SCHEMA = T.StructType([
    T.StructField(c, T.IntegerType() if c == "published_year" else T.StringType(), True)
    for c in WIDE_COLUMNS
])

CLIENT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CLIENT_COLUMNS])

# Target types for shard harmonisation; anything not listed is a string.
# ``score`` is forced to double.
SHARD_TYPE_OVERRIDES = {"published_year": T.LongType(), "score": T.DoubleType()}
