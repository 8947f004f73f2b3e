"""String helpers with Python truthiness semantics, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .json import col_

# Python's str.strip() removes Unicode white space plus the separators
# U+001C..U+001F; SQL trim() only removes spaces.
_WS = r"[\s\x{1C}-\x{1F}]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def strip(c) -> Column:
    """``str.strip()``: NULL stays NULL."""
    return F.regexp_replace(col_(c), _STRIP_RE, "")


def truthy(c) -> Column:
    """NULL for NULL and ``""`` (a Python-falsy string), the value otherwise."""
    return F.nullif(col_(c), F.lit(""))


def first_truthy(*cols) -> Column:
    """``a or b or c``: the first non-empty value, else the last value as is."""
    *head, last = [col_(c) for c in cols]
    out = last
    for c in reversed(head):
        out = F.when(truthy(c).isNotNull(), c).otherwise(out)
    return out


def doi_prefix(prefix, doi) -> Column:
    """Registry prefix if truthy, else the DOI before its first ``/``.

    NULL when the DOI is empty or has no ``/`` (``substring_index`` alone
    would return the whole DOI).
    """
    d = col_(doi)
    from_doi = F.when(F.instr(d, "/") > 0, F.substring_index(d, "/", 1))
    return F.coalesce(truthy(prefix), from_doi)


def infer_provider(rel_provider, attr_provider, client_id) -> Column:
    """``rel or attr``; if still falsy and the client id has a dot, the part
    before the first dot; otherwise the falsy value is kept (``""`` stays)."""
    given = first_truthy(rel_provider, attr_provider)
    cid = col_(client_id)
    from_client = F.when(truthy(cid).isNotNull() & (F.instr(cid, ".") > 0),
                         F.substring_index(cid, ".", 1))
    return F.when(truthy(given).isNotNull(), given).otherwise(F.coalesce(from_client, given))


def year_from_iso(c) -> Column:
    """First four characters when they are all digits (any Unicode decimal
    digit, like ``str.isdigit``), else NULL; the result is a string."""
    s = col_(c)
    return F.when(s.rlike(r"^\p{Nd}{4}"), F.substring(s, 1, 4))


def query_param(url, name: str) -> Column:
    """First non-blank value of query parameter ``name`` in ``url``.

    Follows ``parse_qs(urlparse(url).query)``: the query is the text between
    the first ``?`` and ``#``; pairs are split on ``&``; key and value are
    percent-decoded with ``+`` as space; pairs without ``=`` or with an empty
    value are skipped.
    """
    query = F.regexp_extract(col_(url), r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: F.instr(p, "=") > 0)

    def dec(x):
        return F.try_url_decode(F.replace(x, F.lit("+"), F.lit(" ")))

    kv = F.transform(pairs, lambda p: F.struct(
        dec(F.substring_index(p, "=", 1)).alias("k"),
        dec(F.substr(p, F.instr(p, "=") + 1)).alias("v")))
    hits = F.filter(kv, lambda e: (e["k"] == F.lit(name)) & (F.length(e["v"]) > 0))
    return F.try_element_at(hits, F.lit(1))["v"]
