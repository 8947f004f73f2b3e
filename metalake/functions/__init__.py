"""Column functions (scalar, JVM-side except ``html_unescape``)."""

from .dates import norm_date
from .html import html_unescape
from .json import (canon, canon_or, is_missing, is_object, is_string, joined_members, json_members,
                   json_string_literal, member, member_or, python_sorted_json, vget, vstring)
from .text import (doi_prefix, first_truthy, infer_provider, query_param, strip, truthy,
                   year_from_iso)

__all__ = [
    "canon", "canon_or", "doi_prefix", "first_truthy", "html_unescape", "infer_provider",
    "is_missing", "is_object", "is_string", "joined_members", "json_members", "json_string_literal",
    "member", "member_or", "norm_date", "python_sorted_json", "query_param", "strip", "truthy", "vget", "vstring",
    "year_from_iso",
]
