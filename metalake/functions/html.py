"""HTML entity decoding of titles.

Spark has no built-in for the HTML5 entity table, so this is the package's
single vectorised UDF: Arrow batches, and only values that contain ``&`` are
sent through ``html.unescape`` (the rest pass as is, also on the JVM side).
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json import col_


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    mask = s.notna() & s.str.contains("&", regex=False)
    if not mask.any():
        return s
    out = s.copy()
    out[mask] = s[mask].map(html.unescape)
    return out


# Titles whose every "&" starts one of these complete references are decoded
# on the JVM; the result equals html.unescape because "&amp;" is replaced
# last (one left-to-right pass never re-reads its own output).
_SIMPLE = r"^[^&]*(?:&(?:amp|lt|gt|quot|apos|#39|#x27|#X27);[^&]*)*$"
_SIMPLE_REFS = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
                ("&#x27;", "'"), ("&#X27;", "'"), ("&amp;", "&")]


def _decode_simple(s: Column) -> Column:
    for ref, ch in _SIMPLE_REFS:
        s = F.replace(s, F.lit(ref), F.lit(ch))
    return s


def html_unescape(c) -> Column:
    # Only titles with other references reach the UDF; all other rows pass
    # NULL, so the Arrow batches stay small.
    s = col_(c)
    has_ref = F.instr(s, "&") > 0
    simple = s.rlike(_SIMPLE)
    return (F.when(~has_ref, s)
            .when(simple, _decode_simple(s))
            .otherwise(_unescape(F.when(has_ref & ~simple, s))))
