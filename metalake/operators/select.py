"""Record selectors as DataFrame predicates.

On landed Parquet these predicates reach the scan (``PushedFilters``) and skip
row groups: dates are kept as ``YYYY-MM-DD`` text, and a range of them is a
half-open range of the stored text itself; the case-insensitive types are
compared in folded columns that ``with_type_keys`` lands beside the rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strip

TYPE_MODES = ("canonical", "label", "both")
DATE_FIELDS = ("created", "registered", "updated")
#: Folded copies of the two type columns, as landed.
TYPE_KEY, LABEL_KEY = "_type_key", "_label_key"


def _type_key() -> Column:
    return F.lower(F.col("resource_type_general"))


def _label_key() -> Column:
    return F.lower(F.trim(F.col("resource_type")))


def with_type_keys(df: DataFrame) -> DataFrame:
    """Rows with the columns that type selections compare; landed so, a
    selection is an equality on a stored column."""
    return df.withColumns({TYPE_KEY: _type_key(), LABEL_KEY: _label_key()})


def _canonical(df: DataFrame, type_id: str) -> Column:
    return (F.col(TYPE_KEY) if TYPE_KEY in df.columns else _type_key()) == type_id.lower()


def _label(df: DataFrame, label: str) -> Column:
    return (F.col(LABEL_KEY) if LABEL_KEY in df.columns else _label_key()) == label.lower()


def by_canonical_type(df: DataFrame, type_id: str) -> DataFrame:
    """B1: ``resource_type_general`` equals the type id, case-insensitive."""
    return df.filter(_canonical(df, type_id))


def by_label_type(df: DataFrame, label: str) -> DataFrame:
    """B2: the free-text ``resource_type`` label equals ``label`` (trimmed,
    case-insensitive)."""
    return df.filter(_label(df, label))


def check_type_mode(mode: str, label: str | None = None) -> None:
    """Invalid selector modes fail before any plan is built."""
    if mode not in TYPE_MODES:
        raise ValueError(f"unknown type selection {mode!r}; choose one of {', '.join(TYPE_MODES)}")
    if mode != "canonical" and label is not None and str(label).strip() in ("", "None"):
        raise ValueError(f"invalid type label {label!r}")


def by_type(df: DataFrame, mode: str = "canonical", type_id: str = "Preprint",
            label: str | None = None) -> DataFrame:
    """B1-B3. ``both`` is a UNION ALL of the two passes (a row matching both
    appears twice); callers de-duplicate by DOI afterwards (D1)."""
    check_type_mode(mode, label)
    label = label or type_id
    if mode == "canonical":
        return by_canonical_type(df, type_id)
    if mode == "label":
        return by_label_type(df, label)
    # One pass: a row comes once for each selection it matches. On landed keys
    # the scan skips what matches neither.
    either = [_canonical(df, type_id), _label(df, label)]
    times = sum((F.coalesce(c, F.lit(False)).cast("int") for c in either[1:]), F.coalesce(either[0], F.lit(False)).cast("int"))
    if {TYPE_KEY, LABEL_KEY} <= set(df.columns):
        df = df.filter(either[0] | either[1])
    return df.withColumn("_times", F.explode(F.array_repeat(F.lit(0), times))).drop("_times")


def _after(text: str) -> str:
    """The least text above all that start with ``text``."""
    n = ord(text[-1]) + 1
    return text[:-1] + chr(0xE000 if n == 0xD800 else n)


def in_range(field: str, start: str | None = None, end: str | None = None) -> Column:
    """B5 as a condition: the first ten characters of the field lie in the
    inclusive range; ``end`` defaults to today; a NULL date lies in none.

    Bounds are put on the stored text, not on a part of it, so that they are
    compared with a file's statistics: ten characters at most ``end`` means
    text below all that could follow ``end``.
    """
    if field not in DATE_FIELDS:
        raise ValueError(f"date field must be one of {DATE_FIELDS}")
    d, end = F.col(field), str(end or date.today().isoformat())
    cond = d < _after(end[:10]) if len(end) >= 10 else d <= end
    if not start:
        return cond
    start = str(start)
    return cond & (d >= (_after(start[:10]) if len(start) > 10 else start))


def by_date_range(df: DataFrame, field: str = "registered", start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Rows whose date lies in the inclusive range (``in_range``)."""
    return df.filter(in_range(field, start, end))


def by_clients(df: DataFrame, client_ids, column: str = "client_id") -> DataFrame:
    """Keep the given clients. ``None`` is no selection and keeps all; an
    empty list or table of ids keeps nothing.

    A list of the caller's becomes an IN predicate, which reaches the scan;
    ids that come as data are a DataFrame and become a left-semi join.
    """
    if client_ids is None:
        return df
    if isinstance(client_ids, DataFrame):
        ids = client_ids.select(F.col(client_ids.columns[0]).alias("_cid"))
        return df.join(ids, F.col(column) == F.col("_cid"), "left_semi")
    return df.filter(F.col(column).isin(list(client_ids)))


def nonblank_ids(df: DataFrame, column: str = "client_id") -> DataFrame:
    """Stripped ids, NULL and blank ones dropped."""
    return df.select(strip(F.col(column)).alias(column)).filter(F.col(column) != "")
