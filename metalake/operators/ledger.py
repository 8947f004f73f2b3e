"""H3-H6: run signatures, checkpoint ledger, page-chain and total checks."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import python_sorted_json
from ..schema import SIGNATURE_KEYS
from ..session import kept
from ..sources.files import run_date_range
from .aggregates import union_all

CHECKPOINT_SCHEMA = "signature map<string,string>, next_cursor string, saved_at string"


def signature(params: dict) -> dict:
    """H3: the filter subset of request parameters that identifies a run."""
    return {k: params[k] for k in SIGNATURE_KEYS if k in params and params[k] is not None}


def signature_hash(params: dict) -> str:
    """H3: first 12 hex digits of SHA-1 over the sorted-key JSON text."""
    payload = json.dumps(signature(params), sort_keys=True, ensure_ascii=False)
    return hashlib.sha1(payload.encode("utf-8")).hexdigest()[:12]


def signature_hash_col(map_col) -> Column:
    """H3 as a column over ``map<string,string>`` signatures."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    keys = F.array(*[F.lit(k) for k in SIGNATURE_KEYS])
    kept = F.map_filter(m, lambda k, v: F.array_contains(keys, k) & v.isNotNull())
    return F.substring(F.sha1(F.encode(python_sorted_json(kept), "UTF-8")), 1, 12)


def read_checkpoints(spark: SparkSession, path) -> DataFrame:
    """Checkpoint documents (one JSON document per file, pretty-printed or
    not) with the file they came from."""
    return (spark.read.schema(CHECKPOINT_SCHEMA).option("multiLine", True).json(path)
            .withColumn("file", F.col("_metadata.file_path")))


def decoded_cursor(c: Column) -> Column:
    """The text inside a base64 cursor; NULL where it is neither base64 nor
    UTF-8."""
    return F.try_validate_utf8(F.try_to_binary(c, F.lit("base64")).cast("string"))


def cursor_order(c: Column, is_text: bool) -> Column:
    """What page cursors are ordered by: a number as it is; a text cursor by
    the number it starts with, then by the rest (``<time>,<doi>``), after
    decoding. A cursor of another form is ordered by its text."""
    if not is_text:
        return F.struct(c.cast("decimal(38,0)").alias("n"), F.lit("").alias("rest"))
    text = F.when(c.rlike("^[0-9]+$"), c).otherwise(F.coalesce(decoded_cursor(c), c))
    return F.struct(F.regexp_extract(text, "^([0-9]+)", 1).try_cast("decimal(38,0)").alias("n"),
                    F.regexp_replace(text, "^[0-9]+,?", "").alias("rest"))


def run_ledger(checkpoints: DataFrame) -> DataFrame:
    """H4: one row per checkpoint: stored vs recomputed hash, finished or
    open, the signature's date field and range, the range in the folder
    name, and the decoded cursor."""
    sig = F.col("signature")
    fields = ["registered", "created", "updated"]
    date_field = F.coalesce(*[F.when(sig.getItem(f"from-{f}-date").isNotNull() |
                                     sig.getItem(f"until-{f}-date").isNotNull(), F.lit(f))
                              for f in fields])
    dr = run_date_range(F.regexp_extract("file", r"^(.*)/[^/]*$", 1))
    return checkpoints.select(
        "file",
        F.nullif(F.regexp_extract("file", r"checkpoint[_=]([0-9a-f]{12})", 1), F.lit("")).alias("hash_in_name"),
        signature_hash_col(sig).alias("signature_hash"),
        date_field.alias("date_field"),
        F.coalesce(*[sig.getItem(f"from-{f}-date") for f in fields]).alias("date_from"),
        F.coalesce(*[sig.getItem(f"until-{f}-date") for f in fields]).alias("date_until"),
        dr["start"].alias("folder_start"), dr["end"].alias("folder_end"),
        sig.getItem("resource-type-id").alias("resource_type_id"),
        sig.getItem("query").alias("query"),
        sig.getItem("client-id").alias("client_id"),
        F.col("next_cursor"),
        F.col("next_cursor").isNull().alias("finished"),
        decoded_cursor(F.col("next_cursor")).alias("cursor_decoded"),
        "saved_at",
    ).withColumn("hash_ok", F.col("hash_in_name") == F.col("signature_hash"))


def page_chain_problems(pages: DataFrame, group_cols, cursor: str = "cursor",
                        next_cursor: str = "next_cursor") -> DataFrame:
    """H5: continuity of cursor-linked pages within each group.

    * ``gap``: a page's next cursor is no other page's cursor (left anti
      self join on group + cursor);
    * ``not_advancing``: next cursor not after the page's cursor
      (``cursor_order``);
    * ``open_end``: more than one page without a next cursor.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    linked = pages.filter(F.col(next_cursor).isNotNull())
    targets = pages.select(*group_cols, F.col(cursor).alias("_target"))
    text = pages.schema[cursor].dataType.simpleString() == "string"
    gaps = (linked.join(targets, [*[linked[c] == targets[c] for c in group_cols],
                                  linked[next_cursor] == targets["_target"]], "left_anti")
            .select(*group_cols, cursor, next_cursor, F.lit("gap").alias("problem")))
    back = (linked.filter(cursor_order(F.col(next_cursor), text) <= cursor_order(F.col(cursor), text))
            .select(*group_cols, cursor, next_cursor, F.lit("not_advancing").alias("problem")))
    ends = (pages.filter(F.col(next_cursor).isNull()).groupBy(*group_cols)
            .agg(F.count(F.lit(1)).alias("_n"), F.max(cursor).alias(cursor))
            .filter("_n > 1")
            .select(*group_cols, cursor, F.lit(None).cast(pages.schema[next_cursor].dataType)
                    .alias(next_cursor), F.lit("open_end").alias("problem")))
    return union_all([gaps, back, ends])


def chain_order(pages: DataFrame, group_cols, cursor: str = "cursor", next_cursor: str = "next_cursor") -> DataFrame:
    """H5 as a whole: one row per group and page with its ``position`` (0 for
    the first) on the way from the group's first page along the next cursors,
    NULL where that way does not lead, and whether the page lies on a cycle.

    The first page is the one with the smallest cursor among those that no
    other page leads to (in a closed ring, among all). Pages landed twice
    count once. Pointers are doubled: after k rounds every page knows the page
    2^k links ahead and all positions below 2^k are known, so that a chain of
    a million pages takes twenty rounds of two joins, each written to the
    shared folder. Joins are by group and cursor, so a long chain is no hot key.
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    text = pages.schema[cursor].dataType.simpleString() == "string"
    here = [F.col(c).alias(f"g{i}") for i, c in enumerate(group_cols)]
    g = [f"g{i}" for i in range(len(group_cols))]
    nodes = kept(pages.select(*here, F.col(cursor).alias("c"), F.col(next_cursor).alias("to")).groupBy(*g, "c")
                 .agg(F.min("to").alias("to")), "chain-pages")

    def ahead(left: DataFrame, jump: DataFrame, key: str) -> DataFrame:
        """``left`` with ``further``, where the pointer of its column ``key`` leads."""
        right = jump.select(*[F.col(x).alias(f"r_{x}") for x in g], F.col("c").alias("r_c"), F.col("to").alias("further"))
        same = [left[x].eqNullSafe(right[f"r_{x}"]) for x in g]
        return left.join(right, [*same, left[key].eqNullSafe(right["r_c"])]).drop("r_c", *[f"r_{x}" for x in g])

    real = nodes.where("to IS NOT NULL")
    ends = nodes.select(*g, F.col("c").alias("to"))
    jump = kept(real.join(ends.select(*[F.col(x).alias(f"e_{x}") for x in g], F.col("to").alias("e_to")),
                          [*[F.col(x).eqNullSafe(F.col(f"e_{x}")) for x in g], F.col("to") == F.col("e_to")]).select(*g, "c", "to"),
                "chain-jump")
    led = jump.where(~F.col("c").eqNullSafe(F.col("to"))).select(*[F.col(x).alias(f"e_{x}") for x in g], F.col("to").alias("e_to")).distinct()
    open_ = nodes.join(led, [*[F.col(x).eqNullSafe(F.col(f"e_{x}")) for x in g], F.col("c").eqNullSafe(F.col("e_to"))], "left")
    rank = F.struct(F.col("e_to").isNotNull().alias("led"), F.col("c").isNotNull().alias("known"), cursor_order(F.col("c"), text).alias("at"))
    reach = kept(open_.groupBy(*g).agg(F.min_by(F.struct("c"), rank).alias("first")).select(*g, F.col("first.c").alias("c"),
                 F.lit(0).cast("long").alias("position")), "chain-reach")
    longest = nodes.groupBy(*g).count().agg(F.max("count")).first()[0] or 0
    step = 1
    while step <= longest and not jump.isEmpty():
        more = ahead(reach, jump, "c").select(*g, F.col("further").alias("c"), (F.col("position") + step).alias("position"))
        reach = kept(reach.unionByName(more).groupBy(*g, "c").agg(F.min("position").alias("position")), "chain-reach")
        jump = kept(ahead(jump, jump.select("*"), "to").select(*g, "c", F.col("further").alias("to")), "chain-jump")
        step *= 2
    ring = jump.select(*g, F.col("to").alias("c")).distinct().withColumn("on_cycle", F.lit(True))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnsRenamed({x: f"r_{x}" for x in [*g, "c"]})
        same = [left[x].eqNullSafe(right[f"r_{x}"]) for x in [*g, "c"]]
        return left.join(right, same, "left").drop(*[f"r_{x}" for x in [*g, "c"]])

    placed = beside(beside(nodes, reach), ring)
    return placed.select(*[F.col(x).alias(c) for x, c in zip(g, group_cols)], F.col("c").alias(cursor), F.col("to").alias(next_cursor),
                         "position", F.coalesce("on_cycle", F.lit(False)).alias("on_cycle"))


def chain_order_problems(pages: DataFrame, group_cols, cursor: str = "cursor", next_cursor: str = "next_cursor") -> DataFrame:
    """What only the whole chain shows, in the form of ``page_chain_problems``:

    * ``unreachable``: no way leads from the group's first page to the page;
    * ``cycle``: the page's way comes back to it;
    * ``doubled_link``: several pages lead to one (the smallest is named).
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    order = kept(chain_order(pages, group_cols, cursor, next_cursor), "chain-order")
    cols = [*group_cols, cursor, next_cursor]
    doubled = (order.where(F.col(next_cursor).isNotNull()).groupBy(*group_cols, next_cursor)
               .agg(F.min(cursor).alias(cursor), F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    return union_all([order.where("position IS NULL").select(*cols, F.lit("unreachable").alias("problem")),
                      order.where("on_cycle").select(*cols, F.lit("cycle").alias("problem")),
                      doubled.select(*cols, F.lit("doubled_link").alias("problem"))])


def expected_vs_harvested(expected: DataFrame, harvested: DataFrame, key,
                          expected_col: str = "expected") -> DataFrame:
    """H6: announced totals per pass against harvested rows per pass."""
    keys = [key] if isinstance(key, str) else list(key)
    got = harvested.groupBy(*keys).agg(F.count(F.lit(1)).alias("harvested"))
    j = expected.select(*keys, F.col(expected_col).cast("bigint").alias("expected")) \
        .join(got, keys, "full_outer")
    j = j.withColumn("expected", F.coalesce("expected", F.lit(0)).cast("bigint")) \
         .withColumn("harvested", F.coalesce("harvested", F.lit(0)).cast("bigint"))
    return (j.withColumn("missing", F.col("expected") - F.col("harvested"))
            .withColumn("complete", F.col("missing") == 0))
