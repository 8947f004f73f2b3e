"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Four exact patterns give the base spans, which always stay. Four wider
generators propose further spans that may overlap (bracketed addresses,
numbers without a plus sign or with other separators). Each candidate has a
small vector of format and context features; boosted trees score it, and it
is added where its score passes a threshold calibrated on held-out documents
and it does not overlap a base span.

The trees learn from labels that do not ask for a base span, since only
candidates without one can be added: a sound candidate is positive if its form
says what it is (bracketed addresses) or a cue word stands before it, besides
those that overlap a base span of their kind; an unsound one is negative. The
other sound ones are unlabelled and count in part: by how many are to be
expected beside those of their form with a cue word, seen that confirmed ones
lack one so often, or (cards) by how far sound checksums are above chance. How
common a form is does not change its share. Thresholds are calibrated on the candidates
that can be added, so the precision asked for is that of the added spans. The
candidates of all documents are counted by feature vector in Spark; only those
counts (at most one row per cell of the feature grid) reach the driver, and the
fitted trees go back as a column expression.

Positions come from cutting the text at the matches: with the pieces between
matches and the matches themselves, every offset is a running sum of lengths.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import held_out, materialise

KINDS = ("email", "ip", "card", "phone")

# Where a possible start lies inside a run of the same class, the run's own
# start would have matched first (or the last match ended there), so the scan
# skips it; runs that cannot give anything back are possessive. Both leave the
# matches as they are and keep the scan linear in the text.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\]|\{{at\}})\x20?[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?)[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20._-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+])[0-9(][\x20()./0-9-]{6,18}[0-9](?![0-9])",
}
#: A text without these holds no match of the kind.
_GATE = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
}
_WIDE_GATE = {
    "email": r"@|[(\[{]at[)\]}]",
    "ip": r"[0-9](?:\.|\x20?[(\[](?:\.|dot))",
    "card": r"[0-9](?:[\x20._-]{0,2}[0-9]){6}",
    "phone": r"[0-9(][\x20()./0-9-]{6}",
}
#: Words before a candidate that speak for its kind.
CUES = {
    "email": r"(?i)mail|contact|write|reach",
    "ip": r"(?i)\bip\b|addr|host|server",
    "card": r"(?i)card|visa|credit|pay",
    "phone": r"(?i)phone|tel|call|fax|mobile",
}
FEATURES = ("kind", "sound", "marks", "cue", "before", "after", "size")
#: Kinds whose sound bracketed form (marks 3) is proof enough.
BRACKETED = ("email", "ip")
#: Share of random digit strings with a sound first digit and checksum.
_LUCK = 0.04


@dataclass
class Model:
    bias: float = 0.0
    trees: list[boosting.Tree] = field(default_factory=list)
    limits: tuple[float, ...] = (2.0, 2.0, 2.0, 2.0)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    """Whether a base match passes its kind's rule."""
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.coalesce(
            F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        d = _digits(hit)
        return F.length(d).between(16, 19) & F.call_function("luhn_check", F.substring(d, 1, 20))
    if kind == "phone":
        return F.length(_digits(hit)).between(8, 15)
    return F.lit(True)


def _char_class(c: Column) -> Column:
    """0 none, 1 space, 2 letter, 3 digit, 4 anything else."""
    return (F.when(F.length(c) == 0, 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^\p{L}"), 2)
            .when(c.rlike("^[0-9]"), 3).otherwise(4))


def _features(kind: str, hit: Column, before: Column, after: Column) -> list[Column]:
    d = _digits(hit)
    if kind == "email":
        sound, size = hit.rlike(r"(?:\.|dot[)\]}]\x20?)[A-Za-z]{2,}$"), F.length(hit)
    elif kind == "ip":
        parts = F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0))
        sound, size = F.forall(parts, lambda p: p.cast("int") <= 255), F.length(d)
    elif kind == "card":
        sound, size = F.call_function("luhn_check", d) & hit.rlike("^[3-6]"), F.length(d)
    else:
        sound, size = F.length(d).between(9, 15), F.length(d)
    marks = (F.when(hit.rlike(r"[(\[{]"), 3).when(hit.rlike(r"[\x20_/]"), 2).when(hit.rlike(r"[.-]"), 1).otherwise(0))
    return [F.lit(KINDS.index(kind)), sound.cast("int"), marks, before.rlike(CUES[kind]).cast("int"),
            _char_class(F.right(before, F.lit(1))), _char_class(after),
            F.least(F.lit(9), (size / 2).cast("int"))]


def _cut(text: Column, pattern: str, gate: str) -> tuple[Column, Column]:
    """Pieces between matches and matches (both empty where the gate says so)."""
    there = text.contains(gate) if gate == "@" else text.rlike(gate)
    none = F.array().cast("array<string>")
    return (F.when(there, F.split(text, pattern, -1)).otherwise(none),
            F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))


def _scan(rows: Column, zero: Column, after, made, kind: Column) -> Column:
    """``made(state, x)`` (arrays of ``kind``) of all elements in a row, where
    the state before an element is ``after`` of those before it.

    An array that grows by one element is copied each time, so elements are
    taken in chunks of about the square root of their number: first the states
    at the chunks' starts, then each chunk by itself. A text with a million
    matches costs a thousand small arrays, not a million growing ones.
    """
    size = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(rows)))).cast("int")
    last = F.greatest(F.ceil(F.size(rows) / size) - 1, F.lit(0)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(rows, k * size + 1, size))
    start = F.struct(zero.alias("state"), F.slice(F.array(F.struct(zero.alias("state"), rows.alias("chunk"))), 1, 0).alias("out"))

    def on(acc, chunk):
        return F.struct(F.aggregate(chunk, acc["state"], after).alias("state"), F.concat(
            acc["out"], F.array(F.struct(acc["state"].alias("state"), chunk.alias("chunk")))).alias("out"))

    def within(at):
        first = F.struct(at["state"].alias("state"), F.slice(F.array(kind), 1, 0).alias("out"))
        return F.aggregate(at["chunk"], first, lambda acc, x: F.struct(
            after(acc["state"], x).alias("state"), F.concat(acc["out"], made(acc["state"], x)).alias("out")), lambda acc: acc["out"])

    return F.flatten(F.transform(F.aggregate(chunks, start, on, lambda acc: acc["out"]), within))


def _rows(gaps: Column, hits: Column) -> Column:
    """Each match with what stands before and after it."""
    return F.arrays_zip(gaps.alias("g"), hits.alias("h"), F.slice(gaps, F.lit(2), F.greatest(F.size(gaps), F.lit(1))).alias("n"))


def _place(rows: Column, keep, item) -> Column:
    """``item(start, end, hit, before, after)`` of every match that ``keep``s."""
    made = item(F.lit(0), F.lit(0), F.lit(""), F.lit(""), F.lit(""))
    none = F.slice(F.array(made), 1, 0)

    def after(pos, x):
        return pos + F.length(x["g"]) + F.coalesce(F.length(x["h"]), F.lit(0))

    def one(pos, x):
        a = pos + F.length(x["g"])
        got = item(a, a + F.length(x["h"]), x["h"], F.right(x["g"], F.lit(24)), F.left(F.coalesce(x["n"], F.lit("")), F.lit(1)))
        return F.when(x["h"].isNotNull() & keep(x["h"]), F.array(got)).otherwise(none)

    return _scan(rows, F.lit(0), after, one, made)


def _span(kind: str, a: Column, b: Column) -> Column:
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), a.cast("int").alias("start"), b.cast("int").alias("end"))


def base_spans(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns, ``text`` and ``base``: the base spans by kind, then start."""
    cut = docs.select(*carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pieces = []
    for k in KINDS:
        g, h = _cut(F.col("text"), BASE[k], _GATE[k])
        pieces += [g.alias(f"g_{k}"), h.alias(f"h_{k}")]
    found = _zipped(cut.select("*", *pieces))
    spans = [_place(F.col(f"r_{k}"), lambda h, k=k: _valid(k, h), lambda a, b, h, x, y, k=k: _span(k, a, b))
             for k in KINDS]
    return found.select(*carry, "text", F.concat(*spans).alias("base"))


def candidates(spans: DataFrame, *carry: str) -> DataFrame:
    """The rows of ``base_spans`` with ``wide``: candidate spans and features."""
    pieces = []
    for k in KINDS:
        g, h = _cut(F.col("text"), WIDE[k], _WIDE_GATE[k])
        pieces += [g.alias(f"g_{k}"), h.alias(f"h_{k}")]

    def item(k):
        return lambda a, b, h, x, y: F.struct(
            a.cast("int").alias("start"), b.cast("int").alias("end"),
            *[c.cast("int").alias(n) for n, c in zip(FEATURES, _features(k, h, x, y))])

    wide = [_place(F.col(f"r_{k}"), lambda h: F.lit(True), item(k)) for k in KINDS]
    return (_zipped(spans.select("*", *pieces)).withColumn("wide", F.concat(*wide))
            .select(*carry, "text", "base", "wide", _chunked("base").alias("shut")))


def _zipped(found: DataFrame) -> DataFrame:
    """The matches of every kind as one column each."""
    return found.select("*", *[_rows(F.col(f"g_{k}"), F.col(f"h_{k}")).alias(f"r_{k}") for k in KINDS])


def _chunked(spans: str) -> Column:
    """Spans in chunks with the range that each covers: a test against all of
    them opens only the chunks that may meet."""
    size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(spans)))).cast("int")
    last = F.greatest(F.ceil(F.size(spans) / size) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: _range(F.slice(spans, k * size + 1, size)))


def _range(some: Column) -> Column:
    return F.struct(F.array_min(F.transform(some, lambda s: s["start"])).alias("lo"),
                    F.array_max(F.transform(some, lambda s: s["end"])).alias("hi"), some.alias("spans"))


def _covered(c: Column, of_kind: bool = False) -> Column:
    """Whether a candidate overlaps a base span (of its kind)."""
    def meets(b):
        both = (b["start"] < c["end"]) & (b["end"] > c["start"])
        return both & (b["kind"] == c["kind"]) if of_kind else both
    return F.exists("shut", lambda chunk: F.coalesce((chunk["lo"] < c["end"]) & (chunk["hi"] > c["start"]), F.lit(False))
                    & F.exists(chunk["spans"], meets))


def shares(x: np.ndarray, covered: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The part of each cell's ``free`` candidates that counts as positive."""
    kind, sound, marks, cue = x[:, 0], x[:, 1] == 1, x[:, 2], x[:, 3] == 1
    evident = np.isin(kind, [KINDS.index(k) for k in BRACKETED]) & (marks == 3)
    share = (sound & (cue | evident)).astype(float)
    forms: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(sound | (kind == KINDS.index("card"))):
        forms.setdefault((x[i, 0], x[i, 2], *x[i, 4:]), []).append(i)
    for k in range(len(KINDS)):
        one = kind == k
        chance = (free[one & ~sound & cue].sum() + 1) / (free[one & ~sound].sum() + 20)
        true = (covered[one & sound & cue].sum() + 10) / (covered[one & sound].sum() + 10)
        for form, cells in forms.items():
            if form[0] != k:
                continue
            m = np.zeros(len(x), bool)
            m[cells] = True
            n, without = free[m & sound].sum(), free[m & sound & ~cue].sum()
            real = (free[m & sound & cue].sum() - chance * n) / max(true - chance, 0.1)
            part = real * (1 - true) / (without + 5)
            if KINDS[k] == "card" and n:
                lucky = (free[m & ~sound].sum() + 5) * _LUCK / (1 - _LUCK)
                part = max(part, 1 - lucky / n)
            rest = m & sound & ~cue & ~evident
            share[rest] = min(1.0, max(0.0, part))
    return share


def fit(docs: DataFrame, sample_docs: int | None = None, precision: float = 0.95) -> Model:
    """Trees and thresholds from the candidates of all documents; a fifth of
    the documents calibrates. With ``sample_docs``, only about so many of them
    count, picked by a hash of id and text."""
    some = docs.select("doc_id", "text")
    if sample_docs is not None:
        share = min(1.0, sample_docs / max(1, docs.count()))
        dice = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
        # written first: candidates are made of the sample alone, whatever filters
        # Spark derives from what follows
        some = materialise(some.where(dice < int(share * (1 << 30))), "pii-sample")
    # what covers a candidate is told before the explode, which would copy the base spans to each
    told = F.transform("wide", lambda c: F.struct(c.alias("c"), _covered(c, of_kind=True).cast("int").alias("y"),
                                                  _covered(c).cast("int").alias("closed")))
    rows = (candidates(base_spans(some, "doc_id"), "doc_id").select(held_out(F.col("doc_id"), 5, 0).alias("later"), told.alias("told"))
            # of explode() Spark would infer a filter on ``told`` and push the whole of its expression down
            .select("later", F.explode_outer("told").alias("t")).where("t IS NOT NULL").select("later", "t.*"))
    cells = (rows.groupBy("later", *[F.col(f"c.{f}").alias(f) for f in FEATURES])
             .agg(F.sum("y").alias("covered"), F.sum(1 - F.col("y")).alias("free"),
                  F.sum(1 - F.col("closed")).alias("open")).collect())
    if not cells:
        return Model()
    cells.sort()
    x = np.array([[r[f] for f in FEATURES] for r in cells])
    covered, free, can = (np.array([float(r[n]) for r in cells]) for n in ("covered", "free", "open"))
    later = np.array([r["later"] for r in cells])
    part = shares(x, covered, can)
    # what overlaps a base span of another kind cannot be added and says nothing for its own
    pos, neg = covered + part * can, (1 - part) * can + (free - can)
    weight = np.ones(len(x))
    for k in range(len(KINDS)):  # a kind with few candidates is learnt as well as one with many
        m = ~later & (x[:, 0] == k)
        weight[m] = (pos + neg)[~later].sum() / len(KINDS) / max(1.0, (pos + neg)[m].sum())
    t = ~later if (~later).any() else later
    bias, trees = boosting.fit(x[t], (weight * pos)[t], (weight * neg)[t])
    p = boosting.predict(bias, trees, x)
    limits = []
    for k in range(len(KINDS)):
        m = (x[:, 0] == k) & (x[:, 1] == 1) & (can > 0)
        m = m & later if (m & later).any() else m
        # with nothing to calibrate on, the score itself has to reach the precision
        limits.append(max(0.5, boosting.threshold(p[m], (part * can)[m], ((1 - part) * can)[m], precision))
                      if m.any() else precision)
    return Model(bias, trees, tuple(limits))


def _passes(model: Model, c: Column) -> Column:
    def test(t):
        return c[FEATURES[t[0]]] == t[1]

    score = F.lit(model.bias)
    for t in model.trees:
        sides = []
        for at, two in ((t.yes, t.leaves[:2]), (t.no, t.leaves[2:])):
            sides.append(F.lit(two[1]) if at is None else F.when(test(at), two[0]).otherwise(two[1]))
        score = score + F.when(test(t.root), sides[0]).otherwise(sides[1])
    p = 1 / (1 + F.exp(-score))
    limit = F.element_at(F.array(*[F.lit(x) for x in model.limits]), c["kind"] + 1)
    return (c["sound"] == 1) & (p >= limit)


def find_spans(docs: DataFrame, *carry: str, model: Model | None = None) -> DataFrame:
    """``carry``, ``text``, ``base`` and ``spans`` (base and added ones, by kind
    then start) of every whole text; null counts as empty."""
    model = fit(docs) if model is None else model
    found = candidates(base_spans(docs, *carry), *carry)
    added = F.transform(F.filter("wide", lambda c: _passes(model, c) & ~_covered(c)),
                        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select(*carry, "text", "base", added.alias("added")).select(
        *carry, "text", "base", F.array_sort(F.concat("base", "added")).alias("spans"))


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: ``doc_id``, counts of base spans per kind,
    ``base_sha256`` and ``spans``.

    Null and empty texts have no spans. Rows repeated under one id are
    reported alike; null ids stay null; an empty table gives no rows; other
    columns are ignored. Ends are exclusive, in code points. Added spans of
    different kinds may overlap each other, never a base span; all are listed.
    """
    def of_kind(i):  # Spark reads a lambda's parameters: no default arguments here
        return lambda s: s["kind"] == i

    counts = [F.size(F.filter("base", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return find_spans(docs, "doc_id", model=model).select(
        F.col("doc_id").cast("long").alias("doc_id"), *counts,
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (spans that
    overlap by the kind of the first, of two with one start the shorter);
    texts without spans stay as they are, null ones too. Repeated rows and
    null ids are treated like any other; an empty table stays empty."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(row, "text", "doc_id")
    found = find_spans(packed, "row", model=model)
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # the text is cut into code points once, so that long texts with many spans stay linear
    def piece(at, s):
        before = F.array_join(F.slice("chars", at + 1, F.greatest(s["start"] - at, F.lit(0))), "")
        return F.when(s["start"] >= at, F.array(before, F.element_at(tags, s["kind"] + 1))).otherwise(F.array().cast("array<string>"))

    pieces = _scan(F.col("by_start"), F.lit(0), lambda at, s: F.greatest(at, s["end"]), piece, F.lit(""))
    end = F.coalesce(F.array_max(F.transform("by_start", lambda s: s["end"])), F.lit(0))
    rest = F.array_join(F.slice("chars", end + 1, F.greatest(F.size("chars") - end, F.lit(0))), "")
    clean = F.when(F.size("spans") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("row.text"))
    cut = found.select("row", "spans", by_start.alias("by_start"), F.when(F.size("spans") > 0, F.split("text", "", 0)).alias("chars"))
    return cut.select("row", clean.alias("clean")).select(
        *[F.col("clean").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
