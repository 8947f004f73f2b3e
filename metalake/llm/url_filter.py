"""URL filtering by empirical-Bayes host reputation.

Labelled outcomes of pages (good or not) are counted per host. Each level of
the name hierarchy is shrunk towards the one above it through a beta-binomial
prior: suffix towards the corpus, registered domain towards its suffix, host
towards its domain. The strength of a level's prior is estimated from the
level's own overdispersion (method of moments). A host is blocked when the
lower bound of its posterior share of good pages falls under a floor; a host
without labels is judged by what its parents lend it.

Explicit rules on host and path go before the reputation; of those that fit,
the longest wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, materialise, prepare

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEVELS = ("suffix", "domain", "host")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[tuple[str, str]]) -> list[Rule]:
    """Rules from (verdict, ``host/path``), the longest first."""
    rules = [Rule(v, host, f"/{path}") for v, t in lines for host, _, path in [t.partition("/")]]
    return sorted(rules, key=lambda r: (-len(r.text), r.text))


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(rules):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text).otherwise(text)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def host_reputation(outcomes: DataFrame, z: float = 1.645, most: float = 10_000.0) -> DataFrame:
    """``host, n, mean, lower`` of every host in ``outcomes`` (``host``,
    ``good``: good labelled pages, ``n``: labelled pages; either may be 0).

    Hosts are counted before anything is joined, so a host that holds a third
    of all pages costs one row; the counts are written, and all levels start
    from them. Only the corpus mean and one prior strength
    per level are brought to the driver. ``most`` bounds a prior's strength.
    """
    prepare(outcomes.sparkSession)
    hosts = outcomes.groupBy("host").agg(F.sum("good").cast("double").alias("good"), F.sum("n").cast("double").alias("n"))
    hosts = materialise(hosts.withColumn("suffix", F.regexp_extract("host", r"[^.]*$", 0)).withColumn(
        "domain", F.when(F.col("host").contains("."), F.regexp_extract("host", r"[^.]*\.[^.]*$", 0)).otherwise(F.col("host"))),
        "url-hosts")
    whole = hosts.agg(F.sum("good"), F.sum("n")).first()
    mean = ((whole[0] or 0.0) + 1) / ((whole[1] or 0.0) + 2)
    above = None
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[:depth + 1])
        here = hosts.groupBy(*keys).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        if above is None:
            here = here.withColumn("prior", F.lit(mean))
        else:
            here = here.join(above, keys[:-1]).withColumnRenamed("mean", "prior")
        v = F.col("prior") * (1 - F.col("prior"))
        off = F.when(F.col("n") > 0, F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("prior"), 2) - v)
        spread = here.agg(F.sum(off), F.sum(F.when(F.col("n") > 1, (F.col("n") - 1) * v))).first()
        rho = (spread[0] or 0.0) / spread[1] if spread[1] else 0.0
        strength = most if rho <= 1 / (most + 1) else max(1.0, 1 / rho - 1)
        a = F.col("prior") * strength + F.col("good")
        b = (1 - F.col("prior")) * strength + F.col("n") - F.col("good")
        here = here.select(*keys, "n", (a / (a + b)).alias("mean"),
                           F.sqrt(a * b / (a + b + 1)).alias("_sd"), (a + b).alias("_w"))
        above = here.select(*keys, "mean")
    return here.select("host", "n", "mean", (F.col("mean") - z * F.col("_sd") / F.col("_w")).alias("lower"))


def judge_urls(pages: DataFrame, rules: list[Rule], good: Column, n: Column, floor: float = 0.6,
               z: float = 1.645) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page.

    ``good`` and ``n`` are a page's labelled outcomes (null or 0 for none). A
    url that is null or has no ``://`` has an empty host and path, which form
    a host of their own for the reputation. Rows repeated under one id are
    judged alike and each counts; an empty table gives no rows; other columns
    are ignored.
    """
    base = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                        F.coalesce(good, F.lit(0)).alias("good"), F.coalesce(n, F.lit(0)).alias("n"))
    known = host_reputation(base, z).select("host", F.when(F.col("lower") < floor, "block").otherwise("allow").alias("by_host"))
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return base.join(known, "host").select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, F.col("by_host")).alias("verdict"))
