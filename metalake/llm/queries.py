"""Driver queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_neighbours
from .common import table
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .language import identify
from .minhash import minhash_groups
from .packing import pack_documents
from .pii import personal_data
from .simhash import simhash_groups
from .spelling import spelling_variants
from .subword import round_trip
from .suffix_dedup import remove_repeats
from .toxicity import score_toxicity
from .url_filter import judge_urls, parse_rules, url_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; the folder is a setting, nothing is copied."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@query("""
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, t.text_sha256
FROM t JOIN g ON t.text_sha256 = g.text_sha256
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]


def _op10_sql() -> str:
    """The same hierarchy in SQL: one block of shrinkage per level."""
    def level(keys, prior, source):
        k = ", ".join(keys)
        name = keys[-1]
        return f"""
{name}_n AS (SELECT {k}, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY {k}),
{name}_p AS (SELECT x.*, {prior} AS prior FROM {name}_n x {source}),
{name}_s AS (
  SELECT *, (SELECT CASE WHEN coalesce(s, 0) / t <= 1 / 10001.0 OR t IS NULL OR t = 0 THEN 10000.0
                         ELSE greatest(1.0, t / s - 1) END
             FROM (SELECT sum(CASE WHEN n > 0 THEN n * pow(good / n - prior, 2) - prior * (1 - prior) END) AS s,
                          sum(CASE WHEN n > 1 THEN (n - 1) * prior * (1 - prior) END) AS t FROM {name}_p)) AS m
  FROM {name}_p),
{name}_r AS (
  SELECT *, a / (a + b) AS mean, sqrt(a * b / (a + b + 1)) / (a + b) AS sd
  FROM (SELECT *, prior * m + good AS a, (1 - prior) * m + n - good AS b FROM {name}_s))"""

    fits = [(f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))", r)
            for r in parse_rules(RULES)]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in fits)
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in fits)
    url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
WITH marks AS (SELECT doc_id, sum(quality) AS good, count(quality) AS n FROM labels
               WHERE doc_id IS NOT NULL GROUP BY doc_id),
base AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{url}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '{url}', 2) AS path FROM pages),
judged AS (
  SELECT base.*, coalesce(good, 0) AS good, coalesce(n, 0) AS n
  FROM base LEFT JOIN marks ON marks.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]+)(\\.html)?/?$', 1) AS BIGINT)),
hosts AS (
  SELECT host, sum(good)::DOUBLE AS good, sum(n)::DOUBLE AS n, regexp_extract(host, '[^.]*$', 0) AS suffix,
         CASE WHEN contains(host, '.') THEN regexp_extract(host, '[^.]*\\.[^.]*$', 0) ELSE host END AS domain
  FROM judged GROUP BY host),
whole AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean FROM hosts),
{level(["suffix"], "(SELECT mean FROM whole)", "")},
{level(["suffix", "domain"], "u.mean", "JOIN suffix_r u ON u.suffix = x.suffix")},
{level(["suffix", "domain", "host"], "u.mean", "JOIN domain_r u ON u.suffix = x.suffix AND u.domain = x.domain")}
SELECT page_id, judged.host, path, CASE {rule} END AS rule,
       coalesce(CASE {verdict} END, CASE WHEN r.mean - 1.645 * r.sd < 0.6 THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT * FROM judged) judged JOIN (SELECT host AS h, mean, sd FROM host_r) r ON judged.host = r.h
"""


@query(_op10_sql())
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labels are those of the document it was made from, whose
    number ends the path."""
    marks = (table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.sum("quality").alias("good"), F.count("quality").alias("n")))
    number = F.regexp_extract(url_path(F.col("url")), r"/([0-9]+)(\.html)?/?$", 1)
    pages = (table(spark, sf_dir, "pages").select("page_id", "url", number.try_cast("long").alias("doc_id"))
             .join(marks, "doc_id", "left"))
    return judge_urls(pages, parse_rules(RULES), F.col("good"), F.col("n"))


@query()
def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query(r"""
WITH vecs AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vecs a JOIN vecs b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT n.anchor_id, n.positive_id,
       (row_number() OVER (PARTITION BY n.anchor_id, n.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, n.positive_score, s.score AS negative_score
FROM near n JOIN scored s ON s.anchor_id = n.anchor_id AND NOT s.alike
 AND 80 * n.positive_score <= 100 * s.score AND 100 * s.score <= 100 * n.positive_score
QUALIFY rank <= 5
""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0,
                          F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


@query(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT row_number() OVER () AS r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
grams AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.r AS x, b.r AS y FROM grams a JOIN grams b ON a.g = b.g AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach(x, y) AS (SELECT r, r FROM sets UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT reach.x, min(o.doc_id) AS component_id FROM reach JOIN sets o ON o.r = reach.y GROUP BY reach.x) c
  ON c.x = s.r
""")
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_groups(table(spark, sf_dir, "documents"), size=2)


@query(r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(list_transform(
    regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'),
    lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                     ELSE [(192 + (unicode(c) >> 6))::BIGINT, (128 + (unicode(c) & 63))::BIGINT] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc),
spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cut AS (SELECT word, n, i, substring(word, 1, i - 1) AS p, substring(word, i + 1) AS s FROM gaps),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.p || c.s
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.p || c.s),
ranked AS (
  SELECT word, near, n, row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(near)) AS nth,
         count(*) OVER (PARTITION BY word) AS n_near FROM near),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form,
         CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) r ON r.word = w.word),
follow(word, root) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT follow.word, f.form FROM follow JOIN forms f ON f.word = follow.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT follow.word, follow.root FROM follow JOIN forms e ON e.word = follow.root WHERE e.form IS NULL) l
  ON l.word = f.word
""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
