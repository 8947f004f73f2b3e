"""Spelling variants grouped through permuterm rotations.

A word is closed by a terminator and turned: ``abc`` has the rotations
``abc$``, ``bc$a``, ``c$ab`` and ``$abc``. Turned so that the edited place
comes last, two words that differ by one code point share everything before
it: a replacement at ``c`` of ``abc`` leaves ``$ab`` plus one code point, a
deletion there leaves ``$ab`` itself. So all rotations are sorted by the
prefix that skips their last code point (the skipped one is the edited
character), next to the rotations that are that prefix as a whole, and a scan
of each prefix range emits the neighbours.

A prefix range holds at most one word for each code point of the alphabet
and one without any, so it is small however many words there are. An indel
within a run of equal letters would show in several ranges; only the first
place of the run counts, so every pair is emitted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, materialise, prepare

#: Code points of words; the terminator lies outside.
LETTERS = r"A-Za-zÀ-ÿ"
END = "$"


def runs(text: Column, least: int) -> Column:
    """Maximal runs of letters with at least ``least`` code points, A-Z folded."""
    found = F.regexp_extract_all(text, F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))
    return F.transform(found, lambda w: F.translate(w, UPPER, UPPER.lower()))


def spelled(doc_id: Column, run: Column, one_in: int) -> Column:
    """The run as it counts: where the crc32 of ``<doc_id>:<run>`` is divisible
    by ``one_in``, without its code point number crc32 % length."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % one_in == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, least: int = 7, twice: int = 2, one_in: int = 31) -> DataFrame:
    """``word, n`` of the words of at least ``least`` code points that occur
    ``twice`` times or more, counted over all texts."""
    words = docs.select(F.col("doc_id"), F.explode(runs(F.col("text").cast("string"), least)).alias("run"))
    return (words.select(spelled(F.col("doc_id"), F.col("run"), one_in).alias("word"))
            .where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= twice))


def rotations(words: DataFrame, literal: int = 64) -> DataFrame:
    """``prefix, last, first_of_run`` of all rotations of ``word``: ``last`` is
    the skipped code point, or empty where the prefix is the whole rotation.
    Turned back, the two give the word, so that it need not travel along.

    Prefixes over ``literal`` code points are replaced by their SHA-256, so
    that a word of length L takes L rows of bounded size; ``word`` is carried
    there, and null elsewhere.
    """
    turned = words.select("word", "n", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.length("word")),
        lambda i: F.concat(F.substring("word", i + 1, F.length("word")), F.lit(END), F.substring("word", F.lit(1), i)))
    ).alias("i", "turn"))
    before = F.substring("word", F.col("i") - 1, F.lit(1))
    last = F.substring("word", F.col("i"), F.lit(1))
    both = turned.select("word", "n", F.explode(F.array(
        F.struct(F.col("turn").alias("prefix"), F.lit("").alias("last"), F.lit(True).alias("first_of_run")),
        F.when(F.col("i") > 0, F.struct(
            F.substring("turn", F.lit(1), F.length("turn") - 1).alias("prefix"), last.alias("last"),
            ((F.col("i") == 1) | (before != last)).alias("first_of_run"))))).alias("at"))
    long = F.length("at.prefix") > literal
    key = F.when(long, F.sha2(F.col("at.prefix"), 256)).otherwise(F.col("at.prefix"))
    return both.where("at IS NOT NULL").select(key.alias("prefix"), "at.last", "at.first_of_run",
                                               F.when(long, F.col("word")).alias("word"), "n")


def turned_back(prefix: Column, last: Column) -> Column:
    """The word whose rotation is ``prefix`` followed by ``last``."""
    return F.concat(F.substring_index(prefix, END, -1), last, F.substring_index(prefix, END, 1))


def neighbours(words: DataFrame, literal: int = 64) -> DataFrame:
    """``word, near, near_n``: both directions of every pair of ``words``
    (``word, n``) that differ by one inserted, deleted or replaced code point."""
    held = F.struct("last", "first_of_run", "word", "n")
    # a short table makes some twenty times its rows: dealt to all tasks first
    words = words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = (rotations(words, literal).repartitionByRange("prefix").sortWithinPartitions("prefix", "last")
              .groupBy("prefix").agg(F.collect_list(held).alias("held")).where(F.size("held") > 1)
              .select(F.transform("held", lambda x: F.struct(
                  x["last"].alias("last"), x["first_of_run"].alias("first_of_run"),
                  F.coalesce(x["word"], turned_back(F.col("prefix"), x["last"])).alias("word"), x["n"].alias("n"))).alias("held")))
    # Within a range: two code points are a replacement; a word that is the
    # prefix itself (empty ``last``) and one code point are an indel.
    differ = lambda x, y: (x["last"] != y["last"]) & ((x["last"] != "") | y["first_of_run"]) & (
        (y["last"] != "") | x["first_of_run"])
    pairs = F.flatten(F.transform("held", lambda x: F.transform(
        F.filter("held", lambda y: differ(x, y)),
        lambda y: F.struct(x["word"].alias("word"), y["word"].alias("near"), y["n"].alias("near_n")))))
    return ranges.select(F.explode(pairs).alias("pair")).select("pair.*")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that forms lead to, by pointer doubling. A
    form has at least ten times the occurrences, so there are no cycles and
    few rounds."""
    jump = materialise(forms.select("word", F.col("form").alias("root")), "spelling-jump")
    while True:
        on = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = materialise(jump.join(on, "root", "left")
                            .select("word", F.coalesce("further", "root").alias("root"),
                                    F.col("further").isNotNull().alias("moved")), "spelling-jump")
        jump = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            return jump


def spelling_variants(docs: DataFrame, least: int = 7, twice: int = 2, times: int = 10, one_in: int = 31,
                      literal: int = 64) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word with the largest count (ties: the smallest in
    code-point order) if that count is at least ``times`` the word's, else
    null; ``root`` is where forms lead to (the word itself without one).

    Null and empty texts have no words. A null ``doc_id`` counts as an empty
    one in the checksum; rows repeated under an id count again. Whole texts
    are read; a word of any length takes part, with time that grows with the
    square of its length and memory that does not grow with it beyond the
    word itself. An empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    words = materialise(vocabulary(docs, least, twice, one_in), "spelling-words")
    pairs = materialise(neighbours(words, literal), "spelling-pairs")
    most = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    linked = (words.join(most, "word", "left")
              .withColumn("form_n", F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less")))
              .withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("best.near"))))
    placed = materialise(linked.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                       "form_n"), "spelling-forms")
    ends = roots(placed.where(F.col("form").isNotNull()))
    return (placed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
