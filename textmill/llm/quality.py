"""Quality rules whose cutoffs are chosen under a risk bound.

Every rule divides a share (symbols, capitals, exclamation marks, repeated lines, repeated
words) by a fixed unit; a text's badness is the largest quotient. A stratum (language)
rejects texts whose badness exceeds its cutoff. Cutoffs come from labelled holdouts: from
the most lenient to the strictest, each is tested with the exact binomial tail for the
hypothesis that more than RISK of the stratum's good texts would be rejected, at level
ERROR / strata (Bonferroni over the strata, fixed sequence within one). The strictest cutoff
before the first failure holds; a stratum without any certified cutoff rejects nothing by
the rules. One family is calibrated, the largest quotient; its units are fixed. With probability 1 - ERROR every stratum's false rejection rate is at most RISK.

All of it is column expressions.
"""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names, let, stash, table, words_of

RISK, ERROR = 0.02, 0.05
#: Units of the rules, in the order of the shares that badness() divides by them.
UNITS = {"symbols": 0.05, "capitals": 0.30, "exclamations": 0.05, "repeated_lines": 0.40, "repeated_words": 0.50}
#: Cutoffs that are tried, from the most lenient; fixed before any label is seen.
CUTOFFS = (4.0, 3.0, 2.5, 2.0, 1.6, 1.3, 1.1, 1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4)
#: Hard limits of the contract.
LEAST_WORDS, MOST_REPEATED = 50, 50


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of three words that the text has twice or more.

    Windows are compared by 64-bit hash. Only texts with an equal pair are sorted: equal
    hashes stand side by side then, and the windows' places, sorted again, cover
    min(3, distance to the next) words each.
    """

    def cover(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def places(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = let(
            order,
            lambda s: F.transform(
                s,
                lambda e, k: F.when((e.h == F.get(s, k - 1).h) | (e.h == F.get(s, k + 1).h), e.i),
            ),
        )
        return F.sort_array(F.filter(twins, lambda p: p.isNotNull()))

    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        count = let(
            hashes,
            lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(places(h), cover)).otherwise(F.lit(0)),
        )
        return F.when(F.size(w) >= 4, count).otherwise(F.lit(0)).cast("long")

    return let(words, of)


def measures(text: Column) -> Column:
    """Counts of a text as one struct; a null text has none of anything."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    white = " \t\n\x0b\x0c\r"

    def counts(t: Column) -> Column:
        length, solid = F.length(t), _without(t, white)
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            lines,
            lambda ls: let(
                words_of(t),
                lambda w: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    solid.cast("long").alias("word_chars"),
                    (length - _without(t, "#*$%&|<>")).cast("long").alias("n_symbols"),
                    (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                    repeated_words(w).alias("n_repeat_words"),
                    F.size(ls).cast("long").alias("n_lines"),
                    (length - _without(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_capitals"),
                    (length - _without(t, "!")).cast("long").alias("n_exclamations"),
                ),
            ),
        )

    return let(text, counts)


def badness(m: Column) -> Column:
    """The largest of the rules' shares in their units; 0 for a text without words."""
    chars, words, lines = (F.greatest(x, F.lit(1)) for x in (m.word_chars, m.n_words, m.n_lines))
    shares = (m.n_symbols / chars, m.n_capitals / chars, m.n_exclamations / chars, m.n_dup_lines / lines, m.n_repeat_words / words)
    return F.greatest(*[share / unit for share, unit in zip(shares, UNITS.values())])


def base_failed(m: Column) -> Column:
    return (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > MOST_REPEATED * m.n_words)


def log_gamma(x: Column) -> Column:
    """ln Gamma(x), x >= 1: Stirling's series after eight steps up, exact to double precision."""
    z = x + 8.0
    up = x
    for k in range(1, 8):
        up = up * (x + float(k))
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * F.log(z) - z + 0.5 * log(2 * pi) + series - F.log(up)


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X ~ Bin(n, risk), or 1 where k is not below the mean.

    The terms fall from k down, so the sum starts at k and ends when what is left is below
    double precision, after some multiple of the standard deviation.
    """
    n, k = n.cast("double"), k.cast("double")
    top = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * log(risk) + (n - k) * log(1 - risk)
    steps = F.sequence(F.lit(0), F.least(k, F.ceil(40 * F.sqrt(n)) + 100).cast("int"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def step(acc: Column, j: Column) -> Column:
        i = k - j
        return F.struct(
            (acc.term * i * (1 - risk) / ((n - i + 1) * risk)).alias("term"), (acc.total + acc.term).alias("total")
        )

    total = F.aggregate(steps, start, step, lambda acc: acc.total)
    return F.when(k < n * risk, F.least(F.exp(top) * total, F.lit(1.0))).otherwise(F.lit(1.0))


def stratum_of(lang: Column) -> Column:
    return F.coalesce(lang.cast("string"), F.lit(""))


def calibrate(scored: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, cutoff, n, k, p) from good holdouts (stratum, bad): one row for each stratum.

    ``cutoff`` is null where none could be certified; n, k and p are the holdouts, their
    rejections and the tail at the cutoff that holds. No holdouts, no rows.
    """
    counts = scored.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("bad") > c).alias(f"k{j}") for j, c in enumerate(CUTOFFS)]
    )
    tries = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(c).alias("cutoff"), F.col(f"k{j}").alias("k")) for j, c in enumerate(CUTOFFS)])
    tested = counts.crossJoin(F.broadcast(counts.agg(F.count(F.lit(1)).alias("strata")))).select(
        "stratum", "n", "strata", F.explode(tries).alias("t")
    ).select("stratum", "n", "strata", "t.*")
    tested = tested.withColumn("p", binomial_tail(F.col("n"), F.col("k"), risk))
    before = Window.partitionBy("stratum").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    held = F.min((F.col("p") <= error / F.col("strata")).cast("int")).over(before)
    best = F.max(F.when(F.col("held") == 1, F.struct("j", "cutoff", "k", "p")))
    return tested.withColumn("held", held).groupBy("stratum").agg(best.alias("best"), F.first("n").alias("n")).select(
        "stratum", F.col("best.cutoff").alias("cutoff"), "n", F.col("best.k").alias("k"), F.col("best.p").alias("p")
    )


def good_labels(labels: DataFrame) -> DataFrame:
    """(label_id) of the documents that every one of their labels calls good."""
    return (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.min("quality").alias("q"))
        .where("q = 1")
        .select("label_id")
    )


def _cutoffs(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(cut_stratum, cutoff) from measured documents (doc_id, stratum, text_key, m) and labels.

    Equal texts of a stratum are one holdout: the exact bound is for independent draws.
    """
    good = good_labels(labels)
    holdouts = measured.join(good, measured.doc_id == good.label_id, "left_semi")
    once = holdouts.select("stratum", "text_key", badness(F.col("m")).alias("bad")).distinct()
    found = stash(calibrate(once.select("stratum", "bad")), "quality-cutoffs")
    return found.select(F.col("stratum").alias("cut_stratum"), "cutoff")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def judge(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """``measured`` (doc_id, stratum, text_key, m) with base_failed and kept.

    ``kept`` is false where a hard limit fails or the stratum's cutoff is exceeded; a stratum
    without a certified cutoff (so every one, without labels) rejects by the hard limits
    alone. Repeated rows are judged alike; an empty table gives no rows.
    """
    joined = measured.join(_cutoffs(measured, labels), F.col("stratum") == F.col("cut_stratum"), "left")
    failed = base_failed(F.col("m"))
    rejected = F.coalesce(badness(F.col("m")) > F.col("cutoff"), F.lit(False))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~rejected).drop("cut_stratum", "cutoff")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang and any others) that pass, all columns unchanged.

    A null or empty text has no words and fails. Texts are measured whole, whatever their
    length. Repeated rows are judged alike and all stay or go; a badness equal to the cutoff
    stays. A null lang is a stratum of its own; rows with a null doc_id are judged but never
    labelled. Other columns may have any names. An empty table gives no rows.
    """
    # Stored once with the counts: the labels meet the counts alone, and no filter that is
    # pushed below the projection counts a text again.
    counts, cut, at = free_names(docs.columns, "counts", "cut_stratum", "cutoff")
    counted = stash(docs.withColumn(counts, measures(F.col("text"))), "quality-counted")
    measured = counted.select(
        F.col("doc_id").cast("long").alias("doc_id"), stratum_of(F.col("lang")).alias("stratum"), text_key(F.col("text")).alias("text_key"), F.col(counts).alias("m")
    )
    cutoffs = _cutoffs(measured, labels).withColumnsRenamed({"cut_stratum": cut, "cutoff": at})
    joined = counted.join(cutoffs, stratum_of(F.col("lang")) == F.col(cut), "left")
    passes = ~base_failed(F.col(counts)) & F.coalesce(badness(F.col(counts)) <= F.col(at), F.lit(True))
    return joined.where(passes).select(*docs.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of all documents."""
    docs = table(spark, sf_dir, "documents")
    measured = stash(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), stratum_of(F.col("lang")).alias("stratum"), text_key(F.col("text")).alias("text_key"), measures(F.col("text")).alias("m")),
        "quality-measures",
    )
    got = judge(measured, table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return got.select("doc_id", *[F.col(f"m.{c}").alias(c) for c in counts], "base_failed", "kept")
