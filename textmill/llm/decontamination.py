"""Benchmark decontamination with a distributed positional inverted index.

The index holds (term, text, position) postings of the corpus. Of every benchmark window the
LISTS rarest terms are looked up, so only their postings are stored. A posting moved back by
its term's place in the item gives the place where the item would begin; the lists of one
item are intersected there, and a window is a candidate where all its lists meet. The few
candidates are compared with the window word by word, which gives exact phrases. For
proximity a window has as many anchors as words may be missing and one more, so a stretch of
text that holds the rest of the window holds an anchor. Everything is column expressions and
joins; copies of a text are one text from the first group on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, free_names, lower_ascii, split_words, stash, table

WINDOW = 10
#: Postings lists that are intersected for each window: those of its rarest terms.
LISTS = 3
#: A proximity match: all words of a window but MISSING at most, within EXTRA words more than it has.
#: Of a short window at most a quarter of the words may be missing.
MISSING, EXTRA = 1, 2
#: A table of benchmark terms or windows is broadcast only up to this many rows.
BROADCAST_ROWS = 500_000
#: The texts with hits are broadcast only up to this many spans and items; beyond, the join is dealt out.
BROADCAST_HITS = 200_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def match_words(text: Column) -> Column:
    """Words of a text in lower case: runs of ASCII letters, digits and anything beyond ASCII."""
    return split_words(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD)


def small(df: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if its counted rows are within the bound, else for a merge join."""
    return F.broadcast(df) if rows <= (BROADCAST_ROWS if most is None else most) else df.hint("merge")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, words): the distinct windows of every item.

    An item of fewer words than ``size``, but not none, is one window. Items may repeat.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), match_words(F.col("text")).alias("w"))
    return items.where(F.size("w") > 0).select("item_id", F.explode(_slices(size)).alias("words")).distinct()


def _slices(size: int) -> Column:
    """The windows of the words ``w``, from their first to their last."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return F.transform(starts, lambda i: F.slice("w", i, size))


def term_postings(words: DataFrame) -> DataFrame:
    """(key, pos, term): every position of every text (key, w)."""
    return words.select("key", F.posexplode("w").alias("pos", "term"))


def term_counts(words: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """(term, n): how often each of ``terms`` occurs in the texts (key, w)."""
    every = words.select(F.explode("w").alias("term"))
    return every.join(small(terms, n_terms), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, w): the words of the texts of ``keys``, each key once.

    Each task sends one text of a key on, however many rows have it.
    """
    n = keys.count()
    wanted = docs.join(small(keys.select(F.col("key").alias("wanted")), n), F.col("key") == F.col("wanted"), "left_semi")
    return wanted.groupBy("key").agg(F.first("text").alias("text")).select("key", match_words(F.col("text")).alias("w"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(key, spans, items) of the rows of ``docs`` (key, text) that hold a benchmark window.

    ``spans`` are the sorted distinct (start, end) word positions of exact occurrences,
    ``items`` the sorted distinct ids of the items whose windows occur. ``key`` is any
    column that is the same for equal texts only; repeated keys count once.
    """
    # Items of equal words are one; windows of equal words are one in the result.
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), match_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    found = stash(items.groupBy("w").agg(F.collect_set("item_id").alias("ids")).withColumn("item", F.monotonically_increasing_id()), "bench-items")
    n_places = found.agg(F.sum(F.size("w"))).first()[0] or 0
    slices = found.select("item", "ids", F.posexplode(_slices(size)).alias("at", "words"))
    distinct = stash(
        slices.groupBy("words").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items")).withColumn("window", F.monotonically_increasing_id()),
        "bench-distinct",
    )
    cut = stash(slices.select("item", "at", "words").join(distinct.select("words", "window"), "words"), "bench-windows")
    terms = found.select(F.explode("w").alias("term")).distinct()
    n_terms, n_windows = terms.count(), cut.count()
    words = docs.select("key", match_words(F.col("text")).alias("w"))
    counts = stash(term_counts(words, terms, n_terms), "bench-term-counts")
    # A window's lists: of its terms, each at its first place, those with the shortest lists.
    # A term that no text has makes its window's list empty.
    terms_at = cut.select("item", "at", F.posexplode("words").alias("place", "term")).groupBy("item", "at", "term").agg(F.min("place").alias("place"))
    ranked = terms_at.join(counts, "term", "left").groupBy("item", "at").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (F.col("at") + F.col("place")).alias("place"), F.col("term")))).alias("r")
    )
    lists = stash(ranked.where(F.get("r", F.lit(0)).n > 0).select("item", "at", F.slice("r", 1, LISTS).alias("r")), "bench-lists")
    anchors = lists.select("item", F.explode("r").alias("r")).select("item", "r.place", "r.term").distinct()
    needs = lists.groupBy("item").agg(
        F.collect_list(F.struct("at", F.transform("r", lambda x: x.place).alias("places"))).alias("needs"), F.min(F.size("r")).alias("least")
    )
    index = stash(term_postings(words).join(small(anchors.select("term").distinct(), n_terms), "term", "left_semi"), "bench-postings")
    # Lists meet where the item would begin, which may be before the text: it may hold a later window alone.
    moved = index.join(small(anchors, n_places), "term").select("key", "item", (F.col("pos") - F.col("place")).alias("begin"), "place")
    met = moved.groupBy("key", "item", "begin").agg(F.collect_set("place").alias("places"))
    # Where fewer lists meet than any window has, none is looked at.
    many = met.join(small(needs, n_windows), "item").where(F.size("places") >= F.col("least"))
    all_meet = F.filter("needs", lambda n: F.size(F.array_except(n.places, "places")) == 0)
    candidates = stash(
        many.select("key", "item", "begin", F.explode(all_meet).alias("n")).select("key", "item", F.col("n.at").alias("at"), (F.col("begin") + F.col("n.at")).alias("start")).where("start >= 0"),
        "bench-candidates",
    )
    # A text has no more candidates than places times windows that begin alike: what a row holds follows its text.
    by_text = candidates.groupBy(F.col("key").alias("text_key")).agg(F.collect_list(F.struct("item", "at", "start")).alias("found"))
    seen = texts_of(docs, by_text.select(F.col("text_key").alias("key"))).join(by_text, F.col("key") == F.col("text_key"))
    around = F.transform("found", lambda c: F.struct(c.item.alias("item"), c.at.alias("at"), c.start.alias("start"), F.slice("w", c.start + 1, F.lit(size)).alias("near")))
    near = seen.select("key", F.explode(around).alias("c")).select("key", "c.*")
    # A window of fewer than ``size`` words is a whole short item.
    hits = near.join(small(cut, n_windows), ["item", "at"]).where(F.slice("near", F.lit(1), F.size("words")) == F.col("words"))
    hit = F.struct(F.col("start"), (F.col("start") + F.size("words")).alias("end"), F.col("window"))
    checked = stash(hits.groupBy("key").agg(F.collect_set(hit).alias("hits")), "bench-hits")
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h.start.alias("start"), h.end.alias("end")))))
    out = _with_items(checked, spans, distinct, n_windows)
    discard(found, cut, counts, lists, index, candidates, checked, distinct)
    return out


def _with_items(checked: DataFrame, spans: Column, distinct: DataFrame, n_windows: int) -> DataFrame:
    """(key, spans, items) of (key, hits), each hit with its window."""
    per_item = (
        checked.select("key", F.explode(F.array_distinct(F.transform("hits", lambda h: h.window))).alias("window"))
        .join(small(distinct.select("window", "items"), n_windows), "window")
        .groupBy("key")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    )
    return stash(checked.select("key", spans.alias("spans")).join(per_item, "key"), "bench-matches")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, missing: int = MISSING, extra: int = EXTRA) -> DataFrame:
    """(key, spans, items) of the rows of ``docs`` (key, text) that hold the words of a window close together.

    A window of n words is held by a stretch of n + ``extra`` words (or the whole text, if
    shorter) that has all its words, repeats counted and in any order, but for ``missing``
    at most; never more than a quarter of them. ``spans``
    are the sorted distinct (start, end) of all such stretches, ``items`` as in
    ``phrase_matches``, whose matches are among these.
    """
    spark = docs.sparkSession
    found = stash(windows(benchmark, size), "near-windows")
    # The order of a window's words does not matter here: equal multisets are one window.
    distinct = stash(
        found.groupBy(F.array_sort("words").alias("words")).agg(F.array_sort(F.collect_set("item_id")).alias("items")).withColumn("window", F.xxhash64(F.array_join("words", " "))),
        "near-distinct",
    )
    terms = distinct.select(F.explode("words").alias("term")).distinct()
    n_terms, n_windows = terms.count(), distinct.count()
    words = docs.select("key", match_words(F.col("text")).alias("w"))
    counts = stash(term_counts(words, terms, n_terms), "near-term-counts")
    terms_at = distinct.select("window", F.posexplode("words").alias("at", "term"))
    ranked = terms_at.join(counts, "term", "left").groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("at"), F.col("term")))).alias("r")
    )
    lacking = F.least(F.lit(missing), F.floor(F.size("words") / 4)).cast("int")
    times = F.transform(F.array_distinct("words"), lambda t: F.struct(t.alias("t"), F.size(F.filter("words", lambda x: x == t)).alias("m")))
    rarest = F.array_distinct(F.transform(F.filter(F.slice("r", F.lit(1), F.col("lacking") + 1), lambda a: a.n > 0), lambda a: a.term))
    seeds = stash(
        distinct.withColumn("lacking", lacking).join(ranked, "window").select(
            "window", "lacking", F.size("words").alias("n"), times.alias("times"), F.array_distinct("words").alias("kinds"), F.explode(rarest).alias("anchor")
        ),
        "near-seeds",
    )
    anchors = seeds.select(F.col("anchor").alias("term")).distinct()
    index = stash(term_postings(words).join(small(anchors, n_terms), "term", "left_semi"), "near-postings")
    by_text = stash(index.groupBy(F.col("key").alias("doc_key")).agg(F.collect_set(F.struct("pos", "term")).alias("postings")), "near-postings-by-text")
    discard(index)
    once = docs.groupBy("key").agg(F.first("text").alias("text"))
    seen = once.join(by_text.hint("merge"), F.col("key") == F.col("doc_key")).select("key", "postings", match_words(F.col("text")).alias("w"))
    most = size + extra

    def around(p: Column) -> Column:
        base = F.greatest(p.pos - (most - 1), F.lit(0))
        return F.struct(p.pos.alias("pos"), p.term.alias("term"), base.alias("base"), F.size("w").alias("len"), F.slice("w", base + 1, F.lit(2 * most - 1)).alias("near"))

    placed = seen.select("key", F.explode(F.transform("postings", around)).alias("p")).select("key", "p.*")
    proposed = placed.join(small(seeds, n_windows * (missing + 1)), F.col("term") == F.col("anchor"))
    # Far most proposals lack too many of the window's different words anywhere near.
    likely = proposed.where(F.size(F.array_intersect("kinds", "near")) >= F.size("kinds") - F.col("lacking"))
    reach = F.least(F.col("n") + extra, F.col("len"))
    starts = F.sequence(F.greatest(F.col("pos") - reach + 1, F.lit(0)), F.least(F.col("pos"), F.col("len") - reach))

    def holds(s: Column) -> Column:
        stretch = F.slice("near", s - F.col("base") + 1, reach)
        held = F.aggregate("times", F.lit(0), lambda acc, t: acc + F.least(t.m, F.size(F.filter(stretch, lambda x: x == t.t))))
        return held >= F.col("n") - F.col("lacking")

    stretches = likely.select("key", "window", reach.alias("reach"), F.explode(F.filter(starts, holds)).alias("start"))
    hit = F.struct(F.col("start"), (F.col("start") + F.col("reach")).alias("end"), F.col("window"))
    copies = stash(stretches.select("key", hit.alias("hit")), "near-hits")
    checked = stash(copies.groupBy("key").agg(F.collect_set("hit").alias("hits")), "near-hits-once")
    spans = F.array_sort(F.array_distinct(F.transform("hits", lambda h: F.struct(h.start.alias("start"), h.end.alias("end")))))
    out = _with_items(checked, spans, distinct, n_windows)
    discard(found, distinct, counts, seeds, by_text, copies, checked)
    return out


def covered(spans: Column) -> Column:
    """How many positions sorted (start, end) spans cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.greatest(s.end - F.greatest(acc.end, s.start), F.lit(0))
        return F.struct(F.greatest(acc.end, s.end).alias("end"), (acc.n + fresh).alias("n"))

    return F.aggregate(spans, zero, step, lambda acc: acc.n)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, matches: Callable[..., DataFrame] = phrase_matches) -> DataFrame:
    """``docs`` (with a column text) and, in a struct column ``hit``, what of the benchmark each row holds.

    hit has n_words, n_hit (words in matches, by phrase or by proximity), items (sorted ids
    as strings) and spans (word positions; null without any). If ``docs`` has a column hit,
    the struct's name has underscores before it: it is the last column. Texts are matched
    once however often they repeat. Null and empty texts have no words and no hits; an empty
    benchmark hits nothing, an empty table gives no rows; other columns, whatever their names, stay.
    """
    key, found_key, spans, items, out = free_names(docs.columns, "key", "found_key", "spans", "items", "hit")
    digest = F.substr(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256), F.lit(1), F.lit(32))
    keyed = docs.withColumn(key, F.unhex(digest))
    found = matches(
        keyed.where("text IS NOT NULL").select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")), benchmark, size
    ).select(F.col("key").alias(found_key), F.col("spans").alias(spans), F.col("items").alias(items))
    entries = found.agg(F.sum(F.size(spans) + F.size(items) + 1)).first()[0] or 0
    joined = keyed.join(small(found, entries, BROADCAST_HITS), F.col(key) == F.col(found_key), "left")
    n_words = F.size(match_words(F.col("text").cast("string"))).cast("long")
    hit = F.struct(
        n_words.alias("n_words"),
        F.coalesce(covered(F.col(spans)), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.col(items), F.expr("cast(array() as array<string>)")).alias("items"),
        F.col(spans).alias("spans"),
    )
    return joined.select(*docs.columns, hit.alias(out))


def _digests(spark: SparkSession, sf_dir: str, matches: Callable[..., DataFrame]) -> DataFrame:
    """doc_id, hit and what both queries return of it."""
    got = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), matches=matches)
    return got.select("doc_id", "hit.*", F.size("hit.items").cast("long").alias("n_items"), F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark overlap of all documents with all items."""
    got = _digests(spark, sf_dir, phrase_matches)
    return got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def op9_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words close together in all documents: what exact windows miss if a word is put in, left out or changed."""
    return _digests(spark, sf_dir, proximity_matches).select("doc_id", "n_words", F.col("n_hit").alias("n_near"), "n_items", "items_sha256")
