"""Queries over checks, coverage, counters, sampling, splits and resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import checks as K
from ..operators import sampling as S
from .registry import query, read

CHECKED = (
    "WITH r AS (SELECT doc_id, len(text) BETWEEN 200 AND 4000 AS length_ok, len(text) - len(translate(text, '#%&*$', '')) <= 20 AS few_symbols, "
    "text NOT LIKE '%@%' AS no_email, coalesce(quality = 1, false) AS labelled_good FROM documents LEFT JOIN labels USING (doc_id)), "
    "c AS (UNPIVOT r ON length_ok, few_symbols, no_email, labelled_good INTO NAME check_name VALUE ok) "
)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    text = F.col("text")
    return K.verify(
        docs,
        {
            "length_ok": F.length(text).between(200, 4000),
            "few_symbols": F.length(text) - F.length(F.translate(text, "#%&*$", "")) <= 20,
            "no_email": ~text.contains("@"),
            "labelled_good": F.col("quality") == 1,
        },
    )


@query(CHECKED + "SELECT doc_id, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed FROM c GROUP BY doc_id")
def doc_checks(spark, sf_dir):
    ok = F.map_values("checks")
    n = F.size(F.filter(ok, lambda x: x)).cast("long")
    return _checked(spark, sf_dir).select("doc_id", n.alias("passed"), (F.size(ok) - n).cast("long").alias("failed"))


@query(CHECKED + "SELECT check_name, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed, round(avg(CAST(ok AS INTEGER)), 6) AS pass_rate FROM c GROUP BY check_name")
def check_metrics(spark, sf_dir):
    return K.metrics(_checked(spark, sf_dir)).withColumn("pass_rate", F.round("pass_rate", 6))


@query(
    CHECKED + ", f AS (SELECT check_name, doc_id, row_number() OVER (PARTITION BY check_name ORDER BY doc_id) AS r FROM c WHERE NOT ok) "
    "SELECT check_name, count(*) AS failed, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY r) FILTER (r <= 5) AS examples FROM f GROUP BY check_name"
)
def failure_summary(spark, sf_dir):
    return K.failures(_checked(spark, sf_dir), "doc_id")


@query("SELECT 'quality' AS score_name, round(avg(quality), 6) AS mean, count(quality) AS n FROM labels UNION ALL SELECT 'toxic', round(avg(toxic), 6), count(toxic) FROM labels")
def score_means(spark, sf_dir):
    scores = F.create_map(F.lit("quality"), F.col("quality").cast("double"), F.lit("toxic"), F.col("toxic").cast("double"))
    return K.score_means(read(spark, sf_dir, "labels").withColumn("scores", scores)).withColumn("mean", F.round("mean", 6))


@query(
    "WITH p AS (SELECT lang, source, count(*) AS planned FROM documents GROUP BY ALL), o AS (SELECT lang, source, count(*) AS observed FROM documents JOIN labels USING (doc_id) GROUP BY ALL) "
    "SELECT lang, source, coalesce(planned, 0) AS planned, coalesce(observed, 0) AS observed, CASE WHEN observed IS NULL THEN 'missing' WHEN planned IS NULL THEN 'unexpected' WHEN planned <> observed THEN 'mismatched' ELSE 'passed' END AS verdict FROM p FULL JOIN o USING (lang, source)"
)
def coverage_lang_source(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return K.coverage(docs, docs.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi"), ["lang", "source"])


@query("SELECT w.lang, coalesce(n, 0) AS n, w.least, coalesce(n, 0) >= w.least AS passed FROM (VALUES ('en', 100), ('fr', 50), ('da', 10)) w(lang, least) LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) USING (lang)")
def counter_minimums(spark, sf_dir):
    return K.minimums(read(spark, sf_dir, "documents"), "lang", {"en": 100, "fr": 50, "da": 10})


@query("SELECT count(DISTINCT text) AS n_unique, count(*) AS n, count(DISTINCT text) >= 100 AS passed FROM documents")
def unique_text(spark, sf_dir):
    # Distinct by digest: the shuffle carries 32 bytes a row, not the text.
    docs = read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("h"))
    return docs.groupBy("h").agg(F.count(F.lit(1)).alias("c")).agg(F.count(F.lit(1)).alias("n_unique"), F.sum("c").alias("n"), (F.count(F.lit(1)) >= 100).alias("passed"))


@query("SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source ORDER BY n DESC, source LIMIT 10")
def value_counts(spark, sf_dir):
    return K.value_counts(read(spark, sf_dir, "documents"), "source", 10)


@query(CHECKED + "SELECT check_name AS reason, count(*) AS n FROM c WHERE NOT ok GROUP BY 1 ORDER BY n DESC, reason")
def reject_reasons(spark, sf_dir):
    bad = _checked(spark, sf_dir).select(F.explode(F.map_keys(F.map_filter("checks", lambda _, ok: ~ok))).alias("reason"))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


@query("SELECT lang, source, grouping_id(lang, source) AS level, count(*) AS n, round(avg(n_chars), 4) AS mean_chars FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), ())")
def dataset_counters(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("lang", "source", "n_chars")
    return docs.rollup("lang", "source").agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 4).alias("mean_chars"))


@query("WITH c AS (SELECT lang, quality, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL), t AS (SELECT * FROM (VALUES ('en', 1, 500), ('en', 0, 20), ('de', 1, 60), ('xx', 1, 5)) v(lang, quality, target)) SELECT lang, quality, target, target - coalesce(n, 0) AS short FROM t LEFT JOIN c USING (lang, quality) WHERE coalesce(n, 0) < target")
def success_targets(spark, sf_dir):
    """Quotas that the labelled documents do not reach, and by how much."""
    targets = spark.createDataFrame([("en", 1, 500), ("en", 0, 20), ("de", 1, 60), ("xx", 1, 5)], "lang string, quality int, target int")
    seen = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id").groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"))
    joined = targets.join(seen, ["lang", "quality"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return joined.where("n < target").select("lang", "quality", "target", (F.col("target") - F.col("n")).alias("short"))


@query("SELECT count(*) AS scanned, count(*) FILTER (len(text) >= 400) AS usable, count(*) FILTER (len(text) < 400) AS too_short, count(*) FILTER (len(text) >= 400 AND doc_id IN (SELECT doc_id FROM labels)) AS resumed, count(*) FILTER (len(text) >= 400 AND doc_id NOT IN (SELECT doc_id FROM labels)) AS pending FROM documents")
def count_articles(spark, sf_dir):
    done = read(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("done", F.lit(True))
    docs = read(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n")).join(done, "doc_id", "left")
    usable, seen = F.col("n") >= 400, F.col("done").isNotNull()
    return docs.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(usable).alias("usable"), F.count_if(F.col("n") < 400).alias("too_short"),
        F.count_if(usable & seen).alias("resumed"), F.count_if(usable & ~seen).alias("pending"),
    )


@query("SELECT doc_id, text, lang, source, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'eval' END AS split FROM documents")
def train_eval_split(spark, sf_dir):
    return S.split_by_position(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id", 0.9)


@query("SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) <= floor(count(*) OVER (PARTITION BY source) * 0.8) THEN 'train' ELSE 'eval' END AS split FROM documents")
def per_source_split(spark, sf_dir):
    return S.split_by_position(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 0.8, "source")


QUOTA = "SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 10 OR source IS NULL"


@query(QUOTA)
def per_source_quota(spark, sf_dir):
    return S.quota(read(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "source", "doc_id", 10)


@query("SELECT doc_id, lang, pool, (row_number() OVER (PARTITION BY lang, pool ORDER BY doc_id) - 1) % 5 AS variant FROM (SELECT doc_id, lang, CASE WHEN len(text) > 8000 THEN 'long' ELSE 'short' END AS pool FROM documents)")
def variant_cycle(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.length("text") > 8000, "long").otherwise("short").alias("pool"))
    return S.cycle(docs, ["lang", "pool"], "doc_id", 5, "variant").withColumn("variant", F.col("variant").cast("long"))


@query("SELECT CAST(row_number() OVER (ORDER BY style, direction, prompt_language) - 1 AS BIGINT) AS ord, style, direction, prompt_language FROM (VALUES ('translate_into'), ('from_to'), ('minimal_output')) s(style), (VALUES ('da-en'), ('en-da')) d(direction), (VALUES ('da'), ('en')) p(prompt_language)")
def variant_grid(spark, sf_dir):
    """The cross product of three configured lists: its size is the configuration's."""
    one = lambda name, values: spark.createDataFrame([(v,) for v in values], f"{name} string")
    grid = one("style", ["translate_into", "from_to", "minimal_output"]).crossJoin(one("direction", ["da-en", "en-da"])).crossJoin(one("prompt_language", ["da", "en"]))
    order = Window.orderBy("style", "direction", "prompt_language")
    return grid.select((F.row_number().over(order) - 1).cast("long").alias("ord"), "style", "direction", "prompt_language")


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS round FROM documents")
def interleave(spark, sf_dir):
    return S.interleave(read(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id").withColumn("round", F.col("round").cast("long"))


@query("SELECT doc_id, lang, (row_number() OVER (PARTITION BY lang ORDER BY md5('11:' || doc_id), doc_id) - 1) % 6 AS recipe FROM documents")
def plan_catalog(spark, sf_dir):
    return S.shuffled_cycle(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 6, 11, "lang", "recipe").withColumn("recipe", F.col("recipe").cast("long"))


@query("WITH d AS (SELECT doc_id, text, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents), p AS (SELECT * FROM (VALUES (0, 'novice', 'terse'), (1, 'expert', 'formal'), (2, 'student', 'warm')) v(j, persona, tone)), a AS (SELECT * FROM (VALUES (0, 'definition'), (1, 'cause')) v(k, angle)) SELECT doc_id, text, lang, i, persona, tone, angle FROM d JOIN p ON i % 3 = j JOIN a ON (i // 3) % 2 = k")
def persona_pairing(spark, sf_dir):
    docs = S.numbered(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["doc_id"], "i")
    personas = spark.createDataFrame([(0, "novice", "terse"), (1, "expert", "formal"), (2, "student", "warm")], "j int, persona string, tone string")
    angles = spark.createDataFrame([(0, "definition"), (1, "cause")], "k int, angle string")
    paired = docs.join(F.broadcast(personas), F.col("i") % 3 == F.col("j")).join(F.broadcast(angles), F.floor(F.col("i") / 3) % 2 == F.col("k"))
    return paired.select("doc_id", "text", "lang", "i", "persona", "tone", "angle")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf_dir):
    return S.resume(read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100) WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_limit_anti(spark, sf_dir):
    """The limit counts rows that are already processed: it comes before the anti-join."""
    return S.resume(read(spark, sf_dir, "documents").select("doc_id").orderBy("doc_id").limit(100), read(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM documents) WHERE r <= 1")
def limit_after_first(spark, sf_dir):
    return S.limit_after_first(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0)


@query("WITH g AS (SELECT lang AS k, count(*) AS n FROM documents GROUP BY 1), i AS (SELECT k, n, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS kinds FROM g) SELECT k AS variant, 1003 // kinds + CASE WHEN i < 1003 % kinds THEN 1 ELSE 0 END AS rows FROM i")
def variant_counts(spark, sf_dir):
    """An even split of 1003 rows; the first variants take the remainder. One row for each language."""
    kinds = read(spark, sf_dir, "documents").select(F.col("lang").alias("variant")).distinct()
    numbered = kinds.withColumn("i", F.row_number().over(Window.orderBy("variant")) - 1)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return numbered.withColumn("kinds", n).select("variant", (F.floor(F.lit(1003) / F.col("kinds")) + F.when(F.col("i") < 1003 % F.col("kinds"), 1).otherwise(0)).cast("long").alias("rows"))


@query("SELECT doc_id, lang, source, is_first FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY md5(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) ORDER BY doc_id) = 1 AS is_first FROM documents) WHERE is_first")
def keep_first_text(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5(F.lower(T.collapse(F.col("text")))).alias("h"))
    return S.keep_first(docs, F.col("h"), "doc_id").select("doc_id", "lang", "source", F.lit(True).alias("is_first"))
