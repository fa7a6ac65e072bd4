"""Queries over plans of rows: profiles, grids, acceptance, resuming, record fields, keywords, model counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records as R
from ..operators import planning as L
from .registry import query, read


def _docs(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", *columns)


@query(
    "WITH p AS (SELECT profile, copy FROM (VALUES ('terse', 1), ('formal', 3), ('warm', 2)) v(profile, weight), range(0, 3) r(copy) WHERE copy < weight), "
    "t AS (SELECT profile, row_number() OVER (ORDER BY md5('3:' || profile || '#' || copy), profile || '#' || copy) - 1 AS turn FROM p), "
    "d AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT doc_id, source, profile FROM d JOIN t ON i % 6 = turn"
)
def weighted_profiles(spark, sf_dir):
    return L.weighted_cycle(_docs(spark, sf_dir, "source"), "doc_id", {"terse": 1, "formal": 3, "warm": 2}, 3)


@query(
    "SELECT CAST(row_number() OVER (ORDER BY a, b, c) - 1 AS BIGINT) AS ord, variant, template, lang FROM (VALUES (0, 'plain'), (1, 'short')) x(a, variant), "
    "(VALUES (0, 'ask'), (1, 'tell'), (2, 'plan')) y(b, template), (VALUES (0, 'da'), (1, 'en')) z(c, lang)"
)
def seed_specs(spark, sf_dir):
    return L.grid(spark, {"variant": ("plain", "short"), "template": ("ask", "tell", "plan"), "lang": ("da", "en")})


@query(
    "WITH d AS (SELECT doc_id, coalesce(len(text) > 2000, false) AS ok FROM documents), "
    "c AS (SELECT *, coalesce(sum(ok::INT) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d) "
    "SELECT doc_id, CASE WHEN ok THEN 'accepted' ELSE 'rejected' END AS outcome FROM c WHERE before < 40"
)
def strict_acceptance(spark, sf_dir):
    return L.strict_accept(_docs(spark, sf_dir, "text"), F.length("text") > 2000, "doc_id", 40).drop("text")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS r FROM documents) WHERE r > (SELECT count(*) FROM labels)")
def resume_by_count(spark, sf_dir):
    return L.resume_by_count(_docs(spark, sf_dir, "lang"), read(spark, sf_dir, "labels"), "doc_id")


AXES = {
    "surface_intro": "['context', 'assignment', 'task_first']", "surface_instruction": "['solve', 'unique', 'consistency']", "surface_answer": "['respond', 'write', 'complete']",
    "surface_clue": "['plain', 'compact', 'deductive']", "surface_response_envelope": "['answer_block', 'solution_block', 'final_block', 'json', 'xml', 'yaml']",
}


def _sql_stable(key: str) -> str:
    return f"CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({key}, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda h, c: (h*33+c) % 2147483647) AS BIGINT)"


@query("SELECT doc_id, " + ", ".join(f"({values})[1 + {_sql_stable(f'doc_id || chr(124) || {chr(39)}{name}{chr(39)}')} % len({values})] AS {name}" for name, values in AXES.items()) + " FROM documents")
def surface_plans(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", R.surface_plan(F.col("doc_id").cast("string")).alias("p")).select("doc_id", "p.*")


@query(
    "WITH o AS (SELECT o_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS got, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey)[1:3] AS want FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) "
    "SELECT o_orderkey, len(got) > 0 AND list_contains(m, w[1]) AND (len(w) = 1 OR len(list_intersect(w, m)) >= 2) AS grounded FROM (SELECT *, list_transform(got, lambda x: x % 5) AS m, list_distinct_keep AS w FROM "
    "(SELECT *, list_transform(list_filter(range(1, len(want) + 1), lambda i: list_position(list_transform(want, lambda x: x % 5), want[i] % 5) = i), lambda i: want[i] % 5) AS list_distinct_keep FROM o))"
)
def qa_retrieval_grounded(spark, sf_dir):
    """Orders as questions: their first suppliers (modulo 5) are expected, their parts (modulo 5) retrieved."""
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))).alias("l"))
    expected = F.array_distinct(F.transform(F.slice("l", 1, 3), lambda x: x.l_suppkey % 5))
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), R.qa_grounded(expected, F.transform("l", lambda x: x.l_partkey % 5)).alias("grounded"))


DEFINED = {"count:sentences": (("da", "en"), ("prose",)), "format:json_keys": (("en",), ("json", "prose")), "format:bullet_list": (("da", "en"), ("list", "prose"))}
_IDS = "CASE i % 4 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['count:sentences', 'format:bullet_list'] WHEN 2 THEN ['format:json_keys'] ELSE ['format:bullet_list', 'unknown'] END"


@query(
    f"WITH d AS (SELECT c_custkey, ids, lang, shape FROM (SELECT c_custkey, {_IDS} AS ids, CASE WHEN i % 3 = 0 THEN 'da' ELSE 'en' END AS lang, (['prose', 'json', 'list'])[1 + i % 3] AS shape FROM (SELECT c_custkey, c_custkey AS i FROM customer))), "
    "k AS (SELECT * FROM (VALUES ('count:sentences', ['da','en'], ['prose']), ('format:json_keys', ['en'], ['json','prose']), ('format:bullet_list', ['da','en'], ['list','prose'])) v(id, langs, shapes)), "
    "u AS (SELECT c_custkey, lang, shape, unnest(ids) AS id FROM d), f AS (SELECT c_custkey, bool_and(coalesce(list_contains(langs, lang) AND list_contains(shapes, shape), false)) AS ok FROM u LEFT JOIN k USING (id) GROUP BY 1) "
    "SELECT c_custkey, coalesce(ok, false) AS supported FROM d LEFT JOIN f USING (c_custkey)"
)
def constraints_supported(spark, sf_dir):
    i = F.col("c_custkey")
    lists = [[], ["count:sentences", "format:bullet_list"], ["format:json_keys"], ["format:bullet_list", "unknown"]]
    ids = F.get(F.array(*[F.array(*map(F.lit, x)).cast("array<string>") for x in lists]), (i % 4).cast("int"))
    shape = F.get(F.array(F.lit("prose"), F.lit("json"), F.lit("list")), (i % 3).cast("int"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", ids.alias("ids"), F.when(i % 3 == 0, "da").otherwise("en").alias("lang"), shape.alias("shape"))
    return rows.select("c_custkey", R.constraints_supported(F.col("ids"), F.col("lang"), F.col("shape"), DEFINED).alias("supported"))


@query(
    "SELECT count(*) AS parse_attempts, count(*) FILTER (k <> 2) AS parse_successes, count(*) FILTER (k = 2) AS parse_failures, count(*) FILTER (k <> 0) AS repair_attempts, "
    "count(*) FILTER (k = 1) AS repair_successes, count(*) FILTER (k = 2) AS repair_failures FROM (SELECT doc_id % 3 AS k FROM documents)"
)
def json_metrics(spark, sf_dir):
    """Answers as JSON, as JSON in a fence, and as prose: what parses at once, after taking off the fence, or never."""
    k = F.col("doc_id") % 3
    body = F.concat(F.lit('{"id":'), F.col("doc_id").cast("string"), F.lit("}"))
    answer = F.when(k == 0, body).when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise("no object here")
    rows = _docs(spark, sf_dir).select(answer.alias("answer"))
    read_id = lambda t: F.from_json(t, "id long").id.isNotNull()
    return L.parse_metrics(rows, read_id(F.col("answer")), read_id(F.regexp_extract("answer", r"(?s)\{.*\}", 0)))


@query(
    "WITH d AS (SELECT doc_id, [{'id': 'count:keywords_multiple', 'n': doc_id % 4}, {'id': 'words:ordered_keywords', 'n': 0}, {'id': 'format:no_digits', 'n': 9}, {'id': 'start_end:first_word', 'n': 0}] AS c, ['a','b','c','d','e'][1:CAST(doc_id % 6 AS INT)] AS w FROM documents), "
    "t AS (SELECT doc_id, w, [doc_id % 4, 2, 0, 1] AS k FROM d) "
    "SELECT doc_id, CAST(list_sum(k) AS INTEGER) AS budget, array_to_string(list_transform(range(1, 5), lambda j: CASE WHEN len(w) = 0 THEN '' ELSE array_to_string(list_transform(range(CAST(coalesce(list_sum(k[1:j-1]), 0) AS BIGINT), CAST(list_sum(k[1:j]) AS BIGINT)), lambda p: w[1 + p % len(w)]), '+') END), '|') AS words FROM t"
)
def keyword_rotation(spark, sf_dir):
    one = lambda name, n: F.struct(F.lit(name).alias("id"), n.cast("int").alias("n"))
    zero = F.lit(0)
    constraints = F.array(one("count:keywords_multiple", F.col("doc_id") % 4), one("words:ordered_keywords", zero), one("format:no_digits", F.lit(9)), one("start_end:first_word", zero))
    words = F.slice(F.array(*map(F.lit, "abcde")), F.lit(1), (F.col("doc_id") % 6).cast("int"))
    rows = _docs(spark, sf_dir).select("doc_id", constraints.alias("c"), words.alias("w"))
    turned = F.transform(R.rotate_keywords(F.col("c"), F.col("w")), lambda x: F.array_join(x, "+"))
    return rows.select("doc_id", R.keyword_budget(F.col("c")).alias("budget"), F.array_join(turned, "|").alias("words"))


@query(
    "SELECT c_custkey, array_to_string(list_filter([trim(c_mktsegment)], lambda x: x <> ''), ',') AS listed, coalesce(c_nationkey >= 18 OR c_nationkey % 5 = 0, true) AS adult, "
    "concat_ws(chr(10), nullif(trim(c_name), ''), nullif(trim(c_mktsegment), '')) AS joined, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'row-' || substr(sha1('{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\"}'), 1, 12) END AS item_key, "
    "CASE WHEN c_custkey % 3 = 0 THEN 'x+y z' WHEN c_custkey % 3 = 1 THEN 'plain, text' ELSE '' END AS parsed FROM customer"
)
def record_fields(spark, sf_dir):
    i = F.col("c_custkey")
    raw = F.when(i % 3 == 0, "['x', \"y z\", 'w']").when(i % 3 == 1, "plain, text").otherwise(" ")
    own = F.when(i % 2 == 0, i.cast("string"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.array_join(R.as_list(F.col("c_mktsegment")), ",").alias("listed"),
        R.age_at_least(F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")), 18).alias("adult"), R.joined_fields(F.col("c_name"), F.col("c_mktsegment")).alias("joined"),
        R.item_key(own, F.struct("c_custkey", "c_name")).alias("item_key"), F.array_join(R.list_values(raw, 2), "+").alias("parsed"),
    )


@query("SELECT lang, CASE WHEN count(DISTINCT source) = 1 THEN min(source) END AS generation_model FROM (SELECT lang, CASE WHEN lang = 'en' THEN 'one' ELSE source END AS source FROM documents) GROUP BY lang")
def published_models(spark, sf_dir):
    rows = _docs(spark, sf_dir, "lang", "source").withColumn("source", F.when(F.col("lang") == "en", "one").otherwise(F.col("source")))
    return L.published_model(rows, "source", ["lang"])


@query("SELECT item_id, (SELECT bool_or(len(text) > 300) FROM benchmark) AS check_responses FROM benchmark")
def expected_responses(spark, sf_dir):
    return L.expecting_responses(read(spark, sf_dir, "benchmark"), F.length("text") > 300).select("item_id", "check_responses")


@query("SELECT c_custkey, p[1] AS prompt, p[2] AS reasoning, p[3] AS target FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN ['da','da','da'] ELSE ['en','da','en'] END AS p FROM customer)")
def language_plans(spark, sf_dir):
    set_ = F.col("c_custkey") % 2 != 0
    plan = R.language_plan(F.lit("da"), *[F.when(set_, x) for x in ("en", "da", "en")])
    return read(spark, sf_dir, "customer").select("c_custkey", plan.alias("p")).select("c_custkey", "p.prompt", "p.reasoning", "p.target")


@query(
    "SELECT s_suppkey, concat_ws(' ', nullif(trim(s_name), ''), 'claim ' || s_suppkey, 'a', 'b') AS query, CASE WHEN s_suppkey % 2 = 0 THEN 'Kilde 1 er central, fordi den dækker claim ' || s_suppkey || '|Kilde 2 er sekundær støtte og bør kun bruges til detaljer|Kilde 3 er sekundær støtte og bør kun bruges til detaljer' "
    "ELSE 'Source 1 is central because it covers claim ' || s_suppkey || '|Source 2 is secondary support and should only add detail|Source 3 is secondary support and should only add detail' END AS plan FROM supplier"
)
def source_plans(spark, sf_dir):
    claim = F.concat(F.lit("claim "), F.col("s_suppkey").cast("string"))
    sources = F.array(*[F.struct(F.lit(str(k)).alias("citation_id"), claim.alias("claim")) for k in (1, 2, 3, 4)])
    plan = lambda lang: F.array_join(R.source_plan(sources, F.lit(1), lang), "|")
    return read(spark, sf_dir, "supplier").select(
        "s_suppkey", R.support_query(F.col("s_name"), claim, lists=[F.array(F.lit("a"), F.lit(" "), F.lit("b"))]).alias("query"),
        F.when(F.col("s_suppkey") % 2 == 0, plan("da")).otherwise(plan("en")).alias("plan"),
    )
