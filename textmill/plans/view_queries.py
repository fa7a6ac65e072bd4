"""Queries over views, runs, events, rendering, parsing, streams and puzzles."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse as A
from ..functions import render as N
from ..functions.surfaces import NAMES, STYLES, WORDING
from ..operators import puzzles as Z
from ..operators import runs as U
from ..operators import views as V
from ..streaming import events as E
from .registry import query, read

DOCS = V.ViewSpec("doc_id", ("source", "lang"), ("lang", "source"), ("lang", "source"))


@query("SELECT facet, value, count(*) AS n FROM (SELECT 'lang' AS facet, trim(lang) AS value FROM documents UNION ALL SELECT 'source', trim(source) FROM documents) WHERE value IS NOT NULL AND value <> '' GROUP BY ALL")
def facets(spark, sf_dir):
    return V.facet_values(read(spark, sf_dir, "documents").select("lang", "source"), ["lang", "source"])


@query("SELECT doc_id, lang, source FROM documents WHERE contains(lower(source || chr(10) || lang), 'src1') AND lang IN ('en', 'de') ORDER BY doc_id LIMIT 40 OFFSET 40")
def search_page(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return V.page(V.matching(docs, DOCS, "SRC1 ", {"lang": ["en", "de"]}), DOCS, 2)


@query("SELECT count(*) AS total_rows, greatest(1, CAST(ceil(count(*) / 40.0) AS BIGINT)) AS total_pages FROM documents WHERE contains(lower(source || chr(10) || lang), 'src1')")
def search_pages(spark, sf_dir):
    return V.page_count(V.matching(read(spark, sf_dir, "documents").select("doc_id", "lang", "source"), DOCS, "src1"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").withColumnsRenamed({"event_type": "component"})


@query("SELECT event_type AS component, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, component")
def event_counts(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("component").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "component")


@query("SELECT event_id, event_type AS component, user_id FROM events WHERE event_type <> 'view' ORDER BY event_id DESC LIMIT 20")
def event_tail(spark, sf_dir):
    return U.tail(_events(spark, sf_dir).where("component <> 'view'").select("event_id", "component", "user_id"), "event_id", 20)


@query("SELECT event_type AS component, count(*) AS events, round(CASE WHEN epoch_us(max(ts)) > epoch_us(min(ts)) THEN count(*) * 60 / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) ELSE 0 END, 2) AS items_per_minute FROM events GROUP BY 1")
def progress_rate(spark, sf_dir):
    return U.progress(_events(spark, sf_dir)).select("component", "events", "items_per_minute")


@query("SELECT event_type AS target, grouping_id(event_type) AS level, count(*) AS started, count(*) FILTER (value >= 20) AS succeeded, count(*) FILTER (value < 20) AS failed, round(sum(value), 2) AS total_ms, round(max(value), 2) AS max_ms, round(avg(value), 2) AS avg_ms FROM events GROUP BY ROLLUP (event_type)")
def model_metrics(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(F.col("event_type").alias("target"), "value")
    return rows.rollup("target").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("started"), F.count_if(F.col("value") >= 20).alias("succeeded"), F.count_if(F.col("value") < 20).alias("failed"),
        F.round(F.sum("value"), 2).alias("total_ms"), F.round(F.max("value"), 2).alias("max_ms"), F.round(F.avg("value"), 2).alias("avg_ms"),
    )


@query(
    "WITH a AS (SELECT o_orderstatus AS run_id, CAST(count(*) AS VARCHAR) AS n_orders, CAST(min(o_custkey) AS VARCHAR) AS first_key FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), "
    "b AS (SELECT o_orderstatus AS run_id, CAST(count(*) AS VARCHAR) AS n_orders, CAST(min(o_custkey) AS VARCHAR) AS first_key FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1), "
    "j AS (SELECT run_id, a.n_orders AS l1, b.n_orders AS r1, a.first_key AS l2, b.first_key AS r2 FROM a FULL JOIN b USING (run_id)) "
    "SELECT run_id, 'n_orders' AS field, l1 AS left_value, r1 AS right_value FROM j WHERE l1 IS DISTINCT FROM r1 UNION ALL SELECT run_id, 'first_key', l2, r2 FROM j WHERE l2 IS DISTINCT FROM r2"
)
def run_compare(spark, sf_dir):
    """Two summaries of the orders, compared field by field."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    side = lambda k: orders.where(F.col("o_orderkey") % 2 == k).groupBy(F.col("o_orderstatus").alias("run_id")).agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_custkey").alias("first_key"))
    return U.compare(side(0), side(1), "run_id")


def _sql_json(t: str) -> str:
    return f"'\"' || replace(replace(replace(replace(replace({t}, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') || '\"'"


_XML = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    f"SELECT item_id, mode, CASE mode WHEN 'json_string' THEN {_sql_json('text')} WHEN 'json_object' THEN '{{\"translation\": ' || {_sql_json('text')} || '}}' "
    f"WHEN 'json_object_meta' THEN '{{\"source_language\": \"en\", \"target_language\": \"da\", \"translation\": ' || {_sql_json('text')} || '}}' "
    f"WHEN 'xml_tag' THEN '<translation>' || {_XML} || '</translation>' WHEN 'xml_tag_meta' THEN '<translation source_language=\"en\" target_language=\"da\">' || {_XML} || '</translation>' ELSE text END AS target "
    "FROM benchmark, (VALUES ('plain'), ('json_string'), ('json_object'), ('json_object_meta'), ('xml_tag'), ('xml_tag_meta')) m(mode)"
)
def render_targets(spark, sf_dir):
    modes = F.array(*map(F.lit, ["plain", "json_string", "json_object", "json_object_meta", "xml_tag", "xml_tag_meta"]))
    rows = read(spark, sf_dir, "benchmark").select("item_id", "text", F.explode(modes).alias("mode"))
    return rows.select("item_id", "mode", N.target(F.col("mode"), F.col("text"), F.col("text"), F.lit("en"), F.lit("da")).alias("target"))


def _sql_prompts() -> str:
    """All styles in both languages by replacing marks in whole forms, which come from the wording alone."""
    forms = []
    for lang, say in WORDING.items():
        names = NAMES[lang]
        fill = lambda x: x.replace("{source_language}", names["en"]).replace("{target_language}", names["da"])  # noqa: B023, E731
        head, other = (names[k][0].upper() + names[k][1:] for k in ("en", "da"))
        named, block = f"{head} {say['suffix']}:\n@", f"{say['label']}:\n@"
        fields = ", ".join(f'"{k}": ' + ("@j" if k == say["field"] else f'"{v}"') for k, v in sorted((say["payload"] | {say["field"]: ""}).items()))
        special = {
            "translate_into": (say["translate_into"], say["reply_only"], block), "from_to": (say["from_to"], block), "translator_role": (say["translator_role"], say["translator_role_rule"], named),
            "strict_instructions": (say["strict_intro"], say["strict_rule"], named), "minimal_output": (f"{head} {say['arrow']} {other}.", say["output_only"], "@"),
            "marked_text_only": (say["marked_text_only"], f"{say['note_before']}\n<translate_me>\n@\n</translate_me>\n{say['note_after']}"), "json_field_only": (say["json_field_only"], "Payload:\n{" + fields + "}"),
        }
        for style in STYLES:
            parts = special.get(style) or (say["strict_intro"], say[style], named)
            form = "\n\n".join(fill(x) for x in parts).replace("'", "''")
            forms.append(f"('{lang}', '{style}', '{form}')")
    return f"SELECT item_id, lang, style, replace(replace(form, '@j', {_sql_json('text')}), '@', text) AS prompt FROM benchmark, (VALUES {', '.join(forms)}) f(lang, style, form)"


@query(_sql_prompts())
def render_prompts(spark, sf_dir):
    """Benchmark items as texts to translate, in all styles and both languages."""
    kinds = F.broadcast(spark.createDataFrame([(lang, style) for lang in WORDING for style in STYLES], "lang string, style string"))
    rows = read(spark, sf_dir, "benchmark").select("item_id", "text").crossJoin(kinds)
    return rows.select("item_id", "lang", "style", N.prompt(F.col("style"), F.col("text"), F.lit("en"), F.lit("da"), F.col("lang")).alias("prompt"))


@query()
def json_extract(spark, sf_dir):
    """The JSON object inside a wrapped answer; brackets in strings make it no regular language."""
    wrapped = F.concat(F.lit("Sure: ```json\n"), F.col("props"), F.lit("\n``` done"))
    return read(spark, sf_dir, "events").select("event_id", A.json_object(wrapped).alias("found"))


@query("SELECT conv_id, turn, trim(coalesce(nullif(regexp_extract(text, '(?im)^\\s*(?:\\*\\*)?(?:final answer|answer|solution|final)(?:\\*\\*)?\\s*:\\s*(.+)$', 1), ''), list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')[-1])) AS answer FROM conversations WHERE role = 'assistant'")
def answer_envelope(spark, sf_dir):
    return read(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", A.answer(F.col("text")).alias("answer"))


@query("SELECT time_bucket(INTERVAL '10 minutes', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windowed_events(spark, sf_dir):
    """The batch form of the streaming aggregate; both run the same plan."""
    return E.windowed_counts(read(spark, sf_dir, "events"), "event_type")


# Puzzles made from the keys of small tables, so that every scale has its own.
@query(
    "WITH p AS (SELECT s_suppkey AS puzzle_id, CAST(s_suppkey % 16 AS INTEGER) AS rows_sum, CAST((s_suppkey * 7) % 11 AS INTEGER) AS col_sum FROM supplier), m AS (SELECT range AS mask FROM range(512)), "
    "f AS (SELECT mask, list_sum(list_transform(range(9), lambda i: CASE WHEN (mask >> i) & 1 = 1 THEN i % 3 + 1 ELSE 0 END)) AS a, list_sum(list_transform(range(9), lambda i: CASE WHEN (mask >> i) & 1 = 1 THEN i // 3 + 1 ELSE 0 END)) AS b FROM m) "
    "SELECT puzzle_id, count(mask) AS solutions, min(CAST(mask AS VARCHAR)) AS one FROM p LEFT JOIN f ON a = rows_sum AND b = col_sum GROUP BY puzzle_id"
)
def kakurasu_solve(spark, sf_dir):
    """Fillings of a 3x3 board whose weighted row and column totals are given: masks joined on both sums."""
    puzzles = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("puzzle_id"), (F.col("s_suppkey") % 16).alias("rows_sum"), (F.col("s_suppkey") * 7 % 11).alias("col_sum"))
    mask = F.col("mask")
    weight = lambda w: sum(F.shiftright(mask, i).bitwiseAND(F.lit(1)) * w(i) for i in range(9))
    space = Z.bit_masks(spark, 9).select(weight(lambda i: i % 3 + 1).alias("a"), weight(lambda i: i // 3 + 1).alias("b"), mask.cast("string").alias("shown"))
    return Z.enumerate_solutions(puzzles, space, (F.col("a") == F.col("rows_sum")) & (F.col("b") == F.col("col_sum")))


@query(
    "WITH p AS (SELECT s_suppkey AS puzzle_id, CAST(s_suppkey % 4 AS INTEGER) AS who, CAST((s_suppkey * 3 + 1) % 4 AS INTEGER) AS whom, CAST(s_suppkey % 5 AS INTEGER) AS knights FROM supplier), m AS (SELECT CAST(range AS INTEGER) AS mask FROM range(16)) "
    "SELECT puzzle_id, count(mask) AS solutions, min(CAST(mask AS VARCHAR)) AS one FROM p LEFT JOIN m ON ((mask >> who) & 1 = CASE WHEN (mask >> whom) & 1 = 0 THEN 1 ELSE 0 END) AND bit_count(mask) = knights GROUP BY puzzle_id"
)
def knights_solve(spark, sf_dir):
    """Speaker A says B is a knave; the number of knights is known: a truthful speaker's statement holds, else not."""
    k = F.col("s_suppkey")
    puzzles = read(spark, sf_dir, "supplier").select(k.alias("puzzle_id"), (k % 4).cast("int").alias("who"), ((k * 3 + 1) % 4).cast("int").alias("whom"), (k % 5).cast("int").alias("knights"))
    space = Z.bit_masks(spark, 4).select("mask", F.col("mask").cast("string").alias("shown"))
    role = lambda at: F.call_function("shiftright", F.col("mask"), F.col(at)).bitwiseAND(F.lit(1))
    return Z.enumerate_solutions(puzzles, space, (role("who") == 1 - role("whom")) & (F.bit_count("mask") == F.col("knights")))


@query(
    "WITH p AS (SELECT s_suppkey AS puzzle_id, CAST(s_suppkey % 5 AS INTEGER) AS a, CAST((s_suppkey + 2) % 5 AS INTEGER) AS b, CAST((s_suppkey * 2 + 1) % 5 AS INTEGER) AS c FROM supplier), m AS (SELECT CAST(range * 2 AS INTEGER) AS mask FROM range(16)) "
    "SELECT puzzle_id, count(mask) AS solutions, min(CAST(mask AS VARCHAR)) AS one FROM p LEFT JOIN m ON ((mask >> a) & 1) <> ((mask >> b) & 1) AND (((mask >> b) & 1) <> ((mask >> c) & 1) OR ((mask >> a) & 1) <> ((mask >> c) & 1)) GROUP BY puzzle_id"
)
def setsplit_solve(spark, sf_dir):
    """Splits of five elements (the first in group A) in which the listed subsets meet both groups."""
    k = F.col("s_suppkey")
    puzzles = read(spark, sf_dir, "supplier").select(k.alias("puzzle_id"), (k % 5).cast("int").alias("a"), ((k + 2) % 5).cast("int").alias("b"), ((k * 2 + 1) % 5).cast("int").alias("c"))
    space = Z.bit_masks(spark, 4).select((F.col("mask") * 2).alias("mask")).select("mask", F.col("mask").cast("string").alias("shown"))
    side = lambda at: F.call_function("shiftright", F.col("mask"), F.col(at)).bitwiseAND(F.lit(1))
    meets = (side("a") != side("b")) & ((side("b") != side("c")) | (side("a") != side("c")))
    return Z.enumerate_solutions(puzzles, space, meets)


@query(
    "WITH n AS (SELECT CAST(range AS INTEGER) AS v FROM range(4)), o AS (SELECT [a.v, b.v, c.v, d.v] AS p FROM n a, n b, n c, n d WHERE a.v<>b.v AND a.v<>c.v AND a.v<>d.v AND b.v<>c.v AND b.v<>d.v AND c.v<>d.v), "
    "q AS (SELECT s_suppkey AS puzzle_id, CAST(s_suppkey % 4 AS INTEGER) AS x, CAST((s_suppkey + 1) % 4 AS INTEGER) AS y, CAST(s_suppkey % 3 AS INTEGER) AS spot FROM supplier) "
    "SELECT puzzle_id, count(p) AS solutions, min(array_to_string(p, '')) AS one FROM q LEFT JOIN o ON p[x+1] < p[y+1] AND p[((x+2)%4)+1] = spot AND abs(p[x+1]-p[y+1]) = 1 GROUP BY puzzle_id"
)
def lineup_solve(spark, sf_dir):
    """Orders of four people with x right before y and a third person's place known."""
    k = F.col("s_suppkey")
    puzzles = read(spark, sf_dir, "supplier").select(k.alias("puzzle_id"), (k % 4).cast("int").alias("x"), ((k + 1) % 4).cast("int").alias("y"), (k % 3).cast("int").alias("at"))
    space = Z.orders(spark, 4).select("places", F.array_join(F.col("places").cast("array<string>"), "").alias("shown"))
    place = lambda who: F.get("places", who)
    x, y = place(F.col("x")), place(F.col("y"))
    return Z.enumerate_solutions(puzzles, space, (x < y) & (F.abs(x - y) == 1) & (place((F.col("x") + 2) % 4) == F.col("at")))




SPECS = [
    ("futoshiki", {"size": 3, "given": {"0,0": 1}, "less": [[[0, 1], [0, 2]], [[1, 0], [2, 0]]]}),
    ("skyscraper", {"size": 3, "clues": {"left": [3, 2, 1], "top": [3, 2, 1]}}),
    ("starbattle", {"size": 4, "blocked": [[0, 0], [0, 2], [0, 3]]}),
    ("blocked_star", {"size": 4, "blocked": [[0, 1]]}),
    ("jug", {"capacities": [3, 5], "goal": 4}),
    ("cryptarithmetic", {"words": ["TO", "GO"], "total": "OUT"}),
    ("numbrix", {"rows": 3, "cols": 3, "given": {"0": [0, 0], "4": [1, 1], "8": [2, 2]}}),
    ("hitori", {"grid": [[1, 1, 2], [2, 3, 1], [3, 1, 1]]}),
    ("lightup", {"board": ["..#", "...", "#.."]}),
    ("countdown", {"numbers": [2, 3, 7], "goal": 13}),
    ("zebra", {"houses": 3, "axes": {"color": ["red", "blue", "green"], "pet": ["cat", "dog", "fish"]}, "clues": [["at", "red", 0], ["left", "red", "blue"], ["same", "blue", "cat"], ["beside", "cat", "dog"], ["at", "dog", 0]]}),
]


@query()
def csp_unique(spark, sf_dir):
    """Solution counts, up to two, of one puzzle of every search family for each nation."""
    made = spark.createDataFrame([(f, json.dumps(s)) for f, s in SPECS], "family string, spec string")
    keys = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("puzzle_id"))
    return Z.search_udf(keys.crossJoin(F.broadcast(made)), Z.solve)
