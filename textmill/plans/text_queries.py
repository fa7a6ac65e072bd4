"""Queries over evidence wording, language filters, reviews, payloads, completions and made puzzles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import envelopes as EV
from ..functions import evidence as V
from ..functions import language as L
from ..functions import payload as Y
from ..functions import review as W
from ..functions import rows as RW
from ..operators import completion as M
from ..operators import generators as G
from .registry import query, read

_LETTERS = "array_to_string(regexp_extract_all(text, '\\p{L}+'), ' ')"
_SAMPLE = f"CASE WHEN len({_LETTERS}) <= 4000 THEN {_LETTERS} ELSE concat_ws(' ', substr({_LETTERS}, 1, 1333), substr({_LETTERS}, CAST(floor((len({_LETTERS}) - 1333) / 2) AS BIGINT) + 1, 1333), right({_LETTERS}, 1333)) END"
_LANGS = ("en", "de", "fr", "es")


def _sql_detect() -> str:
    counts = ", ".join("len(list_filter(w, lambda x: list_contains([" + ",".join(f"'{x}'" for x in L.FUNCTION_WORDS[lang]) + f"], x))) AS n_{lang}" for lang in _LANGS)
    best = "greatest(" + ", ".join(f"n_{lang}" for lang in _LANGS) + ")"
    cases = " ".join(f"WHEN n_{lang} = {best} THEN '{lang}'" for lang in _LANGS)
    return f"SELECT doc_id, CASE WHEN {best} = 0 THEN NULL {cases} END AS detected FROM (SELECT doc_id, {counts} FROM (SELECT doc_id, string_split(lower({_SAMPLE}), ' ') AS w FROM documents))"


@query(_sql_detect())
def language_filter(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", L.detect(F.col("text"), _LANGS).alias("detected"))


def _sql_recall(t: str) -> str:
    for pattern, new in V.REWORDINGS:
        t = f"regexp_replace({t}, '(?i){pattern}', '{new}', 'g')"
    return f"regexp_replace(regexp_replace(regexp_replace({t}, '\\s+', ' ', 'g'), '\\s+([.,;:!?])', '\\1', 'g'), '^[ -]+|[ -]+$', '', 'g')"


_CLAIM = "'According to the evidence , the source ' || text || ' - the text states that evidence -'"


@query(f"SELECT item_id, {_sql_recall('trim(' + _CLAIM + ')')} AS claim FROM benchmark")
def recall_text(spark, sf_dir):
    claim = F.concat(F.lit("According to the evidence , the source "), F.col("text"), F.lit(" - the text states that evidence -"))
    return read(spark, sf_dir, "benchmark").select("item_id", V.recall_text(claim).alias("claim"))


@query("SELECT c_custkey, array_to_string(list_filter(['Wikidata description: ' || trim(c_mktsegment), 'Aliases: ' || c_name || ', ' || lower(c_name), 'Related links: ' || n_name], lambda x: x IS NOT NULL)[1:2], ' | ') AS facts, regexp_matches(lower(c_mktsegment), 'physicist|chemist|writer|politician|artist|actor|philosopher|scientist') OR regexp_matches(lower(n_name), 'births|deaths|people|actors|actresses|writers|scientists|philosophers|politicians|artists') AS person FROM customer JOIN nation ON c_nationkey = n_nationkey")
def entity_facts(spark, sf_dir):
    """Customers as entities, nations as their links: a small dimension joined, then columns."""
    rows = read(spark, sf_dir, "customer").join(F.broadcast(read(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    none = F.expr("cast(array() as array<string>)")
    told = V.facts(F.col("c_mktsegment"), F.array("c_name", F.lower("c_name")), none, none, F.array("n_name"), 2)
    return rows.select("c_custkey", F.array_join(told, " | ").alias("facts"), V.is_person(F.col("c_mktsegment"), F.array("n_name"), none).alias("person"))


_REVIEWS = ("PASS all fine", "fail: bad", "There is no unsupported claim here", "The answer lacks a source", "does not invent facts", "malformed turn 2", "Accepted", "good")


@query("SELECT review, ok FROM (VALUES ('PASS all fine', true), ('fail: bad', false), ('There is no unsupported claim here', true), ('The answer lacks a source', false), ('does not invent facts', true), ('malformed turn 2', false), ('Accepted', true), ('good', true)) v(review, ok)")
def review_verdicts(spark, sf_dir):
    """Fixed reviews with their verdicts."""
    return spark.createDataFrame([(r,) for r in _REVIEWS], "review string").select("review", W.passed(F.col("review")).alias("ok"))


@query("SELECT doc_id, len(regexp_replace(t, '[^\\p{L}]', '', 'g')) / greatest(len(regexp_replace(t, '\\s', '', 'g')), 1) >= 0.45 AND len(t) >= 80 AS readable FROM (SELECT doc_id, trim(text) AS t FROM documents)")
def payload_readable(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", Y.readable(F.col("text")).alias("readable"))


@query()
def payload_blocks(spark, sf_dir):
    """Blocks of every document; merging needs a cursor over them."""
    return read(spark, sf_dir, "documents").select("doc_id", F.posexplode(Y.payload_blocks(F.col("text"))).alias("block_no", "block"))


@query("SELECT item_id, 'echo:' || substr(sha256(text), 1, 12) AS answer, CAST(NULL AS VARCHAR) AS answer_error FROM benchmark")
def completions(spark, sf_dir):
    """Answers of the stand-in generator: what goes through the boundary comes back on its row."""
    return M.complete(read(spark, sf_dir, "benchmark").select("item_id", "text"), "text", "answer", M.Echo()).drop("text")


@query("SELECT n_nationkey AS puzzle_id, family, 1 AS solutions, true AS parseable, true AS correct FROM nation, (VALUES " + ", ".join(f"('{f}')" for f in sorted(G.MAKERS)) + ") f(family)")
def puzzle_dataset(spark, sf_dir):
    """One made puzzle of every family for each nation: exactly one solution, its own answer right."""
    keys = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("puzzle_id"))
    families = spark.createDataFrame([(f,) for f in sorted(G.MAKERS)], "family string")
    return G.check(G.generate(keys.crossJoin(F.broadcast(families)).repartition("puzzle_id", "family"), 3))


@query("SELECT item_id, kind, text AS answer FROM benchmark, (VALUES ('block'), ('json'), ('xml'), ('yaml')) k(kind)")
def answer_envelopes(spark, sf_dir):
    """Wrapped after a reasoning, and taken out again: what comes back is what went in."""
    rows = read(spark, sf_dir, "benchmark").select("item_id", "text", F.explode(F.array(*map(F.lit, EV.KINDS))).alias("kind"))
    kind, label = F.col("kind"), F.lit("ANSWER")
    said = F.concat(F.lit("Some steps.\n\n"), EV.wrap(kind, F.col("text"), label))
    return rows.select("item_id", "kind", EV.unwrap(kind, said, label).alias("answer"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'same_language' ELSE 'cross_language' END AS mode, CASE WHEN len(text) > 400 THEN 2 ELSE 1 END AS citations, trim(text) = '' OR (contains(text, '<') AND contains(text, '>')) OR contains(lower(text), 'det endelige svar') OR contains(lower(text), 'final answer') AS placeholder FROM documents")
def row_projections(spark, sf_dir):
    """Language mode, required citations and placeholder answers of the documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    n = F.when(F.length("text") > 400, 3).otherwise(1)
    return docs.select("doc_id", RW.language_mode(F.lit("en"), F.col("lang")).alias("mode"), RW.required_citations(n).alias("citations"), RW.placeholder(F.col("text")).alias("placeholder"))
