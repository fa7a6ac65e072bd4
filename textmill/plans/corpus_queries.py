"""Queries over the memory core: cleaning, chunking, indexing, retrieval, grounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import grounding as G
from ..functions import text as T
from ..operators import corpus as C
from .registry import query, read, sql_chunks, sql_clean, sql_index, sql_sentences, sql_tokens, sql_words

CHUNKS = sql_chunks("documents")
#: Chunks, their index tokens, the benchmark's tokens and the overlaps of both.
RETRIEVAL = (
    f"WITH ch AS ({CHUNKS}), ix AS (SELECT doc_id, chunk_no, word_count, unnest({sql_index('text')}) AS token FROM ch), "
    f"q AS (SELECT item_id AS query_id, unnest(list_distinct({sql_tokens('text')})) AS token FROM benchmark), "
    "ov AS (SELECT query_id, doc_id, chunk_no, word_count, count(*) AS overlap FROM q JOIN ix USING (token) GROUP BY ALL), "
    "top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, word_count DESC, doc_id, chunk_no) AS rank FROM ov) "
)


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chunk(read(spark, sf_dir, "documents").select("doc_id", "text"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), T.tokens(F.col("text")).alias("tokens"))


def _top(spark: SparkSession, sf_dir: str, k: int, per_source: bool = False) -> DataFrame:
    return C.retrieve(_items(spark, sf_dir), _chunks(spark, sf_dir), k, per_source)


@query(f"SELECT doc_id, {sql_clean('text')} AS text FROM documents")
def clean_corpus(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.clean_lines(F.col("text")).alias("text"))


@query(
    "SELECT doc_id, CAST(i-1 AS INTEGER) AS section_no, s[i] AS text FROM (SELECT doc_id, s, unnest(range(1, len(s)+1)) AS i FROM ("
    "SELECT doc_id, CASE WHEN len(p)>0 THEN p ELSE [text] END AS s FROM (SELECT doc_id, text, list_filter(list_transform("
    "string_split(text, chr(10)||chr(10)), lambda x: trim(x, ' '||chr(9)||chr(13)||chr(11)||chr(12)||chr(10))), lambda x: x <> '') AS p FROM documents)))"
)
def sectionize(spark, sf_dir):
    return C.sectionize(read(spark, sf_dir, "documents"))


@query(CHUNKS)
def chunk_docs(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query(
    f"SELECT count(*) AS chunks, count(DISTINCT doc_id) AS docs, round(avg(word_count),4) AS mean_words, count(*) FILTER (word_count = 80) AS full_chunks FROM ({CHUNKS})"
)
def chunk_metrics(spark, sf_dir):
    # Distinct documents are those with a first chunk: no second shuffle for a distinct count.
    return _chunks(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(F.col("chunk_no") == 0).alias("docs"),
        F.round(F.avg("word_count"), 4).alias("mean_words"),
        F.count_if(F.col("word_count") == 80).alias("full_chunks"),
    )


@query(f"SELECT c.doc_id, c.chunk_no, c.word_count, d.lang, d.source, 'doc-' || c.doc_id || '-chunk-' || printf('%03d', c.chunk_no) AS chunk_id FROM ({CHUNKS}) c JOIN documents d USING (doc_id)")
def enrich_chunks(spark, sf_dir):
    # The columns of the document travel with its chunks: the join of the two is a projection.
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    got = C.chunk(docs, keep=("lang", "source"))
    return got.select("doc_id", "chunk_no", "word_count", "lang", "source", F.format_string("doc-%d-chunk-%03d", "doc_id", "chunk_no").alias("chunk_id"))


@query(f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct, array_to_string(t[1:5],' ') AS head FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)")
def tokenize(spark, sf_dir):
    t = F.col("t")
    return read(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("t")).select(
        "doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"), F.array_join(F.slice(t, 1, 5), " ").alias("head")
    )


STOPS = ",".join(f"'{w}'" for w in T.STOPWORDS["en"])


@query(f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_meaningful FROM (SELECT doc_id, list_distinct(list_filter({sql_tokens('text')}, lambda x: len(x) > 2 AND NOT list_contains([{STOPS}], x))) AS t FROM documents)")
def meaningful_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(T.meaningful(F.col("text"))).cast("long").alias("n_meaningful"))


@query(f"SELECT token, count(*) AS chunks, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest({sql_index('text')}) AS token FROM ({CHUNKS})) GROUP BY token")
def lexical_index(spark, sf_dir):
    index = C.token_index(_chunks(spark, sf_dir))
    per_doc = index.groupBy("token", "doc_id").agg(F.count(F.lit(1)).alias("c"))
    return per_doc.groupBy("token").agg(F.sum("c").alias("chunks"), F.count(F.lit(1)).alias("docs"))


@query(RETRIEVAL + "SELECT query_id, rank, doc_id, chunk_no, word_count, overlap FROM top WHERE rank <= 5")
def retrieve_support(spark, sf_dir):
    return _top(spark, sf_dir, 5)


@query(
    RETRIEVAL + ", one AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY overlap DESC, word_count DESC, chunk_no) AS r FROM ov), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, word_count DESC, doc_id, chunk_no) AS place FROM one WHERE r = 1) "
    "SELECT query_id, place, doc_id, chunk_no, overlap FROM b WHERE place <= 6"
)
def bridge_sources(spark, sf_dir):
    best = _top(spark, sf_dir, 6, per_source=True).withColumnRenamed("rank", "place")
    return best.select("query_id", "place", "doc_id", "chunk_no", "overlap")


OWN = (
    f"WITH ch AS ({CHUNKS}), ix AS (SELECT doc_id, chunk_no, word_count, unnest({sql_index('text')}) AS token FROM ch), "
    f"q AS (SELECT doc_id AS own, 'doc-' || doc_id AS query_id, unnest(list_distinct({sql_tokens('st')})) AS token FROM (SELECT doc_id, {sql_sentences('text')}[1] AS st FROM documents WHERE doc_id % 100 = 0)), "
    "ov AS (SELECT query_id, own, doc_id, chunk_no, word_count, count(*) AS overlap FROM q JOIN ix USING (token) GROUP BY ALL), "
)


@query(
    OWN + "top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, (doc_id = own) DESC, word_count DESC, doc_id, chunk_no) AS rank FROM ov) "
    "SELECT query_id, rank, doc_id, chunk_no, word_count, overlap FROM top WHERE rank <= 5"
)
def retrieve_own_first(spark, sf_dir):
    """First sentences of every hundredth document as queries against all chunks; the own document breaks ties."""
    return C.retrieve(_own_queries(spark, sf_dir), _chunks(spark, sf_dir), 5)


def _own_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = read(spark, sf_dir, "documents").where("doc_id % 100 = 0")
    first = T.tokens(F.get(T.sentences(F.col("text")), F.lit(0)))
    return asked.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("query_id"), F.col("doc_id").alias("own"), first.alias("tokens"))


@query(
    OWN + "one AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY overlap DESC, word_count DESC, chunk_no) AS r FROM ov), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, (doc_id = own) DESC, word_count DESC, doc_id, chunk_no) AS pl FROM one WHERE r = 1), "
    "p AS (SELECT query_id, 0 AS after, pl, doc_id FROM (SELECT 'doc-' || d.doc_id AS query_id, row_number() OVER (PARTITION BY d.doc_id ORDER BY e.doc_id DESC) AS pl, e.doc_id FROM documents d JOIN documents e ON e.doc_id BETWEEN d.doc_id + 1 AND d.doc_id + 2 WHERE d.doc_id % 100 = 0) "
    "UNION ALL SELECT query_id, 1, pl, doc_id FROM b WHERE pl <= 4), "
    "f AS (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY after, pl) AS r FROM p), "
    "c AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY after, pl, doc_id) AS citation_id FROM f WHERE r = 1) "
    "SELECT query_id, citation_id, doc_id FROM c WHERE citation_id <= 4"
)
def preferred_sources(spark, sf_dir):
    """Grounded retrieval: the plan's sources (here the next two documents, the later first) go before what was found."""
    found = C.retrieve(_own_queries(spark, sf_dir), _chunks(spark, sf_dir), 4, per_source=True)
    ids = read(spark, sf_dir, "documents").select("doc_id")
    near = read(spark, sf_dir, "documents").where("doc_id % 100 = 0").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("d"))
    preferred = near.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("query_id"), (3 - F.col("d")).alias("place"), (F.col("doc_id") + F.col("d")).alias("doc_id")
    ).join(ids, "doc_id", "left_semi")
    return C.preferred_first(found, preferred, 4)


SENTENCES = f"SELECT doc_id, CAST(i-1 AS INTEGER) AS sentence_no, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, least(len(s),8)+1)) AS i FROM (SELECT doc_id, {sql_sentences('text')} AS s FROM documents))"


@query(f"SELECT * FROM ({SENTENCES}) WHERE len({sql_words('sentence')}) BETWEEN 6 AND 40")
def candidate_sentences(spark, sf_dir):
    return C.candidate_sentences(read(spark, sf_dir, "documents"))


@query(
    f"WITH ch AS ({CHUNKS}), ix AS (SELECT doc_id, chunk_no, word_count, unnest(list_distinct({sql_tokens('text')})) AS token FROM ch), "
    f"q AS (SELECT doc_id, unnest(list_distinct({sql_tokens('sentence')})) AS token FROM ({SENTENCES}) WHERE sentence_no = 0), "
    "ov AS (SELECT doc_id, chunk_no, count(*) AS overlap FROM ix JOIN q USING (doc_id, token) GROUP BY ALL) "
    "SELECT doc_id, chunk_no, overlap FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY overlap DESC, chunk_no) AS r FROM ov) WHERE r = 1"
)
def seed_source(spark, sf_dir):
    """Best chunk of a document for its first sentence: all within the row, without a join."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", T.tokens(F.get(T.sentences(F.col("text")), F.lit(0))).alias("asked"))
    chunks = C.chunk(docs, keep=("asked",))
    shared = F.size(F.array_intersect(T.tokens(F.col("text")), F.col("asked"))).cast("long")
    best = chunks.select("doc_id", "chunk_no", shared.alias("overlap")).where("overlap > 0")
    top = best.groupBy("doc_id").agg(F.max(F.struct("overlap", (-F.col("chunk_no")).alias("back"))).alias("b"))
    return top.select("doc_id", (-F.col("b.back")).alias("chunk_no"), F.col("b.overlap").alias("overlap"))


@query(
    RETRIEVAL + f", s AS (SELECT query_id, rank, CAST(i AS INTEGER) AS i, t[i] AS claim FROM (SELECT query_id, rank, t, unnest(range(1, len(t)+1)) AS i FROM ("
    f"SELECT top.query_id, top.rank, {sql_sentences('ch.text')} AS t FROM top JOIN ch USING (doc_id, chunk_no) WHERE rank <= 5))), "
    "d AS (SELECT *, row_number() OVER (PARTITION BY query_id, claim ORDER BY rank, i) AS seen FROM s), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, i) AS place FROM d WHERE seen = 1) "
    "SELECT query_id, place, claim FROM n WHERE place <= 4"
)
def planning_claims(spark, sf_dir):
    """The first distinct sentences of the ranked sources."""
    chunks = _chunks(spark, sf_dir)
    top = _top(spark, sf_dir, 5).select("query_id", "rank", "doc_id", "chunk_no")
    said = top.join(chunks, ["doc_id", "chunk_no"]).select("query_id", "rank", F.posexplode(T.sentences(F.col("text"))).alias("i", "claim"))
    first = said.groupBy("query_id", "claim").agg(F.min(F.struct("rank", "i")).alias("at"))
    placed = first.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("at")))
    return placed.where("place <= 4").select("query_id", "place", "claim")


@query(
    f"WITH ch AS ({CHUNKS}), ix AS (SELECT DISTINCT doc_id, chunk_no FROM ch WHERE len({sql_tokens('text')}) > 0) "
    "SELECT count(*) AS chunks, count(*) FILTER (trim(text) = '') AS empty_text, count(*) FILTER (word_count <= 0) AS bad_word_count, "
    "count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS missing_source, "
    "count(*) FILTER (NOT EXISTS (SELECT 1 FROM ix WHERE ix.doc_id = ch.doc_id AND ix.chunk_no = ch.chunk_no)) AS missing_index FROM ch"
)
def memory_core_checks(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    return C.integrity(chunks, read(spark, sf_dir, "labels"), C.token_index(chunks))


GROUNDED = (
    RETRIEVAL + f", g AS (SELECT top.query_id, list_distinct(flatten(list({sql_index('ch.text', 100000)}))) AS ev, count(*) AS n FROM top JOIN ch USING (doc_id, chunk_no) WHERE rank <= 5 GROUP BY 1), "
    f"t AS (SELECT item_id AS query_id, list_filter(list_distinct({sql_tokens('text')}), lambda x: len(x) > 2 AND NOT list_contains([{STOPS}], x)) AS target FROM benchmark), "
    f"m AS (SELECT query_id, target, list_filter(coalesce(ev, []), lambda x: len(x) > 2 AND NOT list_contains([{STOPS}], x)) AS ev FROM t LEFT JOIN g USING (query_id)), "
    "o AS (SELECT query_id, len(target) AS n_target, len(list_intersect(target, ev)) AS shared FROM m) "
)


@query(
    GROUNDED + "SELECT query_id, CAST(n_target AS BIGINT) AS n_target, CAST(shared AS BIGINT) AS shared, n_target > 0 AND (shared = n_target OR (shared >= 3 AND shared / n_target >= 0.35)) AS answer_supported, "
    "concat_ws(',', CASE WHEN shared < 3 THEN 'retrieval_not_grounded' END, CASE WHEN NOT (n_target > 0 AND (shared = n_target OR (shared >= 3 AND shared / n_target >= 0.35))) THEN 'answer_not_supported' END) AS reasons FROM o"
)
def grounding_reasons(spark, sf_dir):
    """Benchmark items as answers, their retrieved chunks as evidence."""
    top = _top(spark, sf_dir, 5).select("query_id", "doc_id", "chunk_no")
    tokens = _chunks(spark, sf_dir).select("doc_id", "chunk_no", F.array_distinct(T.tokens(F.col("text"))).alias("tk"))
    # At most five chunks an item: the gathered evidence is bounded.
    evidence = top.join(tokens, ["doc_id", "chunk_no"]).groupBy("query_id").agg(F.array_distinct(F.flatten(F.collect_list("tk"))).alias("ev"))
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), T.meaningful(F.col("text")).alias("target"))
    none = F.expr("cast(array() as array<string>)")
    rows = items.join(evidence, "query_id", "left").withColumn("ev", F.coalesce("ev", none))
    shared = G.overlap(F.col("target"), F.col("ev"))
    no = F.lit(False)
    supported = G.answer_supported(F.col("target"), F.col("ev"), no, no)
    why = G.reasons(retrieval_not_grounded=shared < 3, answer_not_supported=~supported)
    return rows.select("query_id", F.size("target").cast("long").alias("n_target"), shared.cast("long").alias("shared"), supported.alias("answer_supported"), F.array_join(why, ",").alias("reasons"))


@query(
    f"WITH s AS (SELECT doc_id, unnest({sql_sentences('text')}) AS st, {sql_sentences('text')}[1] AS src FROM documents), "
    f"k AS (SELECT doc_id, list_filter(list_distinct({sql_tokens('st')}), lambda x: len(x) > 2 AND NOT list_contains([{STOPS}], x)) AS a, list_filter(list_distinct({sql_tokens('src')}), lambda x: len(x) > 2 AND NOT list_contains([{STOPS}], x)) AS b FROM s), "
    "o AS (SELECT doc_id, len(a) AS n, len(list_intersect(a, b)) AS sh FROM k) "
    "SELECT doc_id, count(*) AS statements, count(*) FILTER (n > 0 AND (sh = n OR CASE WHEN n <= 2 THEN sh = n WHEN n <= 4 THEN sh >= greatest(2, n - 1) ELSE sh >= 3 AND sh / n >= 0.3 END)) AS supported FROM o GROUP BY doc_id"
)
def citation_support(spark, sf_dir):
    """All sentences as statements that cite the first one."""
    docs = read(spark, sf_dir, "documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    each = docs.select("doc_id", F.explode("s").alias("st"), F.get("s", F.lit(0)).alias("src"))
    ok = G.statement_supported(T.meaningful(F.col("st")), T.meaningful(F.col("src")))
    return each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("statements"), F.count_if(ok).alias("supported"))


@query(f"SELECT doc_id, md5('7:' || doc_id) AS hash_order, substr(sha256('fam:en:' || doc_id), 1, 16) AS row_seed, sha256('{{\"doc\":' || doc_id || ',\"source\":\"' || source || '\"}}') AS spec_hash FROM documents")
def hash_spec(spark, sf_dir):
    spec = F.concat(F.lit('{"doc":'), F.col("doc_id").cast("string"), F.lit(',"source":"'), F.col("source"), F.lit('"}'))
    return read(spark, sf_dir, "documents").select(
        "doc_id", T.hash_order(7, F.col("doc_id")).alias("hash_order"), T.row_seed(F.lit("fam"), F.lit("en"), F.col("doc_id")).alias("row_seed"), F.sha2(spec, 256).alias("spec_hash")
    )


@query("SELECT doc_id, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda h, c: (h*33+c) % 2147483647) % 17 AS BIGINT) AS idx FROM (SELECT doc_id, source || ':' || lang || ':' || doc_id || ':' || text AS k FROM documents)")
def stable_index(spark, sf_dir):
    k = F.concat_ws(":", "source", "lang", "doc_id", "text")
    return read(spark, sf_dir, "documents").select("doc_id", T.stable_index(k, 17).alias("idx"))


@query("SELECT doc_id, nullif(regexp_replace(regexp_replace(lower(head), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '') AS slug, CASE WHEN len(line) > 220 THEN rtrim(line[1:219]) || '…' ELSE line END AS excerpt FROM (SELECT doc_id, text AS head, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS line FROM documents)")
def slugs_and_excerpts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.slug(F.col("text")).alias("slug"), T.excerpt(F.col("text")).alias("excerpt"))
