"""Queries over conversations: prompts, constraints, turn checks, scores, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constraints as R
from ..functions import dialogue as D
from ..functions import prompts as P
from ..functions import text as T
from ..operators import dialogue as O
from ..operators import sampling as S
from .registry import query, read, sql_collapse, sql_tokens

WORD = r"\p{L}+(?:[-'']\p{L}+)?"
USERS = "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'"


def _turns(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").where(F.col("role") == role).select("conv_id", "turn", "text")


def _sql_norm(t: str) -> str:
    return f"trim(regexp_replace(strip_accents(replace(lower({t}),'ß','ss')),'\\s+',' ','g'))"


# The oracle's own values, written out apart from the engine's.
SQL_TASKS = (
    ("translation", "oversæt|translate|translate into|oversaet"),
    ("rewrite", "omskriv|rephrase|rewrite|redigér|rediger|edit|omformuler"),
    ("classification", "klassificér|klassificer|classify|categorize|kategoriser"),
    ("summarization", "opsummér|opsummer|summarize|resumer|reduce following text|reducer følgende tekst"),
    ("comparison", "sammenlign|compare|forklar forskellen|what is the difference|hvad er forskellen"),
    ("listing", "oplist|list|angiv|nævn|naevn|give me a list|generer en liste"),
    ("analysis", "analyser|analyze|analyse|fortolk|interpret|vurder|evaluate"),
    ("recommendation", "foreslå|anbefal|recommend|suggest|giv et råd|give advice"),
    ("explanation", "forklar|explain|beskriv|describe|hvad er|what is|hvordan|how does|why does|hvorfor"),
    ("creative", "skriv|write|fortæl|tell|opfind|invent|lav et|create a"),
)
SQL_WORDS = {
    "stops": {
        "en": "a an and are as at be by for from how if in into is it of on or the this that to using what when where which who why with write list give generate create describe explain compare summarize translate classify recommend suggest answer response one two three four five six seven eight nine ten eleven twelve",
        "da": "af at de den der det en et for fra hvad hvem hvilke hvilken hvilket hvor hvordan hvorfor i med og om på som til ud ved skriv oplist angiv nævn forklar sammenlign opsummer oversæt klassificer anbefal foreslå svar svaret ét to tre fire fem seks syv otte ni ti elleve tolv",
    },
    "numbers": {
        "en": "one two three four five six seven eight nine ten eleven twelve",
        "da": "et to tre fire fem seks syv otte ni ti elleve tolv",
    },
}


def _sql_list(words: str) -> str:
    return "[" + ",".join(f"'{w}'" for w in words.split()) + "]"


def _sql_task(t: str) -> str:
    norm = _sql_norm(t)
    cases = " ".join(
        "WHEN " + " OR ".join(f"starts_with(split_part({norm}, ':', 1), '{p}') OR contains({norm}, ' {p} ')" for p in patterns.split("|")) + f" THEN '{name}'"
        for name, patterns in SQL_TASKS
    )
    return f"CASE {cases} WHEN contains({t}, '?') THEN 'question_answering' ELSE 'general_generation' END"


def _sql_length(t: str) -> str:
    n = f"len(regexp_extract_all({t}, '{WORD}'))"
    return f"CASE WHEN {n} <= 10 THEN 'short' WHEN {n} <= 22 THEN 'medium' ELSE 'long' END"


KEEP = (
    "len(text) BETWEEN 40 AND 700 AND len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) <= 12 AND NOT contains(text, '```') "
    "AND len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '' AND regexp_matches(x, '^\\s*(?:[-*]|\\d+[.)])\\s+'))) < 3 "
    "AND NOT regexp_matches(replace(lower(text),'ß','ss'), 'additional requirements|yderligere krav|return valid json|returner gyldig json|return valid xml|returner gyldig xml|numbered list|nummereret liste|bullet list|punktopstilling|start the response|begynd svaret|end the response|afslut svaret|do not use|brug ikke|exactly |præcis ')"
)


@query(f"SELECT conv_id, turn FROM ({USERS}) WHERE {KEEP}")
def prompt_keep(spark, sf_dir):
    return _turns(spark, sf_dir, "user").where(P.keep_prompt(F.col("text"))).select("conv_id", "turn")


@query(
    f"SELECT conv_id, turn, {_sql_task('text')} AS task_type, {_sql_length('text')} AS length_bucket, "
    f"array_to_string(list_filter(list_distinct_ordered, lambda x: len(x) > 2 AND NOT list_contains({_sql_list(SQL_WORDS['stops']['en'])}, x))[1:12], ' ') AS keywords FROM ("
    f"SELECT *, list_transform(list_filter(range(1, len(w)+1), lambda i: list_position(w, w[i]) = i), lambda i: w[i]) AS list_distinct_ordered FROM ("
    f"SELECT *, list_transform(regexp_extract_all(text, '{WORD}'), lambda x: replace(lower(x),'ß','ss')) AS w FROM ({USERS})))"
)
def prompt_profile(spark, sf_dir):
    text = F.col("text")
    return _turns(spark, sf_dir, "user").select(
        "conv_id", "turn", P.task_type(text).alias("task_type"), P.length_bucket(text).alias("length_bucket"), F.array_join(P.keywords(text), " ").alias("keywords")
    )


TEMPLATES = {
    "da": (
        "Oversæt følgende tekst til engelsk: {}", "Nævn tre grunde til at besøge {}", "Fortæl en historie om {} i to linjer", "Skriv fem sætninger om {}.",
        "Hvad er hovedstaden i {}?", "Giv et råd om {} og to idéer", "Foreslå syv måder at nå {}", "Sammenlign {} og Danmark: hvad er forskellen i pris?",
        "Beregn prisen på 12 billetter til {}", "Opsummér teksten om {} i én linje", "Kan du anbefal {} til ti venner, punkter tak", "Findes {}?", "Åen i {} løber",
    ),
    "en": (
        "Translate two lines about {} into Danish", "List three facts about {}", "Write twelve sentences on {}", "Explain how the price in {} is calculated", "Is {} far?",
        "Please rewrite this: {}", "Create a poem of 4 lines on {}", "Recommend five ways to see {}", "Numbers 13 and 2 in {} points: suggest items",
    ),
}
SQL_HINTS = {"en": "list|ideas|examples|steps|ways|facts|reasons|items|bullet|points", "da": "liste|idéer|ideer|eksempler|trin|måder|punkter|fakta|grunde"}
SQL_MATH = {"en": "calculate|cost|price|watt|kwh|percent|plus|minus|total|expected", "da": "beregn|koste|pris|watt|kwh|procent|plus|minus|i alt|forventer"}
SQL_UNITS = {"en": ("'sentence','sentences'", "'line','lines'"), "da": ("'sætning','sætninger'", "'linje','linjer'")}


def _sql_features(lang: str) -> str:
    """The features of the templates of one language, by the oracle's own words."""
    texts = " UNION ALL ".join(f"SELECT n_nationkey AS k, {j} AS template, '{lang}' AS lang, replace('{t}', '{{}}', lower(n_name)) AS text FROM nation" for j, t in enumerate(TEMPLATES[lang]))
    value = f"CASE WHEN regexp_matches(x, '^\\d{{1,9}}$') THEN CAST(x AS INTEGER) " + ("WHEN x = 'en' THEN 1 " if lang == "da" else "") + f"ELSE nullif(list_position({_sql_list(SQL_WORDS['numbers'][lang])}, x), 0) END"
    near = lambda units: f"list_filter(range(1, len(toks)), lambda i: list_contains([{units}], toks[i + 1]) AND vals[i] BETWEEN 1 AND 12)"
    count = lambda units: f"vals[({near(units)})[1]]"
    asks = "kind IN ('classification','creative','listing','recommendation','translation')"
    return (
        f"SELECT k, template, lang, kind, items, sentences, lines, numeric, CASE WHEN numeric OR sentences IS NOT NULL OR lines IS NOT NULL OR kind IN ('translation','classification') THEN 'rigid' "
        "WHEN items IS NOT NULL OR kind IN ('analysis','comparison','explanation','question_answering','rewrite','summarization') THEN 'medium' ELSE 'open' END AS rigidity, keywords FROM ("
        f"SELECT *, CASE WHEN {asks} AND (kind = 'translation' OR regexp_matches(norm, '{SQL_HINTS[lang]}')) THEN list_filter(vals, lambda v: v BETWEEN 2 AND 10)[1] END AS items, "
        f"{count(SQL_UNITS[lang][0])} AS sentences, {count(SQL_UNITS[lang][1])} AS lines, "
        f"kind IN ('analysis','comparison','explanation','question_answering') AND (regexp_matches(text, '\\d') OR regexp_matches(norm, '{SQL_MATH[lang]}')) AS numeric, "
        f"array_to_string(list_filter(list_transform(list_filter(range(1, len(w)+1), lambda i: list_position(w, w[i]) = i), lambda i: w[i]), lambda x: len(x) > 2 AND NOT list_contains({_sql_list(SQL_WORDS['stops'][lang])}, x))[1:12], ' ') AS keywords FROM ("
        f"SELECT *, list_transform(toks, lambda x: {value}) AS vals FROM (SELECT *, {_sql_task('text')} AS kind, {_sql_norm('text')} AS norm, regexp_extract_all({_sql_norm('text')}, '\\d+|{WORD}') AS toks, "
        f"list_transform(regexp_extract_all(text, '{WORD}'), lambda x: replace(lower(x),'ß','ss')) AS w FROM ({texts}))))"
    )


@query(f"{_sql_features('da')} UNION ALL {_sql_features('en')}")
def prompt_features(spark, sf_dir):
    """What Danish and English prompts ask for; the prompts are templates filled with every nation's name."""
    rows = [(lang, j, t) for lang, group in TEMPLATES.items() for j, t in enumerate(group)]
    forms = F.broadcast(spark.createDataFrame(rows, "lang string, template int, form string"))
    filled = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.lower("n_name").alias("name")).crossJoin(forms)
    prompts = filled.select("k", "template", "lang", F.replace("form", F.lit("{}"), F.col("name")).alias("text")).withColumn("kind", P.task_type(F.col("text")))
    text, kind = F.col("text"), F.col("kind")
    features = {
        "items": lambda x: P.item_count(text, kind, x), "sentences": lambda x: P.units_before(text, P.SENTENCES[x], x), "lines": lambda x: P.units_before(text, P.LINES[x], x),
        "numeric": lambda x: P.numeric_task(text, kind, x), "rigidity": lambda x: P.rigidity(text, kind, x), "keywords": lambda x: F.array_join(P.keywords(text, lang=x), " "),
    }
    return prompts.select("k", "template", "lang", "kind", *[F.when(F.col("lang") == "da", f("da")).otherwise(f("en")).alias(name) for name, f in features.items()])


@query(f"SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY {_sql_norm('text')} ORDER BY conv_id * 1000 + turn) AS r FROM ({USERS})) WHERE r = 1")
def prompt_dedup(spark, sf_dir):
    rows = _turns(spark, sf_dir, "user").select("conv_id", "turn", F.md5(P.normalize_prompt(F.col("text"))).alias("h"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"))
    return S.keep_first(rows, F.col("h"), "ord").select("conv_id", "turn")


@query(
    f"WITH u AS (SELECT CAST(conv_id AS VARCHAR) || ':' || turn AS k, {_sql_task('text')} AS task_type, {_sql_length('text')} AS bucket FROM ({USERS})), "
    "i AS (SELECT *, row_number() OVER (PARTITION BY task_type, bucket ORDER BY md5('5:' || k), k) AS inr FROM u), "
    "o AS (SELECT *, row_number() OVER (PARTITION BY task_type ORDER BY inr, bucket, k) AS round FROM i) "
    "SELECT k, task_type, bucket, round FROM o ORDER BY round, task_type LIMIT 50"
)
def balanced_sample(spark, sf_dir):
    text = F.col("text")
    rows = _turns(spark, sf_dir, "user").select(F.concat_ws(":", "conv_id", "turn").alias("k"), P.task_type(text).alias("task_type"), P.length_bucket(text).alias("bucket"))
    return S.balanced(rows, "task_type", "bucket", "k", 5, 50).select("k", "task_type", "bucket", F.col("round").cast("long").alias("round"))


LINES = "list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')"
CHECKS = {
    "no_digits": ("NOT regexp_matches(text, '\\p{Nd}')", lambda t: R.no_digits(t)),
    "all_lowercase": ("text = lower(text)", lambda t: R.all_lowercase(t)),
    "word_count_range": (f"len({sql_tokens('text')}) BETWEEN 20 AND 120", lambda t: R.word_count_range(t, 20, 120)),
    "sentences": ("len(list_filter(string_split(regexp_replace(trim(text),'([.!?])\\s+','\\1'||chr(1),'g'),chr(1)), lambda s: trim(s) <> '')) = 4", lambda t: R.sentence_count(t, 4)),
    "paragraphs": ("len(list_filter(string_split_regex(text, '\\n\\s*\\n'), lambda p: trim(p) <> '')) = 1", lambda t: R.paragraph_count(t, 1)),
    "line_count": (f"len({LINES}) = 2", lambda t: R.line_count(t, 2)),
    "forbidden_words": (f"NOT list_has_any({sql_tokens('text')}, ['the','la','der'])", lambda t: R.forbidden_words(t, ["the", "la", "der"])),
    "keywords_multiple": (f"len(list_filter({sql_tokens('text')}, lambda x: x = 'of')) = 1", lambda t: R.keyword_counts(t, "of", 1)),
    "first_word": (f"coalesce({sql_tokens('text')}[1] = 'the', false)", lambda t: R.first_word(t, "the")),
    "last_word": (f"coalesce({sql_tokens('text')}[-1] = 'the', false)", lambda t: R.last_word(t, "the")),
    "end_phrase": ("ends_with(rtrim(text), '.')", lambda t: R.end_phrase(t, ".")),
    "no_commas": ("NOT contains(text, ',')", lambda t: R.no_commas(t)),
    "semicolon_count": ("len(text) - len(replace(text, ';', '')) = 0", lambda t: R.semicolon_count(t, 0)),
    "quoted_spans": ("len(regexp_extract_all(text, '\"[^\"\\n]+\"')) = 0", lambda t: R.quoted_spans(t, 0)),
    "ordered_keywords": (f"coalesce(list_position({sql_tokens('text')}, 'the') < list_position({sql_tokens('text')}, 'of'), false)", lambda t: R.ordered_keywords(t, "the", "of")),
    "word_positions": (f"coalesce({sql_tokens('text')}[2] = 'the', false)", lambda t: R.word_positions(t, [(2, "the")])),
    "numbered_list": (f"len({LINES}) = 1 AND starts_with(trim({LINES}[1]), '1.')", lambda t: R.numbered_list(t, 1)),
    "bullet_list": (f"len({LINES}) = 1 AND starts_with(trim({LINES}[1]), '- ')", lambda t: R.bullet_list(t, 1)),
    "two_responses": ("len(string_split(text, '******')) = 2 AND trim(string_split(text, '******')[1]) <> '' AND trim(string_split(text, '******')[2]) <> ''", lambda t: R.two_responses(t)),
    "line_indent": (f"len({LINES}) = 1 AND len({LINES}[1]) = len(ltrim({LINES}[1]))", lambda t: R.line_indent(t, 1, 2)),
}


@query("SELECT conv_id, turn, " + ", ".join(f"{sql} AS {name}" for name, (sql, _) in CHECKS.items()) + " FROM conversations WHERE role = 'assistant'")
def constraint_checks(spark, sf_dir):
    rows = _turns(spark, sf_dir, "assistant")
    return rows.select("conv_id", "turn", *[check(F.col("text")).alias(name) for name, (_, check) in CHECKS.items()])


def _sql_cut(t: str, a: int, less: int) -> str:
    return f"trim(array_to_string(string_split({t}, chr(10))[{a}:len(string_split({t}, chr(10)))-{less}], chr(10)))"


PLAIN = "replace(text, '*', '')"
VARIANTS = ", ".join(["text", PLAIN] + [_sql_cut(t, a, n) for t in ("text", PLAIN) for a, n in ((2, 0), (1, 1), (2, 1))])


@query(f"SELECT conv_id, turn, CAST(len(list_distinct(v)) AS BIGINT) AS n_variants, list_bool_or(list_transform(v, lambda t: len({sql_tokens('t')}) BETWEEN 20 AND 60)) AS loose_pass FROM (SELECT conv_id, turn, [{VARIANTS}] AS v FROM conversations WHERE role = 'assistant')")
def loose_variants(spark, sf_dir):
    rows = _turns(spark, sf_dir, "assistant")
    text = F.col("text")
    return rows.select(
        "conv_id", "turn", F.size(R.loose_variants(text)).cast("long").alias("n_variants"), R.passes_loosely(text, lambda t: R.word_count_range(t, 20, 60)).alias("loose_pass")
    )


@query(
    "WITH b AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations WHERE role <> 'system'), "
    "a AS (SELECT conv_id, count(*) AS n, bool_and(role = CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END) AS ok FROM b GROUP BY conv_id) "
    "SELECT c.conv_id, coalesce(n, 0) AS n_turns, coalesce(ok AND n >= 4 AND n % 2 = 0, false) AS alternates FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN a USING (conv_id)"
)
def messages_alternate(spark, sf_dir):
    return O.alternation(O.conversations(read(spark, sf_dir, "conversations")))


@query("SELECT conv_id, turn, regexp_matches(text, '(?i)\\b(USER|ASSISTANT)\\s+\\d+\\s*:') AS leaked, NOT regexp_matches(text, '[\\x{2705}\\x{274C}\\x{26A0}\\x{FE0F}\\x{1F300}-\\x{1FAFF}]') AS restrained FROM conversations")
def role_leak(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", D.role_leaked(F.col("text")).alias("leaked"), D.restrained_format(F.col("text")).alias("restrained"))


@query(
    "WITH e AS (SELECT conv_id, turn, role, text, lower(coalesce(string_agg(text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')) AS earlier FROM conversations) "
    "SELECT conv_id, turn, coalesce(list_bool_and(list_transform(list_filter(regexp_extract_all(text, '\"([^\"\\n]+)\"', 1), lambda q: len(trim(q)) >= 4), lambda q: contains(earlier, lower(trim(q))))), true) AS grounded FROM e WHERE role = 'user'"
)
def reaction_grounded(spark, sf_dir):
    return O.quoted_references(read(spark, sf_dir, "conversations"))


ACTS = ("opening", "constraint added", "follow_up", "late change", "closing")


def _dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with a plan, a skeleton, reviews and kinds that follow from their ids."""
    convs = O.conversations(read(spark, sf_dir, "conversations"))
    i = F.col("conv_id")
    acts = F.array(*map(F.lit, ACTS))
    named = lambda name, n: F.concat(F.lit(name), (i % n).cast("string"))
    step = lambda m, k: F.struct(m.role.alias("role"), F.get(acts, ((i * 7 + k) % len(ACTS)).cast("int")).alias("dialogue_act"))
    return convs.withColumns(
        {
            "skeleton": F.transform("messages", step), "family": named("family", 3), "domain": named("domain", 4), "intent_trajectory": named("intent", 2),
            "subtask_trajectory": F.when(i % 5 != 0, named("subtask", 2)), "work_session_type": named("session", 2),
            "plan_steps": F.when(i % 3 == 0, F.array(F.lit("Ask Now"), F.lit("Refine it!"))).otherwise(F.expr("cast(array() as array<string>)")),
            "plan": F.when(i % 3 == 1, F.lit("open -> detail; - close")), "review_score": ((i % 11) / 10).cast("double"), "accepted": i % 7 != 0,
            "reviewers": F.array(F.struct(F.lit("outcome").alias("name"), (i % 4 != 0).alias("passed"))),
        }
    )


# What a word is differs between SQL's and Java's patterns, so tests compare these five with a plain form.
@query()
def mds_scores(spark, sf_dir):
    """Eight scores, the mean and the bin of all conversations."""
    return O.mds_scores(_dialogues(spark, sf_dir))


@query()
def mds_select(spark, sf_dir):
    return O.mds_select(O.mds_scores(_dialogues(spark, sf_dir)), 60)


@query()
def mds_rotate(spark, sf_dir):
    return O.rotate_bins(O.mds_scores(_dialogues(spark, sf_dir)), 30)


@query()
def mds_selection_report(spark, sf_dir):
    scored = O.mds_scores(_dialogues(spark, sf_dir))
    return O.mds_report(scored, O.mds_select(scored, 60), 60)


@query()
def skeleton_matches(spark, sf_dir):
    """Which conversations fit their skeleton and alternate well."""
    rows = _dialogues(spark, sf_dir)
    return rows.select("conv_id", O.well_formed(F.col("messages")).alias("well_formed"), O.skeleton_fits(F.col("messages"), F.col("skeleton")).alias("fits"))


@query(f"SELECT conv_id, turn, {sql_collapse('text')} AS prompt FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM ({USERS})) WHERE r = 1")
def first_user_prompts(spark, sf_dir):
    """The first user turn of a conversation as a prompt candidate."""
    rows = _turns(spark, sf_dir, "user")
    first = rows.groupBy("conv_id").agg(F.min(F.struct("turn", "text")).alias("m"))
    return first.select("conv_id", F.col("m.turn").alias("turn"), T.collapse(F.col("m.text")).alias("prompt"))


@query("SELECT role, turn, grouping_id(role, turn) AS level, count(*) AS n, round(avg(len(text)), 4) AS mean_chars FROM conversations GROUP BY GROUPING SETS ((role), (turn), ())")
def dialogue_counters(spark, sf_dir):
    """Several counters in one scan."""
    rows = read(spark, sf_dir, "conversations").select("role", "turn", F.length("text").alias("n"))
    sets = rows.groupingSets([["role"], ["turn"], []], "role", "turn")
    return sets.agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.avg("n"), 4).alias("mean_chars"))
