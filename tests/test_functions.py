"""Column builders against plain Python on small rows."""

import math
import re

import pytest
from pyspark.sql import functions as F

from textmill.functions import constraints as R
from textmill.functions import dialogue as D
from textmill.functions import grounding as G
from textmill.functions import parse as A
from textmill.functions import prompts as P
from textmill.functions import render as N
from textmill.functions import text as T
from textmill.operators import corpus as C


def one(spark, text, *columns):
    df = spark.createDataFrame([(text,)], "text string")
    row = df.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return row[0] if len(columns) == 1 else tuple(row)


text = None  # the column of that name; it needs a session


@pytest.fixture(autouse=True)
def _column(spark):
    global text
    text = F.col("text")


def test_cleaning_and_sections(spark):
    assert one(spark, " a \n\n\t b\r\n  \nc", T.clean_lines(text)) == "a\nb\nc"
    assert one(spark, "a\nb\n\n c \n\n\n", T.sections(text)) == ["a\nb", "c"]
    assert one(spark, "alone", T.sections(text)) == ["alone"]
    assert one(spark, None, T.words(text)) == []


def test_tokens_fold_case_and_sharp_s(spark):
    assert one(spark, "Straße, ÆØÅ été_2x", T.tokens(text)) == ["strasse", "æøå", "été", "2x"]
    assert one(spark, "b a b c", T.index_tokens(text, 2)) == ["a", "b"]
    assert one(spark, "The cat and the CAT is on mats", T.meaningful(text)) == ["cat", "mats"]
    assert one(spark, "One two.  Three? four! ", T.sentences(text)) == ["One two.", "Three?", "four!"]


@pytest.mark.parametrize("size,overlap", [(80, 20), (20, 5), (3, 1), (1, 0)])
def test_chunks_match_a_loop(spark, size, overlap):
    step = size - overlap
    lengths = sorted({0, 1, size - 1, size, size + 1, size + step, size + step + 1, 5 * step + 2})
    rows = [(n, " ".join(f"w{k}" for k in range(n))) for n in lengths]
    got = {}
    for r in C.chunk(spark.createDataFrame(rows, "doc_id long, text string"), size, overlap).collect():
        got.setdefault(r.doc_id, {})[r.chunk_no] = r.text.split()
    for n, t in rows:
        words, want, at = t.split(), [], 0
        while at < n:
            want.append(words[at : at + size])
            if at + size >= n:
                break
            at += step
        assert [got.get(n, {})[k] for k in range(len(want))] == want and len(got.get(n, {})) == len(want)


def test_stable_index_is_the_polynomial_hash(spark):
    for s in ("", "abc", "Ærø 😀"):
        h = 0
        for ch in s:
            h = (h * 33 + ord(ch)) % 2147483647
        assert one(spark, s, T.stable_index(text, 17)) == h % 17


def test_slug_excerpt_and_path_text(spark):
    assert one(spark, " Hello, World! ", T.slug(text)) == "hello-world"
    assert one(spark, "!!!", T.slug(text)) is None
    assert one(spark, "a " * 200, T.excerpt(text)).endswith("…")
    assert one(spark, "  \n", T.path_text(text)) is None


CASES = [
    ("count:keywords_multiple", ("of", 2), "Of the of", "of"),
    ("words:forbidden_words", (["bad"],), "good", "so BAD"),
    ("format:no_digits", (), "none", "one 1"),
    ("change_case:all_lowercase", (), "low é", "Low"),
    ("count:word_count_range", (2, 3), "a b", "a"),
    ("count:sentences", (2,), "One. Two!", "One."),
    ("count:paragraphs", (2,), "a\n\nb", "a\nb"),
    ("count:line_count", (2,), "a\n\nb", "a"),
    ("start_end:first_word", ("hej",), "Hej du", "du hej"),
    ("start_end:end_phrase", ("the end",), "so the end \n", "The End"),
    ("start_end:last_word", ("du",), "hej DU.", "du hej"),
    ("format:numbered_list", (2,), "1. a\n2. b", "1. a\n3. b"),
    ("format:bullet_list", (2,), "- a\n- b", "- a\n* b"),
    ("format:json_keys", (["b", "a"],), '{"a": 1, "b": {"c": 2}}', '{"a": 1}'),
    ("format:xml_tags", ("r", ["a", "b"]), "<r><a>1</a><b>2</b></r>", "<r><b>2</b><a>1</a></r>"),
    ("format:two_responses", (), "a ****** b", "a ****** "),
    ("words:word_positions", ([(2, "x")],), "a X b", "x a"),
    ("format:line_indent", (3, 2), "a\n  b\n    c", "a\n b\n  c"),
    ("punctuation:no_commas", (), "a b", "a, b"),
    ("punctuation:semicolon_count", (2,), "a;b;", "a;"),
    ("words:ordered_keywords", ("a", "b"), "a x b", "b a"),
    ("format:quoted_spans", (1,), 'say "hi" now', "say hi"),
]


@pytest.mark.parametrize("name,args,passing,failing", CASES, ids=[c[0] for c in CASES])
def test_constraints(spark, name, args, passing, failing):
    check = R.CHECKERS[name]
    assert one(spark, passing, check(text, *args)) is True
    assert one(spark, failing, check(text, *args)) is False


def test_all_constraints_have_a_case():
    assert set(R.CHECKERS) == {c[0] for c in CASES} and len(CASES) == 22


def test_loose_variants_forgive_a_lead_a_tail_and_asterisks(spark):
    strict = lambda t: R.bullet_list(t, 2)
    for loose in ("Sure:\n- a\n- b", "- a\n- b\nDone.", "Sure:\n- a\n- b\nDone.", "**- a\n- b**"):
        assert one(spark, loose, strict(text)) is False and one(spark, loose, R.passes_loosely(text, strict)) is True
    assert one(spark, "- a", R.passes_loosely(text, strict)) is False


def test_prompt_profile(spark):
    kind = P.task_type(text)
    assert one(spark, "Translate into Danish: hello", kind) == "translation"
    assert one(spark, "Please compare tea and coffee", kind) == "comparison"
    assert one(spark, "Is it late?", kind) == "question_answering"
    assert one(spark, "Hello there", kind) == "general_generation"
    assert one(spark, "Give me three ideas or steps", P.item_count(text, F.lit("listing"))) == 3
    assert one(spark, "Answer in two sentences.", P.units_before(text, ("sentences", "sentence"))) == 2
    assert one(spark, "Write 99 lines", P.units_before(text, ("lines", "line"))) is None
    assert one(spark, "Explain how 5 becomes 6", P.rigidity(text, F.lit("explanation"))) == "rigid"
    assert one(spark, "Tell a story", P.rigidity(text, F.lit("creative"))) == "open"
    assert one(spark, "Étude of the Étude of rivers, write", P.keywords(text)) == ["étude", "rivers"]
    assert one(spark, "x" * 39, P.keep_prompt(text)) is False
    assert one(spark, "Write something nice about the rivers of the north", P.keep_prompt(text)) is True
    assert one(spark, "- a\n- b\n- c " + "x" * 40, P.keep_prompt(text)) is False


def test_dialogue_scores(spark):
    assert one(spark, "USER 2: hi", D.role_leaked(text)) is True
    assert one(spark, "fine ✅", D.restrained_format(text)) is False
    assert one(spark, "I pay $20 for the NASA well-known thing about rivers", D.salient_terms(text)) == ["$20", "NASA", "well-known", "known", "thing", "rivers"]
    assert one(spark, "can you help me", D.first_turn_substance(text)) == 0.0
    assert one(spark, "", D.first_turn_substance(text)) == 0.0
    assert [one(spark, s, D.parse_score(text)) for s in ("PASS", "repair", "7/10", "85", "0.4", "none", "3/0")] == [1.0, 0.0, 0.7, 8.5, 0.4, 0.0, 0.0]
    ages = spark.createDataFrame([(None,), (24,), (25,), (49,), (64,), (65,)], "age int").select(D.age_band(F.col("age"))).collect()
    assert [r[0] for r in ages] == ["adult", "adult_18_24", "adult_25_34", "adult_35_49", "adult_50_64", "adult_65_plus"]
    assert one(spark, "--A b!", D.shape_part(text)) == "a_b" and one(spark, "!", D.shape_part(text)) == "unknown"


def arr(*xs):
    return F.array(*map(F.lit, xs)) if xs else F.expr("cast(array() as array<string>)")


def test_grounding_rules(spark):
    ev = arr("a", "b", "c", "d")
    no, yes = F.lit(False), F.lit(True)
    assert one(spark, "", G.answer_supported(arr("a", "b"), ev, no, no)) is True  # subset
    assert one(spark, "", G.answer_supported(arr(), ev, yes, yes)) is False
    target = arr("a", "b", "c", *[f"x{k}" for k in range(6)])
    assert one(spark, "", G.answer_supported(target, ev, no, no)) is False  # 3 of 9
    assert one(spark, "", G.answer_supported(target, ev, yes, yes)) is True  # rescued
    twenty = arr(*[f"e{k}" for k in range(7)], *[f"x{k}" for k in range(13)])
    assert one(spark, "", G.answer_supported(twenty, arr(*[f"e{k}" for k in range(7)]), no, no)) is True  # exactly 0.35
    assert one(spark, "", G.retrieval_grounded(F.lit("s"), arr("s"), arr(), arr())) is True
    assert one(spark, "", G.retrieval_grounded(F.lit("s"), arr(), ev, ev)) is False
    assert one(spark, "", G.reasoning_grounded(arr(*"abcdef"), ev, arr("a"))) is True
    assert one(spark, "", G.reasoning_grounded(arr(*"abcde"), ev, arr("a"))) is False
    points = F.array(arr("a", "b"), arr("q", "r", "s"), arr("a", "z"))
    assert one(spark, "", G.coverage_supported(points, ev)) is True
    assert one(spark, "", G.coverage_supported(points, arr())) is False
    for n, shared, want in [(0, 0, False), (2, 1, False), (2, 2, True), (3, 2, True), (4, 2, False), (4, 3, True), (10, 3, True), (11, 3, False)]:
        st = arr(*[f"t{k}" for k in range(n)])
        assert one(spark, "", G.statement_supported(st, arr(*[f"t{k}" for k in range(shared)]))) is want
    assert one(spark, "", G.reasons(x=yes, y=no, z=yes)) == ["x", "z"]


def test_parsers(spark):
    assert one(spark, 'x {"a": "}{", "b": [1]} y {"c": 2}', A.json_object(text)) == '{"a": "}{", "b": [1]}'
    assert one(spark, "{not json", A.json_object(text)) is None
    assert one(spark, "Answer: 1\nmore\n**Final answer**: 42 ", A.answer(text)) == "42"
    assert one(spark, "no label\nlast\n", A.answer(text)) == "last"
    got = one(spark, '<statement cites="1 2">A b.</statement><statement cites="3">C</statement>', A.cited_statements(text))
    assert [(s.text, s.citations) for s in got] == [("A b.", ["1", "2"]), ("C", ["3"])]
    got = one(spark, "STEP 1: User | ask | none\njunk\nstep 2: assistant | answer | more", A.skeleton_steps(text))
    assert [(s.role, s.act, s.delta) for s in got] == [("user", "ask", "none"), ("assistant", "answer", "more")]
    assert one(spark, "```json\n{}\n```", A.strip_fence(text)) == "{}"
    assert one(spark, "a -> b; c\nd", A.query_plan(text)) == ["a", "b", "c", "d"]
    assert one(spark, "short", A.reasoning_failure(text, F.lit("p"))) == "too_few_steps"
    long = "\n".join(f"this is step number {k}" for k in range(8))
    assert one(spark, long, A.reasoning_failure(text, F.lit(long))) == "copies_prompt"
    assert one(spark, long, A.reasoning_failure(text, F.lit("p"))) is None


def test_rendering_round_trips(spark):
    import json

    raw = 'He said "hi" \\ & <b>\n\ttab'
    args = (text, F.lit("s"), F.lit("en"), F.lit("da"))
    assert json.loads(one(spark, raw, N.target(F.lit("json_string"), *args))) == raw
    assert json.loads(one(spark, raw, N.target(F.lit("json_object_source"), *args))) == {"source_language": "en", "target_language": "da", "source_text": "s", "translation": raw}
    assert one(spark, "a&<b>", N.target(F.lit("xml_tag"), *args)) == "<translation>a&amp;&lt;b&gt;</translation>"
    assert one(spark, raw, N.target(F.lit("plain"), *args)) == raw
    import yaml

    meta = {"source_language": "en", "target_language": "da"}
    for mode, want in (("yaml_field", {}), ("yaml_field_meta", meta), ("yaml_field_source", meta | {"source_text": "s"})):
        for t in (raw, "plain", "æ: ø # å", "- 1", "yes", "", "long " * 60):
            got = one(spark, t, N.yaml_target(F.lit(mode), *args))
            assert yaml.safe_load(got) == want | {"translation": t} and got == yaml.safe_dump(want | {"translation": t}, allow_unicode=True).strip()
    assert one(spark, raw, N.yaml_target(F.lit("plain"), *args)) is None
    assert one(spark, "Hej", N.prompt(F.lit("from_to"), text, F.lit("da"), F.lit("en"), F.lit("da"))) == "Fra dansk til engelsk. Returner kun oversættelsen.\n\nTekst:\nHej"
    assert one(spark, "Hi", N.prompt(F.lit("minimal_output"), text, F.lit("en"), F.lit("da"))) == "English to Danish.\n\nOutput only the translated text.\n\nHi"
    assert one(spark, "x", N.output_mode(F.lit("yaml_meta_output"))) == "yaml_field_meta"
    assert one(spark, "x", N.prompt_blocks([("Do:", F.array(F.lit("a"), F.lit("b")), True), (None, F.array(text), False)])) == "Do:\n1. a\n2. b\n\nx"
