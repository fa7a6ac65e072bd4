"""Packs end to end, made puzzles, completions, reviews, payloads, wording."""

import json
import random
import re
from random import Random

import pytest
from pyspark.sql import functions as F

from textmill import cli
from textmill.functions import evidence as V
from textmill.functions import language as L
from textmill.functions import payload as Y
from textmill.functions import review as W
from textmill.operators import completion as M
from textmill.operators import generators as G
from textmill.operators import packs as P
from textmill.operators import puzzles as Z


def test_demo_pack_builds_reuses_verifies_and_publishes(spark, tmp_path, capsys):
    root = f"{tmp_path}/runs"
    run_id = P.run(spark, root, "demo", {"rows": 20})
    assert P.run(spark, root, "demo", {"rows": 20}) == run_id != P.run(spark, root, "demo", {"rows": 21})
    got = P.summarize(spark, root, "demo", run_id)
    assert {m["check_name"]: m["passed"] for m in got["metrics"]} == {"has_prompt": 20, "has_target": 20, "answer_correct": 20} and got["failures"] == []
    P.publish(spark, root, "demo", run_id, f"{tmp_path}/pub")
    assert {r.split: r["count"] for r in spark.read.parquet(f"{tmp_path}/pub/data").groupBy("split").count().collect()} == {"train": 18, "eval": 2}
    assert json.loads((tmp_path / "pub" / "report.json").read_text())["failures"] == []
    assert cli.main(["list-packs"]) == 0 and "translation" in capsys.readouterr().out
    assert cli.main(["--root", root, "view", "demo", run_id, "--query", "what is"]) == 0 and "demo-000000" in capsys.readouterr().out


def test_a_failed_build_leaves_a_failed_manifest(spark, tmp_path):
    with pytest.raises(Exception):
        P.run(spark, str(tmp_path), "memory_core", {"source_path": f"{tmp_path}/nothing"})
    manifest = json.loads(next(tmp_path.glob("memory_core/*/manifest.json")).read_text())
    assert manifest["error"] and manifest["finished_at"] is None


def test_translation_and_memory_packs(spark, tmp_path):
    pairs = [(k, f"text {k}", f"tekst {k}", "a" if k < 4 else None) for k in range(7)] + [(7, "", "x", None), (8, "long " * 99, "y", None)]
    spark.createDataFrame(pairs, "id long, source_text string, target_text string, origin string").write.parquet(f"{tmp_path}/pairs")
    cfg = {"source_path": f"{tmp_path}/pairs", "max_per_origin": 2, "max_pair_chars": 100}
    rows = spark.read.parquet(f"{tmp_path}/runs/translation/{P.run(spark, f'{tmp_path}/runs', 'translation', cfg)}/rows").orderBy("id").collect()
    assert [r.id for r in rows] == [f"translation-{k}" for k in (0, 1, 4, 5, 6)]
    assert ["Reply" in r.prompt for r in rows] == [True, False, True, False, True]
    cfg = {"source_path": "/root/testdata/sf0.001/documents.parquet"}
    run_id = P.run(spark, f"{tmp_path}/runs", "memory_core", cfg)
    assert all(m["failed"] == 0 for m in P.summarize(spark, f"{tmp_path}/runs", "memory_core", run_id)["metrics"])
    assert P.run(spark, f"{tmp_path}/runs", "tool_use", {"rows": 4})


@pytest.mark.parametrize("family", sorted(G.MAKERS))
def test_made_puzzles_have_one_solution_and_a_right_answer(family):
    for seed in range(4):
        spec, target = G.MAKERS[family](Random(seed))
        assert G.solutions(family, json.loads(json.dumps(spec))) == 1
        assert G.is_correct(family, f"\n{target} \n", target) and not G.is_correct(family, "!?", target)
        assert G.parse_target(family, None) is None and G.parse_target(family, " ") is None
        assert G.MAKERS[family](Random(seed)) == (spec, target)


def test_countdown_prefers_few_operations():
    assert Z.countdown_expressions([3, 4], 12) == (1, 1)


def test_completions_retry_and_carry_errors(spark):
    class Flaky:
        def __init__(self, fails):
            self.fails = fails

        def complete(self, prompts):
            if "boom" in prompts[0]:
                raise ValueError("boom")
            if self.fails:
                self.fails -= 1
                raise TimeoutError
            return [p.upper() for p in prompts]

    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "boom")], "id long, p string").repartition(1)
    got = {r.id: (r.out, r.out_error) for r in M.complete(rows, "p", "out", Flaky(2), 1, M.Retry(4, 0.0, 0.0)).collect()}
    assert got == {1: ("A", None), 2: ("", None), 3: (None, "ValueError: boom")}
    assert M.complete(rows.where("id = 1"), "p", "out", Flaky(9), 1, M.Retry(2, 0.0, 0.0)).first().out_error.startswith("TimeoutError")
    assert M.complete(rows.where("1=0"), "p", "out", M.Echo()).count() == 0


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column).first()[0]


def test_reviews(spark):
    t = F.col("t")
    assert one(spark, "Assistant 1: PASS\nASSISTANT 2: pass", W.audit_passed(t, F.lit(2))) is True
    for bad in ("ASSISTANT 1: PASS", "ASSISTANT 1: PASS ASSISTANT 2: PASS ASSISTANT 3: PASS", "ASSISTANT 1: PASS ASSISTANT 2: PASS but fail", ""):
        assert one(spark, bad, W.audit_passed(t, F.lit(2))) is False
    assert one(spark, "None - fine.", W.repair_actions(t)) == [] and one(spark, " fix turn 2 ", W.repair_actions(t)) == ["fix turn 2"]
    assert one(spark, "REPAIR please", W.selection_accepted(t, F.lit(0.9), 0.5)) is False
    assert one(spark, "unsure", W.selection_accepted(t, F.lit(0.9), 0.5)) is True
    text = "intro\n**SCORE**: 7/10\nFailure mode, it\n  broke here \n\nscore 8/10\nmore"
    assert one(spark, text, W.keyed_lines(t, ["SCORE", "FAILURE_MODE"])) == {"score": "8/10\nmore", "failure_mode": "it\nbroke here"}


def test_payloads(spark):
    t = F.col("t")
    assert one(spark, "word " * 30, Y.trim_excerpt(t, 33)) == ("word " * 6).strip()
    assert one(spark, "x" * 50, Y.trim_excerpt(t, 20)) == "x" * 20
    assert one(spark, "short", Y.trim_excerpt(t, 20)) == "short"
    merged = lambda *blocks: one(spark, "", Y.merge_short(F.array(*map(F.lit, blocks))))
    assert merged("a" * 100, "b" * 100, "c" * 10) == ["a" * 100 + "\n" + "b" * 100 + "\n" + "c" * 10]
    assert merged("a" * 200, "b" * 200) == ["a" * 200, "b" * 200] and merged("a") == ["a"]
    text = ("Some sentence here. " * 120).strip()
    parts = one(spark, text, Y.chunks(t))
    assert all(p.endswith(".") for p in parts) and "".join(parts).replace(" ", "") == text.replace(" ", "")
    assert one(spark, "p one\n\np two", Y.payload_blocks(t)) == ["p one\np two"]
    assert one(spark, None, Y.payload_blocks(t)) == []
    words = " ".join(f"w{k}" for k in range(100))
    cut = one(spark, words, Y.window(t, F.lit("seed"), 60, 0.2))
    assert cut in words and len(cut) <= 80 and set(cut.split()) <= set(words.split())
    assert one(spark, "tiny", Y.window(t, F.lit("seed"), 60, 0.2)) == "tiny"
    passages = F.array(*[F.lit(x * 10) for x in "abc"])
    assert one(spark, "", Y.passage_span(passages, F.lit(1), 15)) == "b" * 10 + "\n\n" + "c" * 10
    assert one(spark, "", Y.passage_span(passages, F.lit(9), 5)) == "c" * 10


def brute_blocks(text):
    """Blocks by trying every place to cut, from the last."""
    text = (text or "").replace("\r\n", "\n").replace("\r", "\n")
    for breaks in (r"\n\s*\n+", "\n"):
        parts = [p.strip() for p in re.split(breaks, text) if p.strip()]
        if len(parts) > 1:
            groups = [[]]
            for p in parts:
                if sum(map(len, groups[-1])) >= 180:
                    groups.append([])
                groups[-1].append(p)
            if len(groups) > 1 and len("\n".join(groups[-1])) < 180:
                groups[-2:] = [groups[-2] + groups[-1]]
            return ["\n".join(g) for g in groups]
    if len(text) <= 1400:
        return [text.strip()] if text.strip() else []
    out = []
    while text:
        ends = [len(text)] if len(text) <= 900 else []
        for mark, more in ((". ", 1), ("\n", 0), ("; ", 1), (", ", 1), (" ", 0)):
            ends += [k + more for k in range(900 - len(mark), 539, -1) if text[k : k + len(mark)] == mark]
        end = [*ends, 900][0]
        out, text = [*out, text[:end].strip()], text[end:]
    return [x for x in out if x]


def test_payload_blocks_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", "  \n ", "one", "é" * 2000]
    for marks in (["\n\n", " ", "\n \n\n"], ["\n", " ", "\r\n"], [". ", " ", ", ", "; "], [" ", ", "], ["", "x"], ["; ", "y"]):
        texts += ["".join("w" * rng.randint(1, 60) + rng.choice(marks) for _ in range(rng.randint(1, 120))) for _ in range(12)]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k long, t string")
    got = {r.k: r.b for r in rows.select("k", Y.payload_blocks(F.col("t")).alias("b")).collect()}
    assert [got[k] for k in range(len(texts))] == [brute_blocks(x) for x in texts]


def test_halves_and_selected_passages(spark):
    t = F.col("t")
    halves = lambda x: (one(spark, x, Y.halves(t)[0]), one(spark, x, Y.halves(t)[1]))
    assert halves("One part. Other part.") == ("One part.", "Other part.") and halves("aaaa bbbb cccc") == ("aaaa bbbb", "cccc") and halves("abcd") == ("abc", "d")
    text = "\n\n".join(f"Passage {k} " + "word " * 40 for k in range(9))
    for count in (1, 3):
        got = one(spark, text, Y.selected_passages(t, count, F.lit("s"), 100, 400, 0.2))
        assert 1 <= len(got) <= count and len(set(got)) == len(got) and all(p in text for p in got)
    assert len(one(spark, text, Y.selected_passages(t, 20, F.lit("s"), 100, 400, 0.2))) == 9
    assert one(spark, "short", Y.selected_passages(t, 2, F.lit("s"), 100, 400, 0.2)) == ["short"]


def test_wording_languages_and_titles(spark):
    t = F.col("t")
    assert one(spark, "- According to the provided text , evidence is thin -", V.recall_text(t)) == "from what is known, known facts is thin"
    assert one(spark, "Moon", V.title_variants(t)) == ["The Moon", "Moon"] and one(spark, "The Moon", V.title_variants(t)) == ["The Moon"]
    assert one(spark, "Det er ikke en hund, som har en kat på taget og der er den", L.detect(t)) == "da"
    assert one(spark, "zzz", L.detect(t)) is None and one(spark, "zzz", L.passes(t, ("en",))) is True
    assert one(spark, "The moon is the satellite of the earth and it is in the sky " * 3, L.passes(t, ("en",))) is True
    assert one(spark, "The moon is the satellite of the earth and it is in the sky " * 3, L.passes(t, ("da",))) is False
    block = V.source_block(F.array(F.lit(1)), F.array(F.lit("A&B")), F.array(t))
    assert one(spark, "x<y", block) == '<source id="1" title="A&amp;B">x&lt;y</source>'
    none = F.expr("cast(array() as array<string>)")
    assert one(spark, "The moon is a satellite.", V.default_target(F.lit("definition"), F.lit("The moon"), t, none)) == "a satellite"
    assert one(spark, "s", V.default_target(F.lit("source_clue"), F.lit("Moon"), t, none)) == "Moon"
    assert one(spark, "s", V.default_target(F.lit("x"), F.lit("Moon"), t, F.array(F.lit("p"), F.lit("q"), F.lit("r")))) == "p q"


def test_envelopes_round_trip(spark):
    from textmill.functions import envelopes as EV

    answers = ["1 2\n3 4", 'say "x" \\ y', "a=1 b=2", "- é"]
    rows = [(k, a) for k in EV.KINDS for a in answers]
    df = spark.createDataFrame(rows, "kind string, answer string")
    kind, label = F.col("kind"), F.lit("ANSWER")
    wrapped = F.concat(F.lit("Step one.\nStep two.\n\n"), EV.wrap(kind, F.col("answer"), label))
    for r in df.select("kind", "answer", EV.unwrap(kind, wrapped, label).alias("back")).collect():
        assert r.back == r.answer, r
    for k in EV.KINDS:
        assert one(spark, "no envelope", EV.unwrap(F.lit(k), F.col("t"), label)) in (None, "")
    assert json.loads(one(spark, 'a\n"b"', EV.wrap(F.lit("json"), F.col("t"), label))) == {"answer_lines": ["a", '"b"']}


def test_row_projections(spark):
    from textmill.functions import rows as RW

    t = F.col("t")
    assert one(spark, "grounded_qa-000001", RW.row_family(F.lit(" "), t, ["grounded", "grounded_qa"])) == "grounded_qa"
    assert one(spark, "x-1", RW.row_family(F.lit("demo"), t, ["x"])) == "demo" and one(spark, "y-1", RW.row_family(F.lit(None), t, ["x"])) is None
    assert one(spark, "en", RW.language_mode(t, F.lit("en"), F.lit(None))) == "same_language" and one(spark, "en", RW.language_mode(t, F.lit("da"))) == "cross_language"
    have = F.array(F.struct(F.lit("a").alias("kind"), F.lit("1").alias("value")))
    assert len(one(spark, "", RW.with_source(have, F.lit("a"), F.lit("2")))) == 1 and len(one(spark, "", RW.with_source(have, F.lit("b"), F.lit("2")))) == 2
    messages = F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit("r").alias("content")))
    assert one(spark, " ", RW.response_text(t, messages)) == "r" and one(spark, "x", RW.response_text(t, messages)) == "x"
    assert (RW.candidate_count(10, 1.25), RW.candidate_count(10, 0.5), RW.attempts(10), RW.attempts(100)) == (13, 10, 60, 400)
    assert one(spark, " s ", RW.upgraded_target(t, F.lit("s"), F.lit("better"))) == "better" and one(spark, "own", RW.upgraded_target(t, F.lit("s"), F.lit("b"))) == "own"
    assert one(spark, '```text\n"hi there"\n```', RW.clean_prompt(t)) == "hi there" and one(spark, '"q"', RW.clean_prompt(t)) == "q"
    assert [one(spark, x, RW.placeholder(t)) for x in ("", "<answer>", "The Final Answer", "42")] == [True, True, True, False]
    assert one(spark, "", RW.merge_unique(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c")))) == ["a", "b", "c"]


def test_artifacts(spark):
    from textmill.functions import artifacts as AR

    t = F.col("t")
    for text, claims, payload in [
        ("Here is the draft.", True, False),
        ("Her er kontrakten", True, False),
        ("tekst: " + "x" * 25, True, True),
        ("kode:\nkilde:", True, True),
        ("kode: kort", True, False),
        ("nothing to see", False, False),
        ("I pasted it, codes elsewhere", False, False),
        ('he said "a very long quotation stands here"', False, True),
        ("a\nb\n" + "c" * 180, False, True),
        ("> quoted", False, True),
        ("", False, False),
    ]:
        assert (one(spark, text, AR.claims_artifact(t)), one(spark, text, AR.has_payload(t))) == (claims, payload), text
    text = "Uddrag 1:\n```text\nfirst\n```\nIndsat tekst 2 begynder:\nsecond\nIndsat tekst 2 slutter.\nUddrag 3: ---\nthird\n---\nUddrag 4:\n> four\n> five"
    assert one(spark, text, AR.inserted_blocks(t)) == ["first", "second", "third", "four\nfive"]
    parse = AR.numbered_blocks("USER")
    assert one(spark, "USER 1: hi\nthere\n\n\nmore\n2. USER turn - bye", parse(t)) == ["hi\nthere\n\nmore", "bye"]
    assert one(spark, "1) a\n2) b", parse(t)) == ["a", "b"] and one(spark, None, parse(t)) == []
    roles = F.array(*map(F.lit, ["user", "assistant", "user"]))
    got = one(spark, "", AR.weave(roles, F.array(F.lit("u1"), F.lit("u2")), F.array(F.lit("a1"))))
    assert [(m.role, m.content) for m in got] == [("user", "u1"), ("assistant", "a1"), ("user", "u2")]
    got = one(spark, "", AR.fallback_skeleton(F.array(F.lit("ask"), F.lit("fix"))))
    assert [(s.role, s.act) for s in got] == [("user", "ask"), ("assistant", "respond_to_ask"), ("user", "fix"), ("assistant", "respond_to_fix")]


def test_publish_splits_a_large_run_by_position(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 12_000, 1, 5).select(F.format_string("%06d", F.col("id") * 7919 % 12_000).alias("id"), F.repeat(F.lit("payload "), 30).alias("text"), (F.col("id") % 3).alias("n"))
    pack = P.Pack("large", lambda spark, cfg: rows, lambda: {"has_text": F.length("text") > 0}, fraction=0.9)
    monkeypatch.setitem(P.PACKS, "large", pack)
    run_id = P.run(spark, str(tmp_path / "runs"), "large", {})
    P.publish(spark, str(tmp_path / "runs"), "large", run_id, f"{tmp_path}/pub")
    data = spark.read.parquet(f"{tmp_path}/pub/data")
    assert data.count() == data.select("id").distinct().count() == 12_000
    assert data.where("split <> if(id < '010800', 'train', 'eval')").count() == 0
