"""Dialogue scores and selection against plain Python over whole conversations."""

import re
from collections import defaultdict

import pytest

from textmill.functions import artifacts as A
from textmill.operators import dialogue as O
from textmill.plans import dialogue_queries as Q

SF = "/root/testdata/sf0.001"
STOPS = set("about after because before could first help there these think under which would again eller efter fordi gerne hjælp hvordan ikke noget omkring selvom skulle ville".split())


def terms(text, most):
    found = [m[0].strip() for p in (r"[$€£]?[0-9][0-9.,]*(?:\s*(?:%|kr\.?|dollars?|minutes?|minutter|days?|dage))?", r"\b[A-ZÆØÅ]{2,}(?:-[A-Z0-9]+)?\b", r"\b[A-Za-zÆØÅæøå]+-[A-Za-z0-9]+\b") for m in re.finditer(p, text)]
    found += [w for w in re.findall("[A-Za-zÆØÅæøå]{5,}", text.lower()) if w not in STOPS]
    first = {}
    for t in found:
        if t:
            first.setdefault(t.lower(), t)
    return list(first.values())[:most]


def grounding(asked, answers):
    ts = terms("\n".join(asked), 16)
    return round(sum(t.lower() in "\n".join(answers).lower() for t in ts) / len(ts), 4) if ts else 1.0


def substance(text):
    t = text.strip()
    n = len(re.findall("[A-Za-zÆØÅæøå0-9]+", t))
    marks = re.search(r'[0-9$€£`"“”:;\n]', t) or re.search(r"(?i)\b(kr|dkk|usd|gb|ram|ssd|python|error|fejl|frist|budget|dato)\b", t)
    calls = re.search("kan du hjælpe|vil du hjælpe|hjælp mig|can you help|could you help", t.lower()) and n < 14 and not re.search(r'[0-9$€£`"“”:]', t)
    score = 0.2 + 0.2 * (n >= 10) + 0.2 * (n >= 18) + 0.3 * bool(marks) + 0.1 * (len(terms(t, 8)) >= 2) - 0.35 * bool(calls)
    return round(min(max(score, 0.0), 1.0), 4) if t else 0.0


def plain_scores(r):
    asked, answers = ([m.text for m in r.messages if m.role == role] for role in ("user", "assistant"))
    acts = [s.dialogue_act for s in r.skeleton if s.role == "user"]
    progress = len(set(acts)) / max(1, len(acts))
    if any(x in a for a in acts for x in ("late", "constraint", "correction")):
        progress = min(progress + 0.15, 1.0)
    form = sum(bool(a.strip()) for a in answers) / max(1, len(answers))
    form = min(form + 0.1, 1.0) if len(asked) == len(answers) else form
    seen, grounded = "", True
    for m in r.messages:
        if m.role == "user":
            grounded &= all(q.strip().lower() in seen for q in re.findall(r'"([^"\n]+)"', m.text) if len(q.strip()) >= 4)
        seen += "\n" + m.text.lower()
    done = round((min(max(r.review_score, 0), 1) + any(x.passed for x in r.reviewers if x.name == "outcome")) / 2, 4)
    only = all(m.role in ("user", "assistant") for m in r.messages)
    seven = [grounding(asked, answers), progress, form, float(only), None, done, substance(asked[0]) if asked else 0.0]
    plan = r.plan_steps or [x.strip(" -\t") for x in re.split(r"->|=>|;|\n", r.plan or "") if x.strip(" -\t")] or acts
    shape = ">".join(re.sub("[^a-z0-9]+", "_", x.lower()).strip("_") or "unknown" for x in plan)
    name = "|".join([r.family, r.domain, r.intent_trajectory, r.subtask_trajectory or "", r.work_session_type, shape, ">".join(acts)])
    good = only and len(r.messages) >= 4 and len(r.messages) % 2 == 0 and all(m.role == ("user", "assistant")[k % 2] and m.text.strip() for k, m in enumerate(r.messages))
    return seven, float(grounded), name, good


@pytest.fixture(scope="module")
def dialogues(spark):
    return Q._dialogues(spark, SF)


def test_scores_match_plain_python(spark, dialogues):
    own = {r.conv_id: [A_ for A_ in r.a] for r in dialogues.selectExpr("conv_id", "filter(messages, m -> m.role = 'user') AS u").select("conv_id", Q.F.transform("u", lambda m: ~A.claims_artifact(m.text) | A.has_payload(m.text)).alias("a")).collect()}
    got = {r.conv_id: r for r in O.mds_scores(dialogues).collect()}
    rows = dialogues.collect()
    assert len(got) == len(rows) > 10
    for r in rows:
        seven, grounded, name, good = plain_scores(r)
        seven[4] = float(all(own[r.conv_id]))
        g = got[r.conv_id]
        assert [g[c] for c in O.SCORED] == pytest.approx([round(x, 4) for x in seven], abs=1.01e-4)
        assert g.reaction_grounding == grounded and g.global_bin == name and abs(g.local_score - sum(seven) / 7) < 1.01e-4
        assert not g.eligible or (good and r.accepted and seven[4] == 1)


def plain_select(rows, target):
    families = defaultdict(lambda: defaultdict(list))
    for r in sorted(rows, key=lambda r: (-r.local_score, -r.review_score, r.conv_id)):
        families[r.family][r.global_bin].append(r.conv_id)
    cursor, chosen = defaultdict(int), []
    while len(chosen) < target and families:
        for f in sorted(families, key=lambda f: (sum(map(len, families[f].values())), f)):
            names = sorted(families[f])
            at = cursor[f] % len(names)
            cursor[f] = (at + 1) % len(names)
            chosen.append(families[f][names[at]].pop(0))
            if not families[f][names[at]]:
                del families[f][names[at]]
            if len(chosen) == target:
                break
        families = defaultdict(lambda: defaultdict(list), {f: b for f, b in families.items() if b})
    return chosen


@pytest.mark.parametrize("target", [1, 7, 25, 10_000])
def test_selection_matches_plain_python(spark, dialogues, target):
    scored = O.mds_scores(dialogues).withColumn("eligible", Q.F.col("conv_id") % 9 != 0).cache()
    got = O.mds_select(scored, target)
    want = plain_select(scored.where("eligible").collect(), target)
    assert sorted(r.conv_id for r in got.collect()) == sorted(want)
    report = O.mds_report(scored, got, target).first()
    assert report.accepted_rows == len(want) and report.shortfall == target - len(want) and report.status == ("completed" if len(want) == target else "partial")
