"""Review parsing: verdicts, negated failures, turn audits, repair actions, keyed lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a failed review says, and the negations that do not count as failure.
FAILURES = (
    r"\bfail(?:ed|s|ure)?\b", r"\breject(?:ed|s|ion)?\b", r"\bmissing\b", r"\blacks?\b", r"\bunsupported\b", r"\bnot\s+(?:supported|grounded|visible)\b",
    r"\bcontradict(?:s|ed|ion|ions|ory)?\b", r"\bhallucinat\w*\b", r"\binvent(?:ed|s|ing)?\b", r"\bfuture leakage\b", r"\bsource invention\b", r"\bmalformed\b",
    r"\bbroken\b", r"\bcorrupt(?:ed|ion)?\b", r"\bunnatural\b", r"\brepair\s+(?:needed|required)\b", r"\bneeds?\s+(?:repair|regeneration|rewrite|fix)\b",
)
NEGATED = (
    r"\bno\s+[^.:\n;]{0,120}\b(?:unsupported|contradict(?:ion|ions|ory)?|missing|hallucinat\w*|invent\w*|source invention|failures?|issues?|problems?|semantic oddit\w*|recovery situation\w*)[^.:\n;]{0,80}",
    r"\bwithout\s+[^.:\n;]{0,80}\b(?:unsupported|contradict\w*|missing|hallucinat\w*|invent\w*|source invention)[^.:\n;]{0,80}",
    r"\bdoes not\s+(?:assert|introduce|imply|claim|invent|contradict|rely|pretend|need|silently|fabricate|override|act)\b",
    r"\bdoesn't\s+(?:assert|introduce|imply|claim|invent|contradict|rely|pretend|need|silently|fabricate|override|act)\b",
    r"\bdo not\s+(?:assert|introduce|imply|claim|invent|contradict|rely|pretend|fabricate|override|act)\b",
    r"\bavoids?\s+(?:hallucination|contradiction|unsupported|inventing|source invention|future leakage)\b",
    r"\bnot unsupported\b",
)
NO_ACTION = "^(?:none required|none needed|no repair|no action|not needed|not required)"


def passed(text: Column) -> Column:
    """The leading verdict; without one, that no failure is left once negated ones are gone."""
    lower = F.lower(text)
    cleared = reduce(lambda t, p: F.regexp_replace(t, p, " "), NEGATED, lower)
    lead = F.ltrim(lower)
    return F.when(lead.rlike("^(?:fail|reject)"), False).when(lead.rlike("^(?:pass|accept)"), True).otherwise(~cleared.rlike("|".join(FAILURES)))


def audit_passed(text: Column, turns: Column) -> Column:
    """PASS for assistant turns 1 to n, none beyond them, no FAIL anywhere."""
    seen = F.transform(
        F.regexp_extract_all(text, F.lit(r"(?i)\bASSISTANT\s+(\d+)\s*:\s*PASS\b"), F.lit(1)), lambda n: n.cast("int")
    )
    listed = F.transform(F.regexp_extract_all(text, F.lit(r"(?i)\bASSISTANT\s+(\d+)\s*:"), F.lit(1)), lambda n: n.cast("int"))
    every = F.forall(F.sequence(F.lit(1), F.greatest(turns, F.lit(1))), lambda k: (k > turns) | F.array_contains(seen, k))
    return (F.trim(text) != "") & every & ~F.array_contains(listed, turns + 1) & ~F.upper(text).contains("FAIL")


def repair_actions(text: Column) -> Column:
    """What a review asks to repair: nothing, or the whole text."""
    lower = F.regexp_replace(F.regexp_replace(F.lower(text), "^[ .]+|[ .]+$", ""), r"\s*[-–—]\s*", " - ")
    none = lower.isin("", "none", "n/a") | lower.rlike(r"^none(?:\b| - )") | lower.rlike(NO_ACTION)
    return F.when(none, F.expr("cast(array() as array<string>)")).otherwise(F.array(F.trim(text)))


def selection_accepted(text: Column, score: Column, threshold: float) -> Column:
    lower = F.lower(text)
    return F.when(lower.rlike("reject|fail"), False).when(lower.contains("accept"), True).when(lower.contains("repair"), False).otherwise(score >= threshold)


def keyed_lines(text: Column, keys: list[str]) -> Column:
    """map<key, value> of lines that open with one of the keys; other lines continue the value before them.

    Keys match in any case, bare or in asterisks, with a space for each underscore if so
    written; a colon, comma or space separates. The last of equal keys holds.
    """
    names = "|".join(sorted((k.replace("_", r"[_ ]") for k in keys), key=len, reverse=True))
    # A mark before every keyed line turns the text into parts that start with their key.
    parts = F.split(F.regexp_replace(F.regexp_replace(text, r"(?m)^[ \t]+|[ \t]+$", ""), rf"(?im)^\**({names})\**(?:[ \t]*[:,][ \t]*|[ \t]+|$)", "\x01$1\x02"), "\x01")
    found = F.transform(
        F.filter(parts, lambda p: p.contains("\x02")),
        lambda p: F.struct(
            F.replace(F.lower(F.split_part(p, F.lit("\x02"), F.lit(1))), F.lit(" "), F.lit("_")).alias("key"),
            F.trim(F.regexp_replace(F.regexp_replace(F.split_part(p, F.lit("\x02"), F.lit(2)), r"\n+", "\n"), r"^\n|\n$", "")).alias("value"),
        ),
    )
    last = F.filter(found, lambda e, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda later: later.key == e.key))
    return F.map_from_entries(last)


def merged_score(score: Column, strict: Column, gates: Column) -> Column:
    """The lower of two scores, nothing if a local gate fails."""
    return F.when(gates, F.least(score, strict)).otherwise(F.lit(0.0))
