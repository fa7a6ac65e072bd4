"""Conversation checks and scores as column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Words that say nothing about a conversation's subject; what salient terms look
# like; what an opening turn with something concrete in it has; calls for help; score weights.
SALIENT_STOPS = [
    "about", "after", "because", "before", "could", "first", "help", "there", "these", "think", "under", "which", "would", "again",
    "eller", "efter", "fordi", "gerne", "hjælp", "hvordan", "ikke", "noget", "omkring", "selvom", "skulle", "ville",
]
LETTERS = "A-Za-zÆØÅæøå"
TERM_PATTERNS = (
    r"[$€£]?\d[\d.,]*(?:\s*(?:%|kr\.?|dollars?|minutes?|minutter|days?|dage))?",
    r"\b[A-ZÆØÅ]{2,}(?:-[A-Z0-9]+)?\b",
    rf"\b[{LETTERS}]+-[A-Za-z0-9]+\b",
)
LONG_WORD = rf"[{LETTERS}]{{5,}}"
PAYLOAD_MARKS = r'[0-9]|[$€£]|[`"]|“|”|:|;|\n'
PAYLOAD_WORDS = r"(?i)\b(?:kr|dkk|usd|gb|ram|ssd|python|error|fejl|frist|budget|dato)\b"
SPECIFIC_MARKS = r'[0-9]|[$€£]|[`"]|“|”|:'
HELP_CALLS = "kan du hjælpe|vil du hjælpe|hjælp mig|can you help|could you help"
PROGRESS_ACTS = ("late", "constraint", "correction")


def role_leaked(text: Column) -> Column:
    return text.rlike(r"(?i)\b(USER|ASSISTANT)\s+\d+\s*:")


def restrained_format(text: Column) -> Column:
    return ~text.rlike("[\\x{2705}\\x{274C}\\x{26A0}\\x{FE0F}\\x{1F300}-\\x{1FAFF}]")


def dedupe_caseless(values: Column, most: int | None = None) -> Column:
    """Values in order, the first of those that differ in case only; at most ``most``."""

    def of(keys: Column, all_values: Column) -> Column:
        kinds = F.array_distinct(keys)
        chosen = kinds if most is None else F.slice(kinds, 1, most)
        return F.transform(chosen, lambda k: F.get(all_values, F.array_position(keys, k).cast("int") - 1))

    return let(values, lambda v: let(F.transform(v, lambda x: F.lower(x)), lambda keys: of(keys, v)))


def salient_terms(text: Column, most: int = 16) -> Column:
    """Amounts, capitalised names, hyphenated terms, then long words; distinct but for case."""

    def of(t: Column) -> Column:
        named = [F.transform(F.regexp_extract_all(t, F.lit(p), F.lit(0)), lambda x: F.trim(x)) for p in TERM_PATTERNS]
        long = F.filter(F.regexp_extract_all(F.lower(t), F.lit(LONG_WORD), F.lit(0)), lambda w: ~w.isin(*SALIENT_STOPS))
        return dedupe_caseless(F.filter(F.concat(*named, long), lambda x: x != ""), most)

    return let(text, of)


def entity_grounding(user_text: Column, assistant_text: Column) -> Column:
    """Share of the user's salient terms that the assistant's text has; 1 without terms."""

    def of(terms: Column, lower: Column) -> Column:
        hits = F.size(F.filter(terms, lambda t: lower.contains(F.lower(t))))
        return F.when(F.size(terms) == 0, F.lit(1.0)).otherwise(F.round(hits / F.size(terms), 4))

    return let(salient_terms(user_text), lambda terms: let(F.lower(assistant_text), lambda lower: of(terms, lower)))


def first_turn_substance(text: Column) -> Column:
    """Additive score of an opening turn: length, concrete payload, terms, minus empty calls for help."""

    def of(t: Column) -> Column:
        def scored(n: Column) -> Column:
            part = lambda c, v: F.when(c, F.lit(v)).otherwise(F.lit(0.0))
            payload = t.rlike(PAYLOAD_MARKS) | t.rlike(PAYLOAD_WORDS)
            empty_call = F.lower(t).rlike(HELP_CALLS) & (n < 14) & ~t.rlike(SPECIFIC_MARKS)
            score = F.lit(0.2) + part(n >= 10, 0.2) + part(n >= 18, 0.2) + part(payload, 0.3) + part(F.size(salient_terms(t, 8)) >= 2, 0.1) - part(empty_call, 0.35)
            return F.when(t == "", F.lit(0.0)).otherwise(F.round(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 4))

        return let(F.size(F.regexp_extract_all(t, F.lit(rf"[{LETTERS}0-9]+"), F.lit(0))), scored)

    return let(F.trim(text), of)


def information_progress(acts: Column) -> Column:
    """Share of different dialogue acts among the user's; acts that bring a change add 0.15, up to 1."""
    share = F.size(F.array_distinct(acts)) / F.greatest(F.size(acts), F.lit(1))
    changes = F.exists(acts, lambda a: a.rlike("|".join(PROGRESS_ACTS)))
    return F.when(changes, F.least(share + 0.15, F.lit(1.0))).otherwise(share)


def shape_part(value: Column) -> Column:
    slim = F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(slim, F.lit("")), F.lit("unknown"))


def age_band(age: Column) -> Column:
    named = F.when(age.isNull(), "adult").when(age < 25, "adult_18_24").when(age < 35, "adult_25_34")
    return named.when(age < 50, "adult_35_49").when(age < 65, "adult_50_64").otherwise("adult_65_plus")


def parse_score(text: Column) -> Column:
    """A review score: verdict words as 1 or 0, a/b as a share, above 1 as tenths, nothing found as 0."""
    t, fraction = F.lower(F.trim(text)), r"(\d+(?:\.\d+)?)\s*/\s*(\d+(?:\.\d+)?)"
    top, bottom = (F.regexp_extract(text, fraction, k).try_cast("double") for k in (1, 2))
    one = F.regexp_extract(text, r"\d+(?:\.\d+)?", 0).try_cast("double")
    word = F.when(t.isin("pass", "passed", "accept", "accepted"), 1.0).when(t.isin("fail", "failed", "reject", "rejected", "repair"), 0.0)
    number = F.when(text.rlike(fraction), F.when(bottom > 0, F.round(top / bottom, 4)).otherwise(0.0)).when(one > 1, F.round(one / 10, 4))
    return F.coalesce(word, number, one, F.lit(0.0))
