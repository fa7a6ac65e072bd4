"""Prompt features: what a prompt asks for, how long and how constrained it is."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, fold

# Excluded phrases, ordered task patterns, stop words, number words and hints.
EXCLUDED = (
    "additional requirements",
    "yderligere krav",
    "return valid json",
    "returner gyldig json",
    "return valid xml",
    "returner gyldig xml",
    "numbered list",
    "nummereret liste",
    "bullet list",
    "punktopstilling",
    "start the response",
    "begynd svaret",
    "end the response",
    "afslut svaret",
    "do not use",
    "brug ikke",
    "exactly ",
    "præcis ",
)
TASK_PATTERNS = (
    ("translation", ("oversæt", "translate", "translate into", "oversaet")),
    ("rewrite", ("omskriv", "rephrase", "rewrite", "redigér", "rediger", "edit", "omformuler")),
    ("classification", ("klassificér", "klassificer", "classify", "categorize", "kategoriser")),
    ("summarization", ("opsummér", "opsummer", "summarize", "resumer", "reduce following text", "reducer følgende tekst")),
    ("comparison", ("sammenlign", "compare", "forklar forskellen", "what is the difference", "hvad er forskellen")),
    ("listing", ("oplist", "list", "angiv", "nævn", "naevn", "give me a list", "generer en liste")),
    ("analysis", ("analyser", "analyze", "analyse", "fortolk", "interpret", "vurder", "evaluate")),
    ("recommendation", ("foreslå", "anbefal", "recommend", "suggest", "giv et råd", "give advice")),
    ("explanation", ("forklar", "explain", "beskriv", "describe", "hvad er", "what is", "hvordan", "how does", "why does", "hvorfor")),
    ("creative", ("skriv", "write", "fortæl", "tell", "opfind", "invent", "lav et", "create a")),
)
KEYWORD_STOPS = {
    "en": [
        "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "how", "if", "in", "into", "is", "it", "of", "on", "or", "the", "this",
        "that", "to", "using", "what", "when", "where", "which", "who", "why", "with", "write", "list", "give", "generate", "create", "describe",
        "explain", "compare", "summarize", "translate", "classify", "recommend", "suggest", "answer", "response",
    ],
    "da": [
        "af", "at", "de", "den", "der", "det", "en", "et", "for", "fra", "hvad", "hvem", "hvilke", "hvilken", "hvilket", "hvor", "hvordan",
        "hvorfor", "i", "med", "og", "om", "på", "som", "til", "ud", "ved", "skriv", "oplist", "angiv", "nævn", "forklar", "sammenlign",
        "opsummer", "oversæt", "klassificer", "anbefal", "foreslå", "svar", "svaret",
    ],
}
NUMBERS = {
    "en": {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12},
    "da": {"en": 1, "et": 1, "ét": 1, "to": 2, "tre": 3, "fire": 4, "fem": 5, "seks": 6, "syv": 7, "otte": 8, "ni": 9, "ti": 10, "elleve": 11, "tolv": 12},
}
LIST_HINTS = {
    "en": ("list", "ideas", "examples", "steps", "ways", "facts", "reasons", "items", "bullet", "points"),
    "da": ("liste", "idéer", "ideer", "eksempler", "trin", "måder", "punkter", "fakta", "grunde"),
}
MATH_HINTS = {
    "en": ("calculate", "cost", "price", "watt", "kwh", "percent", "plus", "minus", "total", "expected"),
    "da": ("beregn", "koste", "pris", "watt", "kwh", "procent", "plus", "minus", "i alt", "forventer"),
}
SENTENCES = {"en": ("sentence", "sentences"), "da": ("sætning", "sætninger")}
LINES = {"en": ("line", "lines"), "da": ("linje", "linjer")}


def _accent_table() -> tuple[str, str]:
    """Characters whose compatibility form is one character beside marks, that character, and the marks."""
    single, plain, marks = [], [], []
    for code in [*range(0xA0, 0x2200), *range(0xFF01, 0xFF5F)]:
        form = unicodedata.normalize("NFKD", chr(code))
        bare = "".join(c for c in form if not unicodedata.combining(c))
        if not bare:
            marks.append(chr(code))
        elif len(bare) == 1 and bare != chr(code) and bare not in "\\'":
            single.append(chr(code))
            plain.append(bare)
    return "".join(single + marks), "".join(plain)


#: By rule: what translate() takes to do what decomposing and dropping the marks does.
ACCENTS = _accent_table()


def normalize_prompt(text: Column) -> Column:
    """Caseless, decomposed without marks (æ and ø stay, å is a), white space collapsed."""
    return collapse(F.translate(fold(text), *ACCENTS))


def prompt_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\p{L}+(?:[-']\p{L}+)?"), F.lit(0))


def keep_prompt(text: Column, least: int = 40, most: int = 700, max_lines: int = 12, excluded: tuple[str, ...] = EXCLUDED) -> Column:
    """Length and line limits, no code fence, fewer than three list lines, no excluded phrase."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    listed = F.size(F.filter(lines, lambda x: x.rlike(r"^\s*(?:[-*]|\d+[.)])\s+")))
    ok = F.length(text).between(least, most) & (F.size(lines) <= max_lines) & ~text.contains("```") & (listed < 3)
    for phrase in excluded:
        ok = ok & ~fold(text).contains(phrase)
    return ok


def task_type(text: Column) -> Column:
    """The first pattern group that opens the lead or stands between spaces."""
    norm = normalize_prompt(text)
    lead = F.split_part(norm, F.lit(":"), F.lit(1))
    out = None
    for name, patterns in TASK_PATTERNS:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | lead.startswith(p) | norm.contains(f" {p} ")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.when(text.contains("?"), "question_answering").otherwise("general_generation")


def length_bucket(text: Column) -> Column:
    n = F.size(prompt_words(text))
    return F.when(n <= 10, "short").when(n <= 22, "medium").otherwise("long")


def _values(tokens: Column, lang: str) -> Column:
    """What tokens say as numbers, in digits or words; null for other tokens."""
    names = F.create_map(*[x for w, n in NUMBERS[lang].items() for x in (F.lit(w), F.lit(n))])
    return F.transform(tokens, lambda t: F.when(t.rlike(r"^\d{1,9}$"), t.try_cast("int")).otherwise(F.try_element_at(names, t)))


def _count_tokens(text: Column) -> Column:
    return F.regexp_extract_all(normalize_prompt(text), F.lit(r"\d+|\p{L}+(?:[-']\p{L}+)?"), F.lit(0))


def small_numbers(text: Column, lang: str = "en") -> Column:
    """Numbers 1 to 12, in digits or words, in order."""
    return F.filter(_values(_count_tokens(text), lang), lambda v: v.between(1, 12))


def units_before(text: Column, units: tuple[str, ...], lang: str = "en") -> Column:
    """The first number 1 to 12 right before one of the unit words, or null."""
    tokens, wanted = _count_tokens(text), F.array(*map(F.lit, units))
    pairs = F.zip_with(tokens, _values(tokens, lang), lambda t, v: F.struct(t.alias("t"), v.alias("v")))
    before = F.transform(pairs, lambda p, k: F.when(F.array_contains(wanted, F.get(tokens, k + 1)) & p.v.between(1, 12), p.v))
    return F.get(F.filter(before, lambda v: v.isNotNull()), F.lit(0))


def _hinted(text: Column, hints: tuple[str, ...]) -> Column:
    norm, hint = normalize_prompt(text), F.lit(False)
    for h in hints:
        hint = hint | norm.contains(h)
    return hint


def item_count(text: Column, kind: Column, lang: str = "en") -> Column:
    """The first number 2 to 10 of a prompt that asks for items."""
    value = F.get(F.filter(small_numbers(text, lang), lambda v: v.between(2, 10)), F.lit(0))
    asks = kind.isin("classification", "creative", "listing", "recommendation", "translation")
    return F.when(asks & (_hinted(text, LIST_HINTS[lang]) | (kind == "translation")), value)


def numeric_task(text: Column, kind: Column, lang: str = "en") -> Column:
    hint = text.rlike(r"\p{Nd}") | _hinted(text, MATH_HINTS[lang])
    return kind.isin("analysis", "comparison", "explanation", "question_answering") & hint


def rigidity(text: Column, kind: Column, lang: str = "en") -> Column:
    rigid = (
        numeric_task(text, kind, lang)
        | units_before(text, SENTENCES[lang], lang).isNotNull()
        | units_before(text, LINES[lang], lang).isNotNull()
        | kind.isin("translation", "classification")
    )
    medium = item_count(text, kind, lang).isNotNull() | kind.isin("analysis", "comparison", "explanation", "question_answering", "rewrite", "summarization")
    return F.when(rigid, "rigid").when(medium, "medium").otherwise("open")


def keywords(text: Column, most: int = 12, lang: str = "en") -> Column:
    """The first distinct content words in text order."""
    stops = F.array(*[F.lit(w) for w in [*KEYWORD_STOPS[lang], *NUMBERS[lang]]])
    found = F.transform(prompt_words(text), lambda w: fold(w))
    kept = F.filter(F.array_distinct(found), lambda t: (F.length(t) > 2) & ~F.array_contains(stops, t))
    return F.slice(kept, 1, most)
