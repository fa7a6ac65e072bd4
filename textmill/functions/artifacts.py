"""Artifacts in dialogues: claims of visible material, the material itself, numbered turns, weaving."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# What announces an artifact, what artifacts are called, what labels them.
CLAIMS = ("her er", "her kommer", "jeg har indsat", "jeg har sat ind", "jeg har kopieret", "jeg har vedhæftet", "jeg vedhæfter", "nedenfor", "følgende", "here is", "here are", "i pasted", "i copied", "i attached", "attached", "pasted", "below", "following")
TERMS = ("abstract", "aftale", "annonce", "ansøgning", "artikel", "brev", "cv", "dokument", "draft", "email", "e-mail", "excerpt", "fejlbesked", "formular", "jobopslag", "kilde", "kladde", "kode", "kontrakt", "kvittering", "lejeaftale", "mail", "noter", "opslag", "policy", "rapport", "regning", "source", "stack trace", "stillingsopslag", "tekst", "traceback", "uddrag", "udkast", "vilkår")
LABELS = ("abstract", "aftale", "ansøgning", "brev", "cv", "draft", "email", "e-mail", "excerpt", "fejl", "fejlbesked", "formular", "jobopslag", "kilde", "kladde", "kode", "kvittering", "mail", "noter", "opslag", "policy", "source", "stillingsopslag", "tekst", "traceback", "uddrag", "udkast", "vilkår")
STEMS = ("Uddrag", "Indsat tekst", "Dokumentpassage", "Relevant tekst", "Kopieret tekst", "Citeret passage", "Kildeuddrag")

LABEL_LINE = rf"(?im)^\s*(?:{'|'.join(LABELS)})\s*:"
VISIBLE_LABEL = rf"(?:{'|'.join(STEMS)})\s+\d+"
EMPTY = "cast(array() as array<string>)"


def claims_artifact(text: Column) -> Column:
    """Announces an artifact by name, or labels one. Inflected endings of single words count."""
    plain = "|".join(t for t in TERMS if " " not in t and "-" not in t)
    joined = "|".join(t for t in TERMS if " " in t or "-" in t)
    named = F.lower(text).rlike(rf"(?<![a-zæøå])(?:(?:{plain})(?:en|et|er|erne|ene|s)?|{joined})(?![a-zæøå])")
    return (F.lower(text).rlike("|".join(CLAIMS)) & named) | text.rlike(LABEL_LINE)


def has_payload(text: Column) -> Column:
    """A fence, a block quote, a long quotation, labelled content, or three lines of some length."""
    t = F.trim(text)
    quotes = F.regexp_extract_all(t, F.lit("[\"'“”„]([^\"'“”„]{4,})[\"'“”„]"), F.lit(1))
    after = F.split(t, LABEL_LINE, -1)
    told = F.filter(F.split(F.try_element_at(after, F.lit(2)), "\n"), lambda x: F.trim(x) != "")
    labelled = (F.size(after) > 2) | (F.length(F.trim(F.get(told, F.lit(0)))) >= 20)
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")
    long = F.exists(quotes, lambda q: F.length(F.trim(q)) >= 25)
    return (t != "") & (t.contains("```") | t.rlike(r"(?m)^\s*>.+") | long | F.coalesce(labelled, F.lit(False)) | ((F.size(lines) >= 3) & (F.length(t) >= 180)))


def inserted_blocks(text: Column) -> Column:
    """Labelled source blocks of a turn: fenced, begun and ended, between dashes, or quoted by line."""
    found = []
    for pattern in (
        rf"(?is){VISIBLE_LABEL}\s*:\s*```(?:text)?\s*\n(.*?)\n```",
        rf"(?is){VISIBLE_LABEL}\s+begynder:\s*\n(.*?)\n{VISIBLE_LABEL}\s+slutter\.?",
        rf"(?is){VISIBLE_LABEL}\s*:\s*---\s*\n(.*?)\n---",
    ):
        found.append(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda b: F.trim(b)))
    quoted = F.regexp_extract_all(text, F.lit(rf"(?i){VISIBLE_LABEL}\s*:\s*((?:\n>\s?.*)+)"), F.lit(1))
    found.append(F.transform(quoted, lambda b: F.trim(F.regexp_replace(b, r"(?m)^\s*>[ \t]*", ""))))
    return F.concat(*found)


def numbered_blocks(label: str):
    """A vectorised parser of turns written ``LABEL 1: ...``, ``1. LABEL: ...`` or ``1. ...``.

    Lines without a number continue the block before them; a blank line stays one paragraph
    break. Labelled blocks win over bare numbers.
    """

    @F.pandas_udf(ArrayType(StringType()))
    def parse(texts: pd.Series) -> pd.Series:
        import re

        end = r"\s*[:.\-–—]\s*(.*)$"
        labelled = re.compile(rf"^-?\s*(?:{re.escape(label)}\s+(?:turn\s+|response\s+)?\d+(?:\s*\([^)]*\))?|\d+\s*[).:\-–—]\s*{re.escape(label)}(?:\s+turn|\s+response)?){end}", re.I)
        bare = re.compile(r"^-?\s*\d+\s*[).:-]\s*(.*)$")

        def blocks(text: str | None, pattern: re.Pattern) -> list[str]:
            out: list[list[str]] = []
            for line in (text or "").splitlines():
                if m := pattern.match(line.strip()):
                    out.append([m[1].strip()])
                elif out:
                    out[-1].append(line.strip())
            return [re.sub(r"\n{3,}", "\n\n", "\n".join(b)).strip() for b in out]

        return texts.map(lambda t: blocks(t, labelled) or blocks(t, bare))

    return parse


def weave(roles: Column, users: Column, assistants: Column) -> Column:
    """array of struct(role, content): each role takes its next turn, in the order of ``roles``."""

    def turn(role: Column, i: Column) -> Column:
        nth = F.size(F.filter(F.slice(roles, 1, i + 1), lambda r: r == role)) - 1
        return F.struct(role.alias("role"), F.when(role == "user", F.get(users, nth)).otherwise(F.get(assistants, nth)).alias("content"))

    return F.transform(roles, turn)


def fallback_skeleton(acts: Column) -> Column:
    """array of struct(role, act): every user act and an answer to it, where a model gave no skeleton."""
    pair = lambda a: F.array(F.struct(F.lit("user").alias("role"), a.alias("act")), F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("respond_to_"), a).alias("act")))
    return F.flatten(F.transform(acts, pair))
