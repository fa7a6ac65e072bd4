"""Parsers of model answers: JSON, labels, cited statements, numbered lines."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def strip_fence(text: Column) -> Column:
    """The inside of a text that is one code fence, else the text, trimmed."""
    t = F.trim(text)
    inner = F.regexp_extract(t, r"(?s)^```[A-Za-z0-9_-]*\s*\n(.*?)\n?```$", 1)
    return F.when(t.rlike(r"(?s)^```[A-Za-z0-9_-]*\s*\n.*```$"), F.trim(inner)).otherwise(t)


@F.pandas_udf(StringType())
def json_object(texts: pd.Series) -> pd.Series:
    """The first balanced {...} of each text that is valid JSON, or null.

    Brackets inside strings do not count, which no regular expression can tell.
    """
    import json

    def first(text: str | None) -> str | None:
        if not text:
            return None
        decoder, at = json.JSONDecoder(), text.find("{")
        while at >= 0:
            try:
                value, end = decoder.raw_decode(text, at)
            except ValueError:
                at = text.find("{", at + 1)
                continue
            return text[at:end] if isinstance(value, dict) else None
        return None

    return texts.map(first)


def answer(text: Column) -> Column:
    """The last labelled answer of a response; without a label its last non-blank line."""
    label = r"(?im)^\s*(?:\*\*)?(?:final answer|answer|solution|final)(?:\*\*)?\s*:\s*(.+)$"
    found = F.regexp_extract_all(text, F.lit(label), F.lit(1))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    return F.trim(F.coalesce(F.try_element_at(found, F.lit(-1)), F.try_element_at(lines, F.lit(-1))))


def cited_statements(text: Column) -> Column:
    """array of struct(text, citations) of <statement cites="1 2">...</statement> elements."""
    whole = F.regexp_extract_all(text, F.lit(r'(?s)<statement\s+cites="([^"]*)">(.*?)</statement>'), F.lit(0))
    return F.transform(
        whole,
        lambda s: F.struct(
            F.trim(F.regexp_extract(s, r"(?s)>(.*?)</statement>", 1)).alias("text"),
            F.regexp_extract_all(F.regexp_extract(s, r'cites="([^"]*)"', 1), F.lit(r"[^\s,]+"), F.lit(0)).alias("citations"),
        ),
    )


def skeleton_steps(text: Column) -> Column:
    """array of struct(role, act, delta) of lines ``STEP n: role | act | delta``."""
    lines = F.regexp_extract_all(text, F.lit(r"(?im)^\s*STEP\s+\d+\s*:\s*(.+)$"), F.lit(1))
    parts = F.transform(lines, lambda x: F.transform(F.split(x, r"\|"), lambda x: F.trim(x)))
    return F.transform(F.filter(parts, lambda p: F.size(p) == 3), lambda p: F.struct(F.lower(p[0]).alias("role"), p[1].alias("act"), p[2].alias("delta")))


def query_plan(text: Column) -> Column:
    """Steps of a plan written with arrows, semicolons or on lines; dashes around a step are left out."""
    return F.filter(F.transform(F.split(text, r"\s*(?:->|=>|;|\n)\s*"), lambda x: F.btrim(x, F.lit(" -\t"))), lambda s: s != "")


def reasoning_failure(reasoning: Column, prompt: Column) -> Column:
    """Why a reasoning trace is not enough, or null: missing, too few steps, or a copy of the prompt."""
    steps = F.filter(F.transform(F.split(reasoning, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    asked = F.transform(F.split(prompt, "\n"), lambda x: F.trim(x))
    copied = F.size(F.filter(steps, lambda s: F.array_contains(asked, s)))
    n = F.size(steps)
    return (
        F.when(reasoning.isNull() | (n == 0), "missing_reasoning")
        .when(F.size(F.filter(steps, lambda s: F.length(s) >= 12)) < 3, "too_few_steps")
        .when((n >= 8) & (copied >= 6) & (copied >= n * 0.5), "copies_prompt")
    )
