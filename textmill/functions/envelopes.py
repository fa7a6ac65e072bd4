"""Answer envelopes: an answer's lines wrapped as a labelled block, JSON, XML or YAML, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .render import json_string

KINDS = ("block", "json", "xml", "yaml")


def _lines(answer: Column) -> Column:
    return F.transform(F.split(answer, "\n"), lambda x: F.rtrim(x))


def wrap(kind: Column, answer: Column, label: Column) -> Column:
    """The answer in its envelope; lines keep their order."""
    ls = _lines(answer)
    quoted = F.transform(ls, lambda x: json_string(x))
    as_json = F.concat(F.lit('{\n  "answer_lines": [\n    '), F.array_join(quoted, ",\n    "), F.lit("\n  ]\n}"))
    as_xml = F.concat(F.lit("<response>\n"), F.array_join(F.transform(ls, lambda x: F.concat(F.lit("  <line>"), x, F.lit("</line>"))), "\n"), F.lit("\n</response>"))
    as_yaml = F.concat(F.lit("answer_lines:\n"), F.array_join(F.transform(quoted, lambda x: F.concat(F.lit("  - "), x)), "\n"))
    return F.when(kind == "json", as_json).when(kind == "xml", as_xml).when(kind == "yaml", as_yaml).otherwise(F.trim(F.concat(label, F.lit(":\n"), answer)))


def unwrap(kind: Column, text: Column, label: Column) -> Column:
    """The answer in a response that ends with its envelope; null where the envelope is missing.

    Of several envelopes the last one holds.
    """
    last = lambda found: F.try_element_at(found, F.lit(-1))
    body = last(F.regexp_extract_all(text, F.lit(r'(?s)(\{\s*"answer_lines"\s*:\s*\[.*?\]\s*\})'), F.lit(1)))
    as_json = F.array_join(F.from_json(body, "answer_lines array<string>")["answer_lines"], "\n")
    block = last(F.regexp_extract_all(text, F.lit(r"(?s)<response>(.*?)</response>"), F.lit(1)))
    as_xml = F.array_join(F.regexp_extract_all(block, F.lit(r"<line>(.*?)</line>"), F.lit(1)), "\n")
    items = F.regexp_extract(text, r'(?s).*answer_lines:\n((?:\s*- "(?:[^"\\]|\\.)*"\n?)+)', 1)
    rows = F.regexp_extract_all(items, F.lit(r'(?m)^\s*- ("(?:[^"\\]|\\.)*")'), F.lit(1))
    as_yaml = F.array_join(F.from_json(F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")), "array<string>"), "\n")
    parts = F.split(text, F.concat(F.lit("\\Q"), label, F.lit("\\E:\\s*\\n?")), -1)
    as_block = F.when(F.size(parts) > 1, F.trim(last(parts)))
    return F.when(kind == "json", as_json).when(kind == "xml", as_xml).when(kind == "yaml", F.when(items != "", as_yaml)).otherwise(as_block)
