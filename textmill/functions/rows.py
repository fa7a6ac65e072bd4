"""Row-level projections: families, language modes, sources, responses, generation failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import path_text


def row_family(family: Column, row_id: Column, known: list[str]) -> Column:
    """The stated family, else the known one that the id starts with."""
    by_id = None
    for name in sorted(known, key=len, reverse=True):
        hit = row_id.startswith(f"{name}-")
        by_id = F.when(hit, name) if by_id is None else by_id.when(hit, name)
    return F.coalesce(path_text(family), by_id) if by_id is not None else path_text(family)


def language_mode(source: Column, *others: Column) -> Column:
    """same_language if every other language is the source's, else cross_language."""
    same = F.lit(True)
    for other in others:
        same = same & (F.coalesce(other, source) == source)
    return F.when(same, "same_language").otherwise("cross_language")


def required_citations(n_sources: Column) -> Column:
    """Two sources have to be cited if there are two or more, else one."""
    return F.when(n_sources >= 2, 2).otherwise(1)


def with_source(sources: Column, kind: Column, value: Column) -> Column:
    """Append (kind, value) to an array of such structs unless the kind is there."""
    return F.when(F.exists(sources, lambda s: s["kind"] == kind), sources).otherwise(
        F.array_append(sources, F.struct(kind.alias("kind"), value.alias("value")))
    )


def response_text(target: Column, messages: Column) -> Column:
    """The target; without one the last message, if the assistant's."""
    last = F.try_element_at(messages, F.lit(-1))
    return F.coalesce(path_text(target), F.when(last["role"] == "assistant", last["content"]))


def candidate_count(rows: int, multiplier: float) -> int:
    """Candidates to draw for ``rows`` accepted ones."""
    from math import ceil

    return max(rows, ceil(rows * multiplier))


def attempts(rows: int) -> int:
    """Draws allowed for a quota."""
    return max(4 * rows, rows + 50)


def upgraded_target(target: Column, sentence: Column, better: Column) -> Column:
    """A better target where the present one is empty or only repeats the source sentence."""
    weak = path_text(target).isNull() | (F.trim(target) == F.trim(sentence))
    return F.when(weak & path_text(better).isNotNull(), better).otherwise(target)


def merge_unique(a: Column, b: Column) -> Column:
    """Values of both lists in order, once each."""
    return F.array_union(F.coalesce(a, F.expr("cast(array() as array<string>)")), F.coalesce(b, F.expr("cast(array() as array<string>)")))


def clean_prompt(text: Column) -> Column:
    """A generated prompt out of its code fence and its quotes."""
    t = F.trim(text)
    fenced = t.startswith("```") & t.endswith("```") & (F.size(F.split(t, "\n")) >= 3)
    inner = F.trim(F.array_join(F.slice(F.split(t, "\n"), 2, F.greatest(F.size(F.split(t, "\n")) - 2, F.lit(0))), "\n"))
    bare = F.when(fenced, inner).otherwise(t)
    quoted = bare.startswith('"') & bare.endswith('"') & (F.length(bare) >= 2)
    return F.when(quoted, F.trim(F.substr(bare, F.lit(2), F.greatest(F.length(bare) - 2, F.lit(0))))).otherwise(bare)


def placeholder(text: Column) -> Column:
    """Whether an answer is empty or a stand-in."""
    t = F.lower(F.trim(text))
    return (t == "") | (t.contains("<") & t.contains(">")) | t.contains("det endelige svar") | t.contains("final answer")
