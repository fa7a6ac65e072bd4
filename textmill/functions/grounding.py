"""Grounding rules over token sets: whether an answer rests on its evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def retrieval_grounded(source_id: Column, retrieved_ids: Column, teacher: Column, retrieved: Column) -> Column:
    """Something was retrieved: the row's own source, or at least three of the teacher's tokens."""
    return (F.size(retrieved_ids) > 0) & (F.array_contains(retrieved_ids, source_id) | (overlap(teacher, retrieved) >= 3))


def reasoning_grounded(reasoning: Column, evidence: Column, target: Column) -> Column:
    return (F.size(reasoning) >= 6) & (overlap(reasoning, evidence) >= 3) & (overlap(reasoning, target) >= 1)


def coverage_supported(points: Column, answer: Column) -> Column:
    """``points`` is an array of token arrays; one point must hold, two if there are more than two."""
    held = F.size(F.filter(points, lambda p: (F.size(p) > 0) & ((overlap(p, answer) >= 2) | (overlap(p, answer) / F.size(p) >= 0.4))))
    need = F.when(F.size(points) <= 2, 1).otherwise(2)
    return F.when(F.size(points) == 0, True).when(F.size(answer) == 0, False).otherwise(held >= need)


def answer_supported(target: Column, evidence: Column, covered: Column, grounded: Column) -> Column:
    """Subset of the evidence, or an overlap of three with a share of 0.35 or the two other rules."""
    shared = overlap(target, evidence)
    rest = (shared >= 3) & ((shared / F.size(target) >= 0.35) | (covered & grounded))
    return (F.size(target) > 0) & (subset(target, evidence) | rest)


def statement_supported(statement: Column, cited: Column) -> Column:
    """All tokens; or all but one (two at least) of three or four; or three and a share of 0.3."""
    n, shared = F.size(statement), overlap(statement, cited)
    short = F.when(n <= 2, shared == n).when(n <= 4, shared >= F.greatest(F.lit(2), n - 1))
    return F.when(n == 0, False).otherwise((shared == n) | short.otherwise((shared >= 3) & (shared / n >= 0.3)))


def reasons(**failed: Column) -> Column:
    """Names of the failed rules in the order given."""
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in failed.items()]), lambda r: r.isNotNull())
