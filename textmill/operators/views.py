"""Ad-hoc views over artifacts: facets, substring search, pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ViewSpec:
    """Which columns a view searches, filters by and shows."""

    key: str
    search: Sequence[str] = ()
    facets: Sequence[str] = ()
    show: Sequence[str] = field(default_factory=tuple)


def facet_values(rows: DataFrame, facets: Sequence[str]) -> DataFrame:
    """(facet, value, n) of the non-empty values, in one scan."""
    pairs = F.array(*[F.struct(F.lit(f).alias("facet"), F.trim(F.col(f).cast("string")).alias("value")) for f in facets])
    each = rows.select(F.explode(pairs).alias("p")).select("p.*").where("value IS NOT NULL AND value <> ''")
    return each.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def search_text(spec: ViewSpec) -> Column:
    return F.lower(F.concat_ws("\n", *[F.col(c).cast("string") for c in spec.search]))


def matching(rows: DataFrame, spec: ViewSpec, query: str = "", chosen: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows with the query in their search text and, for every facet chosen, one of its values."""
    out = rows.where(search_text(spec).contains(query.strip().lower())) if query.strip() else rows
    for facet, values in (chosen or {}).items():
        out = out.where(F.col(facet).cast("string").isin(*values))
    return out


def page(rows: DataFrame, spec: ViewSpec, number: int = 1, size: int = 40) -> DataFrame:
    """One page in key order. The page is at least 1, its size 1 to 200; beyond the end it is empty."""
    size = min(max(size, 1), 200)
    return rows.orderBy(spec.key).offset((max(number, 1) - 1) * size).limit(size).select(spec.key, *spec.show)


def page_count(rows: DataFrame, size: int = 40) -> DataFrame:
    """(total_rows, total_pages): at least one page."""
    size = min(max(size, 1), 200)
    n = F.count(F.lit(1))
    return rows.agg(n.alias("total_rows"), F.greatest(F.lit(1), F.ceil(n / size)).cast("long").alias("total_pages"))
