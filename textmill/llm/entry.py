"""The queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, html_text, language_id, language_model, oracles, packing, pii, quality, sharding, simhash, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_html_text": html_text.op2_html_text,
        "op3_packing": packing.op3_packing,
        "op4_sharding": sharding.op4_sharding,
        "op5_language_id": language_id.op5_language_id,
        "op6_quality": quality.op6_quality,
        "op7_language_model": language_model.op7_language_model,
        "op8_pii": pii.op8_pii,
        "op9_decontamination": decontamination.op9_decontamination,
        "op9_proximity": decontamination.op9_proximity,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_quality": oracles.QUALITY, "op9_decontamination": oracles.DECONTAMINATION}
