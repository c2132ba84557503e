"""The queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxloom.llm import decontaminate, jaccard_join, language_model, line_dedup, packing, private_data, quality_rules, secrets, sharding, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query for each operator."""
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_packing": packing.op3_packing,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_private_data": private_data.op5_private_data,
        "op6_sharding": sharding.op6_sharding,
        "op7_jaccard_join": jaccard_join.op7_jaccard_join,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "op9_language_model": language_model.op9_language_model,
        "op10_warc": warc.op10_warc,
    }


def oracle_sql() -> dict[str, str]:
    """SQL with the same rows as the query of that name."""
    return {
        "op2_line_dedup": line_dedup.ORACLE,
        "op4_decontaminate": decontaminate.ORACLE,
        "op7_jaccard_join": jaccard_join.ORACLE,
        "op10_warc": warc.oracle(),
    }
