"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelake.llm.cross_tokens import op13_cross_tokens
from pricelake.llm.decontamination import OP10_SQL, op10_decontamination
from pricelake.llm.jaccard_join import op5_jaccard_join
from pricelake.llm.language_id import op4_language_id
from pricelake.llm.language_model import op7_language_model
from pricelake.llm.line_dedup import OP8_SQL, op8_line_dedup
from pricelake.llm.outlier_rules import op2_outlier_rules
from pricelake.llm.quality_classifier import op9_quality_classifier
from pricelake.llm.source_mix import op3_source_mix
from pricelake.llm.token_counts import op1_token_counts
from pricelake.llm.token_files import op12_token_files
from pricelake.llm.toxicity import op6_toxicity
from pricelake.llm.whitening import op11_whitening


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By name; the name begins with the operator's number."""
    return {query.__name__: query for query in (
        op1_token_counts, op2_outlier_rules, op3_source_mix, op4_language_id, op5_jaccard_join, op6_toxicity,
        op7_language_model, op8_line_dedup, op9_quality_classifier, op10_decontamination,
        op11_whitening, op12_token_files, op13_cross_tokens)}


def llm_sql() -> dict[str, str]:
    return {"op8_line_dedup": OP8_SQL, "op10_decontamination": OP10_SQL}
