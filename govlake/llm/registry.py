"""Queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from govlake.llm import decontamination, jaccard_join, line_dedup, quality_rules, revisits, substring_dedup, vector_codes
from govlake.llm.decontamination import op1_decontamination
from govlake.llm.html_extract import op2_html_extract
from govlake.llm.jaccard_join import op9_jaccard_join
from govlake.llm.language_id import op6_language_id
from govlake.llm.packing import op3_best_fit_packing
from govlake.llm.periodic_runs import op13_periodic_runs
from govlake.llm.pii import op4_pii_surrogates
from govlake.llm.substring_dedup import op5_substring_dedup
from govlake.llm.suffix_dedup import op7_suffix_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_html_extract": op2_html_extract,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_language_id": op6_language_id,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_revisits": revisits.op10_revisits,
    "op11_line_dedup": line_dedup.op11_line_dedup,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op1_decontamination": decontamination.SQL,
    "op5_substring_dedup": substring_dedup.SQL,
    "op8_quality_rules": quality_rules.SQL,
    "op9_jaccard_join": jaccard_join.SQL,
    "op10_revisits": revisits.SQL,
    "op11_line_dedup": line_dedup.SQL,
    "op12_vector_codes": vector_codes.SQL,
}
