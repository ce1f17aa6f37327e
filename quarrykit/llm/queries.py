"""The registered queries of this subpackage and the SQL of those that SQL can express.

All modules are imported here, so that the subpackage as a whole can be imported or not."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe_automaton, exact_dedup, hard_negatives, html_extract, language_id, packing, quality, quality_model, secrets, simhash, token_counts, token_files

#: Query and its module.
WHERE = {
    "op1_html_extract": html_extract,
    "op2_exact_dedup": exact_dedup,
    "op3_language_id": language_id,
    "op4_bpe_automaton": bpe_automaton,
    "op5_secret_scan": secrets,
    "op6_token_counts": token_counts,
    "op7_simhash": simhash,
    "op8_token_files": token_files,
    "op9_quality_rules": quality,
    "op10_packing": packing,
    "op11_quality_classifier": quality_model,
    "op12_alignment": alignment,
    "op13_hard_negatives": hard_negatives,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(module, name) for name, module in WHERE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in WHERE.items() if getattr(module, "SQL", None)}
