"""Queries of the operators and the pipeline, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module
from importlib.util import find_spec

from pyspark.sql import DataFrame

#: query name: module of this subpackage with query() and, where SQL can express it, ORACLE.
MODULES = {
    "op1_substring_dedup": "substring",
    "op2_pii_surrogates": "surrogates",
    "op3_embedding_near_dedup": "forest",
    "op4_ngram_jaccard_join": "jaccard",
    "op5_lm_scoring": "suffixtree",
    "op6_piece_encoding": "piececoding",
    "op7_nearest_neighbours": "neighbours",
    "op8_language_id": "langid",
    "op9_license_scan": "licenses",
    "op10_packing": "packing",
    "op11_cross_tokenizer_alignment": "alignment",
    "op12_source_divergence": "divergence",
    "op13_quality_classifier": "quality",
}


#: Queries of which SQL can say the same, beside those of the contract: module, function, SQL.
FURTHER = {"license_labels": ("licenses", "labels", "LABELS_ORACLE")}


def queries() -> dict[str, Callable[..., DataFrame]]:
    found = {name: import_module(f"glossmill.llm.{module}").query for name, module in MODULES.items() if find_spec(f"glossmill.llm.{module}")}
    return found | {name: getattr(import_module(f"glossmill.llm.{module}"), f) for name, (module, f, _) in FURTHER.items() if find_spec(f"glossmill.llm.{module}")}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"glossmill.llm.{module}"), "ORACLE", None) for name, module in MODULES.items() if find_spec(f"glossmill.llm.{module}")}
    found |= {name: getattr(import_module(f"glossmill.llm.{module}"), sql) for name, (module, _, sql) in FURTHER.items() if find_spec(f"glossmill.llm.{module}")}
    return {name: sql for name, sql in found.items() if sql}
