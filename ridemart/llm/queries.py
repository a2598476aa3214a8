"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = {"op1_chat_format": "chat", "op2_weak_toxicity": "toxicity", "op3_rotated_bit_search": "ann", "op4_concat_packing": "packing", "op5_pii_surrogates": "pii", "op6_benchmark_decontamination": "decontamination",
            "op7_simhash_near_dedup": "simhash",
            "op8_quality_classifier": "quality", "op9_license_scan": "licenses", "op10_log_bilinear": "lm_scoring",
            "op11_source_mixing": "mixing", "op12_embedding_whitening": "whitening", "op13_prefix_trie": "prefix_trie"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"ridemart.llm.{module}"), name) for name, module in _MODULES.items()}


def oracle_sql() -> dict[str, str]:
    from ridemart.llm.chat import OP1_SQL
    from ridemart.llm.decontamination import OP6_SQL
    from ridemart.llm.mixing import OP11_SQL
    from ridemart.llm.prefix_trie import OP13_SQL

    return {"op1_chat_format": OP1_SQL, "op6_benchmark_decontamination": OP6_SQL, "op11_source_mixing": OP11_SQL,
            "op13_prefix_trie": OP13_SQL}
