"""The subpackage's registered queries, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dwspark.llm import chat, decontam, langid, licenses, manifest, mixing, neardup, quality, shards, structure, suffix, tokens, wrapper
from dwspark.llm.tables import read

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    return {
        "op1_tool_calls": lambda s, d: chat.query(read(s, d, "conversations")),
        "op2_hilbert_shards": lambda s, d: shards.query(read(s, d, "documents")),
        "op3_language_fusion": lambda s, d: langid.classify(read(s, d, "pages"), read(s, d, "documents")),
        "op4_wrapper_induction": lambda s, d: wrapper.extract(read(s, d, "pages")),
        "op5_quality_rules": lambda s, d: quality.query(read(s, d, "documents")),
        "op6_bwt_repeats": lambda s, d: suffix.query(read(s, d, "documents")),
        "op7_template_decontam": lambda s, d: decontam.matches(read(s, d, "documents"), read(s, d, "benchmark")),
        "op8_license_scan": lambda s, d: licenses.scan(read(s, d, "documents")),
        "op9_source_mix": lambda s, d: mixing.query(read(s, d, "documents")),
        "op10_minhash_hamming": lambda s, d: neardup.link(read(s, d, "documents")),
        "op11_structure_repair": lambda s, d: structure.query(read(s, d, "conversations")),
        "op12_merkle_manifest": lambda s, d: manifest.query(read(s, d, "documents")),
        "op13_token_counts": lambda s, d: tokens.query(read(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": quality.sql(), "op8_license_scan": licenses.sql(), "op11_structure_repair": structure.sql(),
            "op12_merkle_manifest": manifest.sql()}
