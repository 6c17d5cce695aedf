"""Registered queries of this package, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marea.llm import (filter_audit, fingerprint, licenses, mixing, near_dup, ngram_join, packing, periodic_runs, pii,
                       quality, sharding, top_k_lists, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dup": near_dup.op1_near_dup,
    "op2_mixing": mixing.op2_mixing,
    "op3_quality": quality.op3_quality,
    "op4_packing": packing.op4_packing,
    "op5_pii": pii.op5_pii,
    "op6_fingerprint": fingerprint.op6_fingerprint,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_sharding": sharding.op8_sharding,
    "op9_licenses": licenses.op9_licenses,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_top_k_lists": top_k_lists.op11_top_k_lists,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

CHECKS: dict[str, str] = {
    "op1_near_dup": near_dup.OP1_SQL,
    "op2_mixing": mixing.OP2_SQL,
    "op9_licenses": licenses.OP9_SQL,
    "op10_ngram_join": ngram_join.OP10_SQL,
    "op11_top_k_lists": top_k_lists.OP11_SQL,
    "op12_periodic_runs": periodic_runs.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
