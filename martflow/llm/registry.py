"""Registered queries of this package: name -> plan, and DuckDB SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import (exact_dedup, html_extract, language_id, line_dedup, merkle, minhash, mixing, packing, quality,
               spelling, substring_dedup, token_counts, warc)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": html_extract.op1_html_extraction,
        "op2_language_id": language_id.op2_language_id,
        "op3_minhash_near_dedup": minhash.op3_minhash_near_dedup,
        "op4_quality_rules": quality.op4_quality_rules,
        "op5_token_counts": token_counts.op5_token_counts,
        "op6_best_fit_packing": packing.op6_best_fit_packing,
        "op7_substring_dedup": substring_dedup.op7_substring_dedup,
        "op8_mixing": mixing.op8_mixing,
        "op9_line_dedup": line_dedup.op9_line_dedup,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
        "op11_merkle_manifest": merkle.op11_merkle_manifest,
        "op12_warc": warc.op12_warc,
        "op13_spelling_variants": spelling.op13_spelling_variants,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    sql = {"op3_minhash_near_dedup": minhash.OP3_SQL, "op7_substring_dedup": substring_dedup.OP7_SQL,
           "op10_exact_dedup": exact_dedup.OP10_SQL, "op11_merkle_manifest": merkle.OP11_SQL,
           "op12_warc": warc.OP12_SQL, "op13_spelling_variants": spelling.OP13_SQL}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
