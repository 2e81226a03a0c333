"""The queries of this subpackage: name -> Spark query, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bm25_search, decontaminate, licenses, line_dedup, lloyd, mixing, near_dedup, token_alignment, toxicity, training_order, url_filters, vector_dedup, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_revisits": warc.query,
    "op2_toxicity": toxicity.query,
    "op3_mixing": mixing.query,
    "op4_bm25_wand": bm25_search.query,
    "op5_prob_minhash": near_dedup.query,
    "op6_spaced_seeds": decontaminate.query,
    "op7_url_filters": url_filters.query,
    "op8_training_order": training_order.query,
    "op9_licenses": licenses.query,
    "op10_fuzzy_lines": line_dedup.query,
    "op11_token_alignment": token_alignment.query,
    "op12_lloyd": lloyd.query,
    "op13_vector_dedup": vector_dedup.query,
}
ORACLE: dict[str, str] = {
    "op1_revisits": warc.SQL,
    "op4_bm25_wand": bm25_search.SQL,
    "op7_url_filters": url_filters.SQL,
    "op12_lloyd": lloyd.SQL,
    "op13_vector_dedup": vector_dedup.SQL,
}
