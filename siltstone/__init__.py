"""Siltstone: a Spark-native crawl-chunk lakehouse.

Crawled text settles in layers: topic records become chunks, chunks become
bronze JSON, bronze is refined into silver.  Every operator takes a DataFrame
and returns a DataFrame (or a Column) and keeps the work inside Catalyst.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them, so executors need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .functions.rules import keyword_policy, link_total_score, prompt, traversal_allowed, verdict  # noqa: E402
from .functions.text import clean_tokens, tokens  # noqa: E402
from .functions.urls import authority, base_domain, is_external, normalize_url, path, target_dir  # noqa: E402
from .functions.vectors import cosine, cosine_distance, normalise_embedding  # noqa: E402
from .operators.adaptive import confidence, consistency, coverage, link_gain, saturation, top_links  # noqa: E402
from .operators.chunking import (  # noqa: E402
    chunk_fixed,
    chunk_identity,
    chunk_overlapping,
    chunk_regex,
    chunk_sentences,
    chunk_sliding,
    merge_by_tokens,
    merge_whole,
)
from .operators.entities import entities, entity_counts  # noqa: E402
from .operators.frontier import counters, first_seen, session_summary, unvisited  # noqa: E402
from .operators.gap_links import covers, gap_filling_links  # noqa: E402
from .operators.gate import Policy, ask_and_gate, keyword_filter, keyword_policies, relevance_gate, score_relevance  # noqa: E402
from .operators.links import filter_chain, filter_stats, intrinsic_score, score_stats, score_urls, seed_admission  # noqa: E402
from .operators.pages import link_citations, link_preview, page_links, page_metadata, page_text, seed_discovery  # noqa: E402
from .operators.policies import policy_matches  # noqa: E402
from .operators.postings import build_postings, stored_bm25, stored_top_k  # noqa: E402
from .operators.ranking import bm25, bm25_filter, new_terms, saturation_history, top_k  # noqa: E402
from .operators.records import group_flush, to_bronze_record  # noqa: E402
from .operators.terms import corpus_stats, semantic_records, term_stats, topic_keywords, trigram_counts, trigrams  # noqa: E402
from .operators.traversal import best_first, bfs, traversal_stats  # noqa: E402
from .operators.vectors import clusters, dedup, gaps, similarity_labels, top_k_similar  # noqa: E402
from .plans.crawl import chunk_messages, crawl_chunks, seed_messages, visited_messages  # noqa: E402
from .plans.silver import classified, deduped, hashed, pieces, row_count, sample, silver, silver_sql, time_buckets, vertical  # noqa: E402
from .plans.silver_delta import apply_batch, silver_now  # noqa: E402
from .schema import BRONZE, DISCOVERY, TOPIC, enforce  # noqa: E402
from .sources.config import active_config, read_configs, read_seeds, seed_urls  # noqa: E402
from .sources.lake import export_kb, file_inventory, import_kb, read_bronze, with_ingested_date, write_bronze  # noqa: E402
from .sources.topics import decode, encode, next_offsets, read_topic, write_topic, write_topic_stream  # noqa: E402
from .sources.visited import Visited  # noqa: E402
from .streaming.event_time import count_windows, counted, late_rows, window_counts  # noqa: E402
from .streaming.first_seen import earliest_messages, first_seen_job, settled  # noqa: E402
from .streaming.jobs import IdleMonitor, RunCounters, discovery, first_seen_stream, ingest, run_counters  # noqa: E402

__version__ = "0.1.0"
__all__ = [name for name in dir() if not name.startswith("_") and name not in ("sys", "cloudpickle")]
