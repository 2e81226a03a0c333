"""What a crawl publishes: seed, visited and chunk messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.chunking import chunk_overlapping
from ..operators.links import seed_admission
from ..scale import skew_join
from ..sources.topics import encode

# Chunk size of the crawl, in words; the topics; the value of a visited message.
WINDOW = 500
OVERLAP = 50
SEED_TOPIC = "discovery_queue"
VISITED_TOPIC = "visited_urls"
CHUNK_TOPIC = "relevant_chunks"
VISITED_MARK = "1"


def seed_messages(seeds: DataFrame, blocked: Sequence[str] = (), topic: str = SEED_TOPIC) -> DataFrame:
    """Admitted seeds (language, url) as discovery messages keyed by URL."""
    return encode(seed_admission(seeds, blocked=blocked), topic, "url", ["url", "language"])


def visited_messages(urls: DataFrame, topic: str = VISITED_TOPIC) -> DataFrame:
    """URLs as visited messages: the key is the URL, the value a mark."""
    return urls.select(
        F.lit(topic).alias("topic"), F.col("url").cast("string").alias("key"), F.lit(VISITED_MARK).alias("value")
    )


def crawl_chunks(
    work: DataFrame,
    pages: DataFrame,
    now: Column | float,
    window: int = WINDOW,
    overlap: int = OVERLAP,
    text: str = "text",
) -> DataFrame:
    """Bronze-shaped chunk records of the crawled pages.

    `work(url, language)` lists the sessions, unique by `url`; `pages(seed, url,
    text)` is what each session found.  A page's chunks carry the session's
    language.  A seed may own much of the pages, so beyond 100,000
    sessions the join is salted by page.
    """
    sessions = work.select(F.col("url").alias("seed"), F.coalesce("language", F.lit("en")).alias("language"))
    found = skew_join(pages.select("seed", "url", text), sessions, "seed", spread=["url"], broadcast_rows=100_000)
    stamp = F.lit(float(now)) if isinstance(now, (int, float)) else now
    return chunk_overlapping(found, window, overlap, text=text, url="url").select(
        "seed",
        "chunk_id",
        F.col("url").alias("source_url"),
        F.col("chunk").alias("content"),
        stamp.cast("double").alias("ingested_at"),
        "language",
    )


def chunk_messages(chunks: DataFrame, topic: str = CHUNK_TOPIC) -> DataFrame:
    """Chunk records as topic messages keyed by page URL."""
    return encode(chunks, topic, "source_url", ["chunk_id", "source_url", "content", "ingested_at", "language"])
